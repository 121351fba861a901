"""Elevation from raster tiles."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.functions.geo import tile_name

#: Grid sizes that a tile may have; nodes that one task handles with a tile.
SIDES, NODES_A_TASK = (1201, 3601), 200_000
# File names of a tile in the order of preference.
SPELLINGS = ("{}.hgt", "{}.hgt.zip", "{}.SRTMGL1.hgt.zip", "{}.SRTMGL3.hgt.zip")


def unpacked(name: str, content: bytes) -> bytes | None:
    """A tile file's raster; None if it is a zip without one or no zip at all."""
    if not name.endswith(".zip"):
        return content
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            inner = next((n for n in z.namelist() if n.endswith(".hgt")), None)
            return z.read(inner) if inner else None
    except zipfile.BadZipFile:
        return None


def read_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """(tile, content) of a folder; of several files for a tile the first spelling that can be read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.hgt*").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def open_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for file, content in zip(pdf["file"], pdf["content"], strict=True):
                tile = file.split(".")[0]
                known = [s.format(tile) for s in SPELLINGS]
                data = unpacked(file, content) if file in known else None
                if data is not None:
                    rows.append((tile, known.index(file), data))
            yield pd.DataFrame(rows, columns=["tile", "rank", "content"])

    found = files.mapInPandas(open_all, "tile string, rank int, content binary")
    return found.groupBy("tile").agg(F.min_by("content", "rank").alias("content"))


def packed(tiles: DataFrame, zipped: list[str]) -> DataFrame:
    """(file, content) of tiles (tile, content): archives for the tiles named, plain files for the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for tile, content in zip(pdf["tile"], pdf["content"], strict=True):
                if tile not in zipped:
                    rows.append((SPELLINGS[0].format(tile), content))
                    continue
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(f"{tile}.hgt", content)
                rows.append((SPELLINGS[1].format(tile), held.getvalue()))
            yield pd.DataFrame(rows, columns=["file", "content"])

    return tiles.select("tile", "content").mapInPandas(run, "file string, content binary")


def interpolate(content: bytes | None, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Bilinear over the four samples around; voids count as 0; half-even rounding.

    A raster that is no square of a known size gives 0.
    """
    side = next((s for s in SIDES if content is not None and len(content) == 2 * s * s), None)
    if side is None:
        return np.zeros(len(lat), np.int32)
    grid = np.frombuffer(content, ">i2").reshape(side, side)
    y = (np.floor(lat) + 1 - lat) * (side - 1)
    x = (lon - np.floor(lon)) * (side - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, side - 1), np.minimum(x0 + 1, side - 1)
    at = lambda r, c: np.where(grid[r, c] == -32768, 0, grid[r, c]).astype(float)
    fx, fy = x - x0, y - y0
    north = at(y0, x0) * (1 - fx) + at(y0, x1) * fx
    south = at(y1, x0) * (1 - fx) + at(y1, x1) * fx
    return np.rint(north * (1 - fy) + south * fy).astype(np.int32)


def elevations(nodes: DataFrame, tiles: DataFrame) -> DataFrame:
    """(id, lat, lon, ele) of nodes (id, lat, lon); a missing tile gives 0.

    Nodes of a tile are dealt to chunks of bounded size and each chunk meets the tile once, so
    neither a tile nor a dense region is gathered in one task.
    """
    own = nodes.select("id", "lat", "lon", tile_name(F.col("lat"), F.col("lon")).alias("tile"))
    chunks = own.groupBy("tile").agg(F.ceil(F.count("*") / NODES_A_TASK).cast("int").alias("chunks"))
    left = own.join(chunks, "tile").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int")).drop("chunks")
    right = tiles.join(chunks, "tile").select("tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "content")

    def run(points: pd.DataFrame, raster: pd.DataFrame) -> pd.DataFrame:
        content = bytes(raster["content"].iloc[0]) if len(raster) else None
        return pd.DataFrame({"id": points["id"], "lat": points["lat"], "lon": points["lon"], "ele": interpolate(content, points["lat"].to_numpy(), points["lon"].to_numpy())})

    return left.groupBy("tile", "chunk").cogroup(right.groupBy("tile", "chunk")).applyInPandas(run, "id bigint, lat double, lon double, ele int")


def plane_tiles(spark: SparkSession, names: list[str], a: int, b: int, side: int = 1201) -> DataFrame:
    """Synthetic tiles whose sample at (row, column) is a * row + b * column."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            grid = (a * np.arange(side)[:, None] + b * np.arange(side)[None, :]).astype(">i2").tobytes()
            yield pd.DataFrame({"tile": pdf["tile"], "content": [grid] * len(pdf)})

    return spark.createDataFrame([(n,) for n in names], "tile string").mapInPandas(make, "tile string, content binary")
