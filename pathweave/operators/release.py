"""Release manifests: hashing, merging, compression and totals."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta, timezone
from pathlib import Path
from typing import IO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASSET = "file string, size bigint, sha256 string, downloadFile string, downloadSize bigint, downloadSHA256 string, compression string"
MANIFEST = (
    f"schemaVersion int, release string, generatedAt string, baseURL string, nationwideRouting struct<{ASSET.replace(' ', ':').replace(',:', ',')}>, "
    f"searchIndexes map<string, struct<{ASSET.replace(' ', ':').replace(',:', ',')}>>, "
    f"regions array<struct<id:string,name:string,south:double,west:double,north:double,east:double,available:boolean,mapFile:string,size:bigint,sha256:string,routing:struct<{ASSET.replace(' ', ':').replace(',:', ',')}>>>"
)
CHUNK = 1 << 20
KST = timezone(timedelta(hours=9))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row."""
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)


def assets(manifest: DataFrame) -> DataFrame:
    """The compressible assets as rows (grp, id, asset fields): nationwide, search, regional."""
    one = lambda grp, key, col: (F.lit(grp).alias("grp"), key.alias("id"), col.alias("a"))
    nation = manifest.where("nationwideRouting is not null").select(*one("nationwide", F.lit(None).cast("string"), F.col("nationwideRouting")))
    search = manifest.select(F.explode("searchIndexes").alias("k", "v")).select(*one("search", F.col("k"), F.col("v")))
    region = manifest.select(F.explode("regions").alias("r")).where("r.routing is not null").select(*one("regional", F.col("r.id"), F.col("r.routing")))
    return nation.unionByName(search).unionByName(region).select("grp", "id", "a.*")


def totals(rows: DataFrame) -> DataFrame:
    """Assets, original, transfer, ratio (three decimals; null without assets)."""
    out = rows.agg(F.count("*").alias("assets"), F.coalesce(F.sum("size"), F.lit(0)).alias("original"), F.coalesce(F.sum("downloadSize"), F.lit(0)).alias("transfer"))
    return out.withColumn("ratio", F.when(F.col("original") > 0, F.format_string("%.3f", F.col("transfer") / F.col("original"))))


@contextmanager
def installed(target: Path) -> Iterator[IO[bytes]]:
    """A file to write that stands under its name only when it is whole (M6): a task that dies, or a
    second try of one beside it, never leaves a part of it there.
    """
    part = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    try:
        with open(part, "wb") as f:
            yield f
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)


def store_assets(files: DataFrame, folder: str) -> DataFrame:
    """Write rows (file, content) as files of a shared folder; (path) of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Path(folder).mkdir(parents=True, exist_ok=True)
        for pdf in batches:
            paths = [Path(folder) / name for name in pdf["file"]]
            for path, content in zip(paths, pdf["content"], strict=True):
                with installed(path) as f:
                    f.write(content)
            yield pd.DataFrame({"path": [str(p) for p in paths]})

    return files.select("file", "content").mapInPandas(run, "path string")


def hashed(paths: DataFrame) -> DataFrame:
    """Paths (path) as (path, size, sha256), read in chunks on the executors from a shared folder.

    size and sha256 are null where there is no file (F13 is then an anti-join).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                if not Path(path).is_file():
                    rows.append((path, None, None))
                    continue
                digest, size = hashlib.sha256(), 0
                with open(path, "rb") as f:
                    while part := f.read(CHUNK):
                        digest.update(part)
                        size += len(part)
                rows.append((path, size, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "size", "sha256"]).astype({"size": "Int64"})

    return paths.select("path").mapInPandas(run, "path string, size bigint, sha256 string")


def require(found: DataFrame) -> DataFrame:
    """found, or FileNotFoundError if a file is missing."""
    missing = [r["path"] for r in found.where("sha256 is null").limit(5).collect()]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    return found


def compressed(paths: DataFrame, out: str, codec: str = "gzip") -> DataFrame:
    """Write each file compressed to a folder that all executors share unless a newer one is there;
    (path, downloadFile, downloadSize, downloadSHA256, compression). Codecs: gzip, zlib.
    """
    ending = {"gzip": "gz", "zlib": "zz"}[codec]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Path(out).mkdir(parents=True, exist_ok=True)
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                source, target = Path(path), Path(out) / f"{Path(path).name}.{ending}"
                if not target.exists() or target.stat().st_mtime < source.stat().st_mtime:
                    pack = zlib.compressobj(9, zlib.DEFLATED, 31 if codec == "gzip" else 15)
                    with open(source, "rb") as f, installed(target) as t:
                        while part := f.read(CHUNK):
                            t.write(pack.compress(part))
                        t.write(pack.flush())
                digest = hashlib.sha256()
                with open(target, "rb") as f:
                    while part := f.read(CHUNK):
                        digest.update(part)
                rows.append((path, target.name, target.stat().st_size, digest.hexdigest(), codec))
            yield pd.DataFrame(rows, columns=["path", "downloadFile", "downloadSize", "downloadSHA256", "compression"])

    return paths.select("path").mapInPandas(run, "path string, downloadFile string, downloadSize bigint, downloadSHA256 string, compression string")


def stamp(now: datetime | None = None) -> str:
    """The time in UTC+9 to the second, ISO 8601."""
    return (now or datetime.now(UTC)).astimezone(KST).replace(microsecond=0).isoformat()


def with_map_files(manifest: DataFrame, files: DataFrame, release: str, base_url: str, now: datetime | None = None) -> DataFrame:
    """M1, M3: new size and sha256 of each region's map by file name; its other fields survive.

    files: (file, size, sha256). A map without a file raises when the row is read (F13).
    """
    found = files.agg(F.map_from_entries(F.collect_list(F.struct("file", F.struct("size", "sha256")))).alias("__f"))
    hit = lambda r: F.try_element_at("__f", r["mapFile"])
    missing = lambda r: F.raise_error(F.concat(F.lit("Missing map: "), r["mapFile"]))
    merged = F.transform("regions", lambda r: r.withField("size", F.coalesce(hit(r)["size"], missing(r).cast("bigint"))).withField("sha256", hit(r)["sha256"]))
    own = manifest.join(F.broadcast(found))  # one row with one row
    own = own.withColumn("regions", merged).drop("__f")
    return header(own, release, base_url, now)


def with_routing_files(manifest: DataFrame, files: DataFrame, version: str) -> DataFrame:
    """M2: a fresh {file, size, sha256} for each region's routing; download fields are lost."""
    return _replaced(manifest, files, f".routing.{version}.sqlite", "regions")


def with_search_files(manifest: DataFrame, files: DataFrame, version: str = "v2") -> DataFrame:
    """M2 for the search indexes, one for each region."""
    return _replaced(manifest, files, f".places.{version}.sqlite", "searchIndexes")


def _replaced(manifest: DataFrame, files: DataFrame, suffix: str, where: str) -> DataFrame:
    found = files.agg(F.map_from_entries(F.collect_list(F.struct("file", F.struct("size", "sha256")))).alias("__f"))
    own = manifest.join(F.broadcast(found))  # one row with one row

    def asset(region):
        name = F.concat(region["id"], F.lit(suffix))
        hit = F.try_element_at("__f", name)
        none = F.lit(None)
        return F.struct(name.alias("file"), hit["size"].alias("size"), hit["sha256"].alias("sha256"), *[none.cast(t).alias(c) for c, t in (("downloadFile", "string"), ("downloadSize", "bigint"), ("downloadSHA256", "string"), ("compression", "string"))])

    if where == "regions":
        return own.withColumn("regions", F.transform("regions", lambda r: r.withField("routing", asset(r)))).drop("__f")
    return own.withColumn("searchIndexes", F.map_from_entries(F.transform("regions", lambda r: F.struct(r["id"], asset(r))))).drop("__f")


def header(manifest: DataFrame, release: str, base_url: str, now: datetime | None = None) -> DataFrame:
    return manifest.withColumns({"release": F.lit(release), "baseURL": F.lit(base_url), "generatedAt": F.lit(stamp(now))})


def verified(expected: DataFrame, found: DataFrame) -> DataFrame:
    """M6: expected (file, size, sha256) plus ok: a file of that size and hash is there."""
    have = found.select(F.col("file"), F.col("size").alias("__s"), F.col("sha256").alias("__h"))
    ok = (F.col("size") == F.col("__s")) & (F.col("sha256") == F.col("__h"))
    return expected.join(have, "file", "left").withColumn("ok", F.coalesce(ok, F.lit(False))).drop("__s", "__h")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The one row as JSON, indent 2, non-ASCII kept, a line feed at the end; nulls are left out."""
    row = manifest.limit(1).collect()[0].asDict(recursive=True)
    full = lambda x: {k: full(v) for k, v in x.items() if v is not None} if isinstance(x, dict) else [full(v) for v in x] if isinstance(x, list) else x
    with installed(Path(path)) as f:
        f.write((json.dumps(full(row), ensure_ascii=False, indent=2) + "\n").encode())


def unpack(content: bytes, codec: str) -> bytes:
    return gzip.decompress(content) if codec == "gzip" else zlib.decompress(content)
