"""Curated routes: the CSV scan and the route dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.operators.dedup import first_wins
from pathweave.operators.ranking import global_rank
from pathweave.operators.spatial_join import nearest_within

# Ids and names of the curated routes.
ROUTES = (
    (1, "아라자전거길"), (2, "한강종주자전거길"), (3, "남한강자전거길"),
    (4, "새재자전거길"), (5, "낙동강자전거길"), (6, "금강자전거길"),
    (7, "영산강자전거길"), (8, "북한강자전거길"), (9, "섬진강자전거길"),
    (10, "오천자전거길"), (11, "동해안(강원)자전거길"),
    (12, "동해안(경북)자전거길"), (13, "제주환상자전거길"),
)
# The columns of the CSV, by our names.
COLUMNS = {"순서": "sequence", "국토종주 자전거길": "route_id", "위도(LINE_XP)": "lat", "경도(LINE_YP)": "lon"}


def routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ROUTES), "id int, name string")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """(idx, route_id, sequence, lat, lon) of a CSV with a header; rows with a bad value or an
    unknown route vanish, and idx counts the rest in file order from 0.
    """
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    kinds = {"sequence": "int", "route_id": "int", "lat": "double", "lon": "double"}
    own = raw.select(*[F.trim(F.col(f"`{c}`")).try_cast(kinds[n]).alias(n) for c, n in COLUMNS.items()], place.alias("place"))
    known = own.dropna(subset=list(kinds)).where(F.col("route_id").between(1, len(ROUTES)))
    return global_rank(known, [F.col("place")], "idx").select("idx", "route_id", "sequence", "lat", "lon")


def official_nodes(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node_id, route_id, sequence) of the points matched; the first by idx wins a key."""
    known = points.where(F.col("route_id").between(1, len(ROUTES)))
    near = nearest_within(known.select("idx", "lat", "lon"), nodes).select("idx", "node_id")
    found = near.join(known.select("idx", "route_id", "sequence"), "idx")
    return first_wins(found.select("node_id", "route_id", "sequence", "idx"), ["node_id", "route_id"], F.col("idx")).drop("idx")
