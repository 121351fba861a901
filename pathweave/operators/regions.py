"""Regional extracts and tag filters (F1-F4, J7, P25), all regions in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.session import cut

# Region id, west, south, east, north.
REGIONS = (
    ("seoul", 126.76, 37.41, 127.20, 37.72),
    ("busan", 128.75, 34.95, 129.32, 35.39),
    ("daegu", 128.35, 35.55, 129.02, 36.02),
    ("incheon", 126.20, 37.30, 126.82, 37.72),
    ("gwangju", 126.64, 35.00, 127.02, 35.30),
    ("daejeon", 127.18, 36.17, 127.56, 36.50),
    ("ulsan", 129.00, 35.30, 129.49, 35.73),
    ("sejong", 127.12, 36.42, 127.38, 36.73),
    ("gyeonggi", 126.36, 36.88, 127.86, 38.30),
    ("gangwon", 127.05, 37.02, 129.37, 38.62),
    ("chungbuk", 127.25, 36.00, 128.65, 37.25),
    ("chungnam", 125.95, 35.95, 127.65, 37.10),
    ("jeonbuk", 126.30, 35.28, 127.88, 36.18),
    ("jeonnam", 125.85, 33.90, 127.88, 35.50),
    ("gyeongbuk", 127.80, 35.55, 130.95, 37.58),
    ("gyeongnam", 127.55, 34.55, 129.25, 35.95),
    ("jeju", 126.05, 33.05, 126.98, 33.62),
)
# Ways kept by the compact extract.
COMPACT_HIGHWAYS = ("cycleway", "trunk", "primary", "secondary", "tertiary", "service", "footway", "path", "pedestrian")


def regions(spark: SparkSession, rows: tuple = REGIONS) -> DataFrame:
    return spark.createDataFrame(list(rows), "id string, west double, south double, east double, north double")


def parse_region(entry: Column) -> Column:
    """P25: `id|west,south,east,north` as a struct."""
    box = F.split(F.split_part(entry, F.lit("|"), F.lit(2)), ",")
    ends = [F.get(box, F.lit(i)).try_cast("double").alias(c) for i, c in enumerate(("west", "south", "east", "north"))]
    return F.struct(F.split_part(entry, F.lit("|"), F.lit(1)).alias("id"), *ends)


def region_nodes(nodes: DataFrame, boxes: tuple = REGIONS) -> DataFrame:
    """(region, id): each node in each region whose box holds it, bounds included. Boxes may overlap."""
    inside = [F.when(F.col("lon").between(w, e) & F.col("lat").between(s, n), F.lit(name)) for name, w, s, e, n in boxes]
    return nodes.select(F.explode(F.array_compact(F.array(*inside))).alias("region"), "id")


def complete_ways(nodes: DataFrame, ways: DataFrame, boxes: tuple = REGIONS) -> DataFrame:
    """(region, kind, id): nodes in the box, ways with a node there, and all nodes of those ways."""
    nodes = cut(nodes.select("id", "lat", "lon"))  # nodes and refs are read several times, but parsed once
    inside = region_nodes(nodes, boxes)
    refs = cut(ways.select(F.col("id").alias("way"), F.explode("refs").alias("ref")).join(nodes.select(F.col("id").alias("ref")), "ref", "left_semi"))
    touched = cut(refs.join(inside.withColumnRenamed("id", "ref"), "ref").select("region", "way").distinct())
    known = refs
    whole = touched.join(known, "way").select("region", F.col("ref").alias("id"))
    row = lambda df, kind: df.select("region", F.lit(kind).alias("kind"), "id")
    return row(inside.union(whole.select("region", "id")).distinct(), "n").unionByName(row(touched.withColumnRenamed("way", "id"), "w"))


def compact_way(tag) -> Column:
    """F2, of a way. tag: a tag's value or the empty string."""
    return tag("highway").isin(*COMPACT_HIGHWAYS) | tag("bicycle").isin("designated", "official")


def detail_way(tags: Column) -> Column:
    """F3, of a way: any highway."""
    return F.map_contains_key(tags, F.lit("highway"))


def named(tags: Column) -> Column:
    """F4, of a node or way: a name, empty or not. Relations have no reader, so none are kept."""
    return F.map_contains_key(tags, F.lit("name"))


def tag_filter(nodes: DataFrame, ways: DataFrame, keep_way: Column, keep_node: Column) -> DataFrame:
    """(kind, id) of the objects that match and the nodes that matching ways refer to."""
    kept = cut(ways.where(keep_way).select("id", "refs"))
    nodes = cut(nodes.select("id", keep_node.alias("keep")))
    refs = kept.select(F.explode("refs").alias("id")).distinct()
    referred = nodes.join(refs, "id", "left_semi").select("id")
    found = nodes.where("keep").select("id").union(referred).distinct()
    return found.select(F.lit("n").alias("kind"), "id").unionByName(kept.select(F.lit("w").alias("kind"), "id"))
