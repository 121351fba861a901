"""The map tile layers and settings (V1, V2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layer, least and greatest zoom, layer written to, simplified below a zoom, level, algorithm.
LAYERS = (
    ("place", 0, 14, None, None, None, None),
    ("boundary", 0, 14, None, 12, 0.0003, "visvalingam"),
    ("poi", 12, 14, None, None, None, None),
    ("poi_detail", 14, 14, "poi", None, None, None),
    ("housenumber", 14, 14, None, None, None, None),
    ("waterway", 8, 14, None, 12, 0.0003, None),
    ("waterway_detail", 12, 14, "waterway", None, None, None),
    ("transportation", 4, 14, None, 13, 0.0003, None),
    ("transportation_name", 8, 14, None, None, None, None),
    ("building", 13, 14, None, None, None, None),
    ("water", 6, 14, None, 12, 0.0003, "visvalingam"),
    ("water_name", 14, 14, None, None, None, None),
    ("water_name_detail", 14, 14, "water_name", None, None, None),
    ("aeroway", 11, 14, None, None, None, None),
    ("aerodrome_label", 10, 14, None, None, None, None),
    ("park", 11, 14, None, None, None, None),
    ("landuse", 4, 14, None, 13, 0.0003, "visvalingam"),
    ("landcover", 0, 14, None, 13, 0.0003, "visvalingam"),
    ("mountain_peak", 11, 14, None, None, None, None),
)
# Settings of the tile build.
SETTINGS = {"minzoom": 0, "maxzoom": 14, "basezoom": 14, "include_ids": False, "combine_below": 14, "combine_points": False, "compress": "gzip"}
SCHEMA = "layer string, minzoom int, maxzoom int, write_to string, simplify_below int, simplify_level double, simplify_algorithm string"


def layers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LAYERS), SCHEMA)


def layer_zooms(rows: DataFrame) -> DataFrame:
    """(layer, target, zoom, simplified) for each zoom of a layer."""
    own = rows.withColumn("zoom", F.explode(F.sequence("minzoom", "maxzoom")))
    simple = F.coalesce(F.col("zoom") < F.col("simplify_below"), F.lit(False))
    return own.select("layer", F.coalesce("write_to", "layer").alias("target"), "zoom", simple.alias("simplified"))
