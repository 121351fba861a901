"""Structured Streaming over OPL lines (ours): stateless parsing and profiles, running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.operators.graph import profiled
from pathweave.sources import opl


def lines(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """A stream of (value, ord) from the text files that arrive in a folder."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(folder)
    return raw.select("value", F.lit(0).cast("bigint").alias("ord"))


def nodes(stream: DataFrame) -> DataFrame:
    return opl.nodes(stream).drop("ord")


def rideable_ways(stream: DataFrame, compact: bool = False) -> DataFrame:
    return profiled(opl.ways(stream), compact).drop("ord")


def place_counts(stream: DataFrame) -> DataFrame:
    """A running count of nodes by amenity."""
    kind = F.try_element_at("tags", F.lit("amenity"))
    return opl.nodes(stream).where(kind.isNotNull()).groupBy(kind.alias("amenity")).agg(F.count("*").alias("n"))
