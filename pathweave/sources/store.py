"""Writing and reading the graph and place tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: schemaVersion of the metadata table.
SCHEMA_VERSION = "2"
MODES = {"create": "errorifexists", "replace": "overwrite", "skip": "ignore"}


def metadata(spark: SparkSession, kind: str) -> DataFrame:
    """Two rows; kind is compact or detail."""
    if kind not in ("compact", "detail"):
        raise ValueError(kind)
    return spark.createDataFrame([("schemaVersion", SCHEMA_VERSION), ("kind", kind)], "key string, value string")


#: How a table lies: what it is range sorted by, and the folders it is split into. Row-group statistics
#: then serve look-ups by latitude (F10) or by source node (K6).
LAYOUT = {"nodes": (["lat"], []), "amenities": (["lat"], []), "edges": (["is_cycleway", "src", "dst"], ["is_cycleway"])}
#: K5: tables that a graph may lack are written empty, with their columns.
OPTIONAL = {"official_routes": "id int, name string", "official_nodes": "node_id bigint, route_id int, sequence int"}


def write_graph(tables: dict[str, DataFrame], folder: str, mode: str = "create") -> None:
    """K1-K7: each table as Parquet below the folder, range partitioned and sorted by its layout, so
    the number of writing tasks follows the data.
    """
    spark = next(iter(tables.values())).sparkSession
    known = {n: spark.createDataFrame([], kind) for n, kind in OPTIONAL.items()} | tables
    for name, df in known.items():
        order, split = LAYOUT.get(name, ([], []))
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        writer = df.write.partitionBy(*split) if split else df.write
        writer.mode(MODES[mode]).parquet(f"{folder}/{name}")


def read_graph(spark: SparkSession, *folders: str) -> dict[str, DataFrame]:
    """Nodes and edges of one or more graphs as one."""
    one = lambda name: reduce(DataFrame.unionByName, [spark.read.parquet(f"{f}/{name}") for f in folders])
    return {name: one(name) for name in ("nodes", "edges")}


def save_bucketed(edges: DataFrame, table: str, buckets: int = 16) -> None:
    """K7, K8: edges as a table bucketed and sorted by their key, with statistics."""
    edges.write.mode("overwrite").bucketBy(buckets, "src").sortBy("src", "dst").saveAsTable(table)
    edges.sparkSession.sql(f"analyze table {table} compute statistics for all columns")


def compacted(df: DataFrame, rows_a_file: int = 1_000_000) -> DataFrame:
    """As many partitions as the rows need."""
    return df.repartition(max(1, -(-df.count() // rows_a_file)))
