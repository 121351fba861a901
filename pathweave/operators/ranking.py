"""Names that clash with no column, and places of rows in a total order."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    known, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name.lower() in known:
        name += "_"
    return name


def global_rank(df: DataFrame, keys: list[Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """df plus a column `name` (it replaces one of that name): the row's place from 0 in the order of keys.

    Rows are range partitioned and sorted, with one shuffle; a row's place in its partition comes
    from its monotonic id and partition offsets from a table of one row a partition. The sorted rows
    are written, so offsets and places come from the same partitioning.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    k, m, p, o = (fresh(df, s) for s in "kmpo")
    named = df.select("*", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(keys)]).alias(k))
    cols = [F.col(k)[f"k{i}"] for i in range(len(keys))]
    placed = named.repartitionByRange(n, *cols).sortWithinPartitions(*cols).drop(k)
    placed = cut(placed.withColumn(m, F.monotonically_increasing_id()))
    part, at = F.shiftright(m, 33), F.col(m).bitwiseAND((1 << 33) - 1)
    offset, starts = 0, []
    for r in sorted(placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):
        starts.append({"p": r["p"], "o": offset})
        offset += r["n"]
    # one row a partition
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(starts)), "array<struct<p: bigint, o: bigint>>"))).toDF(p, o)
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return placed.join(F.broadcast(table), part == F.col(p)).select(*rest, (F.col(o) + at).alias(name))
