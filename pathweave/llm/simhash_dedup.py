"""SimHash near-duplicates by a segment-popcount embedding and a grid range join (operator 10).

A fingerprint's 64 bits form 32 segments of two bits. The vector of the segments' bit counts
changes by at most one for each differing bit, so its Manhattan distance is a lower bound of the
Hamming distance. Two fingerprints within 4 bits therefore lie within 2 in at least one half of
the vector (16 segments): each half is a grid with one cell for each count vector, every
fingerprint goes to its own cell and to those one step away, and any two within 2 meet in a cell.
What meets is verified exactly on all 64 bits. A cell gives a spanning forest of its links, never
all its pairs (cells.py), so large groups of near copies cost rows in proportion to their size.

Defined cases: null, empty and word-free texts have the fingerprint zero and are linked with each
other; equal fingerprints are one node, however many documents share it; rows that repeat a
doc_id each get a row; an empty table gives an empty result; other columns, whatever their names, are
ignored by near_duplicates and pass through keep_one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cells import forest, meet
from .common import bounded, components, cut, fresh, series_udf

SHINGLE_WORDS, SEED, RADIUS = 4, 42, 4


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text; bytes.lower and bytes.split are ASCII-only."""
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(own) - words + 1]
    ends = ends[words - 1 :] - 1
    cut_out = map(joined.__getitem__, map(slice, starts.tolist(), ends.tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, cut_out, repeat(SEED)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def simhash_series(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.array([simhash(t) for t in texts], np.uint64).view(np.int64))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def cells(fp: Column) -> Column:
    """The grid cells (half, 16 two-bit counts) that a fingerprint goes to, as an array of longs."""

    def half(h: int) -> Column:
        bits = F.shiftrightunsigned(fp, 32) if h else fp.bitwiseAND(F.lit(0xFFFFFFFF))
        low = F.lit(0x55555555)
        own = bits.bitwiseAND(low) + F.shiftrightunsigned(bits, 1).bitwiseAND(low) + F.lit(h << 32)
        up = [F.when(own.bitwiseAND(F.lit(2 << 2 * j)) == 0, own + F.lit(1 << 2 * j)) for j in range(16)]
        down = [F.when(own.bitwiseAND(F.lit(3 << 2 * j)) != 0, own - F.lit(1 << 2 * j)) for j in range(16)]
        return F.array_compact(F.array(own, *up, *down))

    return F.concat(half(0), half(1))


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect what any chain of pairs within the radius connects. fps: distinct fp."""
    if not 0 <= radius <= 4:
        raise ValueError("cells meet up to a distance of 2 in a half: a radius of 4 at most")
    # each row becomes some fifty: deal the few bytes out first, to a number of tasks that stays
    spread = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    rows = spread.select(F.explode(cells(F.col("fp"))).alias("cell"), "fp", F.col("fp").alias("node"))
    return meet(rows, lambda cell, fp, node: forest(cell, fp, node, radius))


def grouped_rows(own: DataFrame, links: DataFrame) -> DataFrame:
    """own (doc_id, mark, node) plus component_id and kept, given links between nodes.

    component_id: the smallest doc_id of the rows that links connect (null if none has one); kept:
    whether the row is the least of them by (doc_id, mark), rows without a doc_id last.
    """
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("doc_id"), F.col("mark").alias("mark"))
    nodes = cut(own.groupBy("node").agg(F.min(place).alias("least")))
    comp = components(links)
    of = nodes.join(comp, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    least = of.groupBy("component").agg(F.min("least").alias("least"))
    # a table of one row a node: where it is too large to be broadcast, a node that many rows share can still be split
    of = cut(of.select("node", "component").join(least, "component").select("node", "least"))
    out = own.join(bounded(of, 64), "node")
    return out.select("doc_id", "mark", "node", F.col("least.doc_id").alias("component_id"), (place == F.col("least")).alias("kept"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, mark, fp, component_id, kept): component_id is the smallest doc_id that links reach; see grouped_rows.

    mark: a hash of the text, which tells rows of one doc_id apart.
    """
    own = cut(docs.select("doc_id", F.xxhash64("text").alias("mark"), series_udf(simhash_series, T.LongType())(F.col("text")).alias("node")))
    links = fingerprint_links(own.select(F.col("node").alias("fp")).distinct(), radius)
    return grouped_rows(own, links).withColumnRenamed("node", "fp")


def keep_one(docs: DataFrame, radius: int = RADIUS, grouped: DataFrame | None = None) -> DataFrame:
    """docs with one document of each group of near-duplicates, all columns.

    The least by (doc_id, hash of the text) stays, documents without a doc_id last; of rows that
    repeat both, the least by all columns. Rows that share a doc_id but no group all stay.
    grouped: (doc_id, mark, kept), by near_duplicates() unless given.
    """
    found = cut((near_duplicates(docs, radius) if grouped is None else grouped).select("doc_id", "mark", "kept"))
    i, m = fresh(docs, "i"), fresh(docs, "m")
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(m))
    keyed = lambda df: cut(df.select(F.col("doc_id").alias(i), F.col("mark").alias(m)).distinct())
    kept = docs.join(bounded(keyed(found.where("not kept"))), same, "left_anti")
    repeated = keyed(found.where("kept").groupBy("doc_id", "mark").count().where("count > 1"))
    if not repeated.limit(1).count():
        return kept
    repeated = bounded(repeated)
    one = kept.join(repeated, same, "left_semi").groupBy("doc_id", F.xxhash64("text")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return kept.join(repeated, same, "left_anti").unionByName(one.select("row.*"))
