"""Document fingerprints from closed syncmers (operator 9).

A k-mer of code points is a closed syncmer if the least hash of its s-mers is the first's or the
last's. Whether it is one depends on the k-mer alone, so a passage has the same anchors wherever it
stands. A fingerprint has two parts, for k = 16 and, as short texts have few of those, for k = 4. A
part is the distinct 32-bit hashes of all syncmers of a text, in the order of their first positions:
none is left out, so a fingerprint grows with its text (by about 14 hex digits a code point).

Likeness is by position: hashes that both texts have are matched, and the longest chain of matches
that come in the same order in both counts, as a share of all hashes of both. Where order agrees it
is the Jaccard similarity of the texts' syncmer sets; anchors() gives every anchor with its position,
and exact_likeness() the same measure by 64-bit hashes.

Defined cases: null texts are empty; an empty text has the empty fingerprint; a text without a
syncmer (shorter than 4) has the hash of itself as its only anchor; two empty fingerprints have
likeness 1, an empty and another one 0; rows that repeat a doc_id are ordered by text; documents
without doc_id come last; a table of one document is its own successor; long texts are read whole
in overlapping pieces; columns but doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, released

#: (k-mer, s-mer length in code points, hashes kept: None for all) of the two parts; the first counts where both texts have so many of its anchors.
COARSE, FINE, ENOUGH = (16, 8, None), (4, 2, None), 12
#: Code points handled at once; characters of fingerprints that a worker hands on at once.
PIECE, SHOWN = 1 << 18, 8 << 20
BASE = 0x9E3779B97F4A7C15
Kind = tuple[int, int, int | None]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pieces(text: str, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, max(len(text) - k + 1, 1), PIECE):
        yield at, np.frombuffer(text[at : at + PIECE + k - 1].encode("utf-32-le"), "<u4").astype(np.uint64)


def syncmers(codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 64-bit hashes) of the closed syncmers among the k-mers of some code points; k = 2 s, a power of 2."""
    if len(codes) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h, power, n = mix(codes + np.uint64(1)), BASE, 1
    while n < s:  # hashes of 2, 4, 8 code points
        h = h[:-n] * np.uint64(power) + h[n:]
        power, n = power * power & 0xFFFFFFFFFFFFFFFF, 2 * n
    many = len(codes) - k + 1
    order = mix(h)
    low, width = order, 1
    while 2 * width <= k - s + 1:  # least of 2, 4, 8 neighbours
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:many], low[k - s + 1 - width :][:many])
    at = np.flatnonzero((low == order[:many]) | (low == order[k - s :][:many]))
    return at, mix(h[at] * np.uint64(power) + h[at + k - s])


def anchors(text: str | None, kind: Kind = COARSE) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of all closed syncmers of a text."""
    k, s, _ = kind
    found = [(at + p, h) for at, codes in pieces(text or "", k) for p, h in [syncmers(codes, k, s)]]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def part(text: str, kind: Kind) -> np.ndarray:
    """The distinct 32-bit hashes of a text's syncmers (the `kept` smallest, if there is such a number) in the order of their first positions."""
    _, h = anchors(text, kind)
    # the first of equal hashes is the earliest
    least, first = np.unique((h >> np.uint64(32)).astype(np.uint32), return_index=True)
    return least[: kind[2]][np.argsort(first[: kind[2]], kind="stable")]


def fingerprint(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The coarse and the fine part."""
    text = text or ""
    coarse, fine = part(text, COARSE), part(text, FINE)
    if text and not len(fine):
        fine = np.frombuffer(hashlib.blake2b(text.encode(), digest_size=4).digest(), "<u4").astype(np.uint32)
    return coarse, fine


def as_hex(fp: tuple[np.ndarray, np.ndarray]) -> str:
    """Both parts with a point between; empty for an empty text."""
    return ".".join(p.astype(">u4").tobytes().hex() for p in fp) if len(fp[1]) else ""


def chain(places: list[int]) -> int:
    """The length of the longest rising sequence."""
    tails: list[int] = []
    for p in places:
        i = bisect_left(tails, p)
        tails[i : i + 1] = [p]
    return len(tails)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """From 0 to 1: the share of matched anchors in the same order."""
    coarse = min(len(a[0]), len(b[0])) >= ENOUGH
    x, y = (a[0], b[0]) if coarse else (a[1], b[1])
    if not len(x) and not len(y):
        return 1.0
    return chained(x, y, (COARSE if coarse else FINE)[2])


def chained(x: np.ndarray, y: np.ndarray, kept: int | None) -> float:
    """Of the `kept` smallest of two lists of distinct hashes (all without a number), the share in a chain of matches."""
    both = np.union1d(x, y)[:kept]
    order = np.argsort(y)
    x = x[x <= both[-1]] if len(both) else x
    at = np.searchsorted(y, x, sorter=order) if len(y) else np.empty(0, int)
    at = order[at[at < len(y)]], x[at < len(y)]
    return chain(at[0][y[at[0]] == at[1]].tolist()) / max(1, len(both))


def exact_likeness(a: str | None, b: str | None, kind: Kind = COARSE) -> float:
    """chained() over all anchors of two texts."""
    own = []
    for text in (a, b):
        pos, h = anchors(text, kind)
        _, first = np.unique(h, return_index=True)
        own.append(h[np.sort(first)])
    return 1.0 if not len(own[0]) and not len(own[1]) else chained(*own, None)


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """df plus `fingerprint` and `anchors`: each syncmer's position and hash; they replace columns of these names."""

    @F.pandas_udf(T.StructType([T.StructField("f", T.StringType()), T.StructField("p", T.ArrayType(T.LongType())), T.StructField("h", T.ArrayType(T.LongType()))]))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [anchors(t) for t in texts]
            yield pd.DataFrame({"f": [as_hex(fingerprint(t)) for t in texts], "p": [f[0] for f in found], "h": [f[1].view(np.int64) for f in found]})

    name = fresh(df, "f")
    out = df.withColumn(name, run(F.col(text)))
    return out.withColumns({"fingerprint": F.col(f"{name}.f"), "anchors": F.arrays_zip(F.col(f"{name}.p").alias("pos"), F.col(f"{name}.h").alias("hash"))}).drop(name)


def with_successor(docs: DataFrame) -> DataFrame:
    """(bucket, extra, doc_id, text), sorted so that each row's successor by descending doc_id follows it.

    Buckets are ranges of doc_id with bounds from its quantiles; a copy of the first row of a bucket
    (extra = 1) closes the bucket before it, and the very first one the last bucket. Texts are
    shuffled once; the driver gets one number for each bucket.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    bounds = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / (4 * n) for i in range(1, 4 * n)], 1 / (16 * n))})
    shared = spark.sparkContext.broadcast(np.array(bounds, np.int64))

    @F.pandas_udf(T.IntegerType())
    def range_of(own: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, own.to_numpy(np.int64), "right").astype(np.int32))

    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(range_of(F.coalesce("doc_id", F.lit(0))))
    heads = sorted((r["k"], r["head"]) for r in ids.groupBy(bucket.alias("k")).agg(F.max("doc_id").alias("head")).collect())
    after = [k for k, _ in heads]
    to = {k: after[i + 1] if i + 1 < len(after) else after[0] for i, k in enumerate(after)}
    # one row for each bucket; null (no doc_id) heads are found by their bucket
    table = spark.createDataFrame([(head, to[k]) for k, head in heads] or [(None, 0)], "__head long, __to int")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("__head")), "left").withColumn("bucket", bucket)
    twice = F.array_compact(F.array(F.struct(F.col("bucket"), F.lit(0).alias("extra")), F.when(F.col("__to").isNotNull(), F.struct(F.col("__to").alias("bucket"), F.lit(1).alias("extra")))))
    rows = rows.select(F.explode(twice).alias("b"), "doc_id", "text").select("b.*", "doc_id", "text")
    return rows.repartition(n, "bucket").sortWithinPartitions("bucket", "extra", F.desc_nulls_last("doc_id"), "text")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over with_successor(): each document against its edited text and its successor."""
    names, held, out, size = [c.split()[0] for c in SCHEMA.split(", ")], None, [], 0
    for batch in batches:
        for bucket, extra, doc_id, text in zip(batch["bucket"], batch["extra"], batch["doc_id"], batch["text"], strict=True):
            new = not (held and held[0] == bucket and held[1])
            own = fingerprint(text) if new else None
            if held and held[0] == bucket and not held[1]:
                out.append(row(held, text, own))
                size += len(out[-1][3]) + len(out[-1][4])
            if new:
                held = (bucket, extra, doc_id, text, own)
            if size >= SHOWN:
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
            out, size = [], 0


def row(held: tuple, next_text: str, next_fp: tuple[np.ndarray, np.ndarray] | None) -> tuple:
    _, _, doc_id, text, fp = held
    half = len(text) // 2
    edited = text[: len(text) - half] + next_text[:half]
    efp = fingerprint(edited)
    return (None if pd.isna(doc_id) else int(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), as_hex(fp), as_hex(efp), likeness(fp, efp), likeness(fp, next_fp))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """One row for each document: its fingerprint, that of its edited text, and likenesses."""
    return with_successor(docs).mapInPandas(released(compared), SCHEMA)
