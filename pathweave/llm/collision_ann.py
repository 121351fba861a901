"""Nearest neighbours by collision counting over single-projection sorted arrays (operator 3).

Vectors of similar norm are scaled by the greatest and given one component more so that all have length 1;
a query is scaled to length 1 with 0 there. Their Euclidean distance then falls as the inner product
rises. Each of PROJECTIONS random lines keeps the candidates' projections in a sorted array. A
query's window on each array is centred on its own projection and grows with the radius (virtual
rehashing); a candidate collides on a line once it is in the window. Candidates that collide on the
threshold number of lines are verified by their exact inner product. The search ends at the radius
of which a share (SLACK) reaches as many verified vectors as are asked for.

Candidates are dealt to blocks of about BLOCK rows. A block is one task's: it is indexed once, and the
queries (a stated share of the rows) stream past it in bounded batches; the best of all blocks are
merged by query. Nothing is capped: windows grow until the search ends or every candidate is verified.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part;
vectors of different lengths have no inner product and meet only their like; rows that repeat a
vec_id are rows of their own, a query among them asks for each, and only its own row is no
candidate; equal vectors are verified once and rank by vec_id; a query without another candidate has
no rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, released, setting

PROJECTIONS, WIDTH, RATIO, FIRST_RADIUS, THRESHOLD, SLACK = 32, 2.0, 1.2, 0.2, 0.66, 0.8
BLOCK, QUERY_BATCH, BATCH, SEED = 65_536, 64, 4096, 5
#: The round at which a block's first search begins to look; what is found does not depend on it.
START = 10
#: Vectors whose norms differ by more than about this factor are indexed apart.
NORM_RATIO = 1.25


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index:
    """Sorted projections of one block's distinct vectors."""

    def __init__(self, vectors: np.ndarray, largest: float):
        self.vectors = vectors
        scaled = vectors / largest
        rest = np.sqrt(np.clip(1 - (scaled * scaled).sum(axis=1), 0, None))
        rng = np.random.default_rng(SEED)
        self.lines = rng.standard_normal((vectors.shape[1], PROJECTIONS))
        self.extra = rng.standard_normal(PROJECTIONS)
        at = (scaled @ self.lines + rest[:, None] * self.extra).T
        order = np.argsort(at, axis=1)
        self.sorted = np.take_along_axis(at, order, axis=1)
        # each vector's place on each array; a difference of places wraps around below 0
        self.places = np.empty(at.shape, np.uint16 if len(vectors) < 1 << 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(len(vectors), dtype=self.places.dtype)[None], axis=1)
        self.largest, self.start = largest, START

    def windows(self, centres: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of each query's window on each array."""
        half = WIDTH * radius / 2
        low = np.stack([np.searchsorted(s, c - half, "left") for s, c in zip(self.sorted, centres.T, strict=True)], axis=1)
        high = np.stack([np.searchsorted(s, c + half, "right") for s, c in zip(self.sorted, centres.T, strict=True)], axis=1)
        return low, high

    def collided(self, low: np.ndarray, high: np.ndarray, need: int) -> np.ndarray:
        """Which vectors lie in at least `need` of a query's windows."""
        kind, counts = self.places.dtype.type, np.zeros(len(self.vectors), np.uint8)
        place, inside = np.empty(len(counts), kind), np.empty(len(counts), bool)
        for line, first, size in zip(self.places, low.tolist(), (high - low).tolist(), strict=True):
            np.less(np.subtract(line, kind(first), out=place), kind(size), out=inside)
            counts += inside.view(np.uint8)
        return counts >= need

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the k best of the vectors found, as (rows, inner products).

        A wider radius finds what a narrower one does and more, so the first radius at which a query's
        search ends is looked for from that at which others' ended. Products are computed for what
        collides with any of the queries, all at once.
        """
        n, need = len(self.vectors), int(np.ceil(THRESHOLD * PROJECTIONS))
        norms = np.sqrt((queries * queries).sum(axis=1))
        centres = (queries / norms[:, None]) @ self.lines
        products, known = np.empty((len(queries), n)), np.zeros(n, bool)
        found: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        ends, step = np.full(len(queries), -1), np.zeros(len(queries), np.int64)
        at = np.full(len(queries), self.start)
        while (ends < 0).any():
            t = int(at[ends < 0][0])
            some = np.flatnonzero((ends < 0) & (at == t))
            radius = radius_of(t)
            low, high = self.windows(centres[some], radius)
            last = radius > 2 * RATIO and bool((high - low == n).all())
            masks = [self.collided(x, y, need) for x, y in zip(low, high, strict=True)]
            new = np.flatnonzero(np.logical_or.reduce(masks) & ~known)
            products[:, new] = queries @ self.vectors[new].T
            known[new] = True
            for q, mask in zip(some, masks, strict=True):
                rows = np.flatnonzero(mask)
                own, over = products[q, rows], last or len(rows) == n
                if len(rows) >= k:
                    worst = np.partition(own, len(rows) - k)[len(rows) - k]
                    gap = np.sqrt(max(0.0, 2 - 2 * worst / (self.largest * norms[q])))
                    over |= bool(gap <= SLACK * radius)
                    rows = rows[own >= worst - 1e-9 * self.largest * norms[q]]
                if over:
                    found[q] = rows
                    if t == 0 or step[q] > 0:
                        ends[q] = t
                    step[q], at[q] = -1, t - 1
                else:
                    if step[q] < 0:
                        ends[q] = t + 1
                    step[q], at[q] = 1, t + 1
        self.start = int(np.median(ends))
        out = []
        for q, r in enumerate(found):
            s = (self.vectors[r] * queries[q]).sum(axis=1)
            if len(r) > k:  # all that tie with the k-th stay
                kept = s >= np.partition(s, len(s) - k)[len(s) - k]
                r, s = r[kept], s[kept]
            out.append((r, s))
        return out


@lru_cache
def radius_of(t: int) -> float:
    """The radius of round t."""
    return FIRST_RADIUS if t == 0 else radius_of(t - 1) * RATIO


class Block:
    """A block's candidates, equal vectors as one, with indexes of those of similar norm.

    Scaling by a far larger norm would leave all of a class's vectors equally far from every query.
    """

    def __init__(self, vectors: np.ndarray, vec_ids: np.ndarray, rows: np.ndarray, k: int):
        self.k, self.ids, self.rows = k, vec_ids, rows
        keys = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        # the k + 1 least ids of each distinct vector: one of them may be the query's own
        order = np.lexsort((rows, vec_ids, group))
        starts = np.flatnonzero(np.concatenate(([True], np.diff(group[order]) > 0)))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        self.order = order[place <= k]
        self.starts = np.searchsorted(group[self.order], np.arange(len(first) + 1))
        vectors = vectors[first]
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        kinds = np.floor(np.log(norms) / np.log(NORM_RATIO) + 0.5)
        self.parts = [(own, Index(vectors[own], norms[own].max())) for own in (np.flatnonzero(kinds == kind) for kind in np.unique(kinds))]

    def nearest(self, query: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
        """The k best of each query (row: its own row, which is no candidate)."""
        found = [[] for _ in row]
        for own, index in self.parts:
            for q, (r, scores) in enumerate(index.search(query, min(self.k + 1, len(own)))):
                found[q].append((own[r], scores))
        out = []
        for own, parts in zip(row.tolist(), found, strict=True):
            rows, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
            best = np.argsort(-scores, kind="stable")
            got = np.concatenate([self.order[self.starts[r] : self.starts[r + 1]] for r in rows[best]])
            score = np.repeat(scores[best], self.starts[rows[best] + 1] - self.starts[rows[best]])
            kept = self.rows[got] != own
            got, score = got[kept], score[kept]
            top = np.lexsort((self.rows[got], self.ids[got], -score))[: self.k]
            out.append((np.full(len(top), own), self.ids[got[top]], self.rows[got[top]], score[top]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "vec_id", "row", "score"])


def search_blocks(k: int):
    """For mapInArrow over rows (block, asked, row, vec_id, vector) sorted by (block, asked).

    A block's candidates are held and indexed once; its queries stream past them in bounded batches.
    """

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, bool], pa.RecordBatch]]:
        block, asked = batch.column("block").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False)
        key = 2 * block + asked
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        for s, e in zip(starts, np.append(starts[1:], len(key)), strict=True):
            yield (int(block[s]), bool(asked[s])), batch.slice(s, e - s)

    def vectors(batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column("vector").flatten().to_numpy().astype(np.float64) + 0.0
        return flat.reshape(batch.num_rows, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of, block = [], None, None
        for batch in batches:
            for (at, asked), part in parts(batch) if batch.num_rows else ():
                if at != of:
                    held, of, block = [], at, None
                if not asked:
                    held.append(part)
                    continue
                if block is None and held:
                    x, ids, rows = (np.concatenate(c) for c in zip(*[(vectors(p), p.column("vec_id").to_numpy(), p.column("row").to_numpy()) for p in held], strict=True))
                    held, block = [], Block(x, ids, rows, k)
                for start in range(0, part.num_rows if block else 0, QUERY_BATCH):
                    some = part.slice(start, QUERY_BATCH)
                    yield block.nearest(vectors(some), some.column("row").to_numpy())

    return released(run)


def nearest(vectors: DataFrame, asked: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by inner product of each row that `asked` names.

    asked is a condition on vec_id.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"))
    own = own.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    own = cut(own.select("vec_id", "vector", F.size("vector").alias("d"), F.monotonically_increasing_id().alias("row")))
    # vectors of a length have blocks of their own, numbered on from those of shorter ones
    sizes = own.groupBy("d").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("blocks"))
    spot = F.pmod(F.xxhash64(F.lit(SEED), F.col("row")), F.col("blocks"))
    mark = F.shiftleft(F.col("d").cast("long"), 32)
    known = own.join(F.broadcast(sizes), "d")  # a row for each length of vector
    data = known.select((mark + spot).alias("block"), F.lit(False).alias("asked"), "row", "vec_id", "vector")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    queries = known.where(asked).select("d", blocks.alias("spot"), "row", "vec_id", "vector")
    queries = queries.select((mark + F.col("spot")).alias("block"), F.lit(True).alias("asked"), "row", "vec_id", "vector")
    dealt = data.unionByName(queries).repartition("block").sortWithinPartitions("block", "asked")
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
        found = cut(dealt.mapInArrow(search_blocks(k), "query long, vec_id long, row long, score double"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    names = own.where(asked).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", "rank", "vec_id", "score")
