"""Links between rows that meet in a cell and whose 64-bit fingerprints are near, in bounded memory.

Rows (cell, fp, node, ...) are sorted by cell and streamed. A cell gives a spanning forest of its
links, never all its pairs, so large groups of near copies cost rows in proportion to their size. A
cell of more than CHUNK rows is passed on instead of held: its rows are dealt to chunks, and each
pair of chunks is a cell of its own, so that no task holds more and every pair still meets.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, forget, released, setting

#: Rows of a cell that a task compares at most; rows that make it worth while to compare what is held; rows of an Arrow batch.
CHUNK, LEAST, BATCH = 1 << 16, 1 << 17, 50_000

Fit = Callable[[np.ndarray, np.ndarray], np.ndarray]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows is connected to by the links i-j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def all_fit(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.ones(len(i), bool)


def long_run(fps: np.ndarray, radius: int, fit: Fit = all_fit, tile: int = 2048) -> np.ndarray:
    """roots() of one cell with many rows, tile by tile, so in bounded memory."""
    label = np.arange(len(fps))
    for top in range(0, len(fps), tile):
        for left in range(top, len(fps), tile):
            i, j = np.nonzero(np.bitwise_count(fps[top : top + tile, None] ^ fps[None, left : left + tile]) <= radius)
            i, j = i + top, j + left
            new = label[i] != label[j]
            i, j = i[new], j[new]
            new = fit(i, j)
            if new.any():
                label = roots(len(fps), np.append(i[new], np.arange(len(fps))), np.append(j[new], label))
    return label


def linked(keys: np.ndarray, fps: np.ndarray, radius: np.ndarray | int, fit: Fit = all_fit, long: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Rows linked with a smaller row (a spanning forest for each cell) among rows sorted by cell.

    radius: for each row, the same in a cell. fit(i, j): which pairs of rows within the radius are links.
    """
    radius = np.broadcast_to(radius, len(keys))
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(starts, len(keys)))
    run = np.repeat(np.arange(len(starts)), sizes)
    i, j = [], []
    left = np.where(sizes[run] <= long, np.repeat(starts + sizes, sizes) - 1 - np.arange(len(keys)), 0)
    at = np.flatnonzero(left)
    for d in range(1, long):
        at = at[left[at] >= d]  # rows with a row of their cell d places on
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + d]) <= radius[at]]
        near = near[fit(near, near + d)]
        i.append(near)
        j.append(near + d)
    i, j = (np.concatenate(x) if x else np.empty(0, int) for x in (i, j))
    label = roots(len(keys), i, j)
    for k in np.flatnonzero(sizes > long):
        s = starts[k]
        label[s : s + sizes[k]] = s + long_run(fps[s : s + sizes[k]], radius[s], lambda x, y, s=s: fit(x + s, y + s))
    rows = np.flatnonzero(label != np.arange(len(keys)))
    return label[rows], rows


def parted(keys: np.ndarray, fps: np.ndarray, radius: np.ndarray | int, fit: Fit, label: np.ndarray, tile: int = 2048) -> np.ndarray:
    """The rows that have a row of another label in their cell within the radius that fits."""
    radius = np.broadcast_to(radius, len(keys))
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    out = np.zeros(len(keys), bool)
    for s, e in zip(starts, np.append(starts[1:], len(keys)), strict=True):
        if e - s < 2 or (label[s:e] == label[s]).all():
            continue
        for top in range(s, e, tile):
            for left in range(top, e, tile):
                i, j = near_pairs(fps, slice(top, min(top + tile, e)), slice(left, min(left + tile, e)), radius[s], label)
                fits = fit(i, j)
                out[i[fits]] = out[j[fits]] = True
    return np.flatnonzero(out)


def near_pairs(fps: np.ndarray, x: slice, y: slice, radius: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row of x and a later one of y within the radius whose labels differ."""
    near = (np.bitwise_count(fps[x, None] ^ fps[None, y]) <= radius) & (label[x, None] != label[None, y])
    i, j = np.nonzero(np.triu(near, 1) if x == y else near)
    return i + x.start, j + y.start


#: Asks which pairs of rows are alike, is sent the answers, and returns links.
Walk = Generator[tuple[np.ndarray, np.ndarray], np.ndarray, list[tuple[int, int]]]


def connecting(fps: np.ndarray, radius: int, label: np.ndarray, start: int = 0, tile: int = 1024, some: int = 1024, most: int = 8192) -> Walk:
    """Links between the rows of one cell that connect all labels that any pair within the radius that is alike connects.

    Whether pairs are alike is dear: nearest pairs come first, and pairs that are connected by then
    are not asked for. Pairs are taken in batches that grow, so that little is compared in vain.
    start: the number of the first row.
    """
    label, links = np.unique(label, return_inverse=True)[1], []
    for top in range(0, len(fps), tile):
        for left in range(top, len(fps), tile):
            i, j = near_pairs(fps, slice(top, min(top + tile, len(fps))), slice(left, min(left + tile, len(fps))), radius, label)
            order = np.argsort(np.bitwise_count(fps[i] ^ fps[j]), kind="stable")
            i, j, size, at = i[order], j[order], some, 0
            while at < len(i):
                x, y = i[at : at + size], j[at : at + size]
                at += size
                rest = label[x] != label[y]
                x, y = x[rest], y[rest]
                found = np.flatnonzero((yield x + start, y + start)) if len(x) else x
                for p, q in zip(x[found].tolist(), y[found].tolist(), strict=True):
                    if label[p] != label[q]:
                        links.append((p + start, q + start))
                        label[label == label[q]] = label[p]
                size = some if len(found) else min(2 * size, most)
    return links


def together(walks: list[Walk], alike: Fit) -> list[tuple[int, int]]:
    """The links of all walks, which go side by side, so that alike gets the pairs of all of them at once."""
    links: list[tuple[int, int]] = []
    answers: list[np.ndarray | None] = [None] * len(walks)
    while walks:
        live, asked = [], []
        for walk, answer in zip(walks, answers, strict=True):
            try:
                asked.append(walk.send(answer))
                live.append(walk)
            except StopIteration as end:
                links += end.value
        walks = live
        if walks:
            found = alike(*(np.concatenate(x) for x in zip(*asked, strict=True)))
            answers = np.split(found, np.cumsum([len(x) for x, _ in asked])[:-1])
    return links


def forest(keys: np.ndarray, fps: np.ndarray, node: np.ndarray, radius: np.ndarray | int, fit: Fit = all_fit) -> tuple[np.ndarray, np.ndarray]:
    """linked(), as nodes."""
    i, j = linked(keys, fps, radius, fit)
    return node[i], node[j]


def streamed(join, columns: list[str], chunk: int | None):
    """For mapInArrow over rows sorted by cell: links (a, b) of whole cells, and the rows of cells over `chunk`.

    join(cell, fp, node, ...) gives the values of a and b, nodes as a rule.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("over", pa.bool_()), *[(c, pa.int64()) for c in columns]])

    def links(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        cols[1] = cols[1].view(np.uint64)
        a, b = join(*cols)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), bool)), *[pa.nulls(len(a), pa.int64())] * len(columns)], schema=schema)

    def passed(cols: list[np.ndarray]) -> pa.RecordBatch:
        n = len(cols[0])
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.ones(n, bool)), *map(pa.array, cols)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows, over = 0, None  # over: the cell whose rows are passed on
        for batch in batches:
            own = [batch.column(c).to_numpy() for c in range(len(columns))]
            if over is not None:
                n = int(np.searchsorted(own[0], over, "right"))
                if n:
                    yield passed([x[:n] for x in own])
                    own = [x[n:] for x in own]
            if not len(own[0]):
                continue
            over = None
            held.append(own)
            rows += len(own[0])
            if rows < min(LEAST, chunk or LEAST):
                continue
            own = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = int(np.searchsorted(own[0], own[0][-1]))
            if last:
                yield links([[x[:last] for x in own]])
            own = [x[last:] for x in own]
            if chunk and len(own[0]) > chunk:
                over = own[0][0]
                yield passed(own)
                held, rows = [], 0
            else:
                held, rows = [own], len(own[0])
        if held and rows:
            yield links(held)

    return released(run)


def meet(rows: DataFrame, join, chunk: int | None = None, links: bool = True) -> DataFrame:
    """What join gives for all cells, as a table (a, b) of distinct rows: links with the lesser node first, or other pairs.

    rows: (cell, fp, node, ...: long, no nulls). Where a cell is dealt to pairs of chunks, those are what join sees.
    """
    columns, chunk = rows.columns, chunk or CHUNK
    spark = rows.sparkSession

    def found(own: DataFrame, most: int | None) -> DataFrame:
        schema = "a long, b long, over boolean, " + ", ".join(f"{c} long" for c in columns)
        dealt = own.repartition("cell").sortWithinPartitions("cell")
        with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
            return cut(dealt.mapInArrow(streamed(join, columns, most), schema))

    first = found(rows, chunk)
    tables, pairs = [first], first.where("not over").select("a", "b")
    rest = first.where("over").select(*columns)
    if rest.limit(1).count():
        sizes = rest.groupBy("cell").agg(F.ceil(2 * F.count("*") / F.lit(chunk)).cast("int").alias("parts"))
        own = F.pmod(F.xxhash64("node"), "parts").cast("int")
        dealt = rest.join(sizes, "cell").withColumn("own", own)
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        pair = F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
        # a cell's sign tells its kind
        dealt = dealt.withColumn("cell", F.when(F.col("cell") < 0, -F.abs(pair.bitwiseAND((1 << 62) - 1)) - 1).otherwise(pair.bitwiseAND((1 << 62) - 1)))
        more = found(dealt.select(*columns), None)
        tables.append(more)
        pairs = pairs.union(more.where("not over").select("a", "b"))
    if links:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    out = cut(pairs.distinct())
    forget(*tables)
    return out
