"""Sharding along a Hilbert curve over metadata, with Spark expressions only (operator 5).

Each dimension is quantised to 2 ** BITS bins between its least and greatest value: numbers
linearly, strings by their first bytes after the prefix that all share, so bins keep the order that
a file's least and greatest values prune by. A row's bins are a cell of a grid; rows are ranked by
the cell's place on a Hilbert curve (then by the tie keys) and cut into runs, so a shard covers a
compact region in every dimension. The law is `rows`: counts differ by one at most.

Ranks come from one range partitioning by (curve, ties), which splits hot cells and hot texts too.

Defined cases: nulls are in the first bin; a dimension with one value has one bin; equal rows have
adjacent places in any order; an empty table gives no rows; other columns pass through unchanged.
Equal texts whose metadata differ lie in different cells, so they may be in different shards; equal
texts of one cell have adjacent places if the tie keys begin with a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, fresh, global_rank

BITS, SHARDS, CODE_BYTES = 4, 8, 6


def string_code(value: Column, skip: int) -> Column:
    """The CODE_BYTES bytes after the first `skip` ones as a number; it keeps byte order."""
    tail = F.substring(F.hex(F.encode(F.coalesce(value, F.lit("")), "UTF-8")), 2 * skip + 1, 2 * CODE_BYTES)
    return F.conv(F.rpad(tail, 2 * CODE_BYTES, "0"), 16, 10).cast("double")


def shared_prefix(a: str, b: str) -> int:
    x, y = a.encode(), b.encode()
    return next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def quantised(df: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """A bin from 0 for each dimension. One aggregate row with each dimension's bounds comes to the driver."""
    kinds = dict(df.dtypes)
    ends = df.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(dims) for f in (F.min, F.max)]).first()
    out = []
    for i, c in enumerate(dims):
        low, high = ends[f"min{i}"], ends[f"max{i}"]
        if low is None or low == high:
            out.append(F.lit(0))
            continue
        if kinds[c] == "string":
            skip = shared_prefix(low, high)
            value = string_code(F.col(f"`{c}`"), skip)
            low, high = (int.from_bytes(x.encode()[skip : skip + CODE_BYTES].ljust(CODE_BYTES, b"\0"), "big") for x in (low, high))
        else:
            value = F.col(f"`{c}`").cast("double")
        place = F.floor((value - float(low)) * (1 << bits) / max(float(high) - float(low), 1e-300))
        out.append(F.greatest(F.least(F.coalesce(place, F.lit(0)), F.lit((1 << bits) - 1)), F.lit(0)).cast("int"))
    return out


def hilbert(bins: list[Column], bits: int = BITS) -> Column:
    """The place of a grid cell on the Hilbert curve, by turning and flipping axes bit by bit."""
    n = len(bins)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, s: Column) -> Column:
        p, own, first = s["q"] - 1, F.get(x, s["i"]), F.get(x, F.lit(0))
        flip = own.bitwiseAND(s["q"]) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(p)

        def axis(v: Column, j: Column) -> Column:
            moved = F.when((j == s["i"]) & ~flip, v.bitwiseXOR(swap)).otherwise(v)
            return F.when(j == 0, v.bitwiseXOR(F.when(flip, p).otherwise(swap))).otherwise(moved)

        return F.transform(x, axis)

    turned = F.aggregate(steps, F.array(*bins), turn)
    empty = F.expr("cast(array() as array<int>)")
    # Gray code: each axis takes in those before it
    gray = F.aggregate(turned, empty, lambda a, v: F.concat(a, F.array(v.bitwiseXOR(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))))))
    flips = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])

    def fixed(g: Column) -> Column:
        last = F.get(g, F.lit(n - 1))
        fix = F.aggregate(flips, F.lit(0), lambda a, q: F.when(last.bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a))
        return bind(fix, lambda f: F.transform(g, lambda v: v.bitwiseXOR(f)))

    def woven(g: Column) -> Column:
        return F.aggregate(places, F.lit(0).cast("long"), lambda a, s: a * 2 + F.when(F.get(g, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0))

    return bind(bind(gray, fixed), woven)


def shards(df: DataFrame, dims: list[str], ties: list[str], n_shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """df plus curve, shard and slot (the row's place in its shard, from 0); they replace columns of these names."""
    bins, curve, rank = (fresh(df, c) for c in ("bins", "curve", "rank"))
    placed = df.withColumn(bins, F.array(*quantised(df, dims, bits)))
    placed = placed.withColumn(curve, hilbert([F.get(bins, F.lit(i)) for i in range(len(dims))], bits)).drop(bins)
    ranked = global_rank(placed, [F.col(curve), *[F.col(f"`{c}`") for c in ties]], rank)
    n = ranked.count()
    shard = F.expr(f"({rank} * {n_shards}) div {max(n, 1)}L")
    slot = F.col(rank) - F.expr(f"((({rank} * {n_shards}) div {max(n, 1)}L) * {n}L + {n_shards - 1}) div {n_shards}")
    own = {"curve": F.col(curve), "shard": shard.cast("int"), "slot": slot.cast("long")}
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns if c not in own], *[v.alias(c) for c, v in own.items()])


def manifest(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """What a reader prunes shards by: rows, and the least and greatest value of each dimension."""
    ends = [f(c).alias(f"{name}_{c}") for c in dims for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *ends)
