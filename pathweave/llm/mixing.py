"""Mixing sources to target weights, with Spark expressions only (operator 6).

Tokens are summed by source; sources in code point order (null last) take the weights in turn and
share a budget, a fraction of all tokens. No target exceeds a multiple of its source's tokens: what
is over is shared again by weight until none is above. A source's rate is its target over its
tokens; each document is taken floor(rate) times and once more with the fraction as probability,
decided by a hash of the seed, its id and its text, so reruns agree.

Defined cases: null texts have no tokens; documents without tokens follow their source's rate too;
a source without tokens has target and rate 0; rows that repeat an id and text get one decision;
an empty table gives no rows; other columns pass through unchanged (those added are named mix_size,
mix_source_size, mix_target, mix_copies and mix_copy, and replace columns of these names).

Independent copies leave a source's taken words near its target by chance: relative to the target,
one standard deviation is the square root of the sum, over its documents, of f(1 - f) size^2, over
the target, f being the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, global_rank

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2.0, 11
#: A table of sources up to this size is broadcast; a larger one is joined with salted keys.
BROADCAST_SOURCES, SALTS, TRIES = 100_000, 16, 24


def tokens(text: Column) -> Column:
    """The number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_level(own: DataFrame, budget: float, most: float, level: float) -> float:
    """The level at which the targets, weight times level but at most `most` times the size, add up to the budget.

    level: one that is not too high. Each pass takes the sums for TRIES levels in one row, goes on from
    the highest that is not too high and solves for the level with the sources capped there. A pass
    narrows the range by a factor of TRIES at least, so passes do not grow with the number of sources.
    """
    high, capped = None, -1
    while True:
        tries = [level * 4.0**i for i in range(TRIES)] if high is None else [level + (high - level) * i / TRIES for i in range(TRIES)]
        over = [F.col("weight") * t > most * F.col("source_size") for t in tries]
        sums = own.agg(*[F.struct(F.sum(o.cast("long")), F.sum(F.when(o, F.col("source_size")).otherwise(0)), F.sum(F.when(o, 0.0).otherwise(F.col("weight")))) for o in over]).first()
        fits = [i for i, (n, size, left) in enumerate(sums) if most * size + left * tries[i] <= budget * (1 + 1e-12)]
        at = max(fits, default=0)
        n, size, left = sums[at]
        if n == capped or not left:
            return tries[at]
        high = tries[at + 1] if at + 1 < len(tries) else high
        level, capped = max(tries[at], (budget - most * size) / left), n


def targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size). Only sums come to the driver."""
    own = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(own, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    own = cut(ranked.withColumn("weight", weight).drop("rank"))
    total, all_weight = own.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return own.select("source", "source_size", F.lit(0.0).alias("target"))
    level = water_level(own, share * total, most, share * total / all_weight)
    return own.select("source", "source_size", F.least(F.col("weight") * level, most * F.col("source_size")).alias("target"))


def with_targets(docs: DataFrame, goal: DataFrame) -> DataFrame:
    """docs joined to their source's row (source, ...); a hot source is not gathered anywhere."""
    key, salt, own = (fresh(docs, c) for c in ("source", "salt", "own"))
    goal = goal.withColumnRenamed("source", key)
    same = F.col("source").eqNullSafe(F.col(key))
    if goal.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(goal), same).drop(key)
    goal = goal.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    docs = docs.withColumn(own, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return docs.join(goal, same & (F.col(own) == F.col(salt))).drop(key, salt, own)


def plan(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """docs plus mix_size, mix_source_size, mix_target and mix_copies: how often each is taken."""
    goal = cut(targets(docs.select("source", tokens(F.col("text")).alias("size")), **settings))
    goal = goal.select("source", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 11) / float(1 << 53)
    copies = F.floor(rate) + F.when(spot < rate - F.floor(rate), 1).otherwise(0)
    joined = with_targets(docs.drop("mix_source_size", "mix_target").withColumn("mix_size", tokens(F.col("text"))), goal)
    return joined.withColumn("mix_copies", copies.cast("int"))


def emit(planned: DataFrame) -> DataFrame:
    """Each planned document as often as it is taken, with mix_copy from 1."""
    return planned.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
