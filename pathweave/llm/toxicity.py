"""Toxicity by a factorization machine over hashed terms (operator 7).

A text is the set of its lower-cased words, hashed to buckets. A bucket's value is its salience:
how many standard deviations its count in toxic texts departs from chance, over a floor and up to a
ceiling; the others are left out. The machine adds linear weights and the pairwise interactions of
the buckets present, as inner products of their factors, so a pair such as an insult with a group
mention can weigh more (or less) than its parts. It is trained in numpy by adaptive stochastic
gradient descent on a bounded sample of labelled rows of documents that are not held out.

Defined cases: null and empty texts get the score of a text without terms; a label that is null is
no label; if a doc_id has several labels the highest holds; without labelled rows every score is 0;
texts of any length are read whole; other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out

#: Labelled rows that the model is fitted on, at most about so many.
SAMPLE_ROWS = 10_000
BITS, FACTORS, EPOCHS, RATE, DECAY, TOXIC_WEIGHT = 18, 8, 10, 0.1, 1e-4, 2.0
LEAST_DOCS, FLOOR, SCALE, CEILING = 3, 2.0, 4.0, 2.0
WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's words; at most 2 ** BITS."""
    text = (text or "").lower()
    if len(text) <= 1 << 20:
        words = set(WORD.findall(text))
    else:
        found, words = WORD.finditer(text), set()
        while part := {m.group() for m in islice(found, 1 << 17)}:
            words |= part
    return np.unique(np.fromiter((crc32(w.encode()) & ((1 << BITS) - 1) for w in words), np.int32, len(words)))


class Model:
    """row: a bucket's row in the arrays below, the last (all zero) for those left out."""

    def __init__(self, row: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.row, self.bias, self.linear, self.factors = row, bias, linear, factors

    def score(self, text: str | None) -> float:
        own = self.row[terms(text)]
        own = own[own < len(self.linear) - 1]
        return 1 / (1 + np.exp(-np.clip(self.bias + raw(self.linear[own], self.factors[own]), -50, 50)))


def raw(linear: np.ndarray, factors: np.ndarray) -> float:
    """The machine's sum for terms whose values are multiplied in already."""
    s = factors.sum(axis=0)
    return linear.sum() + (s @ s - (factors * factors).sum()) / 2


def train(rows: list[tuple[np.ndarray, int]], seed: int = 3) -> Model:
    """rows: (distinct buckets, label). Order does not matter."""
    n = 1 << BITS
    rows = sorted(rows, key=lambda r: (r[1], len(r[0]), r[0].tobytes()))
    y = np.array([r[1] for r in rows], float)
    toxic = y.sum()
    if not len(rows) or toxic in (0, len(rows)):
        return Model(np.zeros(n, np.int32), -50.0 if not toxic else 50.0, np.zeros(1), np.zeros((1, FACTORS)))
    seen, hits = np.zeros(n), np.zeros(n)
    for own, label in rows:
        seen[own] += 1
        hits[own] += label
    share = toxic / len(rows)
    sigma = np.abs(hits - share * seen) / np.sqrt(share * (1 - share) * seen + 1e-9)
    value = np.minimum(np.clip(sigma - FLOOR, 0, None) / SCALE, CEILING) * (seen >= LEAST_DOCS)
    active = np.flatnonzero(value)
    row = np.full(n, len(active), np.int32)
    row[active] = np.arange(len(active))
    x = [row[own][row[own] < len(active)] for own, _ in rows]
    v = value[active]
    rng = np.random.default_rng(seed)
    w, f = np.zeros(len(active)), rng.normal(0, 0.01, (len(active), FACTORS))
    gw, gf, bias, gb = np.full(len(active), 1e-2), np.full(len(active), 1e-2), np.log(share / (1 - share)), 1e-2
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            own = x[i]
            vi = v[own]
            vf = f[own] * vi[:, None]
            s = vf.sum(axis=0)
            z = bias + vi @ w[own] + (s @ s - (vf * vf).sum()) / 2
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) * (TOXIC_WEIGHT if y[i] else 1)
            gb += g * g
            bias -= RATE * g / np.sqrt(gb)
            d = g * vi + DECAY * w[own]
            gw[own] += d * d
            w[own] -= RATE * d / np.sqrt(gw[own])
            df = g * vi[:, None] * (s - vf) + DECAY * f[own]
            gf[own] += (df * df).mean(axis=1)
            f[own] -= 0.3 * RATE * df / np.sqrt(gf[own])[:, None]
    return Model(row, float(bias), np.append(w * v, 0.0), np.vstack([f * v[:, None], np.zeros((1, FACTORS))]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the labelled rows of docs (doc_id, text) that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    spot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxic")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(spot < min(1.0, SAMPLE_ROWS / max(1, known.count())))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([terms(t) for t in texts])

    # the sample's rows are bounded by SAMPLE_ROWS, two numbers each
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", features(F.col("text")).alias("b"))
    return train([(np.array(r["b"], np.int32), int(r["toxic"])) for r in rows.toLocalIterator()])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs plus score; it replaces a column of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype=float)

    return docs.withColumn("score", run(F.col(text)))
