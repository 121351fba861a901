"""Language identification by averaged hashed subword embeddings and a linear softmax (operator 2).

Words are lower-cased runs of letters between spaces; their byte n-grams of 2 to 4 (word edges
included) hash to embeddings. A text is the mean of its n-grams' embeddings, classified by a linear
softmax; both are trained by stochastic gradient descent in numpy on a bounded sample of labelled
rows, the same number for each language, of documents that are not held out (whole texts, and short
runs of their words). A temperature and a weight for the number of n-grams, fitted on a part kept
from training, calibrate the scores: few n-grams, or such as training never saw, leave all languages
alike. The rejection threshold is the score that all but a small share of that part's texts reach. As the classifier is linear in the mean, prediction
adds up each n-gram's class scores.

Defined cases: null texts and texts without a letter get `und`, score 0 and are rejected; without
any labelled row every text gets `und`; ties go to the first language in code point order; texts of
any length are read whole, in pieces of bounded size; other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, held_out

#: Labelled rows that the model is fitted on, at most about so many in all and for each language.
SAMPLE_ROWS, SAMPLE_EACH = 4000, 600
BITS, DIM, EPOCHS, RATE = 16, 16, 10, 0.5
#: The share of known texts that the rejection threshold may turn away, and its upper bound.
REJECTED_SHARE, HIGHEST_THRESHOLD = 0.001, 0.4
#: Beside each whole text, runs of so many of its words are learned from, as short texts differ.
RUNS = (2, 8)
PIECE = 1 << 20
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The text's words in lower case between single spaces; empty if it has no letter."""
    words = OTHER.sub(" ", (text or "").lower())
    return f" {words.strip()} " if any(map(str.isalpha, words)) else ""


def buckets(words: str) -> Iterator[np.ndarray]:
    """The n-grams' buckets, in pieces."""
    data = np.frombuffer(words.encode(), np.uint8)
    for at in range(0, len(data) - 1, PIECE):
        a = data[at : at + PIECE + 3].astype(np.uint32)
        space = a == 32
        two, three, four = (a[: len(a) - n + 1][:PIECE] for n in (2, 3, 4))
        if len(a) > 1:
            two = two << 8 | a[1:][: len(two)]
            yield spread(two[~(space[: len(two)] & space[1:][: len(two)])], 2)
        if len(a) > 2:
            three = two[: len(three)] << 8 | a[2:][: len(three)]
            yield spread(three[~space[1:][: len(three)]], 3)
        if len(a) > 3:
            four = three[: len(four)] << 8 | a[3:][: len(four)]
            yield spread(four[~(space[1:][: len(four)] | space[2:][: len(four)])], 4)


def spread(codes: np.ndarray, n: int) -> np.ndarray:
    mixed = (codes ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)).astype(np.int64)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and their counts: at most 2 ** BITS."""
    total = np.zeros(1 << BITS, np.int64)
    for piece in buckets(letters(text)):
        total += np.bincount(piece, minlength=1 << BITS)
    own = np.flatnonzero(total)
    return own.astype(np.int32), total[own]


def run_of(text: str | None, size: int) -> str:
    """A run of so many words from a place that depends on the text alone."""
    words = letters(text).split()
    at = crc32(" ".join(words).encode()) % max(1, len(words) - size + 1)
    return " ".join(words[at : at + size])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """langs, the class scores of each bucket (already divided by the temperature), the number of
    n-grams at which they count by half, the threshold."""

    def __init__(self, langs: list[str], table: np.ndarray, half: float, threshold: float):
        self.langs, self.table, self.half, self.threshold = langs, table, half, threshold

    def predict(self, text: str | None) -> tuple[str, float]:
        words = letters(text)
        if not words or not self.langs:
            return "und", 0.0
        total, n = np.zeros(len(self.langs)), 0
        for own in buckets(words):
            total += self.table[own].sum(axis=0, dtype=np.float64)
            n += len(own)
        p = softmax(total / (max(n, 1) + self.half))
        return self.langs[int(p.argmax())], float(p.max())


def train(rows: list[tuple[np.ndarray, np.ndarray, str, bool, bool]], seed: int = 7) -> Model:
    """rows: (distinct buckets, counts, language, kept for calibration, whole). Order does not matter."""
    rows = [r for r in rows if len(r[0])]
    langs = sorted({r[2] for r in rows})
    if not langs:
        return Model([], np.zeros((1 << BITS, 0)), 0.0, 0.0)
    rows = sorted(rows, key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))
    x = [(r[0], (r[1] / r[1].sum()).astype(np.float32)) for r in rows]
    y = np.array([langs.index(r[2]) for r in rows])
    part = np.array([r[3] for r in rows])
    fit, rest = np.flatnonzero(~part), np.flatnonzero(part)
    fit = fit if len(fit) else rest
    rest = rest if len(rest) else fit
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    lin = np.zeros((DIM, len(langs)), np.float32)
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            own, w = x[i]
            mean = w @ emb[own]
            g = softmax(mean @ lin)
            g[y[i]] -= 1
            g *= RATE * (1 - done / steps)
            back = lin @ g
            lin -= np.outer(mean, g)
            # a text's n-grams share one gradient; each takes as much of it as its share of the mean, scaled so that the common ones move by RATE
            emb[own] -= (w / w.max())[:, None] * back
            done += 1
    seen = np.zeros(1 << BITS, bool)
    for i in fit:
        seen[x[i][0]] = True
    table = (emb @ lin) * seen[:, None]
    z = np.array([x[i][1] @ table[x[i][0]] for i in rest])
    n = np.array([rows[i][1].sum() for i in rest], float)[:, None]

    def loss(heat: float, half: float) -> float:
        return float(-np.log(softmax(z * n / (n + half) / heat)[np.arange(len(rest)), y[rest]] + 1e-12).mean())

    heat, half = min(((t, k) for t in np.geomspace(0.02, 5, 40) for k in (0.0, 3.0, 10.0, 30.0, 100.0)), key=lambda tk: loss(*tk))
    whole = np.array([rows[i][4] for i in rest])
    best = softmax(z * n / (n + half) / heat).max(axis=1)[whole if whole.any() else slice(None)]
    return Model(langs, (table / heat).astype(np.float32), half, min(HIGHEST_THRESHOLD, float(np.quantile(best, REJECTED_SHARE))))


def fit(docs: DataFrame) -> Model:
    """A model of the rows of docs (doc_id, text, lang) that are not held out and have a language."""
    seen = docs.where(~held_out() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in seen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    each = min(SAMPLE_EACH, SAMPLE_ROWS / max(1, len(counts)))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, each / n)).otherwise(share)
    spot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)

    @F.pandas_udf(T.StructType([T.StructField("b", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.LongType()))]))
    def features(texts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        found = [counted(run_of(t, n) if n else t) for t, n in zip(texts, sizes, strict=True)]
        return pd.DataFrame({"b": [f[0] for f in found], "n": [f[1] for f in found]})

    kept = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(5)) == 0
    sample = seen.where(spot < share).select("lang", kept.alias("kept"), "text", F.explode(F.array(F.lit(0), *map(F.lit, RUNS))).alias("size"))
    sample = sample.select("lang", "kept", (F.col("size") == 0).alias("whole"), features("text", "size").alias("f"))
    return train([(np.array(r["f"]["b"], np.int32), np.array(r["f"]["n"], np.int64), r["lang"], r["kept"], r["whole"]) for r in sample.toLocalIterator()])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs plus lang_pred, score and rejected; they replace columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            found = [own.predict(t) for t in texts]
            yield pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    p = fresh(docs, "p")
    out = docs.withColumn(p, run(F.col(text)))
    rejected = (F.col(f"{p}.lang_pred") == "und") | (F.col(f"{p}.score") < model.threshold)
    return out.withColumns({"lang_pred": F.col(f"{p}.lang_pred"), "score": F.col(f"{p}.score"), "rejected": rejected}).drop(p)
