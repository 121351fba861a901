"""What the corpus operators share: tables, size-checked joins, workers' memory, held-out documents."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import pandas as pd
import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from pathweave.operators.components import components
from pathweave.operators.ranking import fresh, global_rank
from pathweave.session import cut, ensure_checkpoint_dir, forget, setting, shared_folder

__all__ = ["components", "cut", "ensure_checkpoint_dir", "forget", "fresh", "global_rank", "setting", "shared_folder"]

#: A side of at most so many bytes, by its rows and their width, may be broadcast; a larger one is shuffled.
BROADCAST_BYTES = 48 << 20
#: Bytes of text that a worker takes apart at once, where it works on many texts together.
TEXT_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded(df: DataFrame, width: int = 48, entries: Column | None = None) -> DataFrame:
    """df with a broadcast hint if its rows take at most BROADCAST_BYTES, else as it is (the join then shuffles).

    width: bytes of a row, or of each of its entries where rows hold arrays and `entries` is their
    size. It reads df once to count, so give it a table or what is cheap.
    """
    n = df.agg(F.sum(entries.cast("long")) if entries is not None else F.count("*")).first()[0] or 0
    return F.broadcast(df) if n * width <= BROADCAST_BYTES else df


def bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once for each row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def slices(texts: pd.Series, most: int = TEXT_BYTES) -> Iterator[slice]:
    """Runs of texts of at most `most` characters together, or of one longer text."""
    start, held = 0, 0
    for i, n in enumerate(texts.str.len().fillna(0).astype(int)):
        if held + n > most and i > start:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(texts):
        yield slice(start, len(texts))


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, giving freed memory back to the system when a task ends: workers outlive their tasks."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pyarrow.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # only where the C library can
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def series_udf(run: Callable[[Iterator], Iterator], kind: DataType):
    """A pandas UDF of one column from an iterator over its batches; it gives memory back after a task."""

    def batches(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from released(run)(series)

    return F.pandas_udf(batches, kind)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of the documents that no model learns from."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))
