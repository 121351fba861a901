"""Keyed dedup in an explicit order (A1-A5). The order is data, never the order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _wins(df: DataFrame, keys: list[str], order: list[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*").select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the first in the order."""
    return _wins(df, keys, list(order), F.min_by)


def last_wins(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the last in the order."""
    return _wins(df, keys, list(order), F.max_by)
