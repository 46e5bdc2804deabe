"""One row per key, chosen by an order, without sorting whole groups.

``max_by``/``min_by`` are combined inside every map task, so a key that holds a large share of
the rows sends one row per task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_row(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row of each key that is greatest in ``order``."""
    return _one_row(df, keys, order, F.max_by)


def first_row(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row of each key that is smallest in ``order``."""
    return _one_row(df, keys, order, F.min_by)


def _one_row(df: DataFrame, keys: list[str], order: list[str | Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order)
    if not rest:
        return df.select(*keys).distinct()
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)
