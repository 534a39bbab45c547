"""One row per key.

All variants are ``row_number() = 1`` filters: Spark keeps the best row per key
inside every map task before it shuffles, so a key with a third of all rows
sends one row per task and not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Newest row of each key; ``ties`` decides among rows of the same date."""
    return first_per_key(df, keys, [F.col(newest_by).desc_nulls_last(), *[_col(t) for t in ties]])


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_by: str = "StartDate") -> DataFrame:
    """Newest row of each key with all other columns as tie-break, so the choice never depends on row order."""
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in keys and c != newest_by]
    return latest_per_key(df, keys, newest_by, rest)


def preferred_row(df: DataFrame, keys: Sequence[str], rank_col: str, ranking: Sequence[str], ties: Sequence) -> DataFrame:
    """Row whose ``rank_col`` value stands earliest in ``ranking``; unlisted values come last."""
    rank = F.lit(len(ranking))
    for position, value in reversed(list(enumerate(ranking))):
        rank = F.when(F.col(rank_col) == value, position).otherwise(rank)
    return first_per_key(df, keys, [rank, *[_col(t) for t in ties]])


def key_like_columns(df: DataFrame) -> list[str]:
    """Columns whose name contains "key" or "id" (a loose rule: it also hits e.g. IsHoliday)."""
    return [c for c in df.columns if "key" in c.lower() or "id" in c.lower()]


def drop_key_duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per key with a deterministic survivor: the smallest in the order of the other columns.

    Without ``keys`` the name rule of ``key_like_columns`` applies; if it finds none, rows stay as they are.
    """
    keys = list(keys) if keys is not None else key_like_columns(df)
    if not keys:
        return df
    rest = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]
    return first_per_key(df, keys, rest or [F.lit(1)])
