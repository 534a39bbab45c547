"""Integrity checks that return violations or counts as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import current_rows


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def primary_key_report(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, null keys, and rows beyond the first of a key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("n_duplicate"),
    )


def multiple_current(dim: DataFrame, keys: Sequence[str], end_col: str = "EndDate") -> DataFrame:
    """Business keys with more than one open row."""
    return duplicate_keys(current_rows(dim, end_col), keys)


def inverted_validity(dim: DataFrame, start: str = "StartDate", end: str = "EndDate") -> DataFrame:
    """Rows that end before they start."""
    return dim.filter(F.col(end) < F.col(start))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def foreign_key_report(child: DataFrame, relations: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per relation with the number of orphan child rows and of distinct orphan keys.

    The child is reduced to counts per key before the join, so a hot key costs one row.
    """
    rows = []
    for name, (child_key, parent, parent_key) in relations.items():
        counts = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(F.count("*").alias("_n"))
        missing = counts.join(parent.select(F.col(parent_key).alias("_k")).distinct(), "_k", "left_anti")
        rows.append(
            missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_orphans"), F.count("*").alias("n_keys")).select(
                F.lit(name).alias("relation"), "n_orphans", "n_keys"
            )
        )
    return reduce(DataFrame.unionByName, rows)


def cascade_delete(fact: DataFrame, fact_key: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """The fact without the rows that refer to deleted dimension rows; null keys stay."""
    gone = deleted.select(F.col(deleted_key).alias("_gone")).distinct()
    return fact.join(gone, fact[fact_key] == gone["_gone"], "left_anti")


def _long(df: DataFrame, counts: dict[str, F.Column]) -> DataFrame:
    """One pass over ``df``, then one output row per counted column."""
    one = df.agg(*[c.alias(n) for n, c in counts.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("n_violations")) for n in counts])
    return one.select(F.inline(pairs))


def not_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each column that must not be null."""
    return _long(df, {c: F.count_if(F.col(f"`{c}`").isNull()) for c in columns})


def length_report(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Number of values longer than their limit, per column."""
    return _long(df, {c: F.count_if(F.length(F.col(f"`{c}`")) > n) for c, n in limits.items()})


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and emptiness flag of each table."""
    rows = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows", (F.col("n_rows") == 0).alias("is_empty"))
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


class EmptyLoad(RuntimeError):
    """A load that must bring rows brought none."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyLoad(f"{name} has no rows")
    return df
