"""Business key to surrogate key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.functions.scalar import open_end
from starloom.operators.dedup import drop_key_duplicates
from starloom.operators.keys import UNKNOWN_KEY


def current_rows(dim: DataFrame, end_col: str = "EndDate") -> DataFrame:
    """Rows that are valid now."""
    return dim.filter(F.col(end_col) == open_end())


def fill_open_end(df: DataFrame, end_col: str = "EndDate") -> DataFrame:
    """Rows without an end are open: the sentinel stands in for null or for a missing column."""
    if end_col not in df.columns:
        return df.withColumn(end_col, open_end())
    return df.withColumn(end_col, F.coalesce(F.col(end_col), open_end()))


@dataclass(frozen=True)
class Lookup:
    """How one dimension key of the fact is resolved."""

    fact_column: str
    business_key: str
    surrogate_key: str
    dimension: str
    output: str | None = None

    @property
    def output_column(self) -> str:
        return self.output or self.surrogate_key


def key_map(dim: DataFrame, business_key: str, surrogate_key: str) -> DataFrame:
    """Business key and smallest surrogate key among its current rows: unique per business key."""
    return (
        current_rows(dim)
        .groupBy(F.col(business_key).alias("_bk"))
        .agg(F.min(surrogate_key).alias("_sk"))
    )


def resolve_key(fact: DataFrame, dim: DataFrame, lookup: Lookup) -> DataFrame:
    """Add the surrogate key of the current member, -1 where there is none.

    The join is left to Spark: a map below the broadcast threshold is sent to
    the executors, a larger one is shuffled and skewed partitions are split.
    """
    keys = key_map(dim, lookup.business_key, lookup.surrogate_key)
    joined = fact.join(keys, fact[lookup.fact_column] == keys["_bk"], "left")
    unknown = F.lit(UNKNOWN_KEY).cast(dim.schema[lookup.surrogate_key].dataType)
    return joined.withColumn(lookup.output_column, F.coalesce("_sk", unknown)).drop("_bk", "_sk")


def resolve_keys(fact: DataFrame, dims: dict[str, DataFrame], lookups: list[Lookup]) -> DataFrame:
    for lookup in lookups:
        fact = resolve_key(fact, dims[lookup.dimension], lookup)
    return fact


def touched_only(df: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a large table whose key occurs in a batch.

    The distinct keys of a daily batch usually fit a broadcast, and then the
    large table is filtered where it lies instead of being shuffled.
    """
    return df.join(touched.select(*keys).distinct(), list(keys), "left_semi").select(*df.columns)


def known_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch that the target has."""
    return touched_only(target.select(*keys), batch, keys)


def insert_only(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks, one per key; existing rows never change."""
    fresh = batch.join(known_keys(target, batch, keys), list(keys), "left_anti")
    return drop_key_duplicates(fresh, keys)


def _same_group(other: DataFrame, keys: Sequence[str]):
    """The keys of ``other`` and the condition that they are those of a row; only the first is a key of the join, the rest is compared inside its group."""
    group, *rest = keys
    named = other.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
    same = F.col(group) == F.col(f"_other_{group}")
    for k in rest:  # an equality would be a second key of the join
        same = same & F.col(k).between(F.col(f"_other_{k}"), F.col(f"_other_{k}"))
    return named, same


def known_by_group(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``known_keys`` by the first key alone: a batch that lies in buckets of it is not shuffled."""
    return target.select(*keys).join(*_same_group(batch, keys), "left_semi")


def insert_only_by_group(batch: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``insert_only`` with the known keys at hand, all steps by the first key alone: a batch that lies in buckets of it is not shuffled.

    The other keys are compared inside a group (the lines of an order), known with new ones pair by pair.
    """
    group, *rest = keys
    others = [F.col(f"`{c}`").asc_nulls_last() for c in batch.columns if c not in keys]
    order = Window.partitionBy(group).orderBy(*rest, *others)
    repeats = F.row_number().over(order) > 1
    for k in rest:
        repeats = repeats & F.lag(k).over(order).eqNullSafe(F.col(k))
    return batch.join(*_same_group(known, keys), "left_anti").withColumn("_repeats", repeats).filter(~F.col("_repeats")).drop("_repeats")


def known_in_months(target: DataFrame, batch: DataFrame, keys: Sequence[str], month: str, months: DataFrame) -> DataFrame:
    """``known_keys`` of a target that is partitioned by ``month``, as in ``insert_only_in_months``."""
    order = [c for c in months.columns if c != month]
    asked = batch.select(*keys).join(months, order).select(*keys, month).filter(F.col(month) >= 0).distinct()
    return target.select(*keys, month).join(asked, [*keys, month], "left_semi").select(*keys)


def insert_only_in_months(target: DataFrame, batch: DataFrame, keys: Sequence[str], month: str, months: DataFrame) -> DataFrame:
    """``insert_only`` against a target that is partitioned by ``month``; the months of the batch's orders are opened and no others.

    ``months`` says in which months the target holds rows of an order of the batch (the order's key among ``keys``, and ``month``, a number from 0 on). An order
    that it does not name is new as a whole. More months than needed do no harm; an order that was filed under
    another month than its date has now is found where it is.
    """
    known = known_in_months(target, batch, keys, month, months)
    return drop_key_duplicates(batch.join(known, list(keys), "left_anti"), keys)
