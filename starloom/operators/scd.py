"""Slowly changing dimensions as DataFrame transformations.

The change set is computed once from the de-duplicated staging rows. It has at
most one row per staged key, so on a daily load it is small beside the target
and the target is only filtered and joined with it, never re-sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import any_differs, open_end
from starloom.operators.dedup import dedup_latest
from starloom.operators.keys import assign_keys
from starloom.operators.lookup import current_rows, touched_only
from starloom.runtime import cut_lineage

INSERT, CHANGE, SAME, LATE = "insert", "change", "same", "late"


@dataclass(frozen=True)
class DimensionSpec:
    """Columns of a historised dimension."""

    name: str
    surrogate_key: str
    business_keys: tuple[str, ...]
    tracked: tuple[str, ...]
    start: str = "StartDate"
    end: str = "EndDate"

    @property
    def row_columns(self) -> list[str]:
        return [*self.business_keys, *self.tracked, self.start, self.end]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate_key, *self.row_columns]


def change_set(target: DataFrame, staging: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Newest staging row of each key with ``_action``: insert, change, same or late.

    ``late`` rows differ but do not start after the current row; merging them
    would turn its validity around, so they are reported and left out.
    """
    keys = list(spec.business_keys)
    newest = dedup_latest(staging.select(*keys, *spec.tracked, spec.start), keys, spec.start)
    wanted = [*keys, *spec.tracked, spec.start]
    current = touched_only(current_rows(target, spec.end).select(*wanted), staging, keys)
    s, t = newest.alias("s"), current.alias("t")
    on = [F.col(f"s.`{k}`") == F.col(f"t.`{k}`") for k in keys]
    start_s, start_t = F.col(f"s.`{spec.start}`"), F.col(f"t.`{spec.start}`")
    action = (
        F.when(start_t.isNull(), INSERT)
        .when(~any_differs(spec.tracked, "s", "t"), SAME)
        .when(start_s > start_t, CHANGE)
        .otherwise(LATE)
    )
    return s.join(t, on, "left").select(*[F.col(f"s.`{c}`") for c in wanted], action.alias("_action"))


def expire(target: DataFrame, changes: DataFrame, spec: DimensionSpec) -> DataFrame:
    """The target with the current row of every changed key ended one second before its new version."""
    keys = list(spec.business_keys)
    marks = changes.filter(F.col("_action") == CHANGE).select(*keys, F.col(spec.start).alias("_until"))
    until = F.col("_until") - F.expr("interval 1 second")
    closes = F.col("_until").isNotNull() & (F.col(spec.end) == open_end())
    ended = F.when(closes, until).otherwise(F.col(spec.end)).alias(spec.end)
    columns = [ended if c == spec.end else F.col(f"`{c}`") for c in target.columns]
    return target.join(marks, keys, "left").select(*columns)


def new_versions(changes: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Rows to add: new keys and new versions of changed keys, open-ended."""
    rows = changes.filter(F.col("_action").isin(INSERT, CHANGE))
    return rows.withColumn(spec.end, open_end()).select(*spec.row_columns)


def scd2_merge(
    target: DataFrame,
    staging: DataFrame,
    spec: DimensionSpec,
    changes: DataFrame | None = None,
    numbered: DataFrame | None = None,
) -> DataFrame:
    """Type-2 merge: unchanged and absent keys stay, changed keys get a new version, new keys are added.

    New rows take the keys after the largest one of ``numbered`` (the target
    unless given), in business-key order. ``target`` may be the open rows only,
    with the whole table as ``numbered``: closed rows never change.
    """
    numbered = target if numbered is None else numbered
    changes = cut_lineage(change_set(target, staging, spec)) if changes is None else changes
    fresh = assign_keys(
        new_versions(changes, spec), spec.surrogate_key, spec.business_keys, after=numbered, after_col=spec.surrogate_key
    )
    kept = expire(target, changes, spec)
    key_type = target.schema[spec.surrogate_key].dataType
    fresh = fresh.withColumn(spec.surrogate_key, F.col(spec.surrogate_key).cast(key_type))
    return kept.select(*spec.columns).unionByName(fresh.select(*spec.columns))


def merge_stats(changes: DataFrame) -> DataFrame:
    """One row: rows expired, inserted, left as they are, and reported as late."""
    action = F.col("_action")
    return changes.agg(
        F.count_if(action == CHANGE).alias("rows_expired"),
        F.count_if(action.isin(INSERT, CHANGE)).alias("rows_inserted"),
        F.count_if(action == SAME).alias("rows_unchanged"),
        F.count_if(action == LATE).alias("rows_late"),
    )


def scd1_merge(target: DataFrame, staging: DataFrame, spec: DimensionSpec, numbered: DataFrame | None = None) -> DataFrame:
    """Type-1 merge: changed attributes are overwritten in place, new keys are added, no history.

    A row that does not start after the current one is late and changes nothing, as in a type-2 merge.
    ``StartDate`` moves only with a real change, so merging the same batch twice gives the same table.
    """
    keys = list(spec.business_keys)
    newest = dedup_latest(staging.select(*keys, *spec.tracked, spec.start), keys, spec.start)
    current = current_rows(target, spec.end)
    t, s = current.alias("t"), newest.withColumn("_hit", F.lit(True)).alias("s")
    on = [F.col(f"s.`{k}`") == F.col(f"t.`{k}`") for k in keys]
    newer = F.col(f"s.`{spec.start}`") > F.col(f"t.`{spec.start}`")
    take = F.col("s._hit").isNotNull() & newer & any_differs(spec.tracked, "s", "t")
    columns = []
    for c in spec.columns:
        old = F.col(f"t.`{c}`")
        columns.append((F.when(take, F.col(f"s.`{c}`")).otherwise(old) if c in (*spec.tracked, spec.start) else old).alias(c))
    updated = t.join(s, on, "left").select(*columns)
    added = newest.join(current.select(*keys), keys, "left_anti").withColumn(spec.end, open_end())
    numbered = target if numbered is None else numbered
    added = assign_keys(added.select(*spec.row_columns), spec.surrogate_key, keys, after=numbered, after_col=spec.surrogate_key)
    key_type = target.schema[spec.surrogate_key].dataType
    added = added.withColumn(spec.surrogate_key, F.col(spec.surrogate_key).cast(key_type))
    closed = target.filter(F.col(spec.end) != open_end()).select(*spec.columns)
    return updated.unionByName(added.select(*spec.columns)).unionByName(closed)


def staged_duplicates(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that a batch holds more than once, with their count."""
    return staging.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
