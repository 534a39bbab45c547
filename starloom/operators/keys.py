"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.runtime import cut_lineage

UNKNOWN_KEY = -1


def next_key(df: DataFrame, key_col: str) -> DataFrame:
    """One row ``next_key``: the largest key plus one, 1 where there is none above 0 (an empty table, or the unknown member alone)."""
    return df.agg((F.greatest(F.coalesce(F.max(key_col), F.lit(0)), F.lit(0)).cast("long") + 1).alias("next_key"))


def assign_keys(
    df: DataFrame,
    key_col: str,
    order: Sequence[str],
    after: DataFrame | None = None,
    after_col: str | None = None,
    unique: bool = True,
) -> DataFrame:
    """Dense keys in the order of ``order``, starting at 1 or after the largest key of ``after``.

    Rows are range-partitioned and sorted, written once (so that the boundaries
    cannot move between uses), and each partition then gets the number of rows
    before it. No task sees more than one range.

    ``unique`` says that the ordering columns identify a row, as business keys
    do. Otherwise the rows are first written with a random number as last
    ordering column: copies of a row spread over tasks, and because the number
    is stored, a repeated task sends every row to the same place again.
    """
    order = list(order)
    source = df
    if not unique:
        source = cut_lineage(df.withColumn("_salt", F.rand()))
        order = [*order, "_salt"]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.select(*df.columns, F.monotonically_increasing_id().alias("_pos")))
    base = 0 if after is None else next_key(after, after_col or key_col).first()[0] - 1
    part = F.shiftright("_pos", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # one row per partition, so this window and its broadcast are small whatever the data size
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    out = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    key = F.col("_start") + F.col("_pos").bitwiseAND((1 << 33) - 1) + (base + 1)
    return out.select(key.alias(key_col), *[F.col(f"`{c}`") for c in df.columns])


def assign_keys_by_group(
    df: DataFrame, sizes: DataFrame, key_col: str, group: str, order: Sequence[str], after: DataFrame | None = None, after_col: str | None = None
) -> DataFrame:
    """The keys that ``assign_keys`` gives in the order of ``group`` and ``order``, without moving the rows by range.

    ``sizes`` (``group``, ``_size``) says how many rows each group has, nulls being one. Only these counts are put in order and summed; a row is numbered inside
    its group, where rows that are partitioned by it already stay.
    """
    ranged = sizes.select(group, "_size").repartitionByRange(group).sortWithinPartitions(group)
    placed = cut_lineage(ranged.select(group, "_size", F.monotonically_increasing_id().alias("_pos")))
    base = 0 if after is None else next_key(after, after_col or key_col).first()[0] - 1
    placed = placed.withColumn("_part", F.shiftright("_pos", 33))
    # one row per partition, so this window and its broadcast are small whatever the data size
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.sum("_size").alias("_size")).select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_size").over(inside), F.lit(0)) + F.col("_before")
    starts = placed.join(F.broadcast(parts), "_part").select(group, start.alias("_start"))
    # rows without a group come first
    key = F.coalesce("_start", F.lit(0)) + F.row_number().over(Window.partitionBy(group).orderBy(*order)) + base
    return df.join(starts, group, "left").select(key.cast("long").alias(key_col), *[F.col(f"`{c}`") for c in df.columns])


def number_stored_rows(df: DataFrame, key_col: str) -> DataFrame:
    """Dense keys for a table stored as Parquet, without a shuffle of its rows.

    The position of a row in its file is fixed, so only the row counts per file
    are needed. ``df`` must be a plain scan. The counts are sent to where the rows lie:
    there is one for each file, while the plan takes them for as large as the rows.
    """
    scan = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = scan.groupBy("_file").agg(F.count("*").alias("_size"))
    # one row per file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    out = scan.join(F.broadcast(starts), "_file")
    return out.select((F.col("_start") + F.col("_row") + 1).alias(key_col), *[F.col(f"`{c}`") for c in df.columns])


def with_unknown_member(dim: DataFrame, key_col: str) -> DataFrame:
    """The dimension plus a member with key -1 and nulls elsewhere, the target of unresolved fact keys."""
    spark = dim.sparkSession
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema if f.name != key_col]
    member = spark.range(1).select(F.lit(UNKNOWN_KEY).cast(dim.schema[key_col].dataType).alias(key_col), *blank)
    return dim.unionByName(member.select(dim.columns))
