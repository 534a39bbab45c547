"""High-water marks of change extraction."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.scalar import DAWN, ntz, to_second

WATERMARK_SCHEMA = "table_name string, last_watermark timestamp_ntz, updated_at timestamp_ntz"


def changed_since(df: DataFrame, date_cols: Sequence[str], since) -> DataFrame:
    """Rows with one of the dates strictly after ``since``; a null date is not a change."""
    mark = ntz(since)
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) > mark for c in date_cols]))


def seed_watermarks(store: DataFrame, seeds: DataFrame) -> DataFrame:
    """The store plus the seed rows of tables it does not know yet."""
    fresh = seeds.dropDuplicates(["table_name"]).join(store.select("table_name"), "table_name", "left_anti")
    return store.unionByName(fresh.select(store.columns))


def named_seeds(spark: SparkSession, names: Sequence[str], now, at=DAWN) -> DataFrame:
    """One seed per name, target or source table, all at the same moment."""
    rows = spark.createDataFrame([(n,) for n in names], "table_name string")
    return rows.select("table_name", ntz(at).alias("last_watermark"), ntz(now).alias("updated_at"))


def seeds_from_tables(spark: SparkSession, tables: dict[str, DataFrame], column: str, now) -> DataFrame:
    """One seed per loaded table: its largest date, so that nothing between copy and seed is skipped."""
    rows = [
        df.agg(F.max(column).cast("timestamp_ntz").alias("_max")).select(
            F.lit(name).alias("table_name"),
            F.coalesce(to_second(F.col("_max")), ntz(DAWN)).alias("last_watermark"),
            ntz(now).alias("updated_at"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], WATERMARK_SCHEMA)


def get_watermark(store: DataFrame, table: str) -> DataFrame:
    """One row ``last_watermark``; 1900-01-01 for an unknown table."""
    return store.filter(F.col("table_name") == table).agg(
        F.coalesce(F.max("last_watermark"), ntz(DAWN)).alias("last_watermark")
    )


def new_watermark(delta: DataFrame, column: str = "StartDate") -> DataFrame:
    """One row ``new_watermark``: the largest date to the second, null for an empty or all-null delta."""
    if column not in delta.columns:
        return delta.agg(F.lit(None).cast("timestamp_ntz").alias("new_watermark"))
    return delta.agg(to_second(F.max(column)).alias("new_watermark"))


def source_high_water(sources: Iterable[DataFrame], since, date_col: str = "ModifiedDate") -> DataFrame:
    """One row ``high_water``: the newest change in any source after ``since``, to the second, null if none."""
    newest = [changed_since(s.select(date_col), [date_col], since).agg(F.max(date_col).alias("_d")) for s in sources]
    return reduce(DataFrame.unionByName, newest).agg(to_second(F.max("_d")).alias("high_water"))


def set_watermark(store: DataFrame, table: str, value, now) -> DataFrame:
    """The store with one mark replaced. Unknown tables are an error for the caller to check first."""
    hit = F.col("table_name") == table
    return store.select(
        "table_name",
        F.when(hit, ntz(value)).otherwise(F.col("last_watermark")).alias("last_watermark"),
        F.when(hit, ntz(now)).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def union_keys(parts: Iterable[DataFrame], key: str) -> DataFrame:
    """Distinct touched keys from several sources."""
    return reduce(DataFrame.unionByName, [p.select(key) for p in parts]).distinct()
