"""Registration of queries with their oracle SQL and a common output form.

Both sides give timestamps (to the microsecond) and dates as ISO text, decimals and numbers that may
be null as doubles, and flags as 0 or 1, so that values compare equal between
the engines whatever client type a null turns them into.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_KINDS = {
    "t": r"regexp_replace(strftime({0}, '%Y-%m-%d %H:%M:%S.%f'), '\.?0+$', '')", "d": "CAST({0} AS DOUBLE)", "D": "strftime({0}, '%Y-%m-%d')",
    "b": "CAST({0} AS INTEGER)", "i": "CAST({0} AS BIGINT)", "s": "CAST({0} AS VARCHAR)",
}


def plain(df: DataFrame, nullable: Collection[str] = ()) -> DataFrame:
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        if f.name in nullable:
            c = c.cast("double")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def shaped(sql: str, shape: str) -> str:
    """Outer select over ``sql``: ``name`` or ``name:kind``, kinds t, D, d, b, i and s."""
    items = []
    for part in shape.split():
        name, _, kind = part.partition(":")
        quoted = f'"{name}"'
        items.append(f"{_KINDS[kind].format(quoted)} AS {quoted}" if kind else quoted)
    return f"SELECT {', '.join(items)} FROM (\n{sql}\n) result"


def query(name: str, sql: str | None = None, shape: str | None = None, nullable: str = ""):
    """Register a query; ``sql`` is the oracle's independent version of it.

    ``nullable`` names the whole-number columns that may hold nulls.
    """
    doubles = nullable.split()

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir), doubles)
        if sql is not None:
            text = shaped(sql, shape) if shape else sql
            if doubles:
                casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in doubles)
                text = f"SELECT * REPLACE ({casts}) FROM (\n{text}\n) numbers"
            ORACLE[name] = text
        return fn

    return register
