"""Types, schema alignment and coercion."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source types that map to one Spark type whatever their size.
PLAIN_TYPES = {
    "text": T.StringType(), "ntext": T.StringType(), "uniqueidentifier": T.StringType(),
    "xml": T.StringType(), "time": T.StringType(),
    "varbinary": T.BinaryType(), "binary": T.BinaryType(), "image": T.BinaryType(),
    "money": T.DecimalType(19, 4), "smallmoney": T.DecimalType(10, 4),
    "float": T.DoubleType(), "real": T.FloatType(),
    "bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(), "tinyint": T.ShortType(),
    "bit": T.BooleanType(),
    "datetime": T.TimestampNTZType(), "datetime2": T.TimestampNTZType(), "smalldatetime": T.TimestampNTZType(),
    "date": T.DateType(),
}


def map_type(source_type: str, max_bytes: int = -1, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type of a source column; two-byte character types hold half as many characters as bytes."""
    name = source_type.lower()
    if name in ("varchar", "char"):
        return T.StringType() if max_bytes == -1 else T.VarcharType(max_bytes)
    if name in ("nvarchar", "nchar"):
        return T.StringType() if max_bytes == -1 else T.VarcharType(ceil(max_bytes / 2))
    if name in ("decimal", "numeric"):
        return T.DecimalType(precision, scale) if precision and scale is not None else T.DecimalType(38, 18)
    return PLAIN_TYPES.get(name, T.StringType())


def table_schema(columns: list[tuple]) -> T.StructType:
    """Schema from ``(name, type, bytes, precision, scale, nullable)`` rows in column order."""
    if not columns:
        raise ValueError("table not found or without columns")
    return T.StructType([T.StructField(n, map_type(t, b, p, s), bool(null)) for n, t, b, p, s, null in columns])


def _plain(data_type: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(data_type, (T.VarcharType, T.CharType)) else data_type


def typed_projection(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns cast to the schema's types, in its order."""
    return df.select(*[F.col(f"`{f.name}`").cast(_plain(f.dataType)).alias(f.name) for f in schema])


def schema_profile(df: DataFrame) -> list[tuple[int, str, str, bool]]:
    """``(position, name, type, nullable)`` of each column; no data is read."""
    return [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema, start=1)]


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that df shares with the target, in target order and spelling.

    Names are compared without case, blanks and quotes; extra columns are dropped.
    """
    have = {c.strip().strip('"').lower(): c for c in df.columns}
    shared = [f.name for f in schema if f.name.lower() in have]
    if not shared:
        raise ValueError("no common columns with the target schema")
    return df.select(*[F.col(f"`{have[n.lower()]}`").alias(n) for n in shared])


def coerce(col: Column, data_type: T.DataType) -> Column:
    """Value as the target type; what cannot be read becomes null.

    Integers are parsed as numbers and rounded half to even ('2.0' and '2.5' give 2);
    booleans know t, f, true and false only.
    """
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.bround(F.trim(col.cast("string")).try_cast("decimal(38,10)"), 0).try_cast(data_type)
    if isinstance(data_type, (T.DecimalType, T.DoubleType, T.FloatType)):
        return F.trim(col.cast("string")).try_cast(data_type)
    if isinstance(data_type, T.BooleanType):
        text = col.cast("string")
        return F.when(text.isin("t", "true"), True).when(text.isin("f", "false"), False)
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return col.try_cast(data_type)
    return col.cast(_plain(data_type))


def coerce_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Align to the target, then coerce every column to its type."""
    aligned = align_to_schema(df, schema)
    return aligned.select(*[coerce(F.col(f"`{c}`"), schema[c].dataType).alias(c) for c in aligned.columns])
