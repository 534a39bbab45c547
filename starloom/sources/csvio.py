"""CSV transfer with the two null conventions of the loads.

``full``: an empty field is null, so empty text and null become one.
``delta``: null is written as ``\\N`` and empty text as ``""``, so both survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_COMMON = {"header": "true", "quote": '"', "escape": '"'}
# How each convention writes and reads null and empty text.
WRITE = {"full": {"nullValue": "", "emptyValue": ""}, "delta": {"nullValue": "\\N", "emptyValue": '""'}}
READ = {"full": {"nullValue": "", "emptyValue": ""}, "delta": {"nullValue": "\\N", "emptyValue": ""}}


def _options(table: dict[str, dict[str, str]], convention: str) -> dict[str, str]:
    if convention not in table:
        raise ValueError("convention must be full or delta")
    return {**_COMMON, **table[convention]}


def write_csv(df: DataFrame, path: str, convention: str = "delta", mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**_options(WRITE, convention)).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, convention: str = "delta", multi_line: bool = False
) -> DataFrame:
    """Files are split over tasks; ``multi_line`` keeps line breaks inside texts, but then each file is read by one task."""
    options = {**_options(READ, convention), "multiLine": str(multi_line).lower()}
    return spark.read.schema(schema).options(**options).csv(path)
