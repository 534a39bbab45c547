"""Cleanse job over many tables with failures isolated per table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.cleanse import cleanse
from starloom.sources.jdbc import JdbcTarget, Split, read_jdbc, write_jdbc

STATUS = "table_name string, status string, message string"


class CleanseFailed(RuntimeError):
    """Some tables failed; ``status`` holds the outcome of every table."""

    def __init__(self, status: DataFrame, names: list[str]):
        super().__init__(f"failed tables: {', '.join(names)}")
        self.status = status


def cleanse_tables(
    spark: SparkSession,
    tables: Sequence[str],
    read: Callable[[str], DataFrame],
    write: Callable[[DataFrame, str], object],
    keys: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Read, cleanse and write each table; go on after a failure and raise at the end.

    Tables without declared keys fall back to the name rule for key columns.
    """
    rows = []
    for name in tables:
        try:
            write(cleanse(read(name), (keys or {}).get(name)), name)
            rows.append((name, "done", None))
        except Exception as error:  # isolated per table and reported
            rows.append((name, "failed", str(error)))
    status = spark.createDataFrame(rows, STATUS)
    failed = [r[0] for r in rows if r[1] == "failed"]
    if failed:
        raise CleanseFailed(status, failed)
    return status


def cleanse_over_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    tables: str,
    staging: str = "staging",
    warehouse: str = "dwh",
    mode: str = "overwrite",
    keys: dict[str, Sequence[str]] | None = None,
    splits: dict[str, Split] | None = None,
    write_partitions: int | None = None,
) -> DataFrame:
    """The job between two schemas of one database, for a comma list of tables.

    ``splits`` says over which ranges of which column a table is read in parallel. The partitions
    of the result are written as they are, or ``write_partitions`` at a time to spare the database.
    """
    names = [n.strip() for n in tables.split(",") if n.strip()]

    def read(name: str) -> DataFrame:
        return read_jdbc(spark, target, f"{staging}.{name}", (splits or {}).get(name))

    def write(df: DataFrame, name: str) -> None:
        write_jdbc(df, target, f"{warehouse}.{name}", mode, write_partitions)

    return cleanse_tables(spark, names, read, write, keys)
