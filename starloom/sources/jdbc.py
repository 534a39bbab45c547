"""JDBC tables and parameterised queries as DataFrames; the driver jar comes with the session."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}


@dataclass(frozen=True)
class Split:
    """Parallel read over ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column, "lowerBound": str(self.lower), "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_options(target: JdbcTarget, source: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Timestamps without a zone stay so: marks compared with them are then pushed to the database."""
    fixed = {"dbtable": source, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    return {**target.options(), **fixed, **(split.options() if split else {})}


def write_options(target: JdbcTarget, table: str, batch_size: int = 10_000, partitions: int | None = None) -> dict[str, str]:
    limit = {} if partitions is None else {"numPartitions": str(partitions)}
    return {**target.options(), "dbtable": table, "batchsize": str(batch_size), **limit}


def changed_rows_query(table: str, columns: list[str], date_column: str, since) -> str:
    """Sub-query for the changed rows of a table, so that the source filters them."""
    return f"(SELECT {', '.join(columns)} FROM {table} WHERE {date_column} > '{since:%Y-%m-%d %H:%M:%S}') AS delta"


def read_jdbc(spark: SparkSession, target: JdbcTarget, source: str, split: Split | None = None) -> DataFrame:
    """A table or a parenthesised sub-query; without a split one task reads it all."""
    return spark.read.format("jdbc").options(**read_options(target, source, split)).load()


def read_sources(spark: SparkSession, target: JdbcTarget, tables: dict[str, str], splits: dict[str, Split] | None = None) -> dict[str, DataFrame]:
    """Source tables by their name in the builders, e.g. ``{"person": "Person.Person"}``."""
    return {name: read_jdbc(spark, target, table, (splits or {}).get(name)) for name, table in tables.items()}


def write_jdbc(df: DataFrame, target: JdbcTarget, table: str, mode: str = "overwrite", partitions: int | None = None) -> None:
    """Every partition is a connection; ``partitions`` bounds them where the database needs it."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be overwrite or append")
    df.write.format("jdbc").mode(mode).options(**write_options(target, table, partitions=partitions)).save()
