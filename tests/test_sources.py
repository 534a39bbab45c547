from datetime import datetime

import pytest

from starloom.operators.quality import EmptyLoad
from starloom.sources import csvio, jdbc
from starloom.sources.tables import TableStore
from tests.conftest import rows


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def test_versions(spark, store):
    assert not store.exists("dwh", "t") and store.version("dwh", "t") == 0
    with pytest.raises(ValueError):
        store.read("dwh", "t")
    store.write(spark.createDataFrame([(1, "a")], "k int, v string"), "dwh", "t")
    store.write(spark.createDataFrame([("b", 2, 9)], "V string, K int, extra int"), "dwh", "t", "append")
    assert rows(store.read("dwh", "t")) == [(1, "a"), (2, "b")]
    store.write(store.read("dwh", "t").filter("k = 2"), "dwh", "t")
    assert rows(store.read("dwh", "t")) == [(2, "b")] and store.version("dwh", "t") == 3
    assert rows(store.read("dwh", "t", 1)) == [(1, "a")] and rows(store.read("dwh", "t", 2)) == [(1, "a"), (2, "b")]
    assert [r.mode for r in store.history("dwh", "t").orderBy("version").collect()] == ["overwrite", "append", "overwrite"]
    with pytest.raises(ValueError):
        store.read("dwh", "t", 9)


def test_modes_and_shapes(spark, store):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        store.write(df, "dwh", "t", "ignore")
    store.write(df, "dwh", "t")
    with pytest.raises(ValueError):
        store.write(spark.range(1), "dwh", "t", "append")
    assert store.create_like(df, "dwh", "u").count() == 0
    assert store.create_like(spark.range(3), "dwh", "t").columns == ["k", "v"]
    assert store.columns("dwh", "u").names == ["k", "v"]


def test_partitioned_and_empty_tables(spark, store):
    df = spark.createDataFrame([(1, 202001), (2, 202002), (3, 202002)], "k int, m int")
    store.write(df, "dwh", "p", partition_by=["m"])
    store.write(df.filter("k = 9"), "dwh", "p", "append", partition_by=["m"])
    store.write(spark.createDataFrame([(4, 202003)], "k int, m int"), "dwh", "p", "append", partition_by=["m"])
    back = store.read("dwh", "p")
    assert rows(back) == [(1, 202001), (2, 202002), (3, 202002), (4, 202003)]
    plan = back.filter("m = 202002")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    empty = store.write(df.limit(0), "dwh", "e", partition_by=["m"])
    assert empty.count() == 0 and set(empty.columns) == {"k", "m"}


def test_kept_partitions_are_not_rewritten(spark, store):
    df = spark.createDataFrame([(1, True), (2, False)], "k int, open boolean")
    store.write(df, "dwh", "d", partition_by=["open"])
    closed = {f for f in store.read("dwh", "d").inputFiles() if "open=false" in f}
    newer = spark.createDataFrame([(1, False), (3, True)], "k int, open boolean")
    back = store.write(newer, "dwh", "d", partition_by=["open"], keep="open=false")
    assert rows(back) == [(1, False), (2, False), (3, True)] and closed < set(back.inputFiles())
    last = store.write(spark.createDataFrame([(4, True)], "k int, open boolean"), "dwh", "d", partition_by=["open"], keep="open=false")
    assert rows(last) == [(1, False), (2, False), (4, True)]
    assert rows(store.read("dwh", "d", 1)) == [(1, True), (2, False)]
    fresh = store.write(df.filter("open"), "dwh", "n", partition_by=["open"], keep="open=false")
    assert rows(store.write(fresh, "dwh", "n", partition_by=["open"], keep="open=false")) == [(1, True)]


def test_csv_conventions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, ""), (3, None), (4, 'q"x'), (5, "two\nlines")], "k int, v string")
    csvio.write_csv(df, str(tmp_path / "delta"))
    assert rows(csvio.read_csv(spark, str(tmp_path / "delta"), df.schema, multi_line=True)) == rows(df)
    csvio.write_csv(df, str(tmp_path / "full"), "full")
    assert {r.k for r in csvio.read_csv(spark, str(tmp_path / "full"), df.schema, "full", multi_line=True).filter("v IS NULL").collect()} == {2, 3}
    with pytest.raises(ValueError):
        csvio.write_csv(df, str(tmp_path / "x"), "other")


def test_jdbc_options():
    target = jdbc.JdbcTarget("jdbc:postgresql://host/db", "u", "p")
    read = jdbc.read_options(target, "staging.t", jdbc.Split("id", "1", "100", 8))
    assert read["fetchsize"] == "10000" and read["partitionColumn"] == "id" and read["numPartitions"] == "8"
    assert "partitionColumn" not in jdbc.read_options(target, "staging.t")
    assert jdbc.write_options(target, "dwh.t") == {
        "url": "jdbc:postgresql://host/db", "user": "u", "password": "p", "driver": "org.postgresql.Driver",
        "dbtable": "dwh.t", "batchsize": "10000"}
    assert jdbc.changed_rows_query("s.t", ["a", "b"], "m", datetime(2020, 1, 2, 3, 4, 5, 6)) == (
        "(SELECT a, b FROM s.t WHERE m > '2020-01-02 03:04:05') AS delta")
    with pytest.raises(ValueError):
        jdbc.write_jdbc(None, target, "t", "ignore")


def test_empty_load_is_its_own_error():
    assert issubclass(EmptyLoad, RuntimeError)
