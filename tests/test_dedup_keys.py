import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import dedup, keys
from starloom.operators.lookup import Lookup, current_rows, fill_open_end, insert_only, resolve_key
from starloom.functions.scalar import ntz
from starloom.runtime import cut_lineage
from tests.conftest import rows


def test_first_row_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("StartDate"), F.lit("x").alias("v"))
    for out in (dedup.dedup_latest(df, ["k"]), dedup.preferred_row(df, ["k"], "v", ["x"], ["StartDate"]), dedup.drop_key_duplicates(df, ["k"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2, plan


def test_latest_and_ties(spark):
    df = spark.createDataFrame(
        [(1, "2020", "b"), (1, "2020", "a"), (1, "2019", "z"), (2, None, "q"), (3, None, None), (3, "2000", None)],
        "k int, StartDate string, v string")
    assert rows(dedup.dedup_latest(df, ["k"])) == [(1, "2020", "a"), (2, None, "q"), (3, "2000", None)]


def test_preference(spark):
    df = spark.createDataFrame([(1, "Billing", "a"), (1, "Shipping", "z"), (2, "Home", "b"), (2, "Home", "a"), (3, "Main Office", "c"), (3, None, "a")],
                               "k int, t string, line string")
    got = dedup.preferred_row(df, ["k"], "t", ["Main Office", "Shipping", "Billing"], ["line"])
    assert rows(got) == [(1, "Shipping", "z"), (2, "Home", "a"), (3, "Main Office", "c")]


def test_key_name_rule(spark):
    df = spark.createDataFrame([(1, "x", True), (1, "x", True), (2, "y", True)], "CustomerID int, MiddleName string, IsHoliday boolean")
    assert dedup.key_like_columns(df) == ["CustomerID", "MiddleName", "IsHoliday"]
    assert dedup.drop_key_duplicates(df).count() == 2
    plain = df.select(F.col("CustomerID").alias("n"))
    assert dedup.drop_key_duplicates(plain).count() == 3


def test_dense_keys_with_ties_and_offset(spark):
    values = [random.Random(3).randint(0, 40) for _ in range(3000)] + [7] * 2000
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    keyed = keys.assign_keys(df, "k", ["v"], unique=False)
    got = sorted((r.k, r.v) for r in keyed.collect())
    assert [k for k, _ in got] == list(range(1, 5001))
    assert [v for _, v in got] == sorted(values)
    more = keys.assign_keys(spark.range(3).withColumnRenamed("id", "v"), "k", ["v"], after=keyed)
    assert rows(more) == [(5001, 0), (5002, 1), (5003, 2)]


def test_keys_of_empty_tables(spark):
    empty = spark.createDataFrame([], "v int")
    assert keys.assign_keys(empty, "k", ["v"]).count() == 0
    assert keys.next_key(empty, "v").first()[0] == 1
    assert rows(keys.assign_keys(spark.range(1).withColumnRenamed("id", "v"), "k", ["v"], after=empty.select(F.col("v").alias("k")))) == [(1, 0)]


def test_numbering_of_stored_rows(spark):
    stored = cut_lineage(spark.range(1000).repartition(5))
    got = sorted(r.k for r in keys.number_stored_rows(stored, "k").collect())
    assert got == list(range(1, 1001))
    again = {r.id: r.k for r in keys.number_stored_rows(stored, "k").collect()}
    assert again == {r.id: r.k for r in keys.number_stored_rows(stored, "k").collect()}


def test_unknown_member_and_lookup(spark):
    dim = spark.createDataFrame([(5, 1, "9999-12-31"), (9, 1, "9999-12-31"), (2, 1, "2000-01-01"), (7, 2, "2001-01-01")],
                                "K long, ID int, e string").withColumn("EndDate", ntz(F.col("e"))).drop("e")
    full = keys.with_unknown_member(dim, "K")
    assert full.filter("K = -1").count() == 1 and full.schema["K"].dataType == dim.schema["K"].dataType
    assert current_rows(full).count() == 2
    fact = spark.createDataFrame([(1,), (2,), (None,)], "ID int")
    assert rows(resolve_key(fact, full, Lookup("ID", "ID", "K", "D"))) == [(1, 5), (2, -1), (None, -1)]


def test_insert_only(spark):
    target = spark.createDataFrame([(1, 1, "old"), (1, 2, "old")], "o int, l int, v string")
    batch = spark.createDataFrame([(1, 1, "new"), (2, 1, "b"), (2, 1, "a"), (3, 1, "c")], "o int, l int, v string")
    assert rows(insert_only(target, batch, ["o", "l"])) == [(2, 1, "a"), (3, 1, "c")]


def test_equal_rows_are_spread_over_tasks(spark, monkeypatch):
    """Rows equal in every column must not end up in one range."""
    written = []
    monkeypatch.setattr(keys, "cut_lineage", lambda df: written.append(cut_lineage(df)) or written[-1])
    same = spark.range(20000).select(F.lit(1).alias("v")).repartition(8)
    # tiny partitions are merged otherwise
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = keys.assign_keys(same, "k", ["v"], unique=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    placed = written[-1].groupBy(F.shiftright("_pos", 33)).count().select("count").collect()
    assert len(placed) > 2 and max(r[0] for r in placed) < 10000
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 20001))
    assert "_salt" in written[0].columns


def test_missing_ends(spark):
    df = spark.createDataFrame([(1, None), (2, "2000-01-01")], "k int, e string").select("k", ntz(F.col("e")).alias("EndDate"))
    assert [r.EndDate.year for r in fill_open_end(df).orderBy("k").collect()] == [9999, 2000]
    assert {r.EndDate.year for r in fill_open_end(df.drop("EndDate")).collect()} == {9999}


def test_bad_inputs(spark):
    with pytest.raises(Exception):
        keys.assign_keys(spark.range(1), "k", ["missing"]).count()
