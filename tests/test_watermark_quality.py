from datetime import datetime

import pytest

from starloom.operators import quality as q
from starloom.operators import watermark as wm
from tests.conftest import rows

T = "timestamp_ntz"


def test_change_filter_is_strict_and_ignores_nulls(spark):
    df = spark.createDataFrame([(1, datetime(2000, 1, 1), None), (2, datetime(2000, 1, 1, 0, 0, 1), None), (3, None, None), (4, None, datetime(2001, 1, 1))],
                               f"id int, a {T}, b {T}")
    assert [r.id for r in wm.changed_since(df, ["a", "b"], "2000-01-01 00:00:00").collect()] == [2, 4]


def test_marks(spark):
    df = spark.createDataFrame([(datetime(2000, 1, 1, 5, 6, 7, 890000),), (None,)], f"StartDate {T}")
    assert wm.new_watermark(df).first()[0] == datetime(2000, 1, 1, 5, 6, 7)
    assert wm.new_watermark(df.filter("StartDate IS NULL")).first()[0] is None
    assert wm.new_watermark(df.limit(0)).first()[0] is None
    assert wm.new_watermark(df, "Missing").first()[0] is None


def test_seed_get_set(spark):
    store = spark.createDataFrame([("A", datetime(2000, 1, 1), datetime(2000, 1, 1))], wm.WATERMARK_SCHEMA)
    tables = {"A": spark.createDataFrame([(datetime(2005, 1, 1),)], f"d {T}"), "B": spark.createDataFrame([], f"d {T}")}
    seeded = wm.seed_watermarks(store, wm.seeds_from_tables(spark, tables, "d", "2024-01-01"))
    assert {r.table_name: r.last_watermark for r in seeded.collect()} == {"A": datetime(2000, 1, 1), "B": datetime(1900, 1, 1)}
    assert wm.get_watermark(seeded, "A").first()[0] == datetime(2000, 1, 1)
    assert wm.get_watermark(seeded, "nope").first()[0] == datetime(1900, 1, 1)
    moved = {r.table_name: (r.last_watermark, r.updated_at) for r in wm.set_watermark(seeded, "B", "2010-01-01", "2024-02-02").collect()}
    assert moved["B"] == (datetime(2010, 1, 1), datetime(2024, 2, 2)) and moved["A"][0] == datetime(2000, 1, 1)
    assert wm.seeds_from_tables(spark, {}, "d", "2024-01-01").count() == 0


def test_named_seeds(spark):
    got = wm.named_seeds(spark, ["a", "b"], "2024-01-01").collect()
    assert [(r.table_name, r.last_watermark) for r in got] == [("a", datetime(1900, 1, 1)), ("b", datetime(1900, 1, 1))]


def test_source_high_water(spark):
    a = spark.createDataFrame([(datetime(2000, 1, 1),)], f"ModifiedDate {T}")
    b = spark.createDataFrame([(datetime(2003, 1, 1, 0, 0, 0, 5),), (None,)], f"ModifiedDate {T}")
    assert wm.source_high_water([a, b], "1999-01-01").first()[0] == datetime(2003, 1, 1)
    assert wm.source_high_water([a, b], "2004-01-01").first()[0] is None


def test_keys_and_lengths(spark):
    df = spark.createDataFrame([(1, "a"), (1, "abc"), (None, "a"), (None, None), (2, "abcd")], "k int, v string")
    assert tuple(q.primary_key_report(df, "k").first()) == (5, 2, 1)
    assert tuple(q.primary_key_report(df.limit(0), "k").first()) == (0, 0, 0)
    assert rows(q.duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]
    assert rows(q.not_null_report(df, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert rows(q.length_report(df, {"v": 2})) == [("v", 2)]


def test_references(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert rows(q.orphans(child, "k", parent, "p")) == [(2,), (2,)]
    assert rows(q.foreign_key_report(child, {"r": ("k", parent, "p"), "s": ("k", child.filter("k IS NOT NULL"), "k")})) == [("r", 2, 1), ("s", 0, 0)]
    assert rows(q.cascade_delete(child, "k", parent, "p")) == [(2,), (2,), (None,)]


def test_row_counts_and_empty_loads(spark):
    df = spark.range(3)
    assert rows(q.row_counts({"a": df, "b": df.limit(0)})) == [("a", 3, False), ("b", 0, True)]
    assert q.require_rows(df, "a") is df
    with pytest.raises(q.EmptyLoad):
        q.require_rows(df.limit(0), "b")
