"""Deltas of the fact: known lines looked up by month, and orders that are replaced as a whole."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import runtime
from starloom.operators.allocate import allocate_exactly
from starloom.operators.keys import assign_keys
from starloom.operators.lookup import insert_only, insert_only_in_months
from starloom.plans import fact
from starloom.plans.full_load import full_load
from starloom.plans.incremental import run_incremental
from starloom.plans.order_index import months_of
from starloom.runtime import cut_lineage
from starloom.sources.tables import TableStore
from tests.conftest import rows
from tests.test_flows import D2, frames, source_rows

GRAIN = ["SalesOrderID", "SalesOrderDetail"]


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def partitions_read(df):
    """Partitions that the scans of an executed plan opened."""
    df.collect()
    found, plans = {}, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.nodeName()
        if name.startswith("Scan parquet") and plan.metrics().contains("numPartitions"):
            found[plan.toString()[:200]] = plan.metrics().apply("numPartitions").value()
        if name == "AdaptiveSparkPlan":
            plans.append(plan.executedPlan())
        elif "QueryStage" in name:
            plans.append(plan.plan())
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_only_months_of_the_batch_are_opened(spark, store):
    fact = spark.range(2_400).select(
        F.col("id").alias("SalesOrderID"), (F.col("id") * 10).alias("SalesOrderDetail"), (F.lit(200001) + F.col("id") % 12).cast("int").alias("OrderMonth")
    )
    target = store.write(fact, "dwh", "F", partition_by=["OrderMonth"])
    batch = cut_lineage(spark.createDataFrame([(3, 30), (3, 31), (15, 150), (9_999, 1), (9_999, 1)], "SalesOrderID long, SalesOrderDetail long"))
    months = cut_lineage(spark.createDataFrame([(3, 200004), (15, 200004)], "SalesOrderID long, OrderMonth int"))
    out = insert_only_in_months(target, batch, GRAIN, "OrderMonth", months)
    assert rows(out) == rows(insert_only(target, batch, GRAIN)) == [(3, 31), (9999, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan, plan
    counts = {k: v for k, v in partitions_read(insert_only_in_months(target, batch, GRAIN, "OrderMonth", months)).items() if "OrderMonth" in k and "dynamicpruning" in k or v > 0}
    assert counts and max(counts.values()) == 1, counts


def test_orders_are_found_under_the_month_they_were_filed(spark, store):
    data = source_rows()
    full_load(store, frames(spark, data))
    assert rows(months_of(store, spark.createDataFrame([(1000,), (1001,), (7,)], "SalesOrderID int"))) == [(1000, 202001), (1001, 202001)]
    header = list(data["order_header"][1][0])
    header[5], header[-1] = datetime(2020, 3, 1), D2  # the order moves to March; its lines are known and do not come twice
    data["order_header"][1][0] = tuple(header)
    data["order_detail"][1].append((1000, 77, 2, 1, 1, Decimal("2"), Decimal("0"), Decimal("2"), D2))
    status = {r.table_name: r for r in run_incremental(store, frames(spark, data), ["FactSales"]).collect()}["FactSales"]
    assert (status.rows_staged, status.rows_inserted) == (3, 2)  # one new line with two reasons
    fact = store.read("dwh", "FactSales")
    assert rows(fact.groupBy("SalesOrderDetail").agg(F.count("*"))) == [(1, 2), (2, 2), (3, 1), (77, 2)]
    assert rows(months_of(store, spark.createDataFrame([(1000,)], "SalesOrderID int"))) == [(1000, 202001), (1000, 202003)]
    assert store.properties("dwh", "FactSales")["last_key"] == "7" == str(fact.agg(F.max("FactSalesKey")).first()[0])


def sums(store):
    fact = store.read("dwh", "FactSales")
    return rows(fact.groupBy("SalesOrderID").agg(F.sum("TaxAllocated"), F.sum("Freight_Allocated")))


def test_a_delta_keeps_header_amounts_exact(spark, store):
    data = source_rows()
    full_load(store, frames(spark, data), header_amounts="reconcile")
    before = {r.FactSalesKey: r for r in store.read("dwh", "FactSales").collect()}
    assert sums(store) == [(1000, Decimal("3.0000"), Decimal("1.2000")), (1001, Decimal("1.0000"), Decimal("1.0000"))]
    data["order_detail"][1][0] = (1000, 1, 1, 1, 3, Decimal("10"), Decimal("0"), Decimal("30"), D2)
    data["order_detail"][1].append((1000, 5, 2, 1, 1, Decimal("1"), Decimal("0"), Decimal("1"), D2))
    data["order_header"][1].append((1002, 13, 1, 1, 1, datetime(2020, 2, 1), datetime(2020, 2, 9), None, 5, False, Decimal("10"), Decimal("1.0001"), Decimal("0"), Decimal("11"), D2))
    data["order_detail"][1].extend((1002, 6 + k, 1, 1, 1, Decimal("1"), Decimal("0"), Decimal("1"), D2) for k in range(3))
    run_incremental(store, frames(spark, data), ["FactSales"])
    assert sums(store) == [
        (1000, Decimal("3.0000"), Decimal("1.2000")), (1001, Decimal("1.0000"), Decimal("1.0000")), (1002, Decimal("1.0001"), Decimal("0.0000"))]
    after = {r.FactSalesKey: r for r in store.read("dwh", "FactSales").collect()}
    assert len(after) == 5 + 2 + 3 and set(before) < set(after)
    for key, old in before.items():
        assert (old.SalesOrderID, old.SalesOrderDetail, old.SalesReasonKey) == (after[key].SalesOrderID, after[key].SalesOrderDetail, after[key].SalesReasonKey)
        if old.SalesOrderID == 1001:
            assert old == after[key]
    assert {r.OrderQty for r in after.values() if r.SalesOrderDetail == 1} == {3}
    again = {r.table_name: r for r in run_incremental(store, frames(spark, data), ["FactSales"]).collect()}["FactSales"]
    assert again.status == "skipped"


def test_large_amounts_add_up(spark):
    amounts = [Decimal("40000000000000.0001"), Decimal("123456789012.3457"), Decimal("-0.0003"), Decimal("0")]
    data = [(h, k, Decimal(w), a) for h, a in enumerate(amounts) for k, w in enumerate(["1", "3", "0.0001", "7", "1", "1", "2"])]
    data += [(9, 0, Decimal("1"), None), (10, 0, None, Decimal("1")), (10, 1, None, Decimal("1")), (11, 0, Decimal("1"), Decimal("5")), (11, 1, Decimal("-1"), Decimal("5"))]
    df = spark.createDataFrame(data, "h int, k int, w decimal(38,6), a decimal(19,4)")
    got = {r.h: r.s for r in allocate_exactly(df, "h", "w", {"p": "a"}, ["k"]).groupBy("h").agg(F.sum("p").alias("s")).collect()}
    assert got == {**dict(enumerate(amounts)), 9: None, 10: Decimal("1"), 11: Decimal("5")}


def test_a_run_leaves_no_files_on_the_way(spark, store, tmp_path, monkeypatch):
    """Only the tables of the store stay on disk, and the measures are not numbered with the keys."""
    made, wide = [], []
    monkeypatch.setattr(runtime, "shared_dir", lambda s: str(tmp_path / "shared"))
    monkeypatch.setattr(fact, "cut_lineage", lambda df: made.append(cut_lineage(df)) or made[-1])
    monkeypatch.setattr(fact, "assign_keys", lambda df, *a, **k: wide.append(df.columns) or assign_keys(df, *a, **k))
    data = source_rows()
    full_load(store, frames(spark, data), header_amounts="reconcile")
    data["order_detail"][1].append((1000, 5, 2, 1, 1, Decimal("1"), Decimal("0"), Decimal("1"), D2))
    run_incremental(store, frames(spark, data), ["FactSales"])
    assert sums(store) == [(1000, Decimal("3.0000"), Decimal("1.2000")), (1001, Decimal("1.0000"), Decimal("1.0000"))]
    assert len(made) == 2 and not any("TaxAllocated" in df.columns for df in made)
    assert wide == [["_row", *GRAIN, "SalesReasonKey"]]
    assert not [p for p in (tmp_path / "shared").rglob("*.parquet")]


def test_replaced_orders_keep_rows_that_come_twice_and_rows_without_a_key(spark):
    def table(keyed, given):
        cells = {c: F.lit(0) for c in fact.FACT_COLUMNS} | {c: F.col(c) for c in (*GRAIN, "SalesReasonKey", "OrderQty")}
        names = [*(["FactSalesKey"] if keyed else []), *GRAIN, "SalesReasonKey", "OrderQty"]
        df = spark.createDataFrame(given, ", ".join(f"{n} long" for n in names))
        return df.select(*(["FactSalesKey"] if keyed else []), *[c.alias(n) for n, c in cells.items()])

    near = cut_lineage(table(True, [(1, 7, 1, -1, 5), (2, 7, 2, -1, 5), (3, 8, 1, -1, 5)]))
    new = cut_lineage(table(False, [(7, 1, -1, 6), (7, 1, -1, 7), (7, 3, -1, 8), (7, 3, -1, 9), (7, None, -1, 4)]))
    out, many = fact.replace_orders(near, spark.createDataFrame([(7,)], "SalesOrderID long"), new, 3)
    got = sorted((r.FactSalesKey, r.OrderQty) for r in out.collect())
    assert many == 3 and [q for k, q in got if k == 1] == [6, 7] and (3, 5) in got
    assert sorted(k for k, _ in got) == [1, 1, 3, 4, 5, 6] and (4, 4) in got


def test_flows_ask_for_shuffle_files_to_go_and_restore_the_setting(spark, store, monkeypatch):
    key, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(key)
    monkeypatch.setattr("starloom.plans.incremental.update_table", lambda s, name, sources: seen.append(spark.conf.get(key)) or ((name, "skipped", 0, 0, 0, 0, None, None), None))
    run_incremental(store, {}, ["FactSales"])
    assert seen == ["true"] and spark.conf.get(key) == before


def test_flows_plan_joins_by_the_size_of_rows_and_restore_the_setting(spark, store, monkeypatch):
    """Files of keys are a tenth of the rows or less; the flows must not take them for small enough to go through the driver."""
    from starloom.plans import full_load as flow

    key, seen = "spark.sql.sources.fileCompressionFactor", []
    build = flow.build_fact

    def noted(*args, **kwargs):
        seen.append(float(spark.conf.get(key)))
        return build(*args, **kwargs)

    monkeypatch.setattr(flow, "build_fact", noted)
    before = spark.conf.get(key, "1.0")
    full_load(store, frames(spark, source_rows()))
    assert seen and min(seen) >= 10 and spark.conf.get(key, "1.0") == before


def test_a_table_of_many_keys_in_small_files_is_not_sent_to_the_driver(spark, tmp_path):
    from starloom.runtime import unpacked_sizes

    # 400,000 keys: over 1 MB in files, over 16 MB in a broadcast
    spark.range(400_000).withColumn("k", F.xxhash64("id") % 4_000_000).select("id", "k").write.parquet(f"{tmp_path}/keys", compression="zstd")
    keys, rows = spark.read.parquet(f"{tmp_path}/keys"), spark.range(10_000_000).withColumnRenamed("id", "k")

    def plan():
        return rows.join(keys, "k")._jdf.queryExecution().sparkPlan().toString()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        assert "BroadcastHashJoin" in plan()
        with unpacked_sizes(spark):
            assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
