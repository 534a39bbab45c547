"""The merge of the fact: what moves, and that moving less changes no row, key or order."""

from datetime import datetime

from pyspark.sql import functions as F

from starloom.functions.scalar import open_end
from starloom.operators import keys
from starloom.operators.keys import assign_keys, assign_keys_by_group
from starloom.operators.lookup import insert_only, insert_only_by_group, known_by_group, known_keys
from starloom.plans import fact
from starloom.runtime import cut_lineage
from tests.conftest import rows
from tests.test_plans import settings

LINES = "o long, l long, v string, w int"


def batch_of(spark):
    """Known lines, new lines, copies, keys that repeat with other values, null keys and null values."""
    data = [(k % 40, k % 7, f"v{k % 3}", k % 5) for k in range(400)]
    data += [(None, 1, "a", 1), (None, 1, "a", None), (None, None, "b", 2), (3, None, "c", 3), (3, None, None, 3), (50, 1, None, None), (50, 1, "z", 1), (50, 1, "z", 1)]
    return spark.createDataFrame(data, LINES)


def loaded(spark):
    return spark.createDataFrame([(k % 40, k % 3) for k in range(60)] + [(3, None), (None, 1), (77, 1)], "o long, l long")


def wide_exchanges(df, column):
    """Shuffles of rows that have ``column``."""
    plans, found = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plans.append(plan.executedPlan())
        found += plan.nodeName() == "Exchange" and f" {column}#" in " " + plan.output().mkString(" ")
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_new_lines_by_group_are_those_of_insert_only(spark):
    batch, target = batch_of(spark), loaded(spark)
    known = known_keys(target, batch, ["o", "l"])
    want = rows(insert_only(target, batch, ["o", "l"]))
    assert len(want) > 100 and rows(insert_only_by_group(batch, known, ["o", "l"])) == want
    assert rows(known_by_group(target, cut_lineage(batch, by="o"), ["o", "l"])) == rows(known)
    assert rows(insert_only_by_group(cut_lineage(batch, by="o"), cut_lineage(known), ["o", "l"])) == want
    assert rows(insert_only_by_group(batch.filter("false"), known, ["o", "l"])) == []


def test_keys_by_group_are_those_of_all_rows_in_order(spark):
    fresh = cut_lineage(insert_only(loaded(spark), batch_of(spark), ["o", "l"]))
    sizes = fresh.groupBy("o").agg(F.count("*").alias("_size"))
    after = spark.createDataFrame([(41,)], "k long")
    for settled in ({}, {"after": after}):
        want = assign_keys(fresh, "k", ["o", "l"], **settled)
        assert rows(assign_keys_by_group(fresh, sizes, "k", "o", ["l"], **settled)) == rows(want)
    assert assign_keys_by_group(fresh.filter("false"), sizes.filter("false"), "k", "o", ["l"]).count() == 0


def test_rows_stored_by_a_column_stay_where_they_are(spark):
    stored = cut_lineage(batch_of(spark), by="o")
    assert rows(stored) == rows(batch_of(spark)) and not [t for t in spark.catalog.listTables() if t.name.startswith("starloom_")]
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        known = cut_lineage(known_keys(loaded(spark), stored, ["o", "l"]))
        assert wide_exchanges(insert_only_by_group(stored, known, ["o", "l"]), "v") == 0
        assert wide_exchanges(insert_only_by_group(cut_lineage(stored), known, ["o", "l"]), "v") == 1


def fact_parts(spark):
    """A delta of 200 orders, of which some lines are known, some come twice and some have no dimension rows; target and dimensions."""
    ids = spark.range(600).select(
        (F.col("id") % 200).alias("SalesOrderID"), (F.col("id") % 450).alias("SalesOrderDetail"),
        *[(F.col("id") % n).alias(k.fact_column) for n, k in enumerate(fact._BY_KEY, start=3)],
        *[F.lit(1).alias(m) for m in fact.MEASURES if m != "OrderQty"], F.col("id").cast("int").alias("OrderQty"), F.lit(datetime(2020, 1, 1)).alias("StartDate"))
    target = spark.range(1, 91).select(F.col("id").alias("FactSalesKey"), (F.col("id") % 30).alias("SalesOrderID"), (F.col("id") % 45).alias("SalesOrderDetail"))
    dims = {
        k.dimension: spark.range(5).select(F.col("id").alias(k.business_key), (F.col("id") + 100).alias(k.surrogate_key), open_end().alias("EndDate")) for k in fact._BY_KEY}
    reasons = spark.range(250).select((F.col("id") % 150).alias("SalesOrderID"), (F.col("id") + 1).alias("SalesReasonKey"), open_end().alias("EndDate"))
    return cut_lineage(ids, by="SalesOrderID"), cut_lineage(target), {**{n: cut_lineage(d) for n, d in dims.items()}, "DimSalesReason": cut_lineage(reasons)}


def test_wide_rows_move_for_no_step_that_goes_by_order(spark, monkeypatch):
    """The known lines, the reasons and the numbers cost no shuffle of the measures, and the measures are not written on the way."""
    written = []
    for module in (fact, keys):
        monkeypatch.setattr(module, "cut_lineage", lambda df, **k: written.append(df.columns) or cut_lineage(df, **k))
    delta, target, dims = fact_parts(spark)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for reasons in ("one", "all"):
            out = fact.merge_fact(target, delta, dims, reasons=reasons)
            assert wide_exchanges(out, "OrderQty") == len(fact._BY_KEY)  # one for each dimension of another key
            assert wide_exchanges(fact.merge_fact(target, cut_lineage(delta), dims, reasons=reasons), "OrderQty") == len(fact._BY_KEY) + 1
    assert written and not any("OrderQty" in c for c in written)


def test_a_merge_numbers_the_rows_in_order(spark):
    delta, target, dims = fact_parts(spark)
    lines = insert_only(target, delta, fact.GRAIN).collect()
    reason_keys = {}
    for r in dims["DimSalesReason"].collect():
        reason_keys.setdefault(r.SalesOrderID, []).append(r.SalesReasonKey)
    for reasons in ("one", "all"):
        want = []
        for r in lines:
            found = sorted(reason_keys.get(r.SalesOrderID, [-1]))
            want += [(r.SalesOrderID, r.SalesOrderDetail, k, r.OrderQty, *[100 + r[b.fact_column] if r[b.fact_column] < 5 else -1 for b in fact._BY_KEY])
                     for k in (found[:1] if reasons == "one" else found)]
        out = fact.merge_fact(target, delta, dims, reasons=reasons)
        got = out.select("FactSalesKey", *fact.GRAIN, "SalesReasonKey", "OrderQty", *[b.surrogate_key for b in fact._BY_KEY]).collect()
        assert sorted(tuple(r) for r in got) == [(91 + i, *w) for i, w in enumerate(sorted(want))]


def test_stores_of_orders_follow_repeated_and_missing_customers(spark):
    headers = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "c"), (2, None, "d"), (3, 99, "e"), (4, 10, "f")], "SalesOrderID long, CustomerID long, x string")
    customers = spark.createDataFrame([(10, 5, "k"), (10, 5, "l"), (10, None, "m"), (11, 6, "n"), (None, 7, "o")], "CustomerID long, StoreID long, y string")
    order = ["SalesOrderID", "CustomerID", "x", "StoreID"]
    got = fact._headers_with_store({"customer": customers}, headers)
    assert rows(got.select(order)) == rows(fact._with_store({"customer": customers}, headers).select(order))
    assert fact._headers_with_store({}, headers).columns == headers.columns
