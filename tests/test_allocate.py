from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.operators.allocate import allocate_exactly
from starloom.plans.fact import build_fact
from starloom.plans.registry import DIMENSIONS, REGISTRY
from tests.test_flows import frames, source_rows


def test_parts_add_up_and_follow_the_weights(spark):
    rows = [(1, 1, Decimal("1"), Decimal("10")), (1, 2, Decimal("1"), Decimal("10")), (1, 3, Decimal("1"), Decimal("10")),
            (2, 1, Decimal("0"), Decimal("0.0001")), (2, 2, Decimal("0"), Decimal("0.0001")), (3, 1, Decimal("3"), Decimal("-5")), (3, 2, Decimal("1"), Decimal("-5"))]
    df = spark.createDataFrame(rows, "o int, l int, w decimal(19,4), a decimal(19,4)")
    got = {(r.o, r.l): r.part for r in allocate_exactly(df, "o", "w", {"part": "a"}, ["l"]).collect()}
    assert [got[1, k] for k in (1, 2, 3)] == [Decimal("3.3334"), Decimal("3.3333"), Decimal("3.3333")]
    assert got[2, 1] + got[2, 2] == Decimal("0.0001")
    assert (got[3, 1], got[3, 2]) == (Decimal("-3.7500"), Decimal("-1.2500"))


def test_cuts_sort_as_whole_numbers_and_lose_no_decimal(spark):
    rows = [(1, k, Decimal(w), Decimal("99999999999.9999")) for k, w in enumerate(["0.0001", "3", "7", "7", "11.1111", "900000000"])]
    df = spark.createDataFrame(rows, "o int, l int, w decimal(19,4), a decimal(19,4)")
    out = allocate_exactly(df, "o", "w", {"part": "a"}, ["l"])
    assert sum(r.part for r in out.collect()) == Decimal("99999999999.9999")
    assert "_cut" in str(out._jdf.queryExecution().optimizedPlan()) and "as decimal(7,6)) AS _cut" in str(out._jdf.queryExecution().optimizedPlan())


def test_lines_are_dealt_by_order_once(spark):
    """The distinct lines, their join with the orders and the spreading share one exchange of the lines."""
    data = source_rows()
    sources = frames(spark, data)
    dims = {n: REGISTRY[n].build(sources).withColumn(REGISTRY[n].spec.surrogate_key, F.lit(1).cast("long")) for n in DIMENSIONS}
    dims["DimDate"] = spark.createDataFrame([(datetime(2020, 1, 1), 20200101)], "Date timestamp_ntz, DateKey int")
    plan = build_fact(sources, dims, "reconcile", unmatched="unknown")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "SalesOrderDetail" in x], plan


def test_columns_that_no_step_reads_go_through_the_sorts_as_one(spark):
    """Forty columns beside those of the allocation are one value in each sort, and come back in their places."""
    import re

    from pyspark.sql import functions as F

    from starloom.operators.allocate import allocate_exactly

    names = [f"c.{k}" for k in range(40)]
    wide = spark.createDataFrame([(7, k, 10, 5) for k in range(3)], "o long, line long, w int, tax int").select(
        *[F.col("line").alias(n) for n in names[:20]], "o", "line", F.lit(None).cast("decimal(19,4)").alias("t"), "w", "tax", *[(F.col("line") * 2).alias(n) for n in names[20:]]
    )
    out = allocate_exactly(wide, "o", "w", {"t": "tax", "u": "tax"}, ["line"])
    assert out.columns == [*wide.columns, "u"]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Window" in plan and not re.search(r"Window \[[^\n]*c\.3\b", plan)
    found = sorted(tuple(r) for r in out.collect())
    assert [r[:20] for r in found] == [(k,) * 20 for k in range(3)] and [r[25:45] for r in found] == [(2 * k,) * 20 for k in range(3)]
    assert sum(r[22] for r in found) == 5 and sum(r[45] for r in found) == 5
