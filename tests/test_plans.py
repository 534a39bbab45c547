"""Physical plans: what is pushed down, what is split, what is not shuffled."""

import re
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.operators.lookup import Lookup, resolve_key
from starloom.operators.scd import change_set, expire
from starloom.functions.scalar import ntz, open_end
from starloom.plans.calendar import build_calendar, date_spine
from starloom.plans.fact import date_roles, fact_delta
from starloom.runtime import cut_lineage
from starloom.workload.merge_queries import PROFILE
from starloom.workload.oltp import OltpSources

SF = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in names:
            spark.conf.unset(k)


def executed(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def large_joins(spark):
    """Joins as between two large tables: shuffled, with skew handling at small sizes."""
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB", spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__shuffle__partitions="16",
    ):
        yield


def test_a_hot_key_is_split_in_the_lookup(spark, large_joins):
    dim = spark.range(2000).select(F.col("id").alias("ID"), (F.col("id") + 1).alias("K"), open_end().alias("EndDate"))
    fact = spark.range(120000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2500).alias("ID"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    out = resolve_key(fact, dim, Lookup("ID", "ID", "K", "D"))
    plan = executed(out)
    assert "SortMergeJoin(skew=true)" in plan, plan
    got = out.groupBy("K").count().filter("K IN (8, -1)").collect()
    assert {r.K: r["count"] for r in got} == {8: 40000 + 32, -1: 120000 - 40000 - sum(1 for i in range(120000) if i % 3 and i % 2500 < 2000)}


def test_filters_reach_the_scans_of_a_delta(spark):
    plan = fact_delta(OltpSources(spark, SF), "2001-06-30")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_shipdate,2001-06-30T00:00)" in plan and "GreaterThan(o_orderdate,2001-06-30T00:00)" in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_linestatus" not in s or "l_tax" in s for s in schemas)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_calendar_joins_are_broadcast(spark):
    headers = spark.range(10).select(*[ntz("2020-01-05").alias(c) for c in ("OrderDate", "ShipDate", "DueDate")])
    plan = executed(date_roles(headers, build_calendar(date_spine(spark, date(2020, 1, 1), date(2021, 1, 1)), fiscal=None)))
    assert plan.count("SortMergeJoin") == 0


def test_a_merge_does_not_shuffle_the_target(spark):
    """With a small stored change set the target is filtered and joined where it lies."""
    target = cut_lineage(spark.range(50000).select(
        F.col("id").alias("ProfileKey"), F.col("id").alias("CustomerID"), F.lit("a").alias("Priority"), F.lit("b").alias("Status"),
        ntz("2000-01-01").alias("StartDate"), open_end().alias("EndDate")))
    staged = cut_lineage(spark.range(10).select(
        (F.col("id") * 7).alias("CustomerID"), F.lit("z").alias("Priority"), F.lit("b").alias("Status"), ntz("2001-01-01").alias("StartDate")))
    changes = cut_lineage(change_set(target, staged, PROFILE))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="40KB"):
        plan = executed(expire(target, changes, PROFILE))
        assert "BroadcastHashJoin" in plan and "ShuffleQueryStage" not in plan and "hashpartitioning" not in plan, plan
    assert changes.count() == 10 and expire(target, changes, PROFILE).filter("EndDate < '9999-01-01'").count() == 10
