"""Integrity checks on the tables and on copies with faults put in."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.scalar import ntz, open_end
from starloom.operators import quality as q
from starloom.plans.dimensions import dim_customer, dim_product, dim_store
from starloom.plans.star_schema import check_lengths, check_required, columns, conform
from starloom.workload.base import query
from starloom.workload.dimension_queries import DIM_SQL, shape_of
from starloom.workload.merge_queries import order_states
from starloom.workload.oltp import OltpSources, read
from starloom.workload.oltp_sql import with_sources


@query("load_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(count(*) = 0 AS INTEGER) AS is_empty FROM {t}"
    for t in ("customer", "orders", "lineitem", "part", "supplier")) +
    " UNION ALL SELECT 'unpriced', count(*), CAST(count(*) = 0 AS INTEGER) FROM orders WHERE o_totalprice IS NULL")
def counts_query(spark, sf):
    tables = {t: read(spark, sf, t) for t in ("customer", "orders", "lineitem", "part", "supplier")}
    tables["unpriced"] = tables["orders"].filter(F.col("o_totalprice").isNull())
    return q.row_counts(tables)


def faulty_orders(spark, sf):
    """Open orders without customer, part-shipped ones with a customer that does not exist."""
    orders = read(spark, sf, "orders")
    status = F.col("o_orderstatus")
    customer = F.when((status == "O") & (F.col("o_orderpriority") == "5-LOW"), None).when(status == "P", -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
    return orders.withColumn("o_custkey", customer)


_FAULTY = """
    SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'P' THEN -o_custkey - 1
                           ELSE o_custkey END AS o_custkey) FROM orders"""


@query("dq_primary_key", f"""
    SELECT count(*) AS n_rows, count(*) FILTER (o_custkey IS NULL) AS n_null, count(o_custkey) - count(DISTINCT o_custkey) AS n_duplicate
    FROM ({_FAULTY})""")
def primary_query(spark, sf):
    return q.primary_key_report(faulty_orders(spark, sf), "o_custkey")


@query("dq_duplicate_grain", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def grain_query(spark, sf):
    return q.duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_single_current", """
    SELECT o_custkey AS CustomerID, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING count(*) > 1""")
def current_query(spark, sf):
    """A dimension in which every open order left an open row."""
    rows = order_states(spark, sf)
    end = F.when(F.col("Status") == "O", open_end()).otherwise(F.col("StartDate"))
    return q.multiple_current(rows.withColumn("EndDate", end), ["CustomerID"])


@query("dq_inverted_validity", """
    SELECT o_custkey AS CustomerID, o_orderdate AS StartDate FROM orders WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1999-06-30'""",
    "CustomerID StartDate:t")
def inverted_query(spark, sf):
    rows = order_states(spark, sf)
    end = F.when(F.col("Status") == "F", ntz("1999-06-30")).otherwise(open_end())
    return q.inverted_validity(rows.withColumn("EndDate", end)).select("CustomerID", "StartDate")


@query("dq_foreign_keys", f"""
    SELECT 'orders -> customer' AS relation, count(*) AS n_orphans, count(DISTINCT o_custkey) AS n_keys FROM ({_FAULTY}) WHERE o_custkey < 0
    UNION ALL SELECT 'orders -> shipped lines', count(*), count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'orders -> order days', count(*), count(DISTINCT o_orderdate) FROM orders
        WHERE o_orderdate NOT IN (SELECT l_shipdate FROM lineitem)""")
def foreign_query(spark, sf):
    orders = faulty_orders(spark, sf)
    lines = read(spark, sf, "lineitem")
    return q.foreign_key_report(orders, {
        "orders -> customer": ("o_custkey", read(spark, sf, "customer"), "c_custkey"),
        "orders -> shipped lines": ("o_orderkey", lines.select("l_orderkey").distinct(), "l_orderkey"),
        "orders -> order days": ("o_orderdate", lines.select("l_shipdate").distinct(), "l_shipdate"),
    })


@query("dq_orphan_rows", """
    SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def orphan_query(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey")
    return q.orphans(orders, "o_orderkey", read(spark, sf, "lineitem"), "l_orderkey")


@query("dq_not_null", f"""
    SELECT 'o_orderkey' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS n_violations FROM ({_FAULTY})
    UNION ALL SELECT 'o_custkey', count(*) FILTER (o_custkey IS NULL) FROM ({_FAULTY})
    UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM ({_FAULTY})""")
def not_null_query(spark, sf):
    return q.not_null_report(faulty_orders(spark, sf), ["o_orderkey", "o_custkey", "o_orderdate"])


@query("dq_length", """
    SELECT 'o_orderpriority' AS column_name, count(*) FILTER (length(o_orderpriority) > 8) AS n_violations FROM orders
    UNION ALL SELECT 'o_orderstatus', count(*) FILTER (length(o_orderstatus) > 1) FROM orders""")
def length_query(spark, sf):
    return q.length_report(read(spark, sf, "orders"), {"o_orderpriority": 8, "o_orderstatus": 1})


@query("cascade_delete_fact", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO' OR p_size > 45)""")
def cascade_query(spark, sf):
    """Lines left after the promotional and the largest parts were deleted."""
    gone = read(spark, sf, "part").filter((F.col("p_type") == "PROMO") | (F.col("p_size") > 45)).select("p_partkey")
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return q.cascade_delete(lines, "l_partkey", gone, "p_partkey")


def _report_sql(name: str, test: str, chosen) -> str:
    """One row per checked column of a dimension."""
    return with_sources(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({test.format(f'"{c}"', size)}) AS n_violations FROM {name}""" for c, size in chosen
    ), DIM_SQL)


_NEEDED = {t: [(c, None) for c, _, _, _, needed in columns(t) if needed and not c.endswith("Key")] for t in ("DimCustomer", "DimStore")}


@query("star_required_columns", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, * FROM ({_report_sql(n, '{0} IS NULL', _NEEDED[t])})" for n, t in (("dim_customer", "DimCustomer"), ("dim_store", "DimStore"))))
def required_query(spark, sf):
    """Required columns of the built customer and store dimensions."""
    src = OltpSources(spark, sf)
    parts = [
        check_required(build(src), t).select(F.lit(t).alias("table_name"), "*") for t, build in (("DimCustomer", dim_customer), ("DimStore", dim_store))
    ]
    return parts[0].unionByName(parts[1])


@query("star_text_lengths", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, * FROM ({_report_sql(n, 'length({0}) > {1}', [(c, size) for c, kind, size, _, _ in columns(t) if kind == 'nvarchar'])})"
    for n, t in (("dim_customer", "DimCustomer"), ("dim_store", "DimStore"))))
def lengths_query(spark, sf):
    """Text limits of the built customer and store dimensions."""
    src = OltpSources(spark, sf)
    parts = [
        check_lengths(build(src), t).select(F.lit(t).alias("table_name"), "*") for t, build in (("DimCustomer", dim_customer), ("DimStore", dim_store))
    ]
    return parts[0].unionByName(parts[1])


@query("star_conform", with_sources(f"SELECT {', '.join(c for c, *_ in columns('DimProduct') if c != 'ProductKey')} FROM dim_product", DIM_SQL),
       shape_of([c for c, *_ in columns("DimProduct") if c != "ProductKey"]))
def conform_query(spark, sf):
    """Products in the column order and types of the target."""
    return conform(dim_product(OltpSources(spark, sf)), "DimProduct")
