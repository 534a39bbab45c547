"""High-water marks and the registry-driven incremental run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import ntz, to_second
from starloom.operators import watermark as wm
from starloom.plans.full_load import WATERMARKS, load_dimension
from starloom.plans.incremental import run_incremental
from starloom.runtime import shared_dir
from starloom.sources.tables import METADATA, TableStore
from starloom.workload.base import query
from starloom.workload.fact_queries import EXTRA
from starloom.workload.merge_queries import BUILDERS, _dimension_ctes
from starloom.workload.oltp import OltpSources, read
from starloom.workload.oltp_sql import CUTOFF, with_sources

NOW = "2024-02-01 00:00:00"
SINCE = "2001-06-30"


def dated_tables(spark, sf):
    return {
        "orders": read(spark, sf, "orders").select(F.col("o_orderdate").alias("d")),
        "lineitem": read(spark, sf, "lineitem").select(F.col("l_shipdate").alias("d")),
        "events": read(spark, sf, "events").select(F.col("ts").alias("d")),
    }


def seeded_store(spark, sf):
    """A store that knows the finished orders, seeded with all tables."""
    tables = dated_tables(spark, sf)
    finished = read(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderdate").alias("d"))
    known = wm.seeds_from_tables(spark, {"orders": finished}, "d", NOW)
    return wm.seed_watermarks(known, wm.seeds_from_tables(spark, tables, "d", NOW))


_STORE = """
    SELECT 'orders' AS table_name, max(o_orderdate) AS last_watermark FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
    UNION ALL SELECT 'events', date_trunc('second', max(ts)) FROM events"""


@query("watermark_seed", f"SELECT *, TIMESTAMP '{NOW}' AS updated_at FROM ({_STORE})", "table_name last_watermark:t updated_at:t")
def seed_query(spark, sf):
    return seeded_store(spark, sf)


@query("watermark_get", f"""
    SELECT n AS table_name, coalesce(max(last_watermark), TIMESTAMP '1900-01-01') AS last_watermark
    FROM (VALUES ('orders'), ('lineitem'), ('events'), ('returns')) v(n) LEFT JOIN ({_STORE}) ON table_name = n GROUP BY n""",
    "table_name last_watermark:t")
def get_query(spark, sf):
    store = seeded_store(spark, sf)
    names = ["orders", "lineitem", "events", "returns"]
    rows = [wm.get_watermark(store, n).select(F.lit(n).alias("table_name"), "last_watermark") for n in names]
    return reduce(DataFrame.unionByName, rows)


@query("watermark_set", f"""
    SELECT table_name, CASE WHEN table_name = 'orders' THEN (SELECT max(o_orderdate) FROM orders) ELSE last_watermark END AS last_watermark,
           CASE WHEN table_name = 'orders' THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '{NOW}' END AS updated_at
    FROM ({_STORE})""", "table_name last_watermark:t updated_at:t")
def set_query(spark, sf):
    store = seeded_store(spark, sf)
    newest = read(spark, sf, "orders").agg(F.max("o_orderdate")).first()[0]
    return wm.set_watermark(store, "orders", newest, "2024-02-02 00:00:00")


@query("watermark_extract", f"""
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, l_shipdate
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderdate > TIMESTAMP '{SINCE}' OR l_shipdate > TIMESTAMP '{SINCE}'""",
    "o_orderkey l_linenumber l_partkey l_suppkey o_orderdate:t l_shipdate:t", "l_linenumber l_partkey l_suppkey")
def extract_query(spark, sf):
    """Change filter over both sides of an outer join; an order without lines counts by its own date only."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return wm.changed_since(orders.join(lines, "o_orderkey", "left"), ["o_orderdate", "l_shipdate"], SINCE)


_MARKS = ["1900-01-01", "1998-06-30", "2001-07-15", "2024-01-15", "2100-01-01"]


@query("watermark_advance", f"""
    SELECT m AS since, date_trunc('second', max(ts)) AS new_watermark
    FROM (VALUES {', '.join(f"('{m}')" for m in _MARKS)}) v(m) LEFT JOIN events ON ts > CAST(m AS TIMESTAMP) GROUP BY m""",
    "since new_watermark:t")
def advance_query(spark, sf):
    """New marks of the events after several old ones; an empty delta gives none."""
    events = read(spark, sf, "events").select("ts")
    rows = [wm.new_watermark(wm.changed_since(events, ["ts"], m), "ts").select(F.lit(m).alias("since"), "new_watermark") for m in _MARKS]
    return reduce(DataFrame.unionByName, rows)


@query("source_high_water", f"""
    SELECT date_trunc('second', max(d)) AS high_water FROM (
        SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) WHERE d > TIMESTAMP '{SINCE}'""", "high_water:t")
def high_water_query(spark, sf):
    tables = dated_tables(spark, sf)
    return wm.source_high_water([tables["orders"], tables["lineitem"]], SINCE, "d")


@query("delta_is_empty", " UNION ALL ".join(f"""
    SELECT '{n}' AS table_name, '{m}' AS since, count(*) AS n_delta, CAST(count(*) = 0 AS INTEGER) AS is_empty
    FROM {n} WHERE {c} > TIMESTAMP '{m}'""" for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")) for m in _MARKS))
def empty_query(spark, sf):
    """Size of the delta after each mark, all marks of a table in one pass."""
    rows = []
    for name, table in dated_tables(spark, sf).items():
        counts = table.agg(*[F.count_if(F.col("d") > ntz(m)).alias(m) for m in _MARKS])
        pairs = F.array(*[F.struct(F.lit(m).alias("since"), F.col(f"`{m}`").alias("n_delta")) for m in _MARKS])
        rows.append(counts.select(F.lit(name).alias("table_name"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, rows).withColumn("is_empty", F.col("n_delta") == 0)


_RUN = ["dim_territory", "dim_ship_method", "dim_promotion", "dim_sales_reason"]


def _run_sql() -> str:
    parts = []
    for name in _RUN:
        spec = BUILDERS[name][1]
        changes = with_sources("""
            SELECT count(*) AS rows_staged, count(*) FILTER (act = 'change') AS rows_expired,
                   count(*) FILTER (act IN ('insert', 'change')) AS rows_inserted, count(*) FILTER (act = 'late') AS rows_late
            FROM change_rows""", _dimension_ctes(name, spec))
        parts.append(f"SELECT '{spec.name}' AS table_name, CASE WHEN rows_staged = 0 THEN 'skipped' ELSE 'merged' END AS status, * FROM ({changes})")
    return " UNION ALL ".join(parts)


@query("incremental_run_status", _run_sql())
def run_query(spark, sf):
    """Load four dimensions as of the cutoff, then run the incremental flow for them."""
    import uuid

    store = TableStore(spark, f"{shared_dir(spark).rstrip('/')}/starloom/store-{uuid.uuid4().hex}")
    old, new = OltpSources(spark, sf, CUTOFF), OltpSources(spark, sf)
    names = [BUILDERS[n][1].name for n in _RUN]
    for name in names:
        load_dimension(store, name, old)
    seeds = spark.createDataFrame([(n,) for n in names], "table_name string").select(
        "table_name", to_second(ntz(CUTOFF)).alias("last_watermark"), ntz(NOW).alias("updated_at")
    )
    store.write(seeds.coalesce(1), METADATA, WATERMARKS)
    columns = ["table_name", "status", "rows_staged", "rows_expired", "rows_inserted", "rows_late"]
    return run_incremental(store, new, names).select(*columns)


__all__ = ["EXTRA"]
