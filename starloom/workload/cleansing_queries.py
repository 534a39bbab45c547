"""Cleansing, alignment, coercion and type mapping on customers and orders with blanks, nulls and bad values put in."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.functions.scalar import try_convert
from starloom.operators.cleanse import cleanse, fill_unknown, trim_text
from starloom.operators.dedup import drop_key_duplicates
from starloom.operators.schema import align_to_schema, coerce_types, schema_profile, table_schema, typed_projection
from starloom.plans.full_load import staging_to_warehouse
from starloom.runtime import shared_dir
from starloom.sources.csvio import read_csv, write_csv
from starloom.sources.tables import STAGING, TableStore
from starloom.workload.base import query
from starloom.workload.oltp import read


def raw_customers(spark, sf):
    """Customers as a careless source has them: padded names, empty and missing segments, missing numbers."""
    c = read(spark, sf, "customer")
    segment = F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("CustomerID"), F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("FullName"),
        F.when(segment == "MACHINERY", None).when(segment == "BUILDING", "   ").otherwise(F.concat(segment, F.lit("  "))).alias("Segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(12,2)")).alias("Balance"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("NationKey"),
        F.when(segment != "FURNITURE", F.col("c_acctbal") > 5000).alias("Premium"),
        F.when(segment != "HOUSEHOLD", F.date_add(F.lit("2000-01-01").cast("date"), F.col("c_nationkey"))).alias("Since"),
    )


_RAW = """
    SELECT c_custkey AS CustomerID, '  ' || lower(c_name) || ' ' AS FullName,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN '   ' ELSE c_mktsegment || '  ' END AS Segment,
           CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(12,2)) END AS Balance,
           CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS NationKey,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal > 5000 END AS Premium,
           CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN DATE '2000-01-01' + c_nationkey END AS Since
    FROM customer"""
_SHAPE = "CustomerID FullName Segment Balance:d NationKey Premium:b Since:D"


@query("cleanse_trim", f"SELECT * REPLACE (trim(FullName) AS FullName, trim(Segment) AS Segment) FROM ({_RAW})", _SHAPE, "NationKey Premium")
def trim_query(spark, sf):
    return trim_text(raw_customers(spark, sf))


@query("cleanse_upper_names", f"SELECT * REPLACE (upper(trim(FullName)) AS FullName, trim(Segment) AS Segment) FROM ({_RAW})", _SHAPE, "NationKey Premium")
def upper_query(spark, sf):
    return trim_text(raw_customers(spark, sf), upper_names=True)


@query("cleanse_fill_unknown", f"""
    SELECT * REPLACE (coalesce(Segment, 'UNKNOWN') AS Segment, coalesce(Balance, 0) AS Balance, coalesce(NationKey, 0) AS NationKey,
                      coalesce(Premium, false) AS Premium) FROM ({_RAW})""", _SHAPE, "NationKey Premium")
def fill_query(spark, sf):
    return fill_unknown(raw_customers(spark, sf))


@query("dedup_keys", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_totalprice) = 1""", "o_custkey o_orderkey o_totalprice")
def dedup_keys_query(spark, sf):
    return drop_key_duplicates(read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"])


def raw_order_names(spark, sf):
    """One row per order, so the customer key repeats."""
    o = read(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("CustomerID"), F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("PriorityName"),
        F.when(F.col("o_orderstatus") != "P", F.concat("o_orderstatus", F.lit(" "))).alias("Status"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice").cast("decimal(12,2)")).alias("Price"),
    )


@query("cleanse_table", """
    SELECT CustomerID, PriorityName, coalesce(Status, 'UNKNOWN') AS Status, coalesce(Price, 0) AS Price FROM (
        SELECT o_custkey AS CustomerID, upper(trim(' ' || o_orderpriority)) AS PriorityName,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS Status,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS Price
        FROM orders)
    QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY PriorityName NULLS LAST, Status NULLS LAST, Price NULLS LAST) = 1""",
    "CustomerID PriorityName Status Price:d")
def cleanse_query(spark, sf):
    return cleanse(raw_order_names(spark, sf), ["CustomerID"])


@query("staging_to_dwh", f"SELECT * REPLACE (trim(FullName) AS FullName, trim(Segment) AS Segment) FROM ({_RAW})", _SHAPE, "NationKey Premium")
def staging_query(spark, sf):
    """Through a staged table into the warehouse and read back."""
    store = TableStore(spark, f"{shared_dir(spark).rstrip('/')}/starloom/store-{uuid.uuid4().hex}")
    store.write(raw_customers(spark, sf), STAGING, "Customer")
    return staging_to_warehouse(store, "Customer")


# A target table as a source catalogue describes it (name, type, bytes, precision, scale, nullable).
TARGET = [
    ("CustomerID", "bigint", 8, 19, 0, False), ("NationKey", "int", 4, 10, 0, True), ("Balance", "money", 8, 19, 4, True),
    ("FullName", "nvarchar", 100, 0, 0, True), ("Premium", "bit", 1, 1, 0, True), ("Since", "datetime", 8, 23, 3, True),
    ("Remark", "nvarchar", -1, 0, 0, True),
]


@query("align_schema", f"SELECT CustomerID, NationKey, Balance, FullName, Premium, Since FROM ({_RAW})",
       "CustomerID NationKey Balance:d FullName Premium:b Since:D", "NationKey Premium")
def align_query(spark, sf):
    """Shuffled, differently spelt columns with an extra one, brought into the target's order and spelling."""
    c = raw_customers(spark, sf)
    loose = c.select(*[F.col(n).alias(n.lower()) for n in reversed(c.columns)]).withColumnRenamed("nationkey", ' "NATIONKEY" ')
    return align_to_schema(loose, table_schema(TARGET))


@query("coerce_types", """
    SELECT c_custkey AS CustomerID,
           CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey ELSE c_nationkey + 1 END
                ELSE c_nationkey END AS NationKey,
           CASE WHEN c_nationkey <> 7 THEN CAST(c_acctbal AS DECIMAL(19,4)) END AS Balance,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 0 WHEN 'FURNITURE' THEN 1 WHEN 'HOUSEHOLD' THEN 0 END AS Premium
    FROM customer""", "CustomerID NationKey Balance:d Premium", "NationKey Premium")
def coerce_query(spark, sf):
    """Numbers and flags as text: '2.0', '2.5', 'x', 't', 'false', 'yes'."""
    c = read(spark, sf, "customer")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    number = F.when(segment == "MACHINERY", F.concat(nation, F.lit("x"))).when(segment == "BUILDING", F.concat(nation, F.lit(".5")))
    flag = F.when(segment == "MACHINERY", "t").when(segment == "BUILDING", "f").when(segment == "FURNITURE", "true").when(segment == "HOUSEHOLD", "false")
    texts = c.select(
        F.col("c_custkey").cast("string").alias("customerid"), number.otherwise(F.concat(nation, F.lit(".0"))).alias("NATIONKEY"),
        F.when(F.col("c_nationkey") == 7, "n/a").otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("balance"),
        flag.otherwise("yes").alias("premium"), F.lit("extra").alias("other"),
    )
    return coerce_types(texts, table_schema(TARGET))


@query("typed_projection", """
    SELECT o_orderkey AS OrderID, CAST(o_totalprice AS DECIMAL(19,4)) AS Total, CAST(o_orderdate AS DATE) AS OrderDay,
           CAST(substr(o_orderpriority, 1, 1) AS SMALLINT) AS Priority, o_orderstatus = 'F' AS Done FROM orders""",
    "OrderID Total:d OrderDay:D Priority Done:b")
def typed_query(spark, sf):
    """Text columns projected to the types that the catalogue maps to."""
    schema = table_schema([
        ("OrderID", "bigint", 8, 19, 0, False), ("Total", "money", 8, 19, 4, True), ("OrderDay", "date", 3, 10, 0, True),
        ("Priority", "tinyint", 1, 3, 0, True), ("Done", "bit", 1, 1, 0, True),
    ])
    o = read(spark, sf, "orders")
    texts = o.select(
        F.col("o_orderkey").cast("string").alias("OrderID"), F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("Total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("OrderDay"), F.left("o_orderpriority", F.lit(1)).alias("Priority"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("Done"),
    )
    return typed_projection(texts, schema)


@query("try_convert", """
    SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type = 'LARGE' THEN NULL ELSE p_size END AS size_number,
           CASE WHEN p_type <> 'LARGE' THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS price FROM part""", "p_partkey size_number price:d", "size_number")
def try_convert_query(spark, sf):
    kind, size = F.col("p_type"), F.col("p_size").cast("string")
    p = read(spark, sf, "part")
    texts = p.select(
        "p_partkey", F.when(kind == "ECONOMY", F.concat(size, F.lit("+"))).when(kind == "LARGE", "AW").otherwise(size).alias("size"),
        F.when(kind == "LARGE", "").otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("price"),
    )
    return texts.select(
        "p_partkey", try_convert(F.col("size"), "int").alias("size_number"), try_convert(F.col("price"), "decimal(18,2)").alias("price")
    )


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"]
_TYPE_NAMES = {**{c: "bigint" for c in _LINE_COLUMNS[:3]}, "l_linenumber": "int", **{c: "double" for c in _LINE_COLUMNS[4:8]},
               "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


@query("schema_profile", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{_TYPE_NAMES[c]}' AS type_name, count({c}) AS n_values FROM lineitem"
    for i, c in enumerate(_LINE_COLUMNS, start=1)))
def profile_query(spark, sf):
    """Columns of the lines in order with type and filled values, one pass."""
    lines = read(spark, sf, "lineitem")
    profile = schema_profile(lines)
    counts = lines.agg(*[F.count(F.col(name)).alias(name) for _, name, _, _ in profile])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(t).alias("type_name"), F.col(n).alias("n_values"))
        for i, n, t, _ in profile
    ])
    return counts.select(F.inline(rows))


@query("csv_null_conventions", f"""
    SELECT convention, count(*) AS n_rows, count(*) FILTER (Segment IS NULL OR (convention = 'full' AND Segment = '')) AS n_null,
           count(*) FILTER (convention = 'delta' AND Segment = '') AS n_empty,
           CAST(sum(hash_part) AS BIGINT) AS id_sum
    FROM (SELECT CASE WHEN Segment IS NULL THEN NULL ELSE trim(Segment) END AS Segment, CustomerID AS hash_part FROM ({_RAW})),
         (VALUES ('full'), ('delta')) v(convention) GROUP BY convention""")
def csv_query(spark, sf):
    """All customers written as CSV and read back under both conventions."""
    customers = trim_text(raw_customers(spark, sf)).select("CustomerID", "Segment", "Balance")
    out = None
    for convention in ("full", "delta"):
        path = f"{shared_dir(spark).rstrip('/')}/starloom/csv-{uuid.uuid4().hex}"
        write_csv(customers, path, convention)
        back = read_csv(spark, path, customers.schema, convention)
        row = back.agg(
            F.count("*").alias("n_rows"), F.count_if(F.col("Segment").isNull()).alias("n_null"),
            F.count_if(F.col("Segment") == "").alias("n_empty"), F.sum("CustomerID").alias("id_sum"),
        ).select(F.lit(convention).alias("convention"), "*")
        out = row if out is None else out.unionByName(row)
    return out
