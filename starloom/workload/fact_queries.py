"""The sales fact: full load in both amount modes, delta, key lookup and insert-only merge."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from starloom.functions.scalar import allocate, line_amounts
from starloom.operators.keys import assign_keys, number_stored_rows, next_key
from starloom.operators.lookup import Lookup, insert_only, resolve_key
from starloom.plans.calendar import build_calendar, date_spine_of
from starloom.plans.fact import FACT_COLUMNS, GRAIN, MEASURES, build_fact, date_roles, fact_delta, merge_fact, store_of_customer
from starloom.plans.full_load import order_days as calendar_days
from starloom.plans.registry import DIMENSIONS, REGISTRY
from starloom.runtime import cut_lineage
from starloom.workload.base import query
from starloom.workload.calendar_queries import DAYS, order_days
from starloom.workload.dimension_queries import DELTA_SQL, DIM_SQL
from starloom.workload.oltp import OltpSources, read
from starloom.workload.oltp_sql import CUTOFF, DIM_NAMES, old_version, with_sources


def keyed_dimension(name: str, sources):
    config = REGISTRY[name]
    return assign_keys(config.build(sources), config.spec.surrogate_key, config.spec.business_keys)


def keyed_dimensions(sources, names=DIMENSIONS):
    """Dimensions with surrogate keys, built side by side; each is written once and then read."""
    for table in {s for n in names for s in REGISTRY[n].sources}:
        sources[table]
    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(names, pool.map(lambda n: keyed_dimension(n, sources), names)))


def calendar_of(spark, sf):
    return build_calendar(date_spine_of(order_days(spark, sf), "day"), fiscal=None)


_KEYED = {
    "key_customer": "SELECT row_number() OVER (ORDER BY CustomerID) AS CustomerKey, * FROM dim_customer",
    "key_product": "SELECT row_number() OVER (ORDER BY ProductID) AS ProductKey, * FROM dim_product",
    "key_promotion": "SELECT row_number() OVER (ORDER BY SpecialOfferID) AS PromotionKey, * FROM dim_promotion",
    "key_sales_reason": "SELECT row_number() OVER (ORDER BY SalesOrderID, SalesReasonID) AS SalesReasonKey, * FROM dim_sales_reason",
    "key_ship_method": "SELECT row_number() OVER (ORDER BY ShipMethodID) AS ShipMethodKey, * FROM dim_ship_method",
    "key_store": "SELECT row_number() OVER (ORDER BY StoreID) AS StoreKey, * FROM dim_store",
    "key_territory": "SELECT row_number() OVER (ORDER BY TerritoryID) AS TerritoryKey, * FROM dim_territory",
    "days": DAYS,
}
EXTRA = {
    **DIM_SQL, **DELTA_SQL, **_KEYED, **{f"old_{n}": old_version(DIM_SQL[n]) for n in DIM_NAMES},
}


def amounts_sql(mode: str) -> str:
    gross = "CAST(CAST(d.UnitPrice AS DECIMAL(12,2)) * d.OrderQty AS DOUBLE)"
    discount = "CAST(CAST(d.UnitPrice AS DECIMAL(12,2)) * CAST(d.UnitPriceDiscount AS DECIMAL(4,2)) * d.OrderQty AS DOUBLE)"
    net = "CAST(d.LineTotal AS DOUBLE)"

    def header(name: str) -> str:
        if mode == "replicate":
            return f"CAST(h.{name} AS DOUBLE)"
        return f"round(CAST(h.{name} AS DOUBLE) * CAST(d.LineTotal AS DOUBLE) / CAST(h.SubTotal AS DOUBLE), 4)"

    source = "CAST(trunc(d.LineTotal) AS INTEGER)" if mode == "replicate" else "CAST(d.LineTotal AS DOUBLE)"
    return f"""d.OrderQty, d.UnitPrice, d.UnitPriceDiscount,
        CAST(strftime(h.OrderDate, '%Y%m%d') AS INTEGER) AS OrderDateKey, CAST(strftime(h.DueDate, '%Y%m%d') AS INTEGER) AS DueDateKey,
        CAST(strftime(h.ShipDate, '%Y%m%d') AS INTEGER) AS ShipDateKey, h.Status, CAST(h.OnlineOrderFlag AS INTEGER) AS OnlineOrderFlag,
        {header('TaxAmt')} AS TaxAllocated, {header('Freight')} AS Freight_Allocated, CAST(h.TotalDue AS DOUBLE) AS TotalDueTime,
        {source} AS LineAmountSource, strftime(greatest(h.ModifiedDate, d.ModifiedDate), '%Y-%m-%d %H:%M:%S') AS SalesInfoModifiedDate,
        {gross} AS LineAmount_Gross, {discount} AS LineDiscountAmount, {net} AS LineAmount_Net,
        {net} + {header('TaxAmt')} + {header('Freight')} AS TotalDue_Line"""


def full_sql(mode: str) -> str:
    return with_sources(f"""
        SELECT p.ProductKey, o.PromotionKey, c.CustomerKey, t.TerritoryKey, s.StoreKey, r.SalesReasonKey, m.ShipMethodKey,
               h.SalesOrderID, d.SalesOrderDetailID AS SalesOrderDetail, {amounts_sql(mode)}
        FROM (SELECT DISTINCT * FROM order_detail) d JOIN order_header h ON h.SalesOrderID = d.SalesOrderID
        JOIN key_product p ON p.ProductID = d.ProductID JOIN key_promotion o ON o.SpecialOfferID = d.SpecialOfferID
        JOIN key_customer c ON c.CustomerID = h.CustomerID JOIN key_territory t ON t.TerritoryID = h.TerritoryID
        JOIN key_ship_method m ON m.ShipMethodID = h.ShipMethodID
        LEFT JOIN (sales_customer sc JOIN key_store s ON s.StoreID = sc.StoreID) ON sc.CustomerID = h.CustomerID
        LEFT JOIN key_sales_reason r ON r.SalesOrderID = h.SalesOrderID
        JOIN days d1 ON d1.day = h.OrderDate JOIN days d2 ON d2.day = h.ShipDate JOIN days d3 ON d3.day = h.DueDate""", EXTRA)


def full_fact(spark, sf, mode):
    sources = OltpSources(spark, sf)
    dims = keyed_dimensions(sources)
    return build_fact(sources, {**dims, "DimDate": calendar_of(spark, sf)}, mode)


@query("fact_sales_full", full_sql("replicate"), nullable="StoreKey SalesReasonKey")
def fact_full_query(spark, sf):
    return full_fact(spark, sf, "replicate")


@query("allocate_reconciles", f"""
    SELECT SalesOrderID, max(TaxAllocated) AS Tax, max(Freight_Allocated) AS Freight FROM ({full_sql("replicate")}) whole GROUP BY SalesOrderID""")
def reconciled_query(spark, sf):
    """Tax and freight of the written rows of every order, against those of its header."""
    sums = full_fact(spark, sf, "reconcile").groupBy("SalesOrderID")
    return sums.agg(*[F.sum(c).cast("double").alias(n) for c, n in (("TaxAllocated", "Tax"), ("Freight_Allocated", "Freight"))])


@query("fact_date_roles_all", with_sources("""
    SELECT CASE WHEN h.OrderDate IS NULL THEN 0 ELSE 1 END AS ordered, CASE WHEN h.ShipDate IS NULL THEN 0 ELSE 1 END AS shipped,
           CASE WHEN h.DueDate IS NULL THEN 0 ELSE 1 END AS due, count(*) AS n FROM order_header h GROUP BY ALL"""))
def date_roles_all_query(spark, sf):
    """Every order by which of its dates have a day in the calendar of the orders; none is dropped."""
    sources = OltpSources(spark, sf)
    placed = date_roles(sources["order_header"], build_calendar(calendar_days(sources), fiscal=None), "left")
    flags = [F.col(c).isNotNull().cast("int").alias(n) for c, n in (("OrderDateKey", "ordered"), ("ShipDateKey", "shipped"), ("DueDateKey", "due"))]
    return placed.groupBy(*flags).agg(F.count("*").alias("n"))


@query("fact_sales_allocated", full_sql("allocate"), nullable="StoreKey SalesReasonKey")
def fact_allocated_query(spark, sf):
    return full_fact(spark, sf, "allocate")


_DELTA = f"""
    SELECT h.SalesOrderID, d.SalesOrderDetailID AS SalesOrderDetail, d.ProductID, d.SpecialOfferID AS PromotionID, h.CustomerID, h.TerritoryID,
           c.StoreID, h.ShipMethodID, {amounts_sql('allocate')}, strftime(greatest(h.ModifiedDate, d.ModifiedDate), '%Y-%m-%d %H:%M:%S') AS StartDate
    FROM order_detail d JOIN order_header h ON h.SalesOrderID = d.SalesOrderID JOIN sales_customer c ON c.CustomerID = h.CustomerID"""


@query("delta_fact_sales", with_sources(f"{_DELTA} WHERE h.ModifiedDate > TIMESTAMP '{CUTOFF}' OR d.ModifiedDate > TIMESTAMP '{CUTOFF}'"),
       nullable="StoreID ShipDateKey")
def delta_query(spark, sf):
    return fact_delta(OltpSources(spark, sf), CUTOFF)


@query("allocate_header_amounts", with_sources("""
    SELECT SalesOrderID, count(*) AS n_lines, sum(round(CAST(TaxAmt AS DOUBLE) * CAST(LineTotal AS DOUBLE) / CAST(SubTotal AS DOUBLE), 4)) AS allocated,
           max(CAST(TaxAmt AS DOUBLE)) AS header_amount
    FROM (SELECT h.SalesOrderID, h.TaxAmt, h.SubTotal, d.LineTotal FROM order_header h JOIN order_detail d ON d.SalesOrderID = h.SalesOrderID)
    GROUP BY SalesOrderID"""), "SalesOrderID n_lines allocated:d header_amount:d")
def allocate_query(spark, sf):
    """Tax spread over the lines of each order, beside the header amount it must add up to."""
    src = OltpSources(spark, sf)
    rows = src["order_header"].select("SalesOrderID", "TaxAmt", "SubTotal").join(src["order_detail"].select("SalesOrderID", "LineTotal"), "SalesOrderID")
    part = allocate(F.col("TaxAmt"), F.col("LineTotal"), F.col("SubTotal"))
    return rows.withColumn("part", part).groupBy("SalesOrderID").agg(
        F.count("*").alias("n_lines"), F.sum("part").alias("allocated"), F.max("TaxAmt").alias("header_amount")
    )


@query("fact_line_amounts", with_sources("""
    SELECT SalesOrderID, SalesOrderDetailID AS SalesOrderDetail,
           CAST(UnitPrice AS DECIMAL(12,2)) * OrderQty AS LineAmount_Gross,
           CAST(UnitPrice AS DECIMAL(12,2)) * CAST(UnitPriceDiscount AS DECIMAL(4,2)) * OrderQty AS LineDiscountAmount,
           LineTotal AS LineAmount_Net FROM order_detail"""),
    "SalesOrderID SalesOrderDetail LineAmount_Gross:d LineDiscountAmount:d LineAmount_Net:d")
def line_amounts_query(spark, sf):
    amounts = line_amounts(F.col("OrderQty"), F.col("UnitPrice"), F.col("UnitPriceDiscount"))
    lines = OltpSources(spark, sf)["order_detail"]
    return lines.select("SalesOrderID", F.col("SalesOrderDetailID").alias("SalesOrderDetail"), *[c.alias(n) for n, c in amounts.items()])


@query("fact_date_roles", with_sources("""
    SELECT SalesOrderID, CAST(strftime(OrderDate, '%Y%m%d') AS INTEGER) AS OrderDateKey, CAST(strftime(ShipDate, '%Y%m%d') AS INTEGER) AS ShipDateKey,
           CAST(strftime(DueDate, '%Y%m%d') AS INTEGER) AS DueDateKey
    FROM order_header WHERE OrderDate IN (SELECT day FROM days) AND ShipDate IN (SELECT day FROM days) AND DueDate IN (SELECT day FROM days)""", EXTRA))
def date_roles_query(spark, sf):
    headers = OltpSources(spark, sf)["order_header"].select("SalesOrderID", "OrderDate", "ShipDate", "DueDate")
    return date_roles(headers, calendar_of(spark, sf)).select("SalesOrderID", "OrderDateKey", "ShipDateKey", "DueDateKey")


@query("fact_reason_fanout", with_sources("""
    SELECT d.SalesOrderID, d.SalesOrderDetailID AS SalesOrderDetail, r.SalesReasonID
    FROM (SELECT DISTINCT * FROM order_detail) d LEFT JOIN dim_sales_reason r ON r.SalesOrderID = d.SalesOrderID""", EXTRA), nullable="SalesReasonID")
def fanout_query(spark, sf):
    src = OltpSources(spark, sf)
    reasons = REGISTRY["DimSalesReason"].build(src).select("SalesOrderID", "SalesReasonID")
    lines = src["order_detail"].select("SalesOrderID", F.col("SalesOrderDetailID").alias("SalesOrderDetail")).distinct()
    return lines.join(reasons, "SalesOrderID", "left")


@query("store_map_right_join", with_sources("""
    SELECT h.SalesOrderID, s.StoreKey FROM (SELECT o_orderkey AS SalesOrderID, o_custkey AS CustomerID FROM orders) h
    LEFT JOIN (sales_customer c JOIN key_store s ON s.StoreID = c.StoreID) ON c.CustomerID = h.CustomerID""", EXTRA), nullable="StoreKey")
def store_map_query(spark, sf):
    """Every order with the store of its customer, if it has one."""
    src = OltpSources(spark, sf)
    stores = store_of_customer(src["customer"], keyed_dimension("DimStore", src))
    orders = read(spark, sf, "orders").select(F.col("o_orderkey").alias("SalesOrderID"), F.col("o_custkey").alias("CustomerID"))
    return stores.join(orders, "CustomerID", "right").select("SalesOrderID", "StoreKey")


@query("fact_key_lookup_unknown", with_sources("""
    SELECT d.SalesOrderID, d.SalesOrderDetailID AS SalesOrderDetail, d.ProductID, coalesce(p.ProductKey, -1) AS ProductKey FROM order_detail d
    LEFT JOIN (SELECT row_number() OVER (ORDER BY ProductID) AS ProductKey, ProductID FROM dim_product WHERE NoOfYears IS NOT NULL) p
           ON p.ProductID = d.ProductID""", EXTRA))
def lookup_query(spark, sf):
    """Lines against a product dimension that lacks the products without maintenance."""
    src = OltpSources(spark, sf)
    config = REGISTRY["DimProduct"]
    known = config.build(src).filter(F.col("NoOfYears").isNotNull())
    products = assign_keys(known, "ProductKey", ["ProductID"])
    lines = src["order_detail"].select("SalesOrderID", F.col("SalesOrderDetailID").alias("SalesOrderDetail"), "ProductID")
    return resolve_key(lines, products, Lookup("ProductID", "ProductID", "ProductKey", "DimProduct"))


@query("fact_insert_only", with_sources("""
    SELECT DISTINCT b.SalesOrderID, b.SalesOrderDetailID AS SalesOrderDetail, b.ProductID, b.OrderQty
    FROM (SELECT * FROM order_detail WHERE ModifiedDate > TIMESTAMP '1998-12-31') b
    WHERE NOT EXISTS (SELECT 1 FROM old_order_detail t WHERE t.SalesOrderID = b.SalesOrderID AND t.SalesOrderDetailID = b.SalesOrderDetailID)"""))
def insert_only_query(spark, sf):
    """A batch that overlaps the loaded lines by half a year."""
    columns = ["SalesOrderID", F.col("SalesOrderDetailID").alias("SalesOrderDetail"), "ProductID", "OrderQty"]
    loaded = OltpSources(spark, sf, CUTOFF)["order_detail"].select(*columns)
    batch = OltpSources(spark, sf)["order_detail"].filter(F.col("ModifiedDate") > F.lit("1998-12-31").cast("timestamp_ntz"))
    return insert_only(loaded, cut_lineage(batch.select(*columns)), GRAIN)


_OLD_LINES = """SELECT DISTINCT d.SalesOrderID, d.SalesOrderDetailID FROM old_order_detail d JOIN old_order_header h ON h.SalesOrderID = d.SalesOrderID"""


@query("fact_merge", with_sources(f"""
    SELECT (SELECT count(*) FROM ({_OLD_LINES})) + row_number() OVER (ORDER BY b.SalesOrderID, b.SalesOrderDetail) AS FactSalesKey,
           coalesce(p.ProductKey, -1) AS ProductKey, coalesce(o.PromotionKey, -1) AS PromotionKey, coalesce(c.CustomerKey, -1) AS CustomerKey,
           coalesce(t.TerritoryKey, -1) AS TerritoryKey, coalesce(s.StoreKey, -1) AS StoreKey, coalesce(r.SalesReasonKey, -1) AS SalesReasonKey,
           coalesce(m.ShipMethodKey, -1) AS ShipMethodKey, b.SalesOrderID, b.SalesOrderDetail, {', '.join('b.' + c for c in MEASURES)}
    FROM (SELECT DISTINCT * FROM ({_DELTA} WHERE h.ModifiedDate > TIMESTAMP '{CUTOFF}' OR d.ModifiedDate > TIMESTAMP '{CUTOFF}')
          WHERE (SalesOrderID, SalesOrderDetail) NOT IN ({_OLD_LINES})) b
    LEFT JOIN key_product p ON p.ProductID = b.ProductID LEFT JOIN key_promotion o ON o.SpecialOfferID = b.PromotionID
    LEFT JOIN key_customer c ON c.CustomerID = b.CustomerID LEFT JOIN key_territory t ON t.TerritoryID = b.TerritoryID
    LEFT JOIN key_store s ON s.StoreID = b.StoreID LEFT JOIN key_ship_method m ON m.ShipMethodID = b.ShipMethodID
    LEFT JOIN (SELECT SalesOrderID, min(SalesReasonKey) AS SalesReasonKey FROM key_sales_reason GROUP BY SalesOrderID) r
           ON r.SalesOrderID = b.SalesOrderID""".replace("d JOIN old_order_header h ON h.SalesOrderID = d.SalesOrderID", "d JOIN old_orders h ON h.o_orderkey = d.SalesOrderID"), EXTRA), nullable="ShipDateKey")
def merge_query(spark, sf):
    """Lines of the delta that the fact lacks, with current keys and -1 for unknown members."""
    new = OltpSources(spark, sf)
    loaded = read(spark, sf, "orders").filter(F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz")).select(F.col("o_orderkey").alias("SalesOrderID"))
    lines = OltpSources(spark, sf, CUTOFF)["order_detail"].select("SalesOrderID", F.col("SalesOrderDetailID").alias("SalesOrderDetail"))
    target = assign_keys(lines.join(loaded, "SalesOrderID").distinct(), "FactSalesKey", GRAIN)
    return merge_fact(target, cut_lineage(fact_delta(new, CUTOFF), by="SalesOrderID"), keyed_dimensions(new), reasons="one")


@query("assign_surrogate_key", """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS OrderKey, o_orderkey, o_orderdate FROM orders""",
    "OrderKey o_orderkey o_orderdate:t")
def assign_query(spark, sf):
    return assign_keys(read(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "OrderKey", ["o_orderdate", "o_orderkey"])


@query("next_surrogate_key", """
    SELECT 'customer' AS table_name, max(c_custkey) + 1 AS next_key FROM customer
    UNION ALL SELECT 'orders', max(o_orderkey) + 1 FROM orders
    UNION ALL SELECT 'empty', 1 FROM (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)""")
def next_key_query(spark, sf):
    orders = read(spark, sf, "orders")
    rows = [
        next_key(read(spark, sf, "customer"), "c_custkey").select(F.lit("customer").alias("table_name"), "next_key"),
        next_key(orders, "o_orderkey").select(F.lit("orders").alias("table_name"), "next_key"),
        next_key(orders.filter(F.col("o_orderkey").isNull()), "o_orderkey").select(F.lit("empty").alias("table_name"), "next_key"),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("number_stored_fact", """
    SELECT count(*) AS n_rows, count(*) AS n_keys, 1 AS lowest, count(*) AS highest, CAST(sum(l_orderkey) AS BIGINT) AS order_sum FROM lineitem""")
def number_stored_query(spark, sf):
    """Keys of a stored table: dense, unique, from 1 to the number of rows."""
    keyed = number_stored_rows(cut_lineage(read(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")), "LineKey")
    return keyed.agg(
        F.count("*").alias("n_rows"), F.countDistinct("LineKey").alias("n_keys"), F.min("LineKey").alias("lowest"),
        F.max("LineKey").alias("highest"), F.sum("l_orderkey").alias("order_sum"),
    )


@query("assign_key_to_copies", """
    SELECT l_returnflag, l_linestatus, count(*) AS n_rows, min(k) AS lowest, max(k) AS highest, CAST(sum(k) AS BIGINT) AS key_sum FROM (
        SELECT l_returnflag, l_linestatus, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS k FROM lineitem) GROUP BY 1, 2""")
def copies_query(spark, sf):
    """Six distinct rows in very many copies, numbered without gathering the copies of one in a task."""
    flags = read(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    keyed = assign_keys(flags, "k", ["l_returnflag", "l_linestatus"], unique=False)
    return keyed.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_rows"), F.min("k").alias("lowest"), F.max("k").alias("highest"), F.sum("k").alias("key_sum")
    )


__all__ = ["EXTRA", "FACT_COLUMNS", "keyed_dimension", "keyed_dimensions"]
