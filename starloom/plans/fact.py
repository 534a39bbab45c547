"""The sales fact: full load, delta, and insert-only merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.scalar import allocate, line_amounts, ntz, row_max
from starloom.operators.allocate import allocate_exactly
from starloom.operators.keys import UNKNOWN_KEY, assign_keys, assign_keys_by_group, number_stored_rows
from starloom.operators.lookup import Lookup, current_rows, insert_only_by_group, known_by_group, known_in_months, resolve_keys, touched_only
from starloom.runtime import cut_lineage

MEASURES = [
    "OrderQty", "UnitPrice", "UnitPriceDiscount", "OrderDateKey", "DueDateKey", "ShipDateKey", "Status",
    "OnlineOrderFlag", "TaxAllocated", "Freight_Allocated", "TotalDueTime", "LineAmountSource",
    "SalesInfoModifiedDate", "LineAmount_Gross", "LineDiscountAmount", "LineAmount_Net", "TotalDue_Line",
]
KEYS = ["ProductKey", "PromotionKey", "CustomerKey", "TerritoryKey", "StoreKey", "SalesReasonKey", "ShipMethodKey"]
GRAIN = ["SalesOrderID", "SalesOrderDetail"]
FACT_COLUMNS = [*KEYS, *GRAIN, *MEASURES]

FACT_LOOKUPS = [
    Lookup("ProductID", "ProductID", "ProductKey", "DimProduct"),
    Lookup("PromotionID", "SpecialOfferID", "PromotionKey", "DimPromotion"),
    Lookup("CustomerID", "CustomerID", "CustomerKey", "DimCustomer"),
    Lookup("TerritoryID", "TerritoryID", "TerritoryKey", "DimTerritory"),
    Lookup("StoreID", "StoreID", "StoreKey", "DimStore"),
    Lookup("SalesOrderID", "SalesOrderID", "SalesReasonKey", "DimSalesReason"),
    Lookup("ShipMethodID", "ShipMethodID", "ShipMethodKey", "DimShipMethod"),
]


def date_roles(headers: DataFrame, calendar: DataFrame, how: str = "inner") -> DataFrame:
    """Order, ship and due date keys by exact match with the calendar.

    An order with a date that is null or outside the calendar is dropped by an
    inner join; a left join keeps it with a null key.
    The calendar has one row per day, so its three copies stay below the broadcast threshold.
    """
    days = calendar.select("Date", "DateKey")
    for column, key in (("OrderDate", "OrderDateKey"), ("ShipDate", "ShipDateKey"), ("DueDate", "DueDateKey")):
        role = days.select(F.col("Date").alias(column), F.col("DateKey").alias(key))
        headers = headers.join(role, column, how)
    return headers


def store_of_customer(customers: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Store key of each customer that belongs to a store."""
    pairs = customers.select("CustomerID", "StoreID").filter(F.col("StoreID").isNotNull())
    return pairs.join(dim_store.select("StoreID", "StoreKey"), "StoreID").select("CustomerID", "StoreKey")


def _header_amount(mode: str, name: str):
    whole = F.col(name).cast("decimal(19,4)")
    if mode == "replicate":
        return whole
    if mode == "reconcile":
        return F.lit(None).cast("decimal(19,4)")
    if mode == "allocate":
        return allocate(F.col(name), F.col("LineTotal"), F.col("SubTotal"))
    raise ValueError("header_amounts must be replicate, allocate or reconcile")


def _measures(header_amounts: str) -> dict:
    tax, freight = _header_amount(header_amounts, "TaxAmt"), _header_amount(header_amounts, "Freight")
    amounts = line_amounts(F.col("OrderQty"), F.col("UnitPrice"), F.col("UnitPriceDiscount"))
    return {
        "TaxAllocated": tax,
        "Freight_Allocated": freight,
        "TotalDueTime": F.col("TotalDue").cast("decimal(19,4)"),
        "SalesInfoModifiedDate": row_max("HeaderModified", "LineModified"),
        **amounts,
        "TotalDue_Line": amounts["LineAmount_Net"] + tax.cast("double") + freight.cast("double"),
    }


def _lines(src) -> DataFrame:
    return src["order_detail"].select(
        "SalesOrderID", F.col("SalesOrderDetailID").alias("SalesOrderDetail"), "ProductID",
        F.col("SpecialOfferID").alias("PromotionID"), "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
        F.col("ModifiedDate").alias("LineModified"),
    )


def _headers(src) -> DataFrame:
    return src["order_header"].withColumnRenamed("ModifiedDate", "HeaderModified")


def build_fact(src, dims: dict[str, DataFrame], header_amounts: str = "allocate", lines_unique: bool = False, unmatched: str = "drop") -> DataFrame:
    """Full load at the grain order line x sales reason.

    ``header_amounts="reconcile"`` spreads tax and freight over the rows as written, so that they add up to the header.
    ``dims`` holds one row per business key: the members that are current now. A
    line whose order or keys find no match is dropped, as by inner joins; with
    ``unmatched="unknown"`` it is kept with key -1 (a null date key for a null date), as the delta keeps it.

    Everything known per order is joined while there is still one row per
    order, and everything known per line before reasons multiply the lines; the
    two meet on the order id, which the reason join has already partitioned by. Duplicates can only stem from the lines, so they
    are removed there and not from the widened result.
    """
    if unmatched not in ("drop", "unknown"):
        raise ValueError("unmatched must be drop or unknown")
    how = "inner" if unmatched == "drop" else "left"
    lines = _lines(src)
    if header_amounts != "reconcile" and not lines_unique:
        lines = lines.distinct()
    whole = F.col("LineTotal").cast("int") if header_amounts == "replicate" else F.col("LineTotal").cast("decimal(19,4)")
    customers = dims["DimCustomer"].select("CustomerID", "CustomerKey").join(
        store_of_customer(src["customer"], dims["DimStore"]), "CustomerID", "left"
    )
    headers = (
        date_roles(_headers(src), dims["DimDate"], how)
        .join(dims["DimTerritory"].select("TerritoryID", "TerritoryKey"), "TerritoryID", how)
        .join(dims["DimShipMethod"].select("ShipMethodID", "ShipMethodKey"), "ShipMethodID", how)
        .join(customers, "CustomerID", how)
        .join(dims["DimSalesReason"].select("SalesOrderID", "SalesReasonKey"), "SalesOrderID", "left")
    )
    lines = (
        lines.join(dims["DimPromotion"].select(F.col("SpecialOfferID").alias("PromotionID"), "PromotionKey"), "PromotionID", how)
        .join(dims["DimProduct"].select("ProductID", "ProductKey"), "ProductID", how)
    )
    if header_amounts == "reconcile":
        # amounts are spread by order; so the lines, once they have met the products, are dealt by it for all further steps
        lines = lines.repartition("SalesOrderID")
        lines = lines if lines_unique else lines.distinct()
    rows = headers.join(lines, "SalesOrderID")
    if unmatched == "unknown":
        rows = rows.withColumns({k: F.coalesce(F.col(k), F.lit(UNKNOWN_KEY).cast("long")) for k in KEYS})
    rows = rows.withColumns({**_measures(header_amounts), "LineAmountSource": whole})
    if header_amounts == "reconcile":
        rows = _reconciled(rows)
    return rows.select(*FACT_COLUMNS)


def _reconciled(rows: DataFrame) -> DataFrame:
    """Tax and freight spread over the rows as written, so that those of an order add up to its header."""
    parts = {"TaxAllocated": "TaxAmt", "Freight_Allocated": "Freight"}
    # nothing that the fact lacks goes through the sorts of the allocation
    rows = rows.select(*[c for c in rows.columns if c in {*FACT_COLUMNS, "LineTotal", *parts.values()} and c != "TotalDue_Line"])
    rows = allocate_exactly(rows, "SalesOrderID", "LineTotal", parts, ["SalesOrderDetail", "SalesReasonKey"])
    due = F.col("LineAmount_Net") + F.col("TaxAllocated").cast("double") + F.col("Freight_Allocated").cast("double")
    return rows.withColumn("TotalDue_Line", due)


def fact_delta(src, since, header_amounts: str = "allocate") -> DataFrame:
    """Order lines of which the line or its order changed since the watermark, with business keys.

    Changed lines and unchanged lines of changed orders are two separate joins,
    so each has a filter on one side that reaches its scan. All joins go by order, so the rows come out partitioned by it.
    """
    mark = ntz(since)
    lines, headers = _lines(src), _headers_with_store(src, _headers(src).drop("StoreID"))
    new_lines = lines.filter(F.col("LineModified") > mark)
    old_lines = lines.filter(~(F.col("LineModified") > mark) | F.col("LineModified").isNull())
    joined = [
        headers.join(new_lines, "SalesOrderID"),
        headers.filter(F.col("HeaderModified") > mark).join(old_lines, "SalesOrderID"),
    ]
    return _measured(reduce(DataFrame.unionByName, joined), header_amounts).select(
        *GRAIN, "ProductID", "PromotionID", "CustomerID", "TerritoryID", "StoreID", "ShipMethodID", *MEASURES, "StartDate"
    )


def _with_store(src, rows: DataFrame) -> DataFrame:
    """Orders, or their lines, with the store of the customer."""
    return rows.join(src["customer"].select("CustomerID", "StoreID"), "CustomerID", "left") if "customer" in src else rows


def _headers_with_store(src, headers: DataFrame) -> DataFrame:
    """``_with_store`` by order id: order and customer alone go to the customers and back, the orders stay where their lines will meet them."""
    if "customer" not in src:
        return headers
    key = "SalesOrderID"
    pairs = headers.select(key, "CustomerID").filter(F.col("CustomerID").isNotNull()).distinct()
    stores = pairs.join(src["customer"].select("CustomerID", "StoreID"), "CustomerID").select(
        F.col(key).alias("_order"), F.col("CustomerID").alias("_customer"), "StoreID"
    )
    # the customer is not a second key of the join, which would move the orders
    own = (F.col(key) == F.col("_order")) & F.col("CustomerID").between(F.col("_customer"), F.col("_customer"))
    return headers.join(stores, own, "left").drop("_order", "_customer")


def _measured(rows: DataFrame, header_amounts: str) -> DataFrame:
    """Lines joined with their orders, with the measures."""
    def key(c):
        return date_key(F.col(c).cast("date"))

    return rows.withColumns({
        **_measures(header_amounts),
        "OrderDateKey": key("OrderDate"), "DueDateKey": key("DueDate"), "ShipDateKey": key("ShipDate"),
        "LineAmountSource": F.col("LineTotal").cast("decimal(19,4)"),
        "StartDate": row_max("HeaderModified", "LineModified"),
    })


def _with_reasons(rows: DataFrame, reasons: DataFrame) -> DataFrame:
    """A row for each current reason of the order, key -1 where it has none."""
    rows = rows.join(current_rows(reasons).select("SalesOrderID", "SalesReasonKey"), "SalesOrderID", "left")
    return rows.withColumn("SalesReasonKey", F.coalesce("SalesReasonKey", F.lit(UNKNOWN_KEY).cast("long")))


def _near(dims: dict[str, DataFrame], *parts: DataFrame) -> dict[str, DataFrame]:
    """Dimensions cut to the keys of a batch, each key from the first part that has it."""
    near = dict(dims)
    for lookup in FACT_LOOKUPS:
        rows = next(p for p in parts if lookup.fact_column in p.columns)
        wanted = rows.select(F.col(lookup.fact_column).alias(lookup.business_key))
        near[lookup.dimension] = touched_only(dims[lookup.dimension], wanted, [lookup.business_key])
    return near


_BY_KEY = [k for k in FACT_LOOKUPS if k.surrogate_key != "SalesReasonKey"]
_BY_REASON = [k for k in FACT_LOOKUPS if k.surrogate_key == "SalesReasonKey"]


def whole_orders(src, orders: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """All fact rows of some orders as the source has them now, with header amounts that add up.

    One changed line moves the parts of all others, so an order is only right as a whole.
    Keys are looked up while orders and lines are apart and narrow; from then on all goes by order.
    """
    key = ["SalesOrderID"]
    headers = cut_lineage(_with_store(src, touched_only(_headers(src).drop("StoreID"), orders, key)))
    lines = touched_only(_lines(src), orders, key)
    near = _near(dims, headers, lines)
    lines = resolve_keys(lines.distinct(), near, [k for k in _BY_KEY if k.fact_column not in headers.columns])
    headers = resolve_keys(headers, near, [k for k in _BY_KEY if k.fact_column in headers.columns])
    rows = _with_reasons(headers, near["DimSalesReason"]).join(lines, "SalesOrderID")
    return _reconciled(_measured(rows, "reconcile")).select(*FACT_COLUMNS)


def replace_orders(near: DataFrame, orders: DataFrame, rows: DataFrame, last_key: int, key_col: str = "FactSalesKey") -> tuple[DataFrame, int]:
    """``near`` with the rows of ``orders`` retracted and ``rows`` in their place, and how many of these are new.

    ``near`` are the stored rows of the months concerned; ``rows`` must be stored, too. Rows of other orders stay as they are; a row that comes
    back under the same line and reason keeps its key, new ones are numbered after ``last_key``. Keys are found
    and numbered without the measures, which join them once, at the end.
    """
    grain = [*GRAIN, "SalesReasonKey"]
    old = touched_only(near, orders, ["SalesOrderID"]).groupBy(*grain).agg(F.min(key_col).alias(key_col))
    rows = number_stored_rows(rows, "_row")
    met = cut_lineage(rows.select("_row", *grain).join(old, grain, "left"))
    new = met.filter(F.col(key_col).isNull())
    after = near.sparkSession.range(1).select(F.lit(last_key).cast("long").alias(key_col))
    fresh = assign_keys(new.select("_row", *grain), key_col, grain, after=after, after_col=key_col)
    keys = met.filter(F.col(key_col).isNotNull()).select("_row", key_col).unionByName(fresh.select("_row", key_col))
    stays = near.join(orders.select("SalesOrderID").distinct(), "SalesOrderID", "left_anti")
    columns = [key_col, *FACT_COLUMNS]
    return stays.select(*columns).unionByName(rows.join(keys, "_row").select(*columns)), new.count()


def merge_fact(
    target: DataFrame,
    delta: DataFrame,
    dims: dict[str, DataFrame],
    key_col: str = "FactSalesKey",
    reasons: str = "all",
    months: DataFrame | None = None,
    last_key: int | None = None,
) -> DataFrame:
    """Rows to append: lines the fact lacks, keys resolved to current members, numbered after the last key.

    A line gets a row for each current reason of its order, as in the full load;
    ``reasons="one"`` takes the smallest key only. Dimensions are cut to the keys of the batch first.
    With ``months`` (the months in which the fact holds the batch's orders) the test for known lines opens these partitions only;
    with ``last_key`` the fact is not read for its largest key.

    ``delta`` must be stored. Lines are compared, matched with reasons and numbered by order alone: the wide rows move once for all of it,
    and not at all where they are stored in buckets of it; then once for each other dimension too large for a broadcast.
    """
    if reasons not in ("all", "one"):
        raise ValueError("reasons must be all or one")
    order = GRAIN[0]
    found = known_by_group(target, delta, GRAIN) if months is None else known_in_months(target, delta, GRAIN, "OrderMonth", months)
    known = cut_lineage(found.distinct())
    near = _near(dims, delta)
    fresh = insert_only_by_group(delta, known, GRAIN)
    sizes = insert_only_by_group(delta.select(*GRAIN), known, GRAIN).groupBy(order).agg(F.count("*").alias("_size"))
    if reasons == "all":
        fresh = _with_reasons(fresh, near["DimSalesReason"])
        many = current_rows(near["DimSalesReason"]).groupBy(order).agg(F.count("*").alias("_many"))
        sizes = sizes.join(many, order, "left").select(order, (F.col("_size") * F.coalesce("_many", F.lit(1))).alias("_size"))
    else:
        fresh = resolve_keys(fresh, near, _BY_REASON)
    after = target if last_key is None else target.sparkSession.range(1).select(F.lit(last_key).cast("long").alias(key_col))
    keyed = assign_keys_by_group(fresh, sizes, key_col, order, [*GRAIN[1:], "SalesReasonKey"], after=after, after_col=key_col)
    return resolve_keys(keyed, near, _BY_KEY).select(key_col, *FACT_COLUMNS)
