"""The seven dimension builders, full and delta, and the row choices they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.dedup import latest_per_key, preferred_row
from starloom.plans import dimensions as dim
from starloom.workload.base import query
from starloom.workload.oltp import OltpSources, read
from starloom.workload.oltp_sql import CUTOFF, with_sources

SURVEY = ("BirthDate MaritalStatus Gender Education Occupation HomeOwnerFlag NumberCarsOwned NumberChildrenAtHome "
          "TotalChildren TotalPurchaseYTD YearlyIncome DateFirstPurchase").split()
END = "TIMESTAMP '9999-12-31' AS EndDate"

# Oracle versions of the dimensions. Each uses the source CTEs; ``greatest`` skips nulls in the oracle as well.
DIM_SQL = {
    "dim_customer": f"""
        SELECT c.CustomerID, p.PersonType, p.FirstName, p.LastName, e.EmailAddress, p.EmailPromotion, a.AddressLine1, a.City,
               a.StateProvinceName, a.CountryRegionName, {', '.join('v.' + c for c in SURVEY)},
               greatest(c.ModifiedDate, p.ModifiedDate, e.ModifiedDate, a.AddressDate, a.StateDate, a.CountryDate, a.LinkDate) AS StartDate, {END}
        FROM sales_customer c JOIN person p ON p.BusinessEntityID = c.PersonID
        LEFT JOIN (SELECT * FROM email_address QUALIFY row_number() OVER
                   (PARTITION BY BusinessEntityID ORDER BY ModifiedDate DESC, EmailAddress) = 1) e ON e.BusinessEntityID = p.BusinessEntityID
        LEFT JOIN (SELECT * FROM entity_address QUALIFY row_number() OVER
                   (PARTITION BY BusinessEntityID ORDER BY AddressDate DESC, AddressID, LinkDate DESC) = 1) a ON a.BusinessEntityID = p.BusinessEntityID
        LEFT JOIN person_survey v ON v.BusinessEntityID = p.BusinessEntityID
        WHERE c.StoreID IS NULL""",
    "dim_product": f"""
        SELECT p.ProductID, p.Name, p.Color, p.Size, p.Weight, p.Style, m.Name AS ModelName, c.Name AS CategoryName,
               s.Name AS SubCategoryName, p.StandardCost, p.ListPrice, m.WarrantyPeriod, m.NoOfYears,
               greatest(p.ModifiedDate, m.ModifiedDate, s.ModifiedDate, c.ModifiedDate) AS StartDate, {END}
        FROM product p LEFT JOIN (SELECT * FROM product_model WHERE described) m ON m.ProductModelID = p.ProductModelID
        LEFT JOIN (product_subcategory s JOIN product_category c ON c.ProductCategoryID = s.ProductCategoryID)
               ON s.ProductSubcategoryID = p.ProductSubcategoryID""",
    "dim_promotion": f"""
        SELECT SpecialOfferID, Description, "Type", Category, DiscountPct, MinQty, MaxQty, ModifiedDate AS StartDate, {END} FROM special_offer""",
    "dim_sales_reason": f"""
        SELECT DISTINCT o.SalesOrderID, o.SalesReasonID, r.Name, r.ReasonType,
               CASE WHEN r.ModifiedDate > o.ModifiedDate THEN r.ModifiedDate ELSE o.ModifiedDate END AS StartDate, {END}
        FROM order_reason o JOIN sales_reason r ON r.SalesReasonID = o.SalesReasonID""",
    "dim_ship_method": f"""
        SELECT s.ShipMethodID, s.Name, s.ShipBase, s.ShipRate, max(h.ShipDate) AS ShipDate, s.ModifiedDate AS StartDate, {END}
        FROM ship_method s LEFT JOIN order_header h ON h.ShipMethodID = s.ShipMethodID AND h.ShipDate IS NOT NULL GROUP BY ALL""",
    "dim_store": f"""
        SELECT s.BusinessEntityID AS StoreID, s.Name, v.AnnualSales, v.AnnualRevenue, v.BusinessType, v.BankName, v.YearOpened, v.Specialty,
               v.SquareFeet, v.Brands, v.Internet, v.NumberEmployees, a.AddressType, a.AddressLine1, a.AddressLine2, a.City,
               a.StateProvinceName, a.CountryRegionName,
               greatest(s.ModifiedDate, a.AddressDate, a.TypeDate, a.CountryDate, a.StateDate, a.LinkDate) AS StartDate, {END}
        FROM store s JOIN (SELECT * FROM entity_address QUALIFY row_number() OVER (PARTITION BY BusinessEntityID ORDER BY
                CASE AddressType WHEN 'Main Office' THEN 0 WHEN 'Shipping' THEN 1 WHEN 'Billing' THEN 2 ELSE 9 END, AddressLine1, AddressID) = 1) a
             ON a.BusinessEntityID = s.BusinessEntityID
        LEFT JOIN store_survey v ON v.BusinessEntityID = s.BusinessEntityID""",
    "dim_territory": f"""
        SELECT t.TerritoryID, t.Name, c.Name AS CountryRegionName, t.grp AS "Group", CAST(t.SalesYTD AS DECIMAL(19,4)) AS SalesYTD,
               CAST(0 AS DECIMAL(19,4)) AS SalesLastYear, CAST(t.CostYTD AS DECIMAL(19,4)) AS CostYTD,
               CAST(0 AS DECIMAL(19,4)) AS CostLastYear, greatest(t.ModifiedDate, c.ModifiedDate) AS StartDate, {END}
        FROM (SELECT * FROM sales_territory QUALIFY row_number() OVER (PARTITION BY TerritoryID ORDER BY ModifiedDate DESC, SalesYTD DESC) = 1) t
        LEFT JOIN country_region c ON c.CountryRegionCode = t.CountryRegionCode""",
}
_KINDS = {"BirthDate": ":t", "DateFirstPurchase": ":t", "ShipDate": ":t", "StartDate": ":t", "EndDate": ":t", "HomeOwnerFlag": ":b",
          **{c: ":d" for c in ("TotalPurchaseYTD", "Weight", "StandardCost", "ListPrice", "DiscountPct", "ShipBase", "ShipRate",
                               "AnnualSales", "AnnualRevenue", "SalesYTD", "SalesLastYear", "CostYTD", "CostLastYear")}}


_NULLABLE = ["HomeOwnerFlag", "NumberCarsOwned", "NumberChildrenAtHome", "TotalChildren", "MaxQty", "YearOpened", "SquareFeet", "Brands", "NumberEmployees"]


def nullable_of(columns) -> str:
    """Whole-number attributes among the columns that may be null."""
    return " ".join(c for c in _NULLABLE if c in columns)


def shape_of(columns) -> str:
    return " ".join(c + _KINDS.get(c, "") for c in columns)


BUILDERS = {
    "dim_customer": (dim.dim_customer, dim.CUSTOMER), "dim_product": (dim.dim_product, dim.PRODUCT),
    "dim_promotion": (dim.dim_promotion, dim.PROMOTION), "dim_sales_reason": (dim.dim_sales_reason, dim.SALES_REASON),
    "dim_ship_method": (dim.dim_ship_method, dim.SHIP_METHOD), "dim_store": (dim.dim_store, dim.STORE),
    "dim_territory": (dim.dim_territory, dim.TERRITORY),
}

# Keys that a change after the cutoff touches, per dimension.
_MOVED = f"""
    SELECT BusinessEntityID FROM entity_address
    WHERE AddressDate > TIMESTAMP '{CUTOFF}' OR LinkDate > TIMESTAMP '{CUTOFF}' OR StateDate > TIMESTAMP '{CUTOFF}'
       OR CountryDate > TIMESTAMP '{CUTOFF}' OR TypeDate > TIMESTAMP '{CUTOFF}'"""
TOUCHED_SQL = {
    "dim_customer": f"""CustomerID IN (
        SELECT c.CustomerID FROM sales_customer c JOIN person p ON p.BusinessEntityID = c.PersonID
        WHERE c.ModifiedDate > TIMESTAMP '{CUTOFF}' OR p.ModifiedDate > TIMESTAMP '{CUTOFF}'
           OR c.PersonID IN (SELECT BusinessEntityID FROM email_address WHERE ModifiedDate > TIMESTAMP '{CUTOFF}')
           OR c.PersonID IN ({_MOVED}))""",
    "dim_product": f"""ProductID IN (
        SELECT p.ProductID FROM product p LEFT JOIN product_model m ON m.ProductModelID = p.ProductModelID
        LEFT JOIN product_subcategory s ON s.ProductSubcategoryID = p.ProductSubcategoryID
        LEFT JOIN product_category c ON c.ProductCategoryID = s.ProductCategoryID
        WHERE p.ModifiedDate > TIMESTAMP '{CUTOFF}' OR m.ModifiedDate > TIMESTAMP '{CUTOFF}'
           OR s.ModifiedDate > TIMESTAMP '{CUTOFF}' OR c.ModifiedDate > TIMESTAMP '{CUTOFF}')""",
    "dim_promotion": f"SpecialOfferID IN (SELECT SpecialOfferID FROM special_offer WHERE ModifiedDate > TIMESTAMP '{CUTOFF}')",
    "dim_sales_reason": f"""(SalesOrderID, SalesReasonID) IN (
        SELECT (o.SalesOrderID, o.SalesReasonID) FROM order_reason o JOIN sales_reason r ON r.SalesReasonID = o.SalesReasonID
        WHERE o.ModifiedDate > TIMESTAMP '{CUTOFF}' OR r.ModifiedDate > TIMESTAMP '{CUTOFF}')""",
    "dim_ship_method": f"""ShipMethodID IN (SELECT ShipMethodID FROM ship_method WHERE ModifiedDate > TIMESTAMP '{CUTOFF}'
        UNION SELECT ShipMethodID FROM order_header WHERE ModifiedDate > TIMESTAMP '{CUTOFF}')""",
    "dim_store": f"""StoreID IN (SELECT BusinessEntityID FROM store WHERE ModifiedDate > TIMESTAMP '{CUTOFF}' UNION {_MOVED})""",
    "dim_territory": f"""TerritoryID IN (
        SELECT t.TerritoryID FROM sales_territory t LEFT JOIN country_region c ON c.CountryRegionCode = t.CountryRegionCode
        WHERE t.ModifiedDate > TIMESTAMP '{CUTOFF}' OR c.ModifiedDate > TIMESTAMP '{CUTOFF}')""",
}
# A delta of ship methods starts at the newest order of the method.
_DELTA_SELECT = {
    "dim_ship_method": """* REPLACE (greatest(StartDate, (SELECT max(h.ModifiedDate) FROM order_header h
                                                          WHERE h.ShipMethodID = d.ShipMethodID)) AS StartDate)""",
}
DELTA_SQL = {
    f"delta_{n}": f"SELECT {_DELTA_SELECT.get(n, '*')} FROM {n} d WHERE {TOUCHED_SQL[n]}" for n in DIM_SQL
}

for _name, (_build, _spec) in BUILDERS.items():
    _shape = shape_of(_spec.row_columns)
    _numbers = nullable_of(_spec.row_columns)
    query(_name, with_sources(DIM_SQL[_name]), _shape, _numbers)(lambda spark, sf, build=_build: build(OltpSources(spark, sf)))
    query(f"delta_{_name}", with_sources(DELTA_SQL[f"delta_{_name}"], DIM_SQL), _shape, _numbers)(
        lambda spark, sf, build=_build: build(OltpSources(spark, sf), CUTOFF)
    )


@query("latest_per_key", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "o_custkey o_orderkey o_orderdate:t o_orderpriority")
def latest_query(spark, sf):
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query("preferred_row_per_key", """
    SELECT l_suppkey, l_returnflag, l_shipdate, l_orderkey, l_partkey, l_linenumber FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 9 END,
                               l_shipdate, l_orderkey, l_partkey, l_linenumber) = 1""",
    "l_suppkey l_returnflag l_shipdate:t l_orderkey l_partkey l_linenumber")
def preferred_query(spark, sf):
    lines = read(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate", "l_orderkey", "l_partkey", "l_linenumber")
    return preferred_row(lines, ["l_suppkey"], "l_returnflag", ["R", "A"], ["l_shipdate", "l_orderkey", "l_partkey", "l_linenumber"])


@query("row_max_dates", """
    SELECT o_orderkey, greatest(o_orderdate, last_ship, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 40 DAY END) AS StartDate
    FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "o_orderkey StartDate:t")
def row_max_query(spark, sf):
    from starloom.functions.scalar import row_max

    ships = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last_ship"))
    later = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("interval 40 days"))
    orders = read(spark, sf, "orders").join(ships, "o_orderkey", "left")
    return orders.select("o_orderkey", row_max("o_orderdate", "last_ship", later).alias("StartDate"))
