"""The same source tables in the oracle's SQL, written independently of the DataFrame version."""

from __future__ import annotations

import re

_DAY = "(TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * ({}))"
_STATUS = "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END"
_PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
_BRAND = "CAST(substr(p_brand, 7) AS INTEGER)"
_TYPE = "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END"
_LINE_TOTAL = "(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) * CAST(l_quantity AS DECIMAL(4,0)))"

# The surveys are given as the columns that parsing the documents must yield.
CTES: dict[str, str] = {
    "person": f"""
        SELECT c_custkey AS BusinessEntityID,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'SC' ELSE 'IN' END AS PersonType,
               split_part(c_name, '#', 1) AS FirstName, split_part(c_name, '#', 2) AS LastName,
               c_nationkey % 3 AS EmailPromotion, c_acctbal >= 0 AS surveyed,
               {_DAY.format('c_custkey * 7 % 2000')} AS ModifiedDate
        FROM customer""",
    "person_survey": f"""
        SELECT c_custkey AS BusinessEntityID,
               CAST(c_acctbal AS DECIMAL(19,4)) AS TotalPurchaseYTD,
               {_DAY.format('c_custkey % 1500')} AS DateFirstPurchase,
               {_DAY.format('-(c_custkey % 9000)')} AS BirthDate,
               CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'S' END AS MaritalStatus,
               ((c_nationkey % 4) * 25000) || '-' || ((c_nationkey % 4 + 1) * 25000) AS YearlyIncome,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender,
               c_nationkey % 6 AS TotalChildren, c_nationkey % 3 AS NumberChildrenAtHome,
               substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) AS Education,
               CASE WHEN c_nationkey % 5 <> 0 THEN 'R&D ' || c_nationkey END AS Occupation,
               c_custkey % 2 = 1 AS HomeOwnerFlag, CAST(c_custkey % 5 AS INTEGER) AS NumberCarsOwned
        FROM customer WHERE c_acctbal >= 0""",
    "sales_customer": f"""
        SELECT c_custkey AS CustomerID, c_custkey AS PersonID,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 1000000000000 + c_custkey % 10 END AS StoreID,
               c_nationkey AS TerritoryID, {_DAY.format('c_custkey * 7 % 2000 + 1')} AS ModifiedDate
        FROM customer""",
    "email_address": f"""
        SELECT o_custkey AS BusinessEntityID,
               'c' || o_custkey || '.' || {_PRIORITY} || '@mail.example' AS EmailAddress, o_orderdate AS ModifiedDate
        FROM orders""",
    "store_place": """
        SELECT l_suppkey, l_returnflag, max(l_shipdate) AS ModifiedDate, count(*) % 3 AS gate,
               -(l_suppkey * 3 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END + 1) AS AddressID
        FROM lineitem GROUP BY l_suppkey, l_returnflag""",
    "address": """
        SELECT o_orderkey AS AddressID, o_orderkey || ' ' || substr(o_orderpriority, 3) || ' Street' AS AddressLine1,
               CASE WHEN o_orderstatus = 'P' THEN 'Suite ' || (o_orderkey % 90) END AS AddressLine2,
               'City ' || (o_orderkey % 100) AS City, CAST(o_orderkey % 25 AS INTEGER) AS StateProvinceID,
               o_orderdate AS ModifiedDate
        FROM orders
        UNION ALL
        SELECT AddressID, 'Dock ' || l_returnflag || ' gate ' || gate, NULL, 'Port ' || (l_suppkey % 20),
               CAST(l_suppkey % 25 AS INTEGER), ModifiedDate
        FROM store_place""",
    "business_entity_address": f"""
        SELECT o_custkey AS BusinessEntityID, o_orderkey AS AddressID, {_STATUS} AS AddressTypeID, o_orderdate AS ModifiedDate
        FROM orders
        UNION ALL
        SELECT 1000000000000 + l_suppkey, AddressID,
               CASE WHEN l_returnflag = 'R' AND l_suppkey % 3 = 0 THEN 1 WHEN l_returnflag = 'N' AND l_suppkey % 2 = 0 THEN 2
                    WHEN l_returnflag = 'A' THEN 4 ELSE 3 END, ModifiedDate
        FROM store_place""",
    "address_type": """
        SELECT AddressTypeID, Name, TIMESTAMP '1995-01-01' AS ModifiedDate
        FROM (VALUES (1, 'Main Office'), (2, 'Shipping'), (3, 'Billing'), (4, 'Archive')) v(AddressTypeID, Name)""",
    "state_province": f"""
        SELECT n_nationkey AS StateProvinceID, n_name AS Name, 'R' || n_regionkey AS CountryRegionCode,
               {_DAY.format('n_nationkey')} AS ModifiedDate FROM nation""",
    "country_region": f"""
        SELECT 'R' || r_regionkey AS CountryRegionCode, r_name AS Name, {_DAY.format('r_regionkey')} AS ModifiedDate FROM region""",
    "entity_address": """
        SELECT b.BusinessEntityID, a.AddressID, a.AddressLine1, a.AddressLine2, a.City, s.Name AS StateProvinceName,
               c.Name AS CountryRegionName, t.Name AS AddressType, a.ModifiedDate AS AddressDate, b.ModifiedDate AS LinkDate,
               s.ModifiedDate AS StateDate, c.ModifiedDate AS CountryDate, t.ModifiedDate AS TypeDate
        FROM business_entity_address b
        JOIN address a ON a.AddressID = b.AddressID
        JOIN state_province s ON s.StateProvinceID = a.StateProvinceID
        JOIN country_region c ON c.CountryRegionCode = s.CountryRegionCode
        JOIN address_type t ON t.AddressTypeID = b.AddressTypeID""",
    "product": f"""
        SELECT p_partkey AS ProductID, p_name AS Name, split_part(p_name, ' ', 1) AS Color, CAST(p_size AS VARCHAR) AS Size,
               CAST(p_size * 1.25 AS DECIMAL(8,2)) AS Weight, nullif(substr(p_type, 1, 1), 'S') AS Style,
               CAST(CAST(p_retailprice AS DECIMAL(19,4)) - 10 AS DECIMAL(19,4)) AS StandardCost,
               CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice,
               CASE WHEN p_size <= 40 THEN {_BRAND} END AS ProductModelID,
               CASE WHEN p_size > 3 THEN ({_TYPE}) * 100 + {_BRAND} END AS ProductSubcategoryID,
               {_DAY.format('p_partkey * 7 % 2000')} AS ModifiedDate
        FROM part""",
    "product_model": f"""
        SELECT DISTINCT {_BRAND} AS ProductModelID, p_brand AS Name, {_BRAND} || ' years' AS WarrantyPeriod,
               CASE WHEN {_BRAND} % 3 <> 0 THEN CAST({_BRAND} % 10 AS VARCHAR) END AS NoOfYears,
               {_BRAND} % 5 <> 0 AS described, {_DAY.format(_BRAND)} AS ModifiedDate
        FROM part""",
    "product_subcategory": f"""
        SELECT DISTINCT ({_TYPE}) * 100 + {_BRAND} AS ProductSubcategoryID, {_TYPE} AS ProductCategoryID,
               p_type || ' ' || p_brand AS Name, {_DAY.format(_BRAND + ' * 2')} AS ModifiedDate
        FROM part""",
    "product_category": f"""
        SELECT DISTINCT {_TYPE} AS ProductCategoryID, p_type AS Name, {_DAY.format('(' + _TYPE + ') * 3')} AS ModifiedDate FROM part""",
    "special_offer": """
        SELECT CAST(round(l_discount * 100) AS INTEGER) AS SpecialOfferID,
               'Discount ' || CAST(round(l_discount * 100) AS INTEGER) || ' pct on ' || count(*) || ' lines' AS Description,
               CASE WHEN round(l_discount * 100) = 0 THEN 'No Discount' ELSE 'Volume Discount' END AS "Type",
               CASE WHEN round(l_discount * 100) < 5 THEN 'Customer' ELSE 'Reseller' END AS Category,
               CAST(round(l_discount * 100) / 100 AS DECIMAL(10,4)) AS DiscountPct,
               CAST(min(l_quantity) AS INTEGER) AS MinQty,
               CASE WHEN round(l_discount * 100) <> 0 THEN CAST(max(l_quantity) AS INTEGER) END AS MaxQty,
               max(l_shipdate) AS ModifiedDate
        FROM lineitem GROUP BY round(l_discount * 100)""",
    "sales_reason": f"""
        SELECT DISTINCT {_PRIORITY} AS SalesReasonID, substr(o_orderpriority, 3) AS Name,
               CASE WHEN {_PRIORITY} <= 2 THEN 'Marketing' WHEN {_PRIORITY} = 3 THEN 'Promotion' ELSE 'Other' END AS ReasonType,
               {_DAY.format('CASE ' + _PRIORITY + ' WHEN 3 THEN 1999 ELSE ' + _PRIORITY + ' END')} AS ModifiedDate
        FROM orders""",
    "order_reason": f"""
        SELECT o_orderkey AS SalesOrderID, {_PRIORITY} AS SalesReasonID, o_orderdate AS ModifiedDate
        FROM orders WHERE o_orderstatus IN ('O', 'F')
        UNION ALL
        SELECT o_orderkey, {_PRIORITY} % 5 + 1, o_orderdate FROM orders WHERE o_orderstatus = 'F'""",
    "ship_method": f"""
        SELECT DISTINCT ({_STATUS}) * 10 + {_PRIORITY} AS ShipMethodID, o_orderstatus || '-' || substr(o_orderpriority, 3) AS Name,
               CAST({_PRIORITY} * 1.5 AS DECIMAL(19,4)) AS ShipBase, CAST({_PRIORITY} * 0.25 AS DECIMAL(19,4)) AS ShipRate,
               {_DAY.format('(' + _STATUS + ') * 10 + ' + _PRIORITY)} AS ModifiedDate
        FROM orders""",
    "store": f"""
        SELECT 1000000000000 + s_suppkey AS BusinessEntityID, s_name AS Name, {_DAY.format('s_suppkey * 37 % 2000')} AS ModifiedDate
        FROM supplier""",
    "store_survey": """
        SELECT 1000000000000 + s_suppkey AS BusinessEntityID, CAST(s_acctbal AS DECIMAL(18,2)) AS AnnualSales,
               CAST(CAST((CAST(round(s_acctbal * 100) AS BIGINT) + 5) // 10 AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)) AS AnnualRevenue,
               'Bank ' || s_nationkey AS BankName, CASE WHEN s_suppkey % 2 = 0 THEN 'BM' ELSE 'OS' END AS BusinessType,
               CAST(1970 + s_suppkey % 40 AS INTEGER) AS YearOpened,
               CASE s_suppkey % 3 WHEN 0 THEN 'Road' WHEN 1 THEN 'Mountain' END AS Specialty,
               CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_suppkey * 10 + 500 AS INTEGER) END AS SquareFeet,
               CASE WHEN s_suppkey % 4 > 1 THEN CAST(s_suppkey % 4 AS INTEGER) END AS Brands,
               CASE WHEN s_nationkey % 2 = 0 THEN 'T1' ELSE 'DSL' END AS Internet,
               CAST(s_suppkey % 100 AS INTEGER) AS NumberEmployees
        FROM supplier WHERE s_acctbal >= 0""",
    "sales_territory": """
        SELECT n_nationkey AS TerritoryID, n_name AS Name, CASE WHEN n_regionkey = 4 THEN 'XX' ELSE 'R' || n_regionkey END AS CountryRegionCode,
               'Group ' || n_regionkey AS grp, SalesYTD, CostYTD, ModifiedDate
        FROM nation JOIN (
            SELECT o_custkey % 25 AS t, year(o_orderdate) AS y, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS SalesYTD,
                   max(CAST(o_totalprice AS DECIMAL(12,2))) AS CostYTD, max(o_orderdate) AS ModifiedDate
            FROM orders GROUP BY ALL) s ON s.t = n_nationkey""",
    "order_detail": f"""
        SELECT l_orderkey AS SalesOrderID,
               CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
                    CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
                    l_returnflag, l_linestatus, strftime(l_shipdate, '%Y%m%d'))), 1, 15) AS BIGINT) AS SalesOrderDetailID,
               l_partkey AS ProductID, CAST(round(l_discount * 100) AS INTEGER) AS SpecialOfferID,
               CAST(l_quantity AS INTEGER) AS OrderQty, l_extendedprice AS UnitPrice, l_discount AS UnitPriceDiscount,
               {_LINE_TOTAL} AS LineTotal, l_shipdate AS ModifiedDate
        FROM lineitem""",
    "order_header": f"""
        SELECT o_orderkey AS SalesOrderID, o_custkey AS CustomerID, CAST(o_custkey % 25 AS INTEGER) AS TerritoryID,
               ({_STATUS}) * 10 + {_PRIORITY} AS ShipMethodID, o_orderkey AS ShipToAddressID, o_orderdate AS OrderDate,
               o_orderdate + INTERVAL 12 DAY AS DueDate,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 1 DAY * (o_orderkey % 7 + 1) END AS ShipDate,
               {_STATUS} AS Status, {_PRIORITY} <= 3 AS OnlineOrderFlag, SubTotal,
               CAST(o_totalprice AS DECIMAL(12,2)) * 0.08 AS TaxAmt, CAST(o_totalprice AS DECIMAL(12,2)) * 0.02 AS Freight,
               coalesce(SubTotal, 0) + CAST(o_totalprice AS DECIMAL(12,2)) * 0.10 AS TotalDue, o_orderdate AS ModifiedDate
        FROM orders LEFT JOIN (
            SELECT l_orderkey, sum({_LINE_TOTAL}) AS SubTotal FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o_orderkey""",
}

CUTOFF = "1999-06-30"
_CHANGED = _DAY.format("p_partkey * 7 % 2000")

# The state at the cutoff: every table again under the prefix old_, on the rows that were there.
_OLD_INPUT = {
    "old_orders": f"SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{CUTOFF}'",
    "old_lineitem": f"SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '{CUTOFF}'",
    "old_part": f"SELECT * FROM part WHERE NOT ({_CHANGED} > TIMESTAMP '{CUTOFF}' AND p_type = 'SMALL')",
}


def _tokens(text: str, names) -> str:
    pattern = r"(?<![\w'])(" + "|".join(sorted(names, key=len, reverse=True)) + r")(?![\w'])"
    return re.sub(pattern, lambda m: "old_" + m.group(1), text)


def old_version(text: str) -> str:
    """The same SQL on the tables of the cutoff state."""
    return _tokens(text, [*CTES, *DIM_NAMES, "orders", "lineitem", "part"])


DIM_NAMES = ["dim_customer", "dim_product", "dim_promotion", "dim_sales_reason", "dim_ship_method", "dim_store", "dim_territory"]


def _old_ctes() -> dict[str, str]:
    out = dict(_OLD_INPUT)
    for name, text in CTES.items():
        out[f"old_{name}"] = old_version(text)
    late = f"{_CHANGED} > TIMESTAMP '{CUTOFF}'"
    product = out["old_product"]
    product = product.replace("CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice",
                              f"CAST(p_retailprice AS DECIMAL(19,4)) - CASE WHEN {late} THEN 5 ELSE 0 END AS ListPrice")
    out["old_product"] = product.replace(f"{_CHANGED} AS ModifiedDate",
                                         f"CASE WHEN {late} THEN TIMESTAMP '1995-01-01' ELSE {_CHANGED} END AS ModifiedDate")
    out["old_product_model"] = CTES["product_model"]
    out["old_product_subcategory"] = CTES["product_subcategory"]
    out["old_product_category"] = CTES["product_category"]
    reason = out["old_sales_reason"].replace("'Promotion'", "'Campaign'")
    out["old_sales_reason"] = reason.replace("WHEN 3 THEN 1999", "WHEN 3 THEN 3")
    return out


_PHYSICAL = {"customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events"}


def with_sources(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the source CTEs that it uses, directly or through another one."""
    ctes = {**CTES, **_old_ctes(), **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", text):
            if name in ctes and name not in needed and name not in _PHYSICAL:
                visit(ctes[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in needed) + "\n" + query
