"""Builders of the seven business dimensions.

Each builder takes the source tables by name and an optional watermark. With a
watermark it first collects the business keys that any of its sources touched
since then and builds the rows of those keys only; the rows themselves are the
same as in a full build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import later_of, open_end, row_max, try_convert
from starloom.functions.xml import with_person_survey, with_store_survey, with_warranty
from starloom.operators.dedup import first_per_key, latest_per_key, preferred_row
from starloom.operators.lookup import touched_only
from starloom.operators.scd import DimensionSpec
from starloom.operators.watermark import changed_since, union_keys
from starloom.runtime import cut_lineage

Sources = dict[str, DataFrame]

CUSTOMER = DimensionSpec("DimCustomer", "CustomerKey", ("CustomerID",), (
    "PersonType", "FirstName", "LastName", "EmailAddress", "EmailPromotion", "AddressLine1", "City",
    "StateProvinceName", "CountryRegionName", "BirthDate", "MaritalStatus", "Gender", "Education", "Occupation",
    "HomeOwnerFlag", "NumberCarsOwned", "NumberChildrenAtHome", "TotalChildren", "TotalPurchaseYTD",
    "YearlyIncome", "DateFirstPurchase",
))
PRODUCT = DimensionSpec("DimProduct", "ProductKey", ("ProductID",), (
    "Name", "Color", "Size", "Weight", "Style", "ModelName", "CategoryName", "SubCategoryName", "StandardCost",
    "ListPrice", "WarrantyPeriod", "NoOfYears",
))
PROMOTION = DimensionSpec("DimPromotion", "PromotionKey", ("SpecialOfferID",), (
    "Description", "Type", "Category", "DiscountPct", "MinQty", "MaxQty",
))
SALES_REASON = DimensionSpec("DimSalesReason", "SalesReasonKey", ("SalesOrderID", "SalesReasonID"), ("Name", "ReasonType"))
SHIP_METHOD = DimensionSpec("DimShipMethod", "ShipMethodKey", ("ShipMethodID",), ("Name", "ShipBase", "ShipRate", "ShipDate"))
STORE = DimensionSpec("DimStore", "StoreKey", ("StoreID",), (
    "Name", "AnnualSales", "AnnualRevenue", "BusinessType", "BankName", "YearOpened", "Specialty", "SquareFeet",
    "Brands", "Internet", "NumberEmployees", "AddressType", "AddressLine1", "AddressLine2", "City",
    "StateProvinceName", "CountryRegionName",
))
TERRITORY = DimensionSpec("DimTerritory", "TerritoryKey", ("TerritoryID",), (
    "Name", "CountryRegionName", "Group", "SalesYTD", "SalesLastYear", "CostYTD", "CostLastYear",
))
ADDRESS_PREFERENCE = ["Main Office", "Shipping", "Billing"]


def _finish(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    return df.withColumn(spec.end, open_end()).select(*spec.row_columns)


def _since(df: DataFrame, since) -> DataFrame:
    return changed_since(df, ["ModifiedDate"], since)


def _touched(parts: list[DataFrame], key: str) -> DataFrame:
    """Distinct touched keys, written once: every source is cut down to them, and their real size decides how."""
    return cut_lineage(union_keys(parts, key))


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    """Columns ``new=old`` only."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def place_names(src: Sources) -> DataFrame:
    """States with their country: the two small levels joined once."""
    state = _renamed(src["state_province"], StateProvinceID="StateProvinceID", StateProvinceName="Name",
                     CountryRegionCode="CountryRegionCode", StateDate="ModifiedDate")
    country = _renamed(src["country_region"], CountryRegionCode="CountryRegionCode", CountryRegionName="Name",
                       CountryDate="ModifiedDate")
    return state.join(country, "CountryRegionCode").drop("CountryRegionCode")


def entity_addresses(src: Sources, of: DataFrame | None = None) -> DataFrame:
    """Every address of every entity, or of some, with type, state and country."""
    link = _renamed(src["business_entity_address"], BusinessEntityID="BusinessEntityID", AddressID="AddressID",
                    AddressTypeID="AddressTypeID", LinkDate="ModifiedDate")
    if of is not None:
        link = touched_only(link, of, ["BusinessEntityID"])
    address = _renamed(src["address"], AddressID="AddressID", AddressLine1="AddressLine1", AddressLine2="AddressLine2",
                       City="City", StateProvinceID="StateProvinceID", AddressDate="ModifiedDate")
    kind = _renamed(src["address_type"], AddressTypeID="AddressTypeID", AddressType="Name", TypeDate="ModifiedDate")
    return link.join(kind, "AddressTypeID").join(address, "AddressID").join(place_names(src), "StateProvinceID")


def _touched_entities(src: Sources, since, with_types: bool) -> list[DataFrame]:
    """Entities with a changed address, link, state, country or address type.

    Small levels are reduced to their changed rows before the join, so an unchanged hierarchy costs nothing.
    """
    link = src["business_entity_address"].select("BusinessEntityID", "AddressID", "AddressTypeID", "ModifiedDate")
    address = src["address"].select("AddressID", "StateProvinceID", "ModifiedDate")
    country = _since(src["country_region"], since).select("CountryRegionCode")
    state = src["state_province"].select("StateProvinceID", "CountryRegionCode", "ModifiedDate")
    states = _since(state, since).unionByName(state.join(country, "CountryRegionCode", "left_semi").select(state.columns))
    moved = _since(address, since).unionByName(
        address.join(states.select("StateProvinceID").distinct(), "StateProvinceID", "left_semi").select(address.columns)
    )
    parts = [_since(link, since), link.join(moved.select("AddressID").distinct(), "AddressID", "left_semi")]
    if with_types:
        kinds = _since(src["address_type"], since).select("AddressTypeID")
        parts.append(link.join(kinds, "AddressTypeID", "left_semi"))
    return parts


def dim_customer(src: Sources, since=None) -> DataFrame:
    """Individual customers with newest e-mail, newest address and survey answers."""
    persons, customers, emails = src["person"], src["customer"], src["email_address"]
    addresses = entity_addresses(src)
    if since is not None:
        touched = _touched([
            _since(persons, since), _since(emails, since),
            _renamed(_since(customers, since), BusinessEntityID="PersonID"),
            *_touched_entities(src, since, with_types=True),
        ], "BusinessEntityID")
        key = ["BusinessEntityID"]
        persons, emails, addresses = [touched_only(d, touched, key) for d in (persons, emails, addresses)]
    individuals = customers.filter(F.col("StoreID").isNull()).select(
        "CustomerID", F.col("PersonID").alias("BusinessEntityID"), F.col("ModifiedDate").alias("CustomerDate")
    )
    email = latest_per_key(
        emails.select("BusinessEntityID", "EmailAddress", F.col("ModifiedDate").alias("EmailDate")),
        ["BusinessEntityID"], "EmailDate", [F.col("EmailAddress").asc_nulls_first()],
    )
    # a link that is newer than everything it leads to starts a version of its own: the customer moved
    located = latest_per_key(addresses, ["BusinessEntityID"], "AddressDate", [F.col("AddressID"), F.col("LinkDate").desc_nulls_last()])
    address = located.select(
        "BusinessEntityID", "AddressLine1", "City", "StateProvinceName", "CountryRegionName",
        "AddressDate", "StateDate", "CountryDate", "LinkDate",
    )
    base = (
        persons.withColumnRenamed("ModifiedDate", "PersonDate")
        .join(individuals, "BusinessEntityID")
        .join(email, "BusinessEntityID", "left")
        .join(address, "BusinessEntityID", "left")
    )
    answered = with_person_survey(base, "Demographics")
    start = row_max("CustomerDate", "PersonDate", "EmailDate", "AddressDate", "StateDate", "CountryDate", "LinkDate")
    return _finish(answered.withColumn("StartDate", start), CUSTOMER)


def dim_product(src: Sources, since=None, model_needs_text: bool = True) -> DataFrame:
    """Products with model, category pair and warranty; models without catalogue text give no model name by default."""
    products = src["product"]
    models, subs, cats = src["product_model"], src["product_subcategory"], src["product_category"]
    if since is not None:
        subs_hit = _since(subs, since).select("ProductSubcategoryID").unionByName(
            subs.join(_since(cats, since).select("ProductCategoryID"), "ProductCategoryID", "left_semi").select("ProductSubcategoryID")
        ).distinct()
        touched = _touched([
            _since(products, since),
            products.join(_since(models, since).select("ProductModelID"), "ProductModelID", "left_semi"),
            products.join(subs_hit, "ProductSubcategoryID", "left_semi"),
        ], "ProductID")
        products = touched_only(products, touched, ["ProductID"])
    if model_needs_text:
        models = models.filter(F.col("CatalogDescription").isNotNull())
    model = with_warranty(models, "CatalogDescription").select(
        "ProductModelID", F.col("Name").alias("ModelName"), "WarrantyPeriod", F.col("MaintenanceYears").alias("NoOfYears"),
        F.col("ModifiedDate").alias("ModelDate"),
    )
    pair = _renamed(subs, ProductSubcategoryID="ProductSubcategoryID", SubCategoryName="Name",
                    ProductCategoryID="ProductCategoryID", SubDate="ModifiedDate").join(
        _renamed(cats, ProductCategoryID="ProductCategoryID", CategoryName="Name", CategoryDate="ModifiedDate"), "ProductCategoryID"
    ).drop("ProductCategoryID")
    rows = products.join(model, "ProductModelID", "left").join(pair, "ProductSubcategoryID", "left")
    start = row_max("ModifiedDate", "ModelDate", "SubDate", "CategoryDate")
    return _finish(rows.withColumn("StartDate", start), PRODUCT)


def dim_promotion(src: Sources, since=None) -> DataFrame:
    """Special offers; the offer's own validity dates are not taken over."""
    offers = src["special_offer"]
    if since is not None:
        offers = _since(offers, since)
    return _finish(offers.drop("StartDate", "EndDate").withColumn("StartDate", F.col("ModifiedDate")), PROMOTION)


def dim_sales_reason(src: Sources, since=None) -> DataFrame:
    """Reasons per order, distinct."""
    reason = _renamed(src["sales_reason"], SalesReasonID="SalesReasonID", Name="Name", ReasonType="ReasonType", ReasonDate="ModifiedDate")
    link = _renamed(src["order_reason"], SalesOrderID="SalesOrderID", SalesReasonID="SalesReasonID", LinkDate="ModifiedDate")
    rows = link.join(reason, "SalesReasonID")
    if since is not None:
        rows = changed_since(rows, ["ReasonDate", "LinkDate"], since)
    return _finish(rows.withColumn("StartDate", later_of(F.col("ReasonDate"), F.col("LinkDate"))), SALES_REASON).distinct()


def dim_ship_method(src: Sources, since=None, usage: DataFrame | None = None) -> DataFrame:
    """Ship methods with the latest known ship date.

    ``usage`` (ShipMethodID, ShipDate, OrderDate) are the newest dates of all orders where they are kept; otherwise the orders are read for them.

    A full build starts a method at its own date; a delta starts it at the
    newest order too, because a new ship date is what makes a new version.
    """
    method, orders = src["ship_method"], src["order_header"].select("ShipMethodID", "ShipDate", "ModifiedDate")
    start = F.col("ModifiedDate")
    if since is not None:
        touched = _touched([_since(method, since), _since(orders, since)], "ShipMethodID")
        method = touched_only(method, touched, ["ShipMethodID"])
        orders = touched_only(orders, touched, ["ShipMethodID"])
        start = row_max("ModifiedDate", "OrderDate")
    if usage is None:
        usage = orders.groupBy("ShipMethodID").agg(F.max("ShipDate").alias("ShipDate"), F.max("ModifiedDate").alias("OrderDate"))
    return _finish(method.join(usage, "ShipMethodID", "left").withColumn("StartDate", start), SHIP_METHOD)


def dim_store(src: Sources, since=None) -> DataFrame:
    """Stores with their preferred address and survey answers."""
    stores = src["store"]
    key = ["BusinessEntityID"]
    if since is not None:
        touched = _touched([_since(stores, since), *_touched_entities(src, since, with_types=True)], "BusinessEntityID")
        stores = touched_only(stores, touched, key)
    rows = with_store_survey(stores.withColumnRenamed("ModifiedDate", "StoreDate"), "Demographics")
    located = rows.select("BusinessEntityID").join(entity_addresses(src, stores), "BusinessEntityID")
    chosen = preferred_row(located, key, "AddressType", ADDRESS_PREFERENCE, [
        F.col("AddressLine1").asc_nulls_first(), F.col("AddressID"), F.col("LinkDate").desc_nulls_last(),
    ])
    start = row_max("StoreDate", "AddressDate", "TypeDate", "CountryDate", "StateDate", "LinkDate")
    out = rows.join(chosen, "BusinessEntityID").withColumn("StartDate", start)
    return _finish(out.withColumn("StoreID", F.col("BusinessEntityID")), STORE)


def dim_territory(src: Sources, since=None) -> DataFrame:
    """Newest row of each territory with its country, amounts as decimals where they convert."""
    territory, country = src["sales_territory"], src["country_region"]
    names = _renamed(country, CountryRegionCode="CountryRegionCode", CountryRegionName="Name", CountryDate="ModifiedDate")
    if since is not None:
        hit = _since(country, since).select("CountryRegionCode")
        touched = _touched([_since(territory, since), territory.join(hit, "CountryRegionCode", "left_semi")], "TerritoryID")
        territory = touched_only(territory, touched, ["TerritoryID"])
    amounts = ["SalesYTD", "SalesLastYear", "CostYTD", "CostLastYear"]
    newest = first_per_key(territory, ["TerritoryID"], [
        F.col("ModifiedDate").desc_nulls_last(), F.col("SalesYTD").desc_nulls_last(),
        F.col("Name").asc_nulls_first(), F.col("CountryRegionCode").asc_nulls_first(),
    ])
    typed = newest.withColumns({a: try_convert(F.col(a), "decimal(19,4)") for a in amounts})
    rows = typed.join(names, "CountryRegionCode", "left")
    return _finish(rows.withColumn("StartDate", row_max("ModifiedDate", "CountryDate")), TERRITORY)
