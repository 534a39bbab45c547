"""The driver's tables seen as the normalised sales schema that the builders read.

Every source is derived from whole tables: persons and customers from
``customer``, e-mails and addresses from ``orders`` (many per person), stores
from ``supplier``, products from ``part``, order headers and lines from
``orders`` and ``lineitem``, small code tables from distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.scalar import ntz

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
STORE_ID_BASE = 1_000_000_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_after(days: Column) -> Column:
    """1995-01-01 plus a number of days."""
    return F.date_add(F.lit("1995-01-01").cast("date"), days.cast("int")).cast("timestamp_ntz")


def money(c) -> Column:
    return F.col(c).cast("decimal(19,4)")


def priority() -> Column:
    return F.left("o_orderpriority", F.lit(1)).cast("int")


def status_number() -> Column:
    return F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)


def brand_number() -> Column:
    return F.substring("p_brand", 7, 10).cast("int")


def type_number() -> Column:
    # The product types in alphabetical order.
    names = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    chain = F.when(F.col("p_type") == names[0], 1)
    for i, n in enumerate(names[1:], start=2):
        chain = chain.when(F.col("p_type") == n, i)
    return chain


def element(name: str, text: Column, attributes: str = "") -> Column:
    """An XML leaf; a null text leaves the element out."""
    leaf = F.concat(F.lit(f"<{name}{attributes}>"), text, F.lit(f"</{name}>"))
    return F.coalesce(leaf, F.lit(""))


def document(root: str, leaves: list[Column], namespace: str) -> Column:
    return F.concat(F.lit(f'<{root} xmlns="{namespace}">'), *leaves, F.lit(f"</{root}>"))


def person_survey_fields() -> dict[str, Column]:
    """Texts of the person survey."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")

    def iso(days: Column) -> Column:
        return F.concat(F.date_format(day_after(days), "yyyy-MM-dd"), F.lit("Z"))

    return {
        "TotalPurchaseYTD": money("c_acctbal").cast("string"),
        "DateFirstPurchase": iso(key % 1500),
        "BirthDate": iso(-(key % 9000)),
        "MaritalStatus": F.when(nation % 2 == 0, "M").otherwise("S"),
        "YearlyIncome": F.concat(((nation % 4) * 25000).cast("string"), F.lit("-"), ((nation % 4 + 1) * 25000).cast("string")),
        "Gender": F.when(key % 2 == 0, "F").otherwise("M"),
        "TotalChildren": (nation % 6).cast("string"),
        "NumberChildrenAtHome": (nation % 3).cast("string"),
        "Education": F.initcap("c_mktsegment"),
        "Occupation": F.when(nation % 5 != 0, F.concat(F.lit("R&amp;D "), nation.cast("string"))),
        "HomeOwnerFlag": (key % 2).cast("string"),
        "NumberCarsOwned": (key % 5).cast("string"),
    }


def person_survey() -> Column:
    leaves = [
        element(n, c, ' currency="USD"' if n == "TotalPurchaseYTD" else "") for n, c in person_survey_fields().items()
    ]
    return F.when(F.col("c_acctbal") >= 0, document("IndividualSurvey", leaves, "urn:example:person-survey"))


def store_survey() -> Column:
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    texts = {
        "AnnualSales": F.col("s_acctbal").cast("decimal(18,2)").cast("string"),
        "AnnualRevenue": (F.col("s_acctbal").cast("decimal(18,2)") / 10).cast("decimal(18,3)").cast("string"),
        "BankName": F.concat(F.lit("Bank "), nation.cast("string")),
        "BusinessType": F.when(key % 2 == 0, "BM").otherwise("OS"),
        "YearOpened": (F.lit(1970) + key % 40).cast("string"),
        "Specialty": F.when(key % 3 == 0, "Road").when(key % 3 == 1, "Mountain"),
        "SquareFeet": F.when(key % 7 == 0, "n/a").otherwise((key * 10 + 500).cast("string")),
        "Brands": F.when(key % 4 == 0, "4+").when(key % 4 == 1, "AW").otherwise((key % 4).cast("string")),
        "Internet": F.when(nation % 2 == 0, "T1").otherwise("DSL"),
        "NumberEmployees": (key % 100).cast("string"),
    }
    leaves = [element(n, c) for n, c in texts.items()]
    return F.when(F.col("s_acctbal") >= 0, document("StoreSurvey", leaves, "urn:example:store-survey"))


def catalogue() -> Column:
    """Description with two namespace prefixes, two warranties for some brands and no maintenance for others."""
    n = F.col("ProductModelID")
    warranty = F.concat(F.lit("<wm:Warranty>"), element("wm:WarrantyPeriod", F.concat(n.cast("string"), F.lit(" years"))), F.lit("</wm:Warranty>"))
    second = F.when(n % 2 == 0, "<wm:Warranty><wm:WarrantyPeriod>never</wm:WarrantyPeriod></wm:Warranty>").otherwise("")
    upkeep = F.when(
        n % 3 != 0, F.concat(F.lit("<wm:Maintenance><wm:NoOfYears>"), (n % 10).cast("string"), F.lit("</wm:NoOfYears></wm:Maintenance>"))
    ).otherwise("")
    doc = F.concat(
        F.lit('<p1:ProductDescription xmlns:p1="urn:example:model" xmlns:wm="urn:example:warranty"><p1:Summary>Model '),
        n.cast("string"), F.lit("</p1:Summary><p1:Features>With "), warranty, second, upkeep,
        F.lit("</p1:Features></p1:ProductDescription>"),
    )
    return F.when(n % 5 != 0, doc)


def detail_id() -> Column:
    """Fingerprint of all columns of a line; order and line number alone do not identify it."""
    cents = [F.rint(F.col(c) * 100).cast("long") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    text = F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *cents, "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyyMMdd"),
    )
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def line_total() -> Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")
    return (price * F.col("l_quantity").cast("decimal(4,0)")).cast("decimal(38,6)")


class OltpSources(dict):
    """Source tables built on first use, so that a query only carries the ones it reads.

    ``until`` gives the state of the source on that day: orders and lines after
    it are not there yet, products changed after it are new (type SMALL) or
    still have their old price, and the third sales reason has its old type.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, until: str | None = None):
        super().__init__()
        self._spark, self._dir, self._until = spark, sf_dir, until

    def __missing__(self, name: str) -> DataFrame:
        if name.startswith("_") or not hasattr(self, f"_{name}"):
            raise KeyError(name)
        self[name] = getattr(self, f"_{name}")()
        return self[name]

    def __contains__(self, name) -> bool:
        return hasattr(self, f"_{name}")

    def _t(self, name: str) -> DataFrame:
        table = read(self._spark, self._dir, name)
        date = {"orders": "o_orderdate", "lineitem": "l_shipdate"}.get(name)
        if self._until is None or date is None:
            return table
        return table.filter(F.col(date) <= ntz(self._until))

    def _person(self):
        return self._t("customer").select(
            F.col("c_custkey").alias("BusinessEntityID"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "SC").otherwise("IN").alias("PersonType"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("FirstName"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("LastName"),
            (F.col("c_nationkey") % 3).alias("EmailPromotion"),
            person_survey().alias("Demographics"),
            day_after(F.col("c_custkey") * 7 % 2000).alias("ModifiedDate"),
        )

    def _customer(self):
        store = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(STORE_ID_BASE) + F.col("c_custkey") % 10)
        return self._t("customer").select(
            F.col("c_custkey").alias("CustomerID"), F.col("c_custkey").alias("PersonID"), store.alias("StoreID"),
            F.col("c_nationkey").alias("TerritoryID"), day_after(F.col("c_custkey") * 7 % 2000 + 1).alias("ModifiedDate"),
        )

    def _email_address(self):
        return self._t("orders").select(
            F.col("o_custkey").alias("BusinessEntityID"),
            F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("."), priority().cast("string"), F.lit("@mail.example")).alias("EmailAddress"),
            F.col("o_orderdate").alias("ModifiedDate"),
        )

    def _store_place(self):
        """One row per supplier and return flag, the places of a store."""
        flag = F.col("l_returnflag")
        number = F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2)
        return (
            self._t("lineitem").groupBy("l_suppkey", "l_returnflag")
            .agg(F.max("l_shipdate").alias("ModifiedDate"), (F.count("*") % 3).alias("gate"))
            .withColumn("AddressID", -(F.col("l_suppkey") * 3 + number + 1))
        )

    def _address(self):
        order = F.col("o_orderkey")
        of_orders = self._t("orders").select(
            order.alias("AddressID"),
            F.concat(order.cast("string"), F.lit(" "), F.substring("o_orderpriority", 3, 20), F.lit(" Street")).alias("AddressLine1"),
            F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Suite "), (order % 90).cast("string"))).alias("AddressLine2"),
            F.concat(F.lit("City "), (order % 100).cast("string")).alias("City"),
            (order % 25).cast("int").alias("StateProvinceID"), F.col("o_orderdate").alias("ModifiedDate"),
        )
        supp = F.col("l_suppkey")
        of_stores = self["store_place"].select(
            "AddressID", F.concat(F.lit("Dock "), F.col("l_returnflag"), F.lit(" gate "), F.col("gate").cast("string")).alias("AddressLine1"),
            F.lit(None).cast("string").alias("AddressLine2"), F.concat(F.lit("Port "), (supp % 20).cast("string")).alias("City"),
            (supp % 25).cast("int").alias("StateProvinceID"), "ModifiedDate",
        )
        return of_orders.unionByName(of_stores)

    def _business_entity_address(self):
        of_orders = self._t("orders").select(
            F.col("o_custkey").alias("BusinessEntityID"), F.col("o_orderkey").alias("AddressID"),
            status_number().alias("AddressTypeID"), F.col("o_orderdate").alias("ModifiedDate"),
        )
        flag, supp = F.col("l_returnflag"), F.col("l_suppkey")
        kind = F.when((flag == "R") & (supp % 3 == 0), 1).when((flag == "N") & (supp % 2 == 0), 2).when(flag == "A", 4).otherwise(3)
        of_stores = self["store_place"].select(
            (F.lit(STORE_ID_BASE) + supp).alias("BusinessEntityID"), "AddressID", kind.alias("AddressTypeID"), "ModifiedDate"
        )
        return of_orders.unionByName(of_stores)

    def _address_type(self):
        # inline rows, of which the planner knows that they are few
        rows = self._spark.sql("SELECT * FROM VALUES (1, 'Main Office'), (2, 'Shipping'), (3, 'Billing'), (4, 'Archive') AS t(AddressTypeID, Name)")
        return rows.withColumn("ModifiedDate", day_after(F.lit(0)))

    def _state_province(self):
        return self._t("nation").select(
            F.col("n_nationkey").alias("StateProvinceID"), F.col("n_name").alias("Name"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("CountryRegionCode"),
            day_after(F.col("n_nationkey")).alias("ModifiedDate"),
        )

    def _country_region(self):
        return self._t("region").select(
            F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("CountryRegionCode"), F.col("r_name").alias("Name"),
            day_after(F.col("r_regionkey")).alias("ModifiedDate"),
        )

    def _product(self):
        size, price, changed = F.col("p_size"), money("p_retailprice"), day_after(F.col("p_partkey") * 7 % 2000)
        parts = self._t("part")
        if self._until is not None:
            later = changed > ntz(self._until)
            parts = parts.filter(~(later & (F.col("p_type") == "SMALL")))
            price = F.when(later, price - 5).otherwise(price).cast("decimal(19,4)")
            changed = F.when(later, day_after(F.lit(0))).otherwise(changed)
        return parts.select(
            F.col("p_partkey").alias("ProductID"), F.col("p_name").alias("Name"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("Color"), size.cast("string").alias("Size"),
            (size.cast("decimal(8,2)") * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(8,2)").alias("Weight"),
            F.nullif(F.left("p_type", F.lit(1)), F.lit("S")).alias("Style"),
            (money("p_retailprice") - 10).cast("decimal(19,4)").alias("StandardCost"), price.alias("ListPrice"),
            F.when(size <= 40, brand_number()).alias("ProductModelID"),
            F.when(size > 3, type_number() * 100 + brand_number()).alias("ProductSubcategoryID"),
            changed.alias("ModifiedDate"),
        )

    def _product_model(self):
        models = self._t("part").select(brand_number().alias("ProductModelID"), F.col("p_brand").alias("Name")).distinct()
        return models.select("*", catalogue().alias("CatalogDescription"), day_after(F.col("ProductModelID")).alias("ModifiedDate"))

    def _product_subcategory(self):
        return self._t("part").select(
            (type_number() * 100 + brand_number()).alias("ProductSubcategoryID"), type_number().alias("ProductCategoryID"),
            F.concat("p_type", F.lit(" "), "p_brand").alias("Name"), day_after(brand_number() * 2).alias("ModifiedDate"),
        ).distinct()

    def _product_category(self):
        return self._t("part").select(
            type_number().alias("ProductCategoryID"), F.col("p_type").alias("Name"), day_after(type_number() * 3).alias("ModifiedDate")
        ).distinct()

    def _special_offer(self):
        offers = self._t("lineitem").groupBy(F.rint(F.col("l_discount") * 100).cast("int").alias("SpecialOfferID")).agg(
            F.min("l_quantity").cast("int").alias("MinQty"), F.max("l_quantity").cast("int").alias("_max"),
            F.min("l_shipdate").alias("StartDate"), F.max("l_shipdate").alias("EndDate"), F.count("*").alias("_n"),
        )
        n = F.col("SpecialOfferID")
        return offers.select(
            n, F.concat(F.lit("Discount "), n.cast("string"), F.lit(" pct on "), F.col("_n").cast("string"), F.lit(" lines")).alias("Description"),
            F.when(n == 0, "No Discount").otherwise("Volume Discount").alias("Type"),
            F.when(n < 5, "Customer").otherwise("Reseller").alias("Category"),
            (n.cast("decimal(10,4)") / 100).cast("decimal(10,4)").alias("DiscountPct"), "MinQty",
            F.when(n != 0, F.col("_max")).alias("MaxQty"), "StartDate", "EndDate", F.col("EndDate").alias("ModifiedDate"),
        )

    def _sales_reason(self):
        n = priority()
        third, changed = ("Promotion", 1999) if self._until is None else ("Campaign", 3)
        return self._t("orders").select(
            n.alias("SalesReasonID"), F.substring("o_orderpriority", 3, 20).alias("Name"),
            F.when(n <= 2, "Marketing").when(n == 3, third).otherwise("Other").alias("ReasonType"),
            day_after(F.when(n == 3, changed).otherwise(n)).alias("ModifiedDate"),
        ).distinct()

    def _order_reason(self):
        """Two reasons for status F, one for O, none for P."""
        own, status = priority(), F.col("o_orderstatus")
        reasons = F.when(status == "F", F.array(own, own % 5 + 1)).when(status == "O", F.array(own))
        return self._t("orders").select(
            F.col("o_orderkey").alias("SalesOrderID"), F.explode(reasons).alias("SalesReasonID"), F.col("o_orderdate").alias("ModifiedDate")
        )

    def _ship_method(self):
        n = status_number() * 10 + priority()
        return self._t("orders").select(
            n.alias("ShipMethodID"), F.concat("o_orderstatus", F.lit("-"), F.substring("o_orderpriority", 3, 20)).alias("Name"),
            (priority().cast("decimal(19,4)") * F.lit("1.5").cast("decimal(2,1)")).cast("decimal(19,4)").alias("ShipBase"),
            (priority().cast("decimal(19,4)") * F.lit("0.25").cast("decimal(3,2)")).cast("decimal(19,4)").alias("ShipRate"),
            day_after(n).alias("ModifiedDate"),
        ).distinct()

    def _store(self):
        return self._t("supplier").select(
            (F.lit(STORE_ID_BASE) + F.col("s_suppkey")).alias("BusinessEntityID"), F.col("s_name").alias("Name"),
            store_survey().alias("Demographics"), day_after(F.col("s_suppkey") * 37 % 2000).alias("ModifiedDate"),
        )

    def _sales_territory(self):
        """One row per territory and order year; every fifth territory has no country."""
        sales = self._t("orders").groupBy(
            (F.col("o_custkey") % 25).cast("int").alias("TerritoryID"), F.year("o_orderdate").alias("_year")
        ).agg(
            F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(19,4)").alias("SalesYTD"),
            F.max(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(19,4)").alias("CostYTD"),
            F.max("o_orderdate").alias("ModifiedDate"),
        )
        nation = self._t("nation").select(
            F.col("n_nationkey").alias("TerritoryID"), F.col("n_name").alias("Name"),
            F.when(F.col("n_regionkey") == 4, "XX").otherwise(F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))).alias("CountryRegionCode"),
            F.concat(F.lit("Group "), F.col("n_regionkey").cast("string")).alias("Group"),
        )
        zero = F.lit(0).cast("decimal(19,4)")
        return sales.join(nation, "TerritoryID").select(
            "TerritoryID", "Name", "CountryRegionCode", "Group", "SalesYTD", zero.alias("SalesLastYear"), "CostYTD",
            zero.alias("CostLastYear"), "ModifiedDate",
        )

    def _order_header(self):
        subtotal = self._t("lineitem").groupBy(F.col("l_orderkey").alias("SalesOrderID")).agg(
            F.sum(line_total()).cast("decimal(19,4)").alias("SubTotal")
        )
        order = F.col("o_orderkey")
        total = F.col("o_totalprice").cast("decimal(12,2)")
        heads = self._t("orders").select(
            order.alias("SalesOrderID"), F.col("o_custkey").alias("CustomerID"), (F.col("o_custkey") % 25).cast("int").alias("TerritoryID"),
            (status_number() * 10 + priority()).alias("ShipMethodID"), order.alias("ShipToAddressID"),
            F.col("o_orderdate").alias("OrderDate"), (F.col("o_orderdate") + F.expr("interval 12 days")).alias("DueDate"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.make_dt_interval((order % 7 + 1).cast("int"))).alias("ShipDate"),
            status_number().alias("Status"), (priority() <= 3).alias("OnlineOrderFlag"),
            (total * F.lit("0.08").cast("decimal(2,2)")).cast("decimal(19,4)").alias("TaxAmt"),
            (total * F.lit("0.02").cast("decimal(2,2)")).cast("decimal(19,4)").alias("Freight"),
            F.col("o_orderdate").alias("ModifiedDate"),
        )
        due = (F.coalesce("SubTotal", F.lit(0)) + F.col("TaxAmt") + F.col("Freight")).cast("decimal(19,4)")
        return heads.join(subtotal, "SalesOrderID", "left").withColumn("TotalDue", due)

    def _order_detail(self):
        return self._t("lineitem").select(
            F.col("l_orderkey").alias("SalesOrderID"), detail_id().alias("SalesOrderDetailID"), F.col("l_partkey").alias("ProductID"),
            F.rint(F.col("l_discount") * 100).cast("int").alias("SpecialOfferID"), F.col("l_quantity").cast("int").alias("OrderQty"),
            money("l_extendedprice").alias("UnitPrice"), money("l_discount").alias("UnitPriceDiscount"),
            line_total().alias("LineTotal"), F.col("l_shipdate").alias("ModifiedDate"),
        )
