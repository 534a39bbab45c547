"""Full load and incremental runs on a small hand-made source."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality as q
from starloom.operators.quality import EmptyLoad
from starloom.plans import registry
from starloom.plans.calendar import date_spine
from starloom.plans.fact import build_fact, fact_delta
from starloom.plans.full_load import extend_calendar, full_load, load_dimension, load_fact, staging_to_warehouse
from starloom.plans.incremental import advance_watermark, read_watermark, run_incremental
from starloom.sources.tables import TableStore
from tests.conftest import rows

D1, D2, D3 = datetime(2020, 1, 10), datetime(2020, 2, 10), datetime(2020, 3, 10, 12, 0, 0, 500000)
NTZ = "timestamp_ntz"


def survey(gender):
    return f'<IndividualSurvey xmlns="urn:x"><Gender>{gender}</Gender><TotalChildren>1</TotalChildren></IndividualSurvey>'


def source_rows():
    """A small shop: persons 1-3 (3 buys for store 100), two products, two orders."""
    return {
        "person": ("BusinessEntityID int, PersonType string, FirstName string, LastName string, EmailPromotion int, Demographics string, ModifiedDate " + NTZ,
                   [(1, "IN", " Ann ", "A", 0, survey("F"), D1), (2, "IN", "Bob", "B", 1, None, D1), (3, "SC", "Cy", "C", 1, None, D1)]),
        "customer": ("CustomerID int, PersonID int, StoreID int, TerritoryID int, ModifiedDate " + NTZ,
                     [(11, 1, None, 1, D1), (12, 2, None, 1, D1), (13, 3, 100, 1, D1)]),
        "email_address": ("BusinessEntityID int, EmailAddress string, ModifiedDate " + NTZ, [(1, "b@x", D1), (1, "a@x", D1), (1, "old@x", datetime(2019, 1, 1))]),
        "business_entity_address": ("BusinessEntityID int, AddressID int, AddressTypeID int, ModifiedDate " + NTZ,
                                    [(1, 1, 2, D1), (100, 2, 3, D1), (100, 3, 2, D1)]),
        "address": ("AddressID int, AddressLine1 string, AddressLine2 string, City string, StateProvinceID int, ModifiedDate " + NTZ,
                    [(1, "1 Road", None, "X", 1, D1), (2, "2 Road", "b", "Y", 1, D1), (3, "3 Road", None, "Z", 1, D1)]),
        "address_type": ("AddressTypeID int, Name string, ModifiedDate " + NTZ, [(1, "Main Office", D1), (2, "Shipping", D1), (3, "Billing", D1)]),
        "state_province": ("StateProvinceID int, Name string, CountryRegionCode string, ModifiedDate " + NTZ, [(1, "S", "C1", D1)]),
        "country_region": ("CountryRegionCode string, Name string, ModifiedDate " + NTZ, [("C1", "Country", D1)]),
        "product": ("ProductID int, Name string, Color string, Size string, Style string, Weight decimal(8,2), StandardCost decimal(19,4), ListPrice decimal(19,4), "
                    "ProductModelID int, ProductSubcategoryID int, ModifiedDate " + NTZ,
                    [(1, "Bike", "red", "M", None, Decimal("1.5"), Decimal("5"), Decimal("10"), 1, 1, D1), (2, "Bell", None, None, None, None, Decimal("1"), Decimal("2"), 2, None, D1)]),
        "product_model": ("ProductModelID int, Name string, CatalogDescription string, ModifiedDate " + NTZ,
                          [(1, "M1", "<P><Features><Warranty><WarrantyPeriod>3 y</WarrantyPeriod></Warranty></Features></P>", D1), (2, "M2", None, D1)]),
        "product_subcategory": ("ProductSubcategoryID int, ProductCategoryID int, Name string, ModifiedDate " + NTZ, [(1, 1, "Sub", D1)]),
        "product_category": ("ProductCategoryID int, Name string, ModifiedDate " + NTZ, [(1, "Cat", D1)]),
        "special_offer": ("SpecialOfferID int, Description string, Type string, Category string, DiscountPct decimal(10,4), MinQty int, MaxQty int, "
                          f"StartDate {NTZ}, EndDate {NTZ}, ModifiedDate {NTZ}", [(1, "None", "N", "C", Decimal("0"), 0, None, D1, D2, D1)]),
        "sales_reason": ("SalesReasonID int, Name string, ReasonType string, ModifiedDate " + NTZ, [(1, "Price", "Other", D1), (2, "Ad", "Promo", D1)]),
        "order_reason": ("SalesOrderID int, SalesReasonID int, ModifiedDate " + NTZ, [(1000, 1, D1), (1000, 2, D1)]),
        "ship_method": ("ShipMethodID int, Name string, ShipBase decimal(19,4), ShipRate decimal(19,4), ModifiedDate " + NTZ,
                        [(1, "Truck", Decimal("1"), Decimal("2"), D1), (2, "Air", Decimal("3"), Decimal("4"), D1)]),
        "store": ("BusinessEntityID int, Name string, Demographics string, ModifiedDate " + NTZ, [(100, "Shop", "<StoreSurvey><Brands>4+</Brands></StoreSurvey>", D1)]),
        "sales_territory": ("TerritoryID int, Name string, CountryRegionCode string, Group string, SalesYTD decimal(19,4), SalesLastYear decimal(19,4), "
                            "CostYTD decimal(19,4), CostLastYear decimal(19,4), ModifiedDate " + NTZ,
                            [(1, "T", "C1", "G", Decimal("10"), Decimal("1"), Decimal("2"), Decimal("3"), D1)]),
        "order_header": (f"SalesOrderID int, CustomerID int, TerritoryID int, ShipMethodID int, ShipToAddressID int, OrderDate {NTZ}, DueDate {NTZ}, ShipDate {NTZ}, "
                         f"Status int, OnlineOrderFlag boolean, SubTotal decimal(19,4), TaxAmt decimal(19,4), Freight decimal(19,4), TotalDue decimal(19,4), ModifiedDate {NTZ}",
                         [(1000, 11, 1, 1, 1, datetime(2020, 1, 1), datetime(2020, 1, 9), datetime(2020, 1, 5), 5, True, Decimal("12"), Decimal("3"), Decimal("1.2"), Decimal("16.2"), D1),
                          (1001, 12, 1, 1, 1, datetime(2020, 1, 2), datetime(2020, 1, 9), None, 5, True, Decimal("2"), Decimal("1"), Decimal("1"), Decimal("4"), D1)]),
        "order_detail": (f"SalesOrderID int, SalesOrderDetailID int, ProductID int, SpecialOfferID int, OrderQty int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), "
                         f"LineTotal decimal(38,6), ModifiedDate {NTZ}",
                         [(1000, 1, 1, 1, 1, Decimal("10"), Decimal("0"), Decimal("10"), D1), (1000, 2, 2, 1, 1, Decimal("2"), Decimal("0"), Decimal("2"), D1),
                          (1001, 3, 2, 1, 1, Decimal("2"), Decimal("0"), Decimal("2"), D1)]),
    }


def frames(spark, data):
    return {n: spark.createDataFrame(r, schema) for n, (schema, r) in data.items()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A full load, then three incremental runs; every version stays readable."""
    store = TableStore(spark, str(tmp_path_factory.mktemp("store")))
    data = source_rows()
    spine = date_spine(spark, date(2019, 1, 1), date(2021, 1, 1))
    counts = full_load(store, frames(spark, data), calendar_spine=spine)
    result = {"counts": rows(counts), "idle": rows(run_incremental(store, frames(spark, data)).select("table_name", "status"))}

    data["email_address"][1].append((2, "bob@x", D2))
    data["product_category"][1][0] = (1, "Cat2", D3)
    data["ship_method"][1].append((3, "Sea", Decimal("1"), Decimal("1"), D2))
    data["order_header"][1].append((1002, 13, 1, 1, 1, datetime(2020, 2, 1), datetime(2020, 2, 9), datetime(2020, 2, 5), 5, False, Decimal("10"), Decimal("1"), Decimal("0"), Decimal("11"), D2))
    data["order_detail"][1].append((1002, 4, 9, 1, 2, Decimal("5"), Decimal("0"), Decimal("10"), D2))
    sources = frames(spark, data)
    result["first"] = {r.table_name: r for r in run_incremental(store, sources).collect()}
    result["second"] = {r.table_name: r for r in run_incremental(store, sources).collect()}
    return store, result, sources


def test_full_load(loaded):
    store, result, _ = loaded
    assert result["counts"] == [("DimCustomer", 3), ("DimProduct", 3), ("DimPromotion", 2), ("DimSalesReason", 3), ("DimShipMethod", 3),
                                ("DimStore", 2), ("DimTerritory", 2), ("FactSales", 5)]
    ann = store.read("dwh", "DimCustomer", 1).filter("CustomerID = 11").first()
    assert (ann.FirstName, ann.EmailAddress, ann.AddressLine1, ann.CountryRegionName, ann.Gender, ann.TotalChildren) == ("Ann", "a@x", "1 Road", "Country", "F", 1)
    shop = store.read("dwh", "DimStore", 1).filter("StoreID = 100").first()
    assert (shop.AddressType, shop.AddressLine1, shop.Brands) == ("Shipping", "3 Road", None)
    bike = store.read("dwh", "DimProduct", 1).filter("ProductID = 1").first()
    assert (bike.ModelName, bike.CategoryName, bike.WarrantyPeriod) == ("M1", "Cat", "3 y")
    bell = store.read("dwh", "DimProduct", 1).filter("ProductID = 2").first()
    assert (bell.ModelName, bell.CategoryName) == (None, None)


def test_fact_grain_and_amounts(loaded):
    store, _, _ = loaded
    fact = store.read("dwh", "FactSales", 1)
    assert rows(fact.select("SalesOrderID", "SalesOrderDetail").distinct()) == [(1000, 1), (1000, 2), (1001, 3)]
    assert fact.count() == 5
    line = fact.filter("SalesOrderDetail = 1").first()
    assert (line.TaxAllocated, line.Freight_Allocated, line.TotalDue_Line) == (Decimal("2.5000"), Decimal("1.0000"), 13.5)
    assert sorted(r.FactSalesKey for r in fact.collect()) == [1, 2, 3, 4, 5]
    assert {r.OrderMonth for r in fact.collect()} == {202001}


def test_nothing_changed(loaded):
    _, result, _ = loaded
    assert {s for _, s in result["idle"]} == {"skipped"}


def test_first_delta(loaded):
    store, result, _ = loaded
    got = result["first"]
    assert {n: (r.status, r.rows_staged, r.rows_expired, r.rows_inserted) for n, r in got.items()} == {
        "DimCustomer": ("merged", 1, 1, 1), "DimProduct": ("merged", 1, 1, 1), "DimPromotion": ("skipped", 0, 0, 0),
        "DimSalesReason": ("skipped", 0, 0, 0), "DimTerritory": ("skipped", 0, 0, 0), "DimShipMethod": ("merged", 2, 1, 2),
        "DimStore": ("skipped", 0, 0, 0), "FactSales": ("merged", 1, 0, 1)}
    bob = store.read("dwh", "DimCustomer").filter("CustomerID = 12").orderBy("StartDate").collect()
    assert [(r.EmailAddress, r.StartDate, r.EndDate) for r in bob] == [
        (None, D1, datetime(2020, 2, 9, 23, 59, 59)), ("bob@x", D2, datetime(9999, 12, 31))]
    truck = store.read("dwh", "DimShipMethod").filter("ShipMethodID = 1").orderBy("StartDate").collect()
    assert [r.ShipDate for r in truck] == [datetime(2020, 1, 5), datetime(2020, 2, 5)]


def test_fact_delta_has_unknown_members(loaded):
    store, _, _ = loaded
    fact = store.read("dwh", "FactSales")
    line = fact.filter("SalesOrderID = 1002").first()
    assert (line.ProductKey, line.CustomerKey, line.SalesReasonKey) == (-1, -1, -1) and line.StoreKey > 0 and line.FactSalesKey == 6
    relations = {n: (k, store.read("dwh", n), k) for n, k in (("DimProduct", "ProductKey"), ("DimCustomer", "CustomerKey"), ("DimStore", "StoreKey"),
                                                              ("DimSalesReason", "SalesReasonKey"))}
    assert {r.n_orphans for r in q.foreign_key_report(fact, relations).collect()} == {0}
    for name in registry.DIMENSIONS:
        keys = list(registry.REGISTRY[name].spec.business_keys)
        assert q.multiple_current(store.read("dwh", name), keys).count() == 0


def test_second_run_and_fractional_seconds(loaded):
    """A change with a fraction of a second is read again, and merging it again changes nothing."""
    store, result, _ = loaded
    again = {n: (r.status, r.rows_expired, r.rows_inserted) for n, r in result["second"].items()}
    assert again.pop("DimProduct") == ("merged", 0, 0)
    assert set(again.values()) == {("skipped", 0, 0)}
    assert read_watermark(store, "DimProduct") == D3.replace(microsecond=0)


def test_watermarks(loaded):
    store, _, _ = loaded
    assert read_watermark(store, "unknown") == datetime(1900, 1, 1)
    with pytest.raises(KeyError):
        advance_watermark(store, "unknown", D1)


def test_failures_are_isolated(loaded):
    store, _, sources = loaded
    broken = {n: d for n, d in sources.items() if n != "store"}
    status = {r.table_name: r.status for r in run_incremental(store, broken, ["DimStore", "DimPromotion"]).collect()}
    assert status == {"DimStore": "failed", "DimPromotion": "skipped"}
    facts = {r.table_name: r.status for r in run_incremental(store, broken, ["DimStore", "DimPromotion", "FactSales"]).collect()}
    assert facts["FactSales"] == "blocked"
    with pytest.raises(RuntimeError):
        run_incremental(store, broken, ["DimStore"])


def test_empty_dimension_stops_the_load(spark, loaded, tmp_path):
    _, _, sources = loaded
    empty = {**sources, "special_offer": sources["special_offer"].limit(0)}
    with pytest.raises(EmptyLoad):
        load_dimension(TableStore(spark, str(tmp_path)), "DimPromotion", empty)


def test_replicated_amounts_and_modes(loaded):
    store, _, sources = loaded
    dims = {n: store.read("dwh", n) for n in [*registry.DIMENSIONS, "DimDate"]}
    fact = build_fact(sources, dims, "replicate").filter("SalesOrderDetail = 1").first()
    assert (fact.TaxAllocated, fact.LineAmountSource) == (Decimal("3.0000"), 10)
    with pytest.raises(ValueError):
        build_fact(sources, dims, "halve")


def test_delta_counts_a_line_once(loaded):
    _, _, sources = loaded
    delta = fact_delta(sources, "2020-01-15")
    assert rows(delta.select("SalesOrderID", "SalesOrderDetail", "StoreID")) == [(1002, 4, 100)]
    everything = fact_delta(sources, "1900-01-01")
    assert everything.count() == 4 and everything.select(F.count_distinct("SalesOrderDetail")).first()[0] == 4


def test_reload_after_a_delta_takes_open_members_only(loaded):
    store, _, sources = loaded
    assert load_fact(store, sources).count() == 6


def test_lines_without_a_match_stay_with_key_minus_one(loaded):
    store, _, _ = loaded
    late = store.read("dwh", "FactSales", 1).filter("SalesOrderID = 1001").first()
    assert late.ShipDateKey is None and late.OrderDateKey == 20200102 and late.SalesReasonKey == -1


def test_calendar_covers_the_orders(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    data = source_rows()
    data["order_header"][1].append((1003, 11, 1, 1, 1, datetime(1990, 6, 1), datetime(1990, 6, 9), datetime(1990, 6, 5), 5, True, Decimal("1"), Decimal("0"), Decimal("0"), Decimal("1"), D1))
    data["order_detail"][1].append((1003, 9, 1, 1, 1, Decimal("1"), Decimal("0"), Decimal("1"), D1))
    full_load(store, frames(spark, data))
    days = store.read("dwh", "DimDate").agg(F.min("DateKey"), F.max("DateKey")).first()
    assert tuple(days) == (19900101, 20201231)
    far = spark.createDataFrame([(20310506, 20310507, None)], "OrderDateKey int, DueDateKey int, ShipDateKey int")
    extend_calendar(store, far)
    assert store.read("dwh", "DimDate").agg(F.max("DateKey")).first()[0] == 20311231
    version = store.version("dwh", "DimDate")
    extend_calendar(store, far)
    assert store.version("dwh", "DimDate") == version


def test_a_moved_customer_gets_a_version_that_starts_with_the_link(spark, tmp_path):
    """The new link leads to an address that is older than the customer's current row."""
    store = TableStore(spark, str(tmp_path))
    data = source_rows()
    data["address"][1].append((9, "9 Old Street", None, "Q", 1, datetime(2020, 1, 11)))
    full_load(store, frames(spark, data))
    data["business_entity_address"][1].append((1, 9, 2, D2))
    status = {r.table_name: r for r in run_incremental(store, frames(spark, data), ["DimCustomer"]).collect()}["DimCustomer"]
    assert (status.rows_expired, status.rows_inserted, status.rows_late) == (1, 1, 0)
    ann = store.read("dwh", "DimCustomer").filter("CustomerID = 11").orderBy("StartDate").collect()
    assert [(r.AddressLine1, r.StartDate, r.EndDate) for r in ann] == [
        ("1 Road", D1, datetime(2020, 2, 9, 23, 59, 59)), ("9 Old Street", D2, datetime(9999, 12, 31))]


def test_append_to_the_warehouse(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.createDataFrame([(1, " a ")], "k int, v string"), "staging", "t")
    staging_to_warehouse(store, "t")
    assert rows(staging_to_warehouse(store, "t", "append")) == [(1, "a"), (1, "a")]
    with pytest.raises(ValueError):
        staging_to_warehouse(store, "t", "merge")


def test_registry():
    assert len(registry.DIMENSIONS) == 7 and registry.FACTS == ["FactSales"]
    assert registry.REGISTRY["DimSalesReason"].spec.business_keys == ("SalesOrderID", "SalesReasonID")
    with pytest.raises(ValueError):
        registry.TableConfig("X", "view", lambda s: s, ())
    with pytest.raises(ValueError):
        registry.TableConfig("X", "dimension", lambda s: s, ())
