"""XML surveys: documents are built from whole tables and parsed back; the oracle knows the original columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.xml import (
    PERSON_SURVEY, STORE_SURVEY, element_names, pivot_elements, pivot_long, shred, with_person_survey, with_store_survey, with_warranty,
)
from starloom.plans.survey_customers import customer_by_ship_to
from starloom.workload.base import query
from starloom.workload.dimension_queries import nullable_of, shape_of
from starloom.workload.oltp import OltpSources
from starloom.workload.oltp_sql import with_sources


@query("xml_survey_struct", with_sources(f"""
    SELECT p.BusinessEntityID, {', '.join('v.' + c for c in PERSON_SURVEY)} FROM person p
    LEFT JOIN person_survey v ON v.BusinessEntityID = p.BusinessEntityID"""), shape_of(["BusinessEntityID", *PERSON_SURVEY]), nullable_of(PERSON_SURVEY))
def survey_query(spark, sf):
    persons = OltpSources(spark, sf)["person"]
    return with_person_survey(persons, "Demographics").select("BusinessEntityID", *PERSON_SURVEY)


@query("xml_store_survey", with_sources(f"""
    SELECT s.BusinessEntityID, {', '.join('v.' + c for c in STORE_SURVEY)} FROM store s
    LEFT JOIN store_survey v ON v.BusinessEntityID = s.BusinessEntityID"""), shape_of(["BusinessEntityID", *STORE_SURVEY]), nullable_of(STORE_SURVEY))
def store_survey_query(spark, sf):
    stores = OltpSources(spark, sf)["store"]
    return with_store_survey(stores, "Demographics").select("BusinessEntityID", *STORE_SURVEY)


@query("xml_namespace_path", with_sources("""
    SELECT p.ProductID, m.WarrantyPeriod, m.NoOfYears AS MaintenanceYears FROM product p
    LEFT JOIN product_model m ON m.ProductModelID = p.ProductModelID AND m.described"""))
def path_query(spark, sf):
    """Warranty of every product, read from the description of its model by prefixed paths."""
    src = OltpSources(spark, sf)
    documents = src["product"].select("ProductID", "ProductModelID").join(
        src["product_model"].select("ProductModelID", "CatalogDescription"), "ProductModelID", "left"
    )
    return with_warranty(documents, "CatalogDescription").select("ProductID", "WarrantyPeriod", "MaintenanceYears")


_TEXTS = {
    "TotalPurchaseYTD": "CAST(TotalPurchaseYTD AS VARCHAR)", "DateFirstPurchase": "strftime(DateFirstPurchase, '%Y-%m-%dZ')",
    "BirthDate": "strftime(BirthDate, '%Y-%m-%dZ')", "TotalChildren": "CAST(TotalChildren AS VARCHAR)",
    "NumberChildrenAtHome": "CAST(NumberChildrenAtHome AS VARCHAR)", "HomeOwnerFlag": "CAST(CAST(HomeOwnerFlag AS INTEGER) AS VARCHAR)",
    "NumberCarsOwned": "CAST(NumberCarsOwned AS VARCHAR)",
}
_LONG = " UNION ALL ".join(
    f"SELECT BusinessEntityID, '{n}' AS ElementName, {_TEXTS.get(n, n)} AS ElementValue FROM person_survey WHERE {n} IS NOT NULL" for n in PERSON_SURVEY
)


@query("xml_shred_long", with_sources(_LONG))
def shred_query(spark, sf):
    """Element names are discovered first, then every element becomes a row."""
    persons = OltpSources(spark, sf)["person"]
    return shred(persons, ["BusinessEntityID"], "Demographics", element_names(persons, "Demographics"))


@query("xml_element_names", with_sources(f"SELECT ElementName, count(*) AS n FROM ({_LONG}) GROUP BY 1"))
def names_query(spark, sf):
    persons = OltpSources(spark, sf)["person"]
    rows = shred(persons, ["BusinessEntityID"], "Demographics", element_names(persons, "Demographics"))
    return rows.groupBy("ElementName").agg(F.count("*").alias("n"))


@query("xml_element_list", with_sources(f"SELECT string_agg(ElementName, ',' ORDER BY ElementName) AS names FROM (SELECT DISTINCT ElementName FROM ({_LONG}))"))
def list_query(spark, sf):
    """The column list of the pivot as one text; the set has one entry per element name."""
    persons = OltpSources(spark, sf)["person"]
    found = shred(persons, ["BusinessEntityID"], "Demographics", PERSON_SURVEY).select("ElementName").distinct()
    return found.agg(F.array_join(F.sort_array(F.collect_list("ElementName")), ",").alias("names"))


@query("xml_pivot_dynamic", with_sources(f"SELECT BusinessEntityID, {', '.join(PERSON_SURVEY)} FROM person_survey"),
       shape_of(["BusinessEntityID", *PERSON_SURVEY]), nullable_of(PERSON_SURVEY))
def pivot_query(spark, sf):
    from starloom.plans.survey_customers import SURVEY_TYPES

    persons = OltpSources(spark, sf)["person"]
    return pivot_elements(persons, ["BusinessEntityID"], "Demographics", None, SURVEY_TYPES)


@query("xml_pivot_long", with_sources(f"SELECT BusinessEntityID, {', '.join(f'{_TEXTS.get(n, n)} AS {n}' for n in PERSON_SURVEY)} FROM person_survey"))
def pivot_long_query(spark, sf):
    """The element rows themselves pivoted, with the column list found from the data."""
    persons = OltpSources(spark, sf)["person"]
    rows = shred(persons, ["BusinessEntityID"], "Demographics", PERSON_SURVEY)
    return pivot_long(rows, ["BusinessEntityID"], "ElementName", "ElementValue")


@query("customer_by_ship_to", with_sources(f"""
    SELECT DISTINCT h.CustomerID, c.PersonID AS BusinessEntityID, c.TerritoryID, c.ModifiedDate, h.ShipToAddressID AS AddressID, p.PersonType,
           p.FirstName, p.LastName, p.EmailPromotion, {', '.join('v.' + c for c in PERSON_SURVEY)}, a.AddressLine1, a.City,
           s.Name AS ProvinceName, r.Name AS CountryRegionName, e.EmailAddress
    FROM order_header h JOIN sales_customer c ON c.CustomerID = h.CustomerID JOIN person p ON p.BusinessEntityID = c.PersonID
    JOIN person_survey v ON v.BusinessEntityID = p.BusinessEntityID JOIN address a ON a.AddressID = h.ShipToAddressID
    JOIN state_province s ON s.StateProvinceID = a.StateProvinceID JOIN country_region r ON r.CountryRegionCode = s.CountryRegionCode
    JOIN email_address e ON e.BusinessEntityID = p.BusinessEntityID"""),
    "CustomerID BusinessEntityID TerritoryID ModifiedDate:t AddressID PersonType FirstName LastName EmailPromotion "
    + shape_of(PERSON_SURVEY) + " AddressLine1 City ProvinceName CountryRegionName EmailAddress", nullable_of(PERSON_SURVEY))
def ship_to_query(spark, sf):
    return customer_by_ship_to(OltpSources(spark, sf))
