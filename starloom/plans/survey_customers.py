"""Alternate customer listing: ship-to address, pivoted survey, e-mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.xml import pivot_elements

# Types of the pivoted survey columns; the others stay text.
SURVEY_TYPES = {
    "BirthDate": "timestamp_ntz", "DateFirstPurchase": "timestamp_ntz", "HomeOwnerFlag": "boolean",
    "NumberCarsOwned": "int", "NumberChildrenAtHome": "int", "TotalChildren": "int", "TotalPurchaseYTD": "double",
}


def survey_table(persons: DataFrame, names=None) -> DataFrame:
    """One row per surveyed person, columns discovered from the documents."""
    return pivot_elements(persons, ["BusinessEntityID"], "Demographics", names, SURVEY_TYPES)


def customer_by_ship_to(src: dict[str, DataFrame], names=None) -> DataFrame:
    """Customers once per address they were shipped to and e-mail they have.

    Orders are reduced to distinct (customer, address) pairs before anything else is joined.
    """
    shipped = src["order_header"].select("CustomerID", F.col("ShipToAddressID").alias("AddressID")).distinct()
    customers = src["customer"].filter(F.col("PersonID").isNotNull()).select(
        "CustomerID", F.col("PersonID").alias("BusinessEntityID"), "TerritoryID", "ModifiedDate"
    )
    persons = src["person"].select("BusinessEntityID", "PersonType", "FirstName", "LastName", "EmailPromotion")
    places = (
        src["address"].select("AddressID", "AddressLine1", "City", "StateProvinceID")
        .join(src["state_province"].select("StateProvinceID", F.col("Name").alias("ProvinceName"), "CountryRegionCode"), "StateProvinceID")
        .join(src["country_region"].select("CountryRegionCode", F.col("Name").alias("CountryRegionName")), "CountryRegionCode")
        .drop("StateProvinceID", "CountryRegionCode")
        .distinct()
    )
    emails = src["email_address"].select("BusinessEntityID", "EmailAddress").distinct()
    known = customers.join(persons, "BusinessEntityID").join(survey_table(src["person"], names), "BusinessEntityID")
    return shipped.join(places, "AddressID").join(known, "CustomerID").join(emails, "BusinessEntityID")
