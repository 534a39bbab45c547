from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import xml as X
from tests.conftest import rows

NS = 'xmlns="urn:example:person-survey"'


@pytest.fixture()
def surveys(spark):
    full = (f"<IndividualSurvey {NS}><TotalPurchaseYTD currency='USD'>12.5</TotalPurchaseYTD><DateFirstPurchase>2001-07-22Z</DateFirstPurchase>"
            "<BirthDate>04/08/1966</BirthDate><MaritalStatus>M</MaritalStatus><YearlyIncome>75001-100000</YearlyIncome><Gender>M</Gender>"
            "<TotalChildren>2</TotalChildren><NumberChildrenAtHome>0</NumberChildrenAtHome><Education>R&amp;D </Education>"
            "<HomeOwnerFlag>1</HomeOwnerFlag><NumberCarsOwned>x</NumberCarsOwned></IndividualSurvey>")
    docs = [(1, full), (2, None), (3, f"<IndividualSurvey {NS}/>"), (4, "<IndividualSurvey><Gender>F"),
            (5, f"<IndividualSurvey {NS}><Gender>F</Gender><Gender>M</Gender><HomeOwnerFlag>0</HomeOwnerFlag><Education/></IndividualSurvey>")]
    return spark.createDataFrame(docs, "id int, doc string")


def test_person_survey(surveys):
    got = {r.id: r for r in X.with_person_survey(surveys, "doc").collect()}
    r = got[1]
    assert (r.TotalPurchaseYTD, r.DateFirstPurchase, r.BirthDate) == (Decimal("12.5000"), datetime(2001, 7, 22), datetime(1966, 4, 8))
    assert (r.TotalChildren, r.NumberChildrenAtHome, r.Education, r.Occupation, r.HomeOwnerFlag, r.NumberCarsOwned) == (2, 0, "R&D ", None, True, None)
    for empty in (2, 3, 4):
        assert [got[empty][n] for n in X.PERSON_SURVEY] == [None] * 12
    assert (got[5].Gender, got[5].HomeOwnerFlag, got[5].Education) == ("F", False, "")


def test_store_survey(spark):
    doc = ('<StoreSurvey xmlns="urn:example:store-survey"><AnnualSales>1.5E6</AnnualSales><AnnualRevenue>99999999999999999999</AnnualRevenue>'
           "<Brands>4+</Brands><SquareFeet>21000</SquareFeet><YearOpened>AW</YearOpened><Internet>T1</Internet></StoreSurvey>")
    r = X.with_store_survey(spark.createDataFrame([(doc,)], "doc string"), "doc").first()
    assert (r.AnnualSales, r.AnnualRevenue, r.Brands, r.SquareFeet, r.YearOpened, r.Internet, r.BankName) == (
        Decimal("1500000.00"), None, None, 21000, None, "T1", None)


def test_warranty_paths(spark):
    def doc(p, w, body):
        return f'<{p}:ProductDescription xmlns:{p}="urn:a" xmlns:{w}="urn:b"><{p}:Features>text {body}</{p}:Features></{p}:ProductDescription>'

    docs = [
        doc("p1", "wm", "<wm:Warranty><wm:WarrantyPeriod>3 years</wm:WarrantyPeriod></wm:Warranty><wm:Maintenance><wm:NoOfYears>10</wm:NoOfYears></wm:Maintenance>"),
        doc("q", "z", "<z:Warranty><z:Other>1</z:Other></z:Warranty><z:Warranty><z:WarrantyPeriod>1 year</z:WarrantyPeriod></z:Warranty>"
                      "<z:Warranty><z:WarrantyPeriod>9 years</z:WarrantyPeriod></z:Warranty>"),
        "<x/>", None, "<bad",
    ]
    got = X.with_warranty(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc").collect()
    assert [(r.WarrantyPeriod, r.MaintenanceYears) for r in got] == [("3 years", "10"), ("1 year", None)] + [(None, None)] * 3


def test_names_shred_and_pivot(spark, surveys):
    names = X.element_names(surveys, "doc")
    assert "IndividualSurvey" not in names and {"Gender", "Education", "BirthDate"} <= set(names) and "Occupation" not in names
    long = rows(X.shred(surveys, ["id"], "doc", names).filter("id = 5"))
    assert long == [(5, "Education", ""), (5, "Gender", "F"), (5, "Gender", "M"), (5, "HomeOwnerFlag", "0")]
    wide = {r.id: r for r in X.pivot_elements(surveys, ["id"], "doc", None, {"HomeOwnerFlag": "boolean"}).collect()}
    assert set(wide) == {1, 5} and (wide[5].Gender, wide[5].HomeOwnerFlag, wide[5].BirthDate) == ("M", False, None)
    pivoted = {r.id: r for r in X.pivot_long(X.shred(surveys, ["id"], "doc", names), ["id"], "ElementName", "ElementValue").collect()}
    assert {i: [pivoted[i][n] for n in names if n != "HomeOwnerFlag"] for i in pivoted} == {i: [wide[i][n] for n in names if n != "HomeOwnerFlag"] for i in wide}
    assert X.element_names(surveys.filter("doc IS NULL"), "doc") == []


def test_names_in_comments_are_not_elements(spark):
    docs = spark.createDataFrame([("<S><!-- <Ghost>1</Ghost> --><A>1<Inner>2</Inner></A></S>",)], "doc string")
    assert X.element_names(docs, "doc") == ["A"]


def test_unicode_names_and_names_that_differ_by_case(spark):
    docs = [(1, "<a><Größe>01.50</Größe><Name>x</Name><name>y</name><n:Élan xmlns:n='q'>z</n:Élan></a>"), (2, None)]
    df = spark.createDataFrame(docs, "id int, doc string")
    names = X.element_names(df, "doc")
    assert set(names) == {"Größe", "Name", "name", "Élan"}
    assert rows(X.shred(df, ["id"], "doc", names)) == [(1, "Größe", "01.50"), (1, "Name", "x"), (1, "name", "y"), (1, "Élan", "z")]
    with pytest.raises(ValueError):
        X.pivot_elements(df, ["id"], "doc")


def test_no_documents(spark):
    df = spark.createDataFrame([], "id int, doc string")
    assert X.element_names(df, "doc") == [] and X.shred(df, ["id"], "doc", []).count() == 0
    assert X.pivot_elements(df, ["id"], "doc").count() == 0


def test_long_pivot_deals_rows_out_before_it_sorts_them(spark):
    long = spark.range(0, 4_000, 1, 1).select((F.col("id") % 500).alias("id"), F.concat(F.lit("n"), F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("v"))
    wide = X.pivot_long(long, ["id"], "k", "v")
    assert rows(wide.filter("id < 2")) == [(0, max(str(i) for i in range(0, 4_000, 500)), None), (1, None, max(str(i) for i in range(1, 4_000, 500)))]
    plan = wide._jdf.queryExecution().sparkPlan().toString().split("Range")[0].splitlines()
    deepest_sort = max(i for i, line in enumerate(plan) if "Aggregate" in line)
    assert any("REPARTITION_BY_NUM" in line for line in plan[deepest_sort + 1:]), plan
