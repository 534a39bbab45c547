from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import cleanse as C
from starloom.operators import schema as S
from starloom.plans.cleanse_job import CleanseFailed, cleanse_tables
from tests.conftest import rows


@pytest.mark.parametrize("args, want", [
    (("varchar", 50), T.VarcharType(50)), (("char", 3), T.VarcharType(3)), (("varchar", -1), T.StringType()),
    (("nvarchar", 101), T.VarcharType(51)), (("NCHAR", 10), T.VarcharType(5)), (("nvarchar", -1), T.StringType()),
    (("text",), T.StringType()), (("ntext",), T.StringType()), (("varbinary",), T.BinaryType()), (("binary",), T.BinaryType()),
    (("image",), T.BinaryType()), (("decimal", 9, 8, 2), T.DecimalType(8, 2)), (("numeric", 9, 10, 0), T.DecimalType(10, 0)),
    (("numeric", 9, None, None), T.DecimalType(38, 18)), (("money",), T.DecimalType(19, 4)), (("smallmoney",), T.DecimalType(10, 4)),
    (("float",), T.DoubleType()), (("real",), T.FloatType()), (("bigint",), T.LongType()), (("int",), T.IntegerType()),
    (("smallint",), T.ShortType()), (("tinyint",), T.ShortType()), (("bit",), T.BooleanType()), (("datetime",), T.TimestampNTZType()),
    (("datetime2",), T.TimestampNTZType()), (("smalldatetime",), T.TimestampNTZType()), (("date",), T.DateType()), (("time",), T.StringType()),
    (("uniqueidentifier",), T.StringType()), (("xml",), T.StringType()), (("geography",), T.StringType()),
])
def test_type_map(args, want):
    assert S.map_type(*args) == want


def test_table_schema_needs_columns():
    with pytest.raises(ValueError):
        S.table_schema([])
    got = S.table_schema([("A", "int", 4, 10, 0, False)])
    assert got == T.StructType([T.StructField("A", T.IntegerType(), False)])


def test_alignment(spark):
    schema = T.StructType([T.StructField("CustomerID", T.IntegerType()), T.StructField("Name", T.StringType()), T.StructField("Gone", T.StringType())])
    df = spark.createDataFrame([("x", 1, 2)], ['"name"', " CUSTOMERID ", "extra"])
    assert S.align_to_schema(df, schema).columns == ["CustomerID", "Name"]
    with pytest.raises(ValueError):
        S.align_to_schema(spark.range(1), schema)


def test_coercion(spark):
    df = spark.createDataFrame([("2.0", "t", "1.5"), ("2.5", "f", "x"), ("3.5", "true", None), ("x", "yes", "7"), ("-2.5", "false", " 8 "), ("99999999999", None, "")],
                               "i string, b string, d string")
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("b", T.BooleanType()), T.StructField("d", T.DecimalType(6, 2))])
    got = [tuple(r) for r in S.coerce_types(df, schema).collect()]
    assert [g[0] for g in got] == [2, 2, 4, None, -2, None]
    assert [g[1] for g in got] == [True, False, True, None, False, None]
    assert [g[2] for g in got] == [Decimal("1.50"), None, None, Decimal("7.00"), Decimal("8.00"), None]
    same = spark.createDataFrame([(5, True, Decimal("1.25"))], schema)
    assert rows(S.coerce_types(same, schema)) == [(5, True, Decimal("1.25"))]


def test_projection_and_profile(spark):
    df = spark.createDataFrame([("1", "2020-01-01")], "a string, b string")
    schema = T.StructType([T.StructField("b", T.DateType()), T.StructField("a", T.ShortType())])
    assert rows(S.typed_projection(df, schema)) == [(date(2020, 1, 1), 1)]
    assert S.schema_profile(df) == [(1, "a", "string", True), (2, "b", "string", True)]


@pytest.fixture()
def dirty(spark):
    return spark.createDataFrame(
        [(1, " Ann ", " x ", None, None, None, None), (1, " Ann ", None, 2.5, Decimal("1.00"), True, date(2020, 1, 1)), (2, None, "", 1.0, None, False, None)],
        "CustomerID int, FirstName string, Note string, Score double, Price decimal(8,2), Flag boolean, Day date")


def test_trim_and_upper(dirty):
    assert rows(C.trim_text(dirty, upper_names=True).select("FirstName", "Note")) == [("ANN", "x"), ("ANN", None), (None, "")]
    assert rows(C.trim_text(dirty).select("FirstName")) == [("Ann",), ("Ann",), (None,)]


def test_fill(dirty):
    got = rows(C.fill_unknown(dirty).filter("CustomerID = 2"))
    assert got == [(2, "UNKNOWN", "", 1.0, Decimal("0.00"), False, None)]


def test_cleanse_keeps_one_row_per_key(dirty):
    got = C.cleanse(dirty, ["CustomerID"]).collect()
    assert sorted(r.CustomerID for r in got) == [1, 2]
    assert C.cleanse(dirty.select("Note"), None).count() == 3


def test_job_isolates_failures(spark, dirty):
    written = {}

    def read(name):
        if name == "bad":
            raise RuntimeError("no such table")
        return dirty

    with pytest.raises(CleanseFailed) as failure:
        cleanse_tables(spark, ["a", "bad", "c"], read, lambda df, n: written.update({n: df.count()}), {"a": ["CustomerID"], "c": ["CustomerID"]})
    assert written == {"a": 2, "c": 2}
    assert [r.status for r in failure.value.status.orderBy("table_name").collect()] == ["done", "failed", "done"]
    assert cleanse_tables(spark, ["a"], read, lambda df, n: None).first().status == "done"


def test_one_projection_for_all_columns(dirty):
    plan = C.fill_unknown(C.trim_text(dirty, True)).select(F.col("FirstName"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1


def test_star_schema(spark):
    from starloom.plans import star_schema as star
    from starloom.plans.fact import FACT_COLUMNS
    from starloom.plans.registry import DIMENSIONS, REGISTRY

    for name in DIMENSIONS:
        spec = REGISTRY[name].spec
        assert sorted(star.star_schema(name).names) == sorted(spec.columns)
    assert sorted(star.star_schema("FactSales").names) == sorted(["FactSalesKey", *FACT_COLUMNS])
    types = {f.name: (f.dataType, f.nullable) for f in star.star_schema("DimProduct")}
    assert types["Weight"] == (T.DecimalType(8, 2), True) and types["ProductID"] == (T.LongType(), False)
    df = spark.createDataFrame([("x" * 6, 1, None), (None, 2, "2020-01-01")], "Size string, ProductID int, StartDate string")
    shaped = star.conform(df, "DimProduct")
    assert shaped.columns == ["ProductID", "Size", "StartDate"] and shaped.schema["StartDate"].dataType == T.TimestampNTZType()
    assert rows(star.check_required(shaped, "DimProduct")) == [("ProductID", 0), ("StartDate", 1)]
    assert rows(star.check_lengths(shaped, "DimProduct")) == [("Size", 1)]


def test_jdbc_job_passes_names_splits_and_partitions_through(spark, monkeypatch):
    from starloom.plans import cleanse_job
    from starloom.sources.jdbc import JdbcTarget, Split

    seen = []
    monkeypatch.setattr(cleanse_job, "read_jdbc", lambda s, t, name, split: seen.append((name, split)) or spark.range(2))
    monkeypatch.setattr(cleanse_job, "write_jdbc", lambda df, t, name, mode, parts: seen.append((name, mode, parts, df.count())))
    split = Split("id", 1, 100, 4)
    status = cleanse_job.cleanse_over_jdbc(spark, JdbcTarget("u", "a", "b"), "DimA, DimB", splits={"DimB": split}, write_partitions=3)
    assert seen == [("staging.DimA", None), ("dwh.DimA", "overwrite", 3, 2), ("staging.DimB", split), ("dwh.DimB", "overwrite", 3, 2)]
    assert status.count() == 2
