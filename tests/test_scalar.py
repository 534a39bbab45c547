from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.functions import scalar as S


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_row_max_skips_nulls(spark):
    a, b, none = S.ntz("2001-01-01"), S.ntz("2002-02-02"), F.lit(None).cast("timestamp_ntz")
    row = one(spark, S.row_max(a, none, b).alias("x"), S.row_max(none, none).alias("y"), S.row_max(a).alias("z"))
    assert (row.x, row.y, row.z) == (datetime(2002, 2, 2), None, datetime(2001, 1, 1))


def test_differs_is_null_safe(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None), (None, 1), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(S.differs(F.col("a"), F.col("b"))).collect()] == [False, True, True, True, False]


def test_later_of_keeps_a_null_second(spark):
    a, none = S.ntz("2001-01-01"), F.lit(None).cast("timestamp_ntz")
    row = one(spark, S.later_of(a, none).alias("x"), S.later_of(none, a).alias("y"))
    assert (row.x, row.y) == (None, datetime(2001, 1, 1))


def test_allocate(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), Decimal("1"), Decimal("3")), (Decimal("10.00"), Decimal("3"), Decimal("3")), (Decimal("10.00"), Decimal("1"), Decimal("0")),
         (Decimal("10.00"), Decimal("1"), None), (Decimal("123456789012.3456"), Decimal("1"), Decimal("7"))],
        "h decimal(19,4), l decimal(19,4), s decimal(19,4)")
    got = [r[0] for r in df.select(S.allocate(F.col("h"), F.col("l"), F.col("s"))).collect()]
    assert got == [Decimal("3.3333"), Decimal("10.0000"), None, None, Decimal("17636684144.6208")]


def test_line_amounts(spark):
    a = S.line_amounts(F.lit(3), F.lit("10.1234").cast("decimal(19,4)"), F.lit("0.1").cast("decimal(5,4)"))
    row = one(spark, *[c.alias(n) for n, c in a.items()])
    assert tuple(row) == (30.3702, 3.03702, 27.33318)


def test_survey_dates_and_conversions(spark):
    df = spark.createDataFrame([("1971-10-06Z",), ("10/06/1971",), ("soon",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(S.survey_date(F.col("t"))).collect()] == [datetime(1971, 10, 6)] * 2 + [None] * 3
    nums = spark.createDataFrame([("4+",), ("AW",), (" 7 ",), ("7.5",), (None,)], "t string")
    assert [r[0] for r in nums.select(S.try_convert(F.col("t"), "int")).collect()] == [None, None, 7, None, None]


def test_to_second_has_no_zone(spark):
    df = spark.range(1).select(S.to_second(S.ntz("2020-01-02 03:04:05.987")).alias("x"))
    assert df.schema["x"].dataType.simpleString() == "timestamp_ntz" and df.first().x == datetime(2020, 1, 2, 3, 4, 5)
