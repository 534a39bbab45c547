"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import dates as D

CALENDAR_COLUMNS = [
    "DateKey", "Date", "FullDate", "DayOfMonth", "DaySuffix", "DayName", "DayOfWeek", "DayOfWeekInMonth",
    "DayOfWeekInYear", "DayOfQuarter", "DayOfYear", "WeekOfMonth", "WeekOfQuarter", "WeekOfYear", "Month",
    "MonthName", "MonthOfQuarter", "Quarter", "QuarterName", "Year", "YearName", "MonthYear", "MMYYYY",
    "FirstDayOfMonth", "LastDayOfMonth", "FirstDayOfQuarter", "LastDayOfQuarter", "FirstDayOfYear",
    "LastDayOfYear", "IsHoliday", "IsWeekday", "HolidayName",
]


def date_spine(spark: SparkSession, start: date = date(2005, 1, 1), end: date = date(2028, 1, 1)) -> DataFrame:
    """Every day of ``[start, end)``."""
    days = (end - start).days
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def date_spine_of(df: DataFrame, date_col: str) -> DataFrame:
    """Every day of the calendar years that ``date_col`` touches; lazy, one tiny aggregate."""
    d = F.col(date_col).cast("date")
    bounds = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi")).filter("lo IS NOT NULL")
    last = F.date_sub(F.add_months(F.trunc("hi", "YEAR"), 12), 1)
    return bounds.select(F.explode(F.sequence(F.trunc("lo", "YEAR"), last, F.expr("interval 1 day"))).alias("day"))


def long_fiscal_years(spark: SparkSession, spec: D.FiscalCalendar = D.FiscalCalendar()) -> DataFrame:
    """The 53-week years: an arithmetic series below ``last_year``."""
    series = F.sequence(F.lit(spec.first_long_year), F.lit(spec.last_year - 1), F.lit(spec.long_every))
    return spark.range(1).select(F.explode(series).alias("FiscalYear"))


def calendar_attributes(d: Column, holiday_mode: str = "intended") -> dict[str, Column]:
    """The calendar columns of a DATE column, codes as trimmed text as in the star schema."""
    label = D.holiday_name(d, holiday_mode)

    def text(c: Column) -> Column:
        return c.cast("string")

    year = text(F.year(d))
    return {
        "DateKey": D.date_key(d),
        "Date": d.cast("timestamp_ntz"),
        "FullDate": D.us_date_text(d),
        "DayOfMonth": text(F.dayofmonth(d)),
        "DaySuffix": D.day_suffix(d),
        "DayName": F.date_format(d, "EEEE"),
        "DayOfWeek": text(F.dayofweek(d)),
        "DayOfWeekInMonth": text(D.weekday_occurrence(d, "month")),
        "DayOfWeekInYear": text(D.weekday_occurrence(d, "year")),
        "DayOfQuarter": text(D.weekday_occurrence(d, "quarter")),
        "DayOfYear": text(F.dayofyear(d)),
        "WeekOfMonth": text(D.week_of_month_us(d)),
        "WeekOfQuarter": text(D.week_of_quarter(d)),
        "WeekOfYear": text(D.week_of_year_us(d)),
        "Month": text(F.month(d)),
        "MonthName": F.date_format(d, "MMMM"),
        "MonthOfQuarter": text(D.month_of_quarter(d)),
        "Quarter": text(F.quarter(d)),
        "QuarterName": D.quarter_name(F.quarter(d)),
        "Year": year,
        "YearName": F.concat(F.lit("CY "), year),
        "MonthYear": F.concat(F.date_format(d, "MMM"), F.lit("-"), year),
        "MMYYYY": F.concat(F.lpad(text(F.month(d)), 2, "0"), year),
        **D.period_bounds(d),
        "IsHoliday": label.isNotNull(),
        "IsWeekday": D.is_weekday(d),
        "HolidayName": label,
    }


def build_calendar(
    spine: DataFrame,
    holiday_mode: str = "intended",
    fiscal: D.FiscalCalendar | None = D.FiscalCalendar(),
) -> DataFrame:
    """Calendar dimension of a spine of days: 32 columns, plus 15 fiscal ones as text and dates."""
    out = spine.select(*[c.alias(n) for n, c in calendar_attributes(F.col("day"), holiday_mode).items()])
    if fiscal is None:
        return out
    out = D.with_fiscal(out, "Date", fiscal)
    codes = ["FiscalDayOfYear", "FiscalWeekOfYear", "FiscalMonth", "FiscalQuarter", "FiscalYear"]
    return out.withColumns({c: F.col(c).cast("string") for c in codes})
