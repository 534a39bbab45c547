"""Calendar operators on the dates of orders, lines and events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom.functions import dates as D
from starloom.plans.calendar import CALENDAR_COLUMNS, build_calendar, date_spine_of, long_fiscal_years
from starloom.workload.base import query
from starloom.workload.oltp import read

# The fiscal years of the queries start in 1995, so that the orders fall into them.
FISCAL = D.FiscalCalendar(start=date(1994, 12, 26), first_year=1995, last_year=2030, first_long_year=1994)


def order_days(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


def orders_per_day(spark, sf):
    return order_days(spark, sf).groupBy("day").agg(F.count("*").alias("n_orders"))


def counted(calendar, per_day, day="day"):
    """Calendar rows with the number of orders of the day."""
    return calendar.join(per_day, day, "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


# every day of the years of the orders, with everything that needs counting done by windows over the days
DAYS = """
    SELECT CAST(d AS DATE) AS day FROM (
        SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
                                      date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
        FROM orders)"""
COUNTED_DAYS = f"""
    SELECT day, year(day) AS y, month(day) AS m, dayofmonth(day) AS dd, dayofweek(day) + 1 AS dow,
           row_number() OVER (PARTITION BY year(day), month(day), dayofweek(day) ORDER BY day) AS in_month,
           row_number() OVER (PARTITION BY year(day), quarter(day), dayofweek(day) ORDER BY day) AS in_quarter,
           row_number() OVER (PARTITION BY year(day), dayofweek(day) ORDER BY day) AS in_year,
           row_number() OVER (PARTITION BY year(day), month(day), dayofweek(day) ORDER BY day DESC) AS from_end
    FROM ({DAYS})"""
WEEK = "CAST(strftime({0}, '%U') AS INTEGER) + CASE WHEN dayofweek(date_trunc('year', {0})) = 0 THEN 0 ELSE 1 END"
HOLIDAY = """CASE
    WHEN m = 11 AND dow = 3 AND dd BETWEEN 2 AND 8 THEN 'Election Day'
    WHEN m = 12 AND dd = 25 THEN 'Christmas Day'
    WHEN m = 11 AND dow = 5 AND in_month = 4 THEN 'Thanksgiving Day'
    WHEN m = 11 AND dd = 11 THEN 'Veterans Day'
    WHEN m = 10 AND dd = 31 THEN 'Halloween'
    WHEN m = 10 AND dow = 2 AND in_month = 2 THEN 'Columbus Day'
    WHEN m = 9 AND dow = 2 AND in_month = 1 THEN 'Labor Day'
    WHEN m = 7 AND dd = 4 THEN 'Independence Day'
    WHEN m = 6 AND dow = 1 AND in_month = 3 THEN 'Father''s Day'
    WHEN m = 5 AND dow = 1 AND in_month = 2 THEN 'Mother''s Day'
    WHEN m = 5 AND dow = 2 AND from_end = 1 THEN 'Memorial Day'
    WHEN m = 3 AND dd = 17 THEN 'Saint Patrick''s Day'
    WHEN m = 2 AND dow = 2 AND in_month = 3 THEN 'President''s Day'
    WHEN m = 2 AND dd = 14 THEN 'Valentine''s Day'
    WHEN m = 1 AND dow = 2 AND in_month = 3 THEN 'Martin Luther King, Jr. Day'
    WHEN m = 1 AND dd = 1 THEN 'New Year''s Day' END"""
PER_DAY = "LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) o ON o.od = day"


@query("date_spine", f"SELECT day, coalesce(n, 0) AS n_orders FROM ({DAYS}) {PER_DAY}", "day:D n_orders")
def date_spine_query(spark, sf):
    return counted(date_spine_of(order_days(spark, sf), "day"), orders_per_day(spark, sf))


@query("date_key", """
    SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS DateKey, strftime(l_shipdate, '%m/%d/%Y') AS FullDate,
           count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1, 2""")
def date_key_query(spark, sf):
    d = F.col("l_shipdate").cast("date")
    lines = read(spark, sf, "lineitem").groupBy(d.alias("d")).agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").cast("long").alias("quantity")
    )
    return lines.select(D.date_key(F.col("d")).alias("DateKey"), D.us_date_text(F.col("d")).alias("FullDate"), "n_lines", "quantity")


@query("day_suffix", """
    SELECT o_orderkey, dayofmonth(o_orderdate) || CASE
        WHEN dayofmonth(o_orderdate) IN (11, 12, 13) THEN 'th' WHEN dayofmonth(o_orderdate) % 10 = 1 THEN 'st'
        WHEN dayofmonth(o_orderdate) % 10 = 2 THEN 'nd' WHEN dayofmonth(o_orderdate) % 10 = 3 THEN 'rd' ELSE 'th' END AS DaySuffix
    FROM orders""")
def day_suffix_query(spark, sf):
    return order_days(spark, sf).select("o_orderkey", D.day_suffix(F.col("day")).alias("DaySuffix"))


@query("weekday_occurrence", f"""
    SELECT o_orderkey, in_month, in_quarter, in_year FROM orders JOIN ({COUNTED_DAYS}) ON day = CAST(o_orderdate AS DATE)""")
def weekday_occurrence_query(spark, sf):
    d = F.col("day")
    return order_days(spark, sf).select(
        "o_orderkey", *[D.weekday_occurrence(d, p).alias(f"in_{p}") for p in ("month", "quarter", "year")]
    )


@query("week_of_year_us", f"""
    SELECT o_orderkey, {WEEK.format('o_orderdate')} AS WeekOfYear,
           {WEEK.format('o_orderdate')} + 1 - ({WEEK.format("date_trunc('month', o_orderdate)")}) AS WeekOfMonth
    FROM orders""")
def week_of_year_query(spark, sf):
    d = F.col("day")
    return order_days(spark, sf).select(
        "o_orderkey", D.week_of_year_us(d).alias("WeekOfYear"), D.week_of_month_us(d).alias("WeekOfMonth")
    )


@query("period_bounds", """
    SELECT o_orderkey, date_trunc('month', o_orderdate) AS FirstDayOfMonth, last_day(o_orderdate) AS LastDayOfMonth,
           date_trunc('quarter', o_orderdate) AS FirstDayOfQuarter,
           date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS LastDayOfQuarter,
           make_date(year(o_orderdate), 1, 1) AS FirstDayOfYear, make_date(year(o_orderdate), 12, 31) AS LastDayOfYear
    FROM orders""",
    "o_orderkey FirstDayOfMonth:D LastDayOfMonth:D FirstDayOfQuarter:D LastDayOfQuarter:D FirstDayOfYear:D LastDayOfYear:D")
def period_bounds_query(spark, sf):
    bounds = D.period_bounds(F.col("day"))
    return order_days(spark, sf).select("o_orderkey", *[c.alias(n) for n, c in bounds.items()])


_TEXT_CODES = {"DayOfMonth", "DayOfWeek", "DayOfWeekInMonth", "DayOfWeekInYear", "DayOfQuarter", "DayOfYear", "WeekOfMonth",
               "WeekOfQuarter", "WeekOfYear", "Month", "MonthOfQuarter", "Quarter", "Year"}
_KIND = {**{c: ":s" for c in _TEXT_CODES}, "Date": ":t", "IsHoliday": ":b", "IsWeekday": ":b",
         **{f"{e}DayOf{p}": ":D" for e in ("First", "Last") for p in ("Month", "Quarter", "Year")}}


@query("dim_date", f"""
    SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS DateKey, CAST(day AS TIMESTAMP) AS "Date", strftime(day, '%m/%d/%Y') AS FullDate,
           dd AS DayOfMonth, dd || CASE WHEN dd BETWEEN 11 AND 13 THEN 'th' WHEN dd % 10 = 1 THEN 'st' WHEN dd % 10 = 2 THEN 'nd'
                                        WHEN dd % 10 = 3 THEN 'rd' ELSE 'th' END AS DaySuffix,
           dayname(day) AS DayName, dow AS DayOfWeek, in_month AS DayOfWeekInMonth, in_year AS DayOfWeekInYear,
           in_quarter AS DayOfQuarter, dayofyear(day) AS DayOfYear,
           {WEEK.format('day')} + 1 - ({WEEK.format("date_trunc('month', day)")}) AS WeekOfMonth,
           date_diff('day', CAST(date_trunc('quarter', day) AS DATE), day) // 7 + 1 AS WeekOfQuarter, {WEEK.format('day')} AS WeekOfYear,
           m AS "Month", monthname(day) AS MonthName,
           CASE WHEN m IN (1, 4, 7, 10) THEN 1 WHEN m IN (2, 5, 8, 11) THEN 2 ELSE 3 END AS MonthOfQuarter,
           quarter(day) AS "Quarter",
           CASE quarter(day) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END AS QuarterName,
           y AS "Year", 'CY ' || y AS YearName, substr(monthname(day), 1, 3) || '-' || y AS MonthYear, strftime(day, '%m%Y') AS MMYYYY,
           date_trunc('month', day) AS FirstDayOfMonth, last_day(day) AS LastDayOfMonth,
           date_trunc('quarter', day) AS FirstDayOfQuarter,
           date_trunc('quarter', day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS LastDayOfQuarter,
           make_date(y, 1, 1) AS FirstDayOfYear, make_date(y, 12, 31) AS LastDayOfYear,
           ({HOLIDAY}) IS NOT NULL AS IsHoliday, dow BETWEEN 2 AND 6 AS IsWeekday, {HOLIDAY} AS HolidayName,
           coalesce(n, 0) AS n_orders
    FROM ({COUNTED_DAYS}) {PER_DAY}""",
    " ".join(c + _KIND.get(c, "") for c in CALENDAR_COLUMNS) + " n_orders")
def dim_date_query(spark, sf):
    calendar = build_calendar(date_spine_of(order_days(spark, sf), "day"), fiscal=None)
    per_day = orders_per_day(spark, sf).withColumnRenamed("day", "_day")
    return counted(calendar.withColumn("_day", F.col("Date").cast("date")), per_day, "_day").drop("_day")


_LITERAL = """CASE
    WHEN m = 1 AND dd = 1 THEN 'New Year''s Day' WHEN m = 2 AND dd = 14 THEN 'Valentine''s Day'
    WHEN m = 3 AND dd = 17 THEN 'Saint Patrick''s Day' WHEN m = 7 AND dd = 4 THEN 'Independance Day'
    WHEN m = 10 AND dd = 31 THEN 'Halloween' WHEN m = 11 AND dd = 11 THEN 'Veterans Day'
    WHEN m = 12 AND dd = 25 THEN 'Christmas Day' END"""


def _holidays(spark, sf, mode):
    spine = date_spine_of(order_days(spark, sf), "day").withColumn("HolidayName", D.holiday_name(F.col("day"), mode))
    return counted(spine.filter(F.col("HolidayName").isNotNull()), orders_per_day(spark, sf))


@query("holiday_calendar", f"""
    SELECT day, {HOLIDAY} AS HolidayName, coalesce(n, 0) AS n_orders
    FROM ({COUNTED_DAYS}) {PER_DAY} WHERE ({HOLIDAY}) IS NOT NULL""", "day:D HolidayName n_orders")
def holiday_query(spark, sf):
    return _holidays(spark, sf, "intended")


@query("holiday_calendar_literal", f"""
    SELECT day, {_LITERAL} AS HolidayName, coalesce(n, 0) AS n_orders
    FROM ({COUNTED_DAYS}) {PER_DAY} WHERE ({_LITERAL}) IS NOT NULL""", "day:D HolidayName n_orders")
def holiday_literal_query(spark, sf):
    return _holidays(spark, sf, "literal")


_BANDS = {
    "445": [4, 4, 5] * 4,
    "454": [4, 5, 4] * 4,
}


def fiscal_sql(start: str, first_year: int, first_long: int, pattern: str) -> str:
    """Every fiscal day, its week and month by counting, its bounds by windows over the days."""
    bands, week = [], 0
    for month, weeks in enumerate(_BANDS[pattern], start=1):
        low, week = week + 1, week + weeks
        longer = "+ extra" if month >= 11 else ""
        bands.append(f"WHEN wk BETWEEN {low} {'+ extra' if month == 12 else ''} AND {week} {longer} THEN {month}")
    years = f"SELECT fy, CASE WHEN (fy - {first_long}) % 6 = 0 THEN 1 ELSE 0 END AS extra FROM range({first_year}, 2031) t(fy)"
    starts = f"""SELECT fy, extra, DATE '{start}' + CAST(coalesce(sum(364 + 7 * extra) OVER
        (ORDER BY fy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS first FROM ({years})"""
    days = f"""SELECT fy, extra, first + CAST(i AS INTEGER) AS day, i + 1 AS fday, i // 7 + 1 AS wk
        FROM ({starts}) s, range(0, 371) r(i) WHERE i < 364 + 7 * extra"""
    months = f"SELECT *, CASE {' '.join(bands)} END AS fm FROM ({days})"
    quarters = f"SELECT *, (fm + 2) // 3 AS fq FROM ({months})"
    return f"""SELECT *, min(day) OVER (PARTITION BY fy, fm) AS m0, max(day) OVER (PARTITION BY fy, fm) AS m1,
           min(day) OVER (PARTITION BY fy, fq) AS q0, max(day) OVER (PARTITION BY fy, fq) AS q1,
           min(day) OVER (PARTITION BY fy) AS y0, max(day) OVER (PARTITION BY fy) AS y1 FROM ({quarters})"""


_FISCAL_LIST = """CAST(fday AS VARCHAR) AS FiscalDayOfYear, CAST(wk AS VARCHAR) AS FiscalWeekOfYear, CAST(fm AS VARCHAR) AS FiscalMonth,
    CAST(fq AS VARCHAR) AS FiscalQuarter, CASE fq WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' WHEN 4 THEN 'Fourth' END AS FiscalQuarterName,
    CAST(fy AS VARCHAR) AS FiscalYear, 'FY ' || fy AS FiscalYearName,
    CASE fm WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul'
            WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dec' END || '-' || fy AS FiscalMonthYear,
    lpad(CAST(fm AS VARCHAR), 2, '0') || fy AS FiscalMMYYYY, m0 AS FiscalFirstDayOfMonth, m1 AS FiscalLastDayOfMonth,
    q0 AS FiscalFirstDayOfQuarter, q1 AS FiscalLastDayOfQuarter, y0 AS FiscalFirstDayOfYear, y1 AS FiscalLastDayOfYear"""
_FISCAL_SHAPE = " ".join(c + (":D" if "DayOf" in c and c != "FiscalDayOfYear" else "") for c in D.FISCAL_COLUMNS)


def fiscal_days(spark, sf, spec):
    calendar = build_calendar(date_spine_of(order_days(spark, sf), "day"), fiscal=spec)
    dated = calendar.select(F.col("Date").cast("date").alias("day"), *D.FISCAL_COLUMNS)
    return counted(dated, orders_per_day(spark, sf))


def _fiscal_days_sql(pattern):
    fiscal = fiscal_sql("1994-12-26", 1995, 1994, pattern)
    return f"SELECT d.day, {_FISCAL_LIST}, coalesce(n, 0) AS n_orders FROM ({DAYS}) d LEFT JOIN ({fiscal}) f ON f.day = d.day " + PER_DAY.replace("= day", "= d.day")


@query("fiscal_calendar", _fiscal_days_sql("445"), f"day:D {_FISCAL_SHAPE} n_orders")
def fiscal_query(spark, sf):
    return fiscal_days(spark, sf, FISCAL)


@query("fiscal_calendar_454", _fiscal_days_sql("454"), f"day:D {_FISCAL_SHAPE} n_orders")
def fiscal_454_query(spark, sf):
    return fiscal_days(spark, sf, D.FiscalCalendar(FISCAL.start, 1995, 2030, 1994, 6, "454"))


@query("fiscal_weeks_of_events", f"""
    SELECT fy AS FiscalYear, fm AS FiscalMonth, wk AS FiscalWeekOfYear, event_type, count(*) AS n_events
    FROM events JOIN ({fiscal_sql("2014-12-29", 2015, 2012, "445")}) ON day = CAST(ts AS DATE) GROUP BY ALL""")
def fiscal_events_query(spark, sf):
    """Events by fiscal week, with the default fiscal calendar applied to the rows themselves."""
    events = D.with_fiscal(read(spark, sf, "events").select("ts", "event_type"), "ts")
    return events.groupBy("FiscalYear", "FiscalMonth", "FiscalWeekOfYear", "event_type").agg(F.count("*").alias("n_events"))


@query("fiscal_period_bounds", f"""
    SELECT fy AS FiscalYear, fq AS FiscalQuarter, fm AS FiscalMonth, min(m0) AS FirstDayOfMonth, max(m1) AS LastDayOfMonth,
           min(q0) AS FirstDayOfQuarter, max(q1) AS LastDayOfQuarter, min(y0) AS FirstDayOfYear, max(y1) AS LastDayOfYear,
           count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS revenue
    FROM orders JOIN ({fiscal_sql("1994-12-26", 1995, 1994, "445")}) ON day = CAST(o_orderdate AS DATE) GROUP BY ALL""",
    "FiscalYear FiscalQuarter FiscalMonth FirstDayOfMonth:D LastDayOfMonth:D FirstDayOfQuarter:D LastDayOfQuarter:D "
    "FirstDayOfYear:D LastDayOfYear:D n_orders revenue:d")
def fiscal_bounds_query(spark, sf):
    """Bounds and revenue of every fiscal month that has orders."""
    orders = read(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("amount")
    )
    bounds = [c for c in D.FISCAL_COLUMNS if "DayOf" in c and c != "FiscalDayOfYear"]
    keys = ["FiscalYear", "FiscalQuarter", "FiscalMonth", *[F.col(c).alias(c.removeprefix("Fiscal")) for c in bounds]]
    return D.with_fiscal(orders, "day", FISCAL).groupBy(*keys).agg(F.sum("n").alias("n_orders"), F.sum("amount").alias("revenue"))


@query("fiscal_long_years", f"""
    SELECT fy AS FiscalYear, count(*) AS n_orders, max(fday) AS last_order_day
    FROM orders JOIN ({fiscal_sql("1994-12-26", 1995, 1994, "445")}) ON day = CAST(o_orderdate AS DATE) WHERE extra = 1 GROUP BY fy""")
def long_years_query(spark, sf):
    """Orders that fall into 53-week years."""
    per_day = orders_per_day(spark, sf)
    dated = D.with_fiscal(per_day, "day", FISCAL).join(long_fiscal_years(spark, FISCAL), "FiscalYear")
    return dated.groupBy("FiscalYear").agg(F.sum("n_orders").alias("n_orders"), F.max("FiscalDayOfYear").alias("last_order_day"))
