"""Column functions of the calendar: pure expressions on a DATE column, no join, no UDF."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quarter names and weekday numbers (Sunday = 1).
QUARTER_NAMES = ["First", "Second", "Third", "Fourth"]
SUNDAY, MONDAY, TUESDAY, THURSDAY, SATURDAY = 1, 2, 3, 5, 7


def date_key(d: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def us_date_text(d: Column) -> Column:
    return F.date_format(d, "MM/dd/yyyy")


def day_suffix(d: Column) -> Column:
    """Day of month with its English ordinal ending."""
    day = F.dayofmonth(d)
    last = day % 10
    ending = (
        F.when(day.between(11, 13), "th")
        .when(last == 1, "st")
        .when(last == 2, "nd")
        .when(last == 3, "rd")
        .otherwise("th")
    )
    return F.concat(day.cast("string"), ending)


def _sevenths(days: Column) -> Column:
    return (F.floor(days / 7) + 1).cast("int")


def weekday_occurrence(d: Column, period: str) -> Column:
    """n-th time this weekday occurs in its month, quarter or year."""
    if period == "month":
        return _sevenths(F.dayofmonth(d) - 1)
    if period == "quarter":
        return _sevenths(F.datediff(d, F.trunc(d, "QUARTER")))
    if period == "year":
        return _sevenths(F.dayofyear(d) - 1)
    raise ValueError("period must be month, quarter or year")


def week_of_year_us(d: Column) -> Column:
    """Week number with week 1 holding 1 January and weeks starting on Sunday."""
    first = F.dayofweek(F.trunc(d, "YEAR"))
    return _sevenths(F.dayofyear(d) + first - 2)


def week_of_month_us(d: Column) -> Column:
    return week_of_year_us(d) + 1 - week_of_year_us(F.trunc(d, "MONTH").cast("date"))


def week_of_quarter(d: Column) -> Column:
    return weekday_occurrence(d, "quarter")


def month_of_quarter(d: Column) -> Column:
    return (F.month(d) - 1) % 3 + 1


def quarter_name(quarter: Column) -> Column:
    chain = F.when(quarter == 1, QUARTER_NAMES[0])
    for number, name in enumerate(QUARTER_NAMES[1:], start=2):
        chain = chain.when(quarter == number, name)
    return chain


def is_weekday(d: Column) -> Column:
    return ~F.dayofweek(d).isin(SUNDAY, SATURDAY)


def period_bounds(d: Column) -> dict[str, Column]:
    """First and last day of the month, quarter and year."""
    quarter = F.trunc(d, "QUARTER")
    year = F.trunc(d, "YEAR")
    return {
        "FirstDayOfMonth": F.trunc(d, "MONTH"),
        "LastDayOfMonth": F.last_day(d),
        "FirstDayOfQuarter": quarter,
        "LastDayOfQuarter": F.date_sub(F.add_months(quarter, 3), 1),
        "FirstDayOfYear": year,
        "LastDayOfYear": F.date_sub(F.add_months(year, 12), 1),
    }


@dataclass(frozen=True)
class Holiday:
    """A yearly rule: a fixed day, or the n-th (``-1`` = last) weekday of a month."""

    name: str
    month: int
    day: int | None = None
    weekday: int | None = None
    nth: int | None = None
    since: int | None = None
    after_first_monday: bool = False
    literal_name: str | None = None


# The holiday table, later entries win over earlier ones.
HOLIDAYS = [
    Holiday("New Year's Day", 1, day=1),
    Holiday("Martin Luther King, Jr. Day", 1, weekday=MONDAY, nth=3, since=1983),
    Holiday("Valentine's Day", 2, day=14),
    Holiday("President's Day", 2, weekday=MONDAY, nth=3),
    Holiday("Saint Patrick's Day", 3, day=17),
    Holiday("Memorial Day", 5, weekday=MONDAY, nth=-1),
    Holiday("Mother's Day", 5, weekday=SUNDAY, nth=2),
    Holiday("Father's Day", 6, weekday=SUNDAY, nth=3),
    Holiday("Independence Day", 7, day=4, literal_name="Independance Day"),
    Holiday("Labor Day", 9, weekday=MONDAY, nth=1),
    Holiday("Columbus Day", 10, weekday=MONDAY, nth=2),
    Holiday("Halloween", 10, day=31),
    Holiday("Veterans Day", 11, day=11),
    Holiday("Thanksgiving Day", 11, weekday=THURSDAY, nth=4),
    Holiday("Christmas Day", 12, day=25),
    Holiday("Election Day", 11, weekday=TUESDAY, after_first_monday=True),
]


def _holiday_test(rule: Holiday, d: Column) -> Column:
    hit = F.month(d) == rule.month
    day = F.dayofmonth(d)
    if rule.day is not None:
        return hit & (day == rule.day)
    hit = hit & (F.dayofweek(d) == rule.weekday)
    if rule.after_first_monday:
        hit = hit & day.between(2, 8)
    elif rule.nth == -1:
        hit = hit & (F.month(F.date_add(d, 7)) != rule.month)
    else:
        hit = hit & (weekday_occurrence(d, "month") == rule.nth)
    return hit & (F.year(d) >= rule.since) if rule.since else hit


def holiday_name(d: Column, mode: str = "intended") -> Column:
    """US holiday label of a day.

    ``intended`` applies every rule. ``literal`` repeats what the original
    load labels: fixed days only, with its spelling of the July holiday.
    """
    if mode not in ("intended", "literal"):
        raise ValueError("mode must be intended or literal")
    label = F.lit(None).cast("string")
    for rule in HOLIDAYS:
        if mode == "literal" and rule.day is None:
            continue
        name = rule.literal_name if mode == "literal" and rule.literal_name else rule.name
        label = F.when(_holiday_test(rule, d), name).otherwise(label)
    return label


@dataclass(frozen=True)
class FiscalCalendar:
    """Week-based fiscal years of 52 weeks, with a 53rd week every ``long_every`` years."""

    start: date = date(2014, 12, 29)
    first_year: int = 2015
    last_year: int = 2100
    first_long_year: int = 2012
    long_every: int = 6
    pattern: str = "445"

    def __post_init__(self):
        if self.pattern not in ("445", "454"):
            raise ValueError("pattern must be 445 or 454")
        if self.first_long_year - self.first_year >= self.long_every:
            raise ValueError("first_long_year must fall before one full cycle from first_year")

    @property
    def long_position(self) -> int:
        """Index of the 53-week year within a cycle that starts at ``first_year``."""
        return (self.first_long_year - self.first_year) % self.long_every

    def week_ends(self) -> list[int]:
        """Last week of each month in a 52-week year."""
        ends, total = [], 0
        for weeks in [int(c) for c in self.pattern] * 4:
            total += weeks
            ends.append(total)
        return ends


FISCAL_COLUMNS = [
    "FiscalDayOfYear", "FiscalWeekOfYear", "FiscalMonth", "FiscalQuarter", "FiscalQuarterName",
    "FiscalYear", "FiscalYearName", "FiscalMonthYear", "FiscalMMYYYY",
    "FiscalFirstDayOfMonth", "FiscalLastDayOfMonth", "FiscalFirstDayOfQuarter",
    "FiscalLastDayOfQuarter", "FiscalFirstDayOfYear", "FiscalLastDayOfYear",
]


def with_fiscal(df: DataFrame, date_col: str, spec: FiscalCalendar = FiscalCalendar()) -> DataFrame:
    """Add the 15 fiscal columns, numbers as integers, by closed form from the day offset.

    Days before the first fiscal year or after ``last_year`` get nulls. Every
    step is a projection, so the function works on a fact-sized input too.
    """
    base = df.columns
    pos, ends = spec.long_position, spec.week_ends()
    cycle = spec.long_every * 364 + 7
    before_long = pos * 364
    limit = F.lit(date(spec.last_year, 12, 31))
    d = F.col(date_col).cast("date")
    inside = (d >= F.lit(spec.start)) & (d <= limit)

    out = df.withColumn("_n", F.when(inside, F.datediff(d, F.lit(spec.start))))
    out = out.withColumns({"_cycle": F.floor(F.col("_n") / cycle).cast("int"), "_r": F.col("_n") % cycle})
    r = F.col("_r")
    out = out.withColumn(
        "_i",
        F.when(r < before_long, F.floor(r / 364))
        .when(r < before_long + 371, pos)
        .otherwise(F.floor((r - 7) / 364))
        .cast("int"),
    )
    i = F.col("_i")
    out = out.withColumns({
        "_long": F.when(i == pos, 1).otherwise(0),
        "_y0": F.col("_cycle") * cycle + i * 364 + F.when(i > pos, 7).otherwise(0),
        "FiscalYear": F.lit(spec.first_year) + F.col("_cycle") * spec.long_every + i,
    })
    out = out.withColumn("FiscalDayOfYear", F.col("_n") - F.col("_y0") + 1)
    out = out.withColumn("FiscalWeekOfYear", F.floor((F.col("FiscalDayOfYear") - 1) / 7).cast("int") + 1)

    week, longer = F.col("FiscalWeekOfYear"), F.col("_long")

    def end_of(month: int) -> Column:
        return F.lit(ends[month - 1]) + longer if month >= 11 else F.lit(ends[month - 1])

    def pick(number: Column, values) -> Column:
        chain = F.when(number == 1, values[0])
        for k, v in enumerate(values[1:], start=2):
            chain = chain.when(number == k, v)
        return chain

    month = F.when(week <= end_of(1), 1)
    for m in range(2, 13):
        month = month.when(week <= end_of(m), m)
    out = out.withColumn("FiscalMonth", month)
    m = F.col("FiscalMonth")
    out = out.withColumn("FiscalQuarter", F.ceil(m / 3).cast("int"))
    q = F.col("FiscalQuarter")
    month_from = pick(m, [F.lit(0)] + [end_of(k) for k in range(1, 12)])
    month_to = pick(m, [end_of(k) for k in range(1, 13)])
    quarter_from = pick(q, [F.lit(0)] + [end_of(k) for k in (3, 6, 9)])
    quarter_to = pick(q, [end_of(k) for k in (3, 6, 9, 12)])

    def day(weeks: Column) -> Column:
        return F.date_add(F.lit(spec.start), (F.col("_y0") + weeks * 7).cast("int"))

    def last(weeks: Column) -> Column:
        return F.least(F.date_sub(day(weeks), 1), limit)

    known = F.col("_n").isNotNull()
    year_text = F.col("FiscalYear").cast("string")
    bounds = {
        "FiscalFirstDayOfMonth": day(month_from),
        "FiscalLastDayOfMonth": last(month_to),
        "FiscalFirstDayOfQuarter": day(quarter_from),
        "FiscalLastDayOfQuarter": last(quarter_to),
        "FiscalFirstDayOfYear": day(F.lit(0)),
        "FiscalLastDayOfYear": last(F.lit(52) + longer),
    }
    out = out.withColumns({
        "FiscalQuarterName": quarter_name(q),
        "FiscalYearName": F.concat(F.lit("FY "), year_text),
        "FiscalMonthYear": F.concat(F.date_format(F.make_date(F.lit(2000), m, F.lit(1)), "MMM"), F.lit("-"), year_text),
        "FiscalMMYYYY": F.concat(F.lpad(m.cast("string"), 2, "0"), year_text),
        **{name: F.when(known, expr) for name, expr in bounds.items()},
    })
    return out.select(*base, *FISCAL_COLUMNS)
