"""Calendar columns against a day-by-day replay with running counters."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.functions import dates as D
from starloom.plans.calendar import CALENDAR_COLUMNS, build_calendar, date_spine, date_spine_of, long_fiscal_years

START, END = date(2005, 1, 1), date(2028, 1, 1)


@pytest.fixture(scope="module")
def calendar(spark):
    return build_calendar(date_spine(spark)).orderBy("DateKey").collect()


def days():
    return [START + timedelta(n) for n in range((END - START).days)]


def test_rows_and_columns(spark, calendar):
    assert len(calendar) == 8400
    assert list(calendar[0].asDict()) == CALENDAR_COLUMNS + D.FISCAL_COLUMNS
    assert [r.DateKey for r in calendar] == [int(f"{d:%Y%m%d}") for d in days()]


def test_running_counters(calendar):
    """The n-th weekday of month, quarter and year, counted day by day."""
    month, quarter, year = Counter(), Counter(), Counter()
    for d, r in zip(days(), calendar):
        w, q = d.weekday(), (d.month - 1) // 3
        month[d.year, d.month, w] += 1
        quarter[d.year, q, w] += 1
        year[d.year, w] += 1
        got = (int(r.DayOfWeekInMonth), int(r.DayOfQuarter), int(r.DayOfWeekInYear))
        assert got == (month[d.year, d.month, w], quarter[d.year, q, w], year[d.year, w]), d
        assert r.WeekOfQuarter == r.DayOfQuarter


def test_weeks_start_on_sunday(calendar):
    week = {}
    number = 0
    for d, r in zip(days(), calendar):
        if d.month == 1 and d.day == 1:
            number = 1
        elif d.weekday() == 6:
            number += 1
        week[d] = number
        assert int(r.WeekOfYear) == number, d
        assert int(r.WeekOfMonth) == number + 1 - week[d.replace(day=1)], d
    assert max(week.values()) == 53
    assert max(int(r.WeekOfMonth) for r in calendar) == 6


def test_labels_and_bounds(calendar):
    r = {x.DateKey: x for x in calendar}[20240222]
    assert (r.FullDate, r.DaySuffix, r.DayName, r.DayOfWeek) == ("02/22/2024", "22nd", "Thursday", "5")
    assert (r.MonthYear, r.MMYYYY, r.YearName, r.QuarterName) == ("Feb-2024", "022024", "CY 2024", "First")
    assert (r.LastDayOfMonth, r.FirstDayOfQuarter, r.LastDayOfQuarter) == (date(2024, 2, 29), date(2024, 1, 1), date(2024, 3, 31))
    assert (r.FirstDayOfYear, r.LastDayOfYear) == (date(2024, 1, 1), date(2024, 12, 31))
    suffixes = {int(x.DayOfMonth): x.DaySuffix for x in calendar}
    assert [suffixes[n] for n in (1, 2, 3, 4, 11, 12, 13, 21, 22, 23, 31)] == [
        "1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "23rd", "31st"]


def test_weekdays_and_holidays(spark, calendar):
    assert sum(r.IsWeekday for r in calendar) == 6000
    assert sum(r.IsHoliday for r in calendar) == 368
    names = {r.DateKey: r.HolidayName for r in calendar}
    assert names[20240527] == "Memorial Day" and names[20201103] == "Election Day" and names[20221108] == "Election Day"
    assert names[20231123] == "Thanksgiving Day" and names[20240902] == "Labor Day" and names[20250704] == "Independence Day"
    assert Counter(n for n in names.values() if n) == {h.name: 23 for h in D.HOLIDAYS}
    literal = build_calendar(date_spine(spark), "literal", None).filter("IsHoliday").collect()
    assert len(literal) == 161 and {r.HolidayName for r in literal if r.DateKey % 10000 == 704} == {"Independance Day"}
    with pytest.raises(ValueError):
        D.holiday_name(F.lit(None), "other")


def replay(spec: D.FiscalCalendar, until: date):
    """Fiscal calendar by walking the days and resetting counters."""
    ends = spec.week_ends()
    year, day, out, d = spec.first_year, 1, {}, spec.start
    while d < until:
        extra = int(year >= spec.first_long_year and (year - spec.first_long_year) % spec.long_every == 0)
        week = (day - 1) // 7 + 1
        month = next(m for m, e in enumerate(ends, start=1) if week <= e + (extra if m >= 11 else 0))
        out[d] = (day, week, month, (month + 2) // 3, year)
        d, day = d + timedelta(1), day + 1
        if day > 364 + 7 * extra:
            year, day = year + 1, 1
    return out


@pytest.mark.parametrize("pattern", ["445", "454"])
def test_fiscal_replay(spark, pattern):
    spec = D.FiscalCalendar(pattern=pattern)
    end = date(2101, 1, 1)
    want = replay(spec, end)
    got = D.with_fiscal(date_spine(spark, date(2014, 12, 1), date(2101, 3, 1)), "day", spec).collect()
    groups = {}
    for d, v in want.items():
        for key in (("y", v[4]), ("q", v[4], v[3]), ("m", v[4], v[2])):
            lo, hi = groups.get(key, (d, d))
            groups[key] = (min(lo, d), max(hi, d))
    for r in got:
        v = want.get(r.day)
        if v is None:
            assert r[1:] == (None,) * 15, r.day
            continue
        assert (r.FiscalDayOfYear, r.FiscalWeekOfYear, r.FiscalMonth, r.FiscalQuarter, r.FiscalYear) == v, r.day
        assert (r.FiscalFirstDayOfMonth, r.FiscalLastDayOfMonth) == groups["m", v[4], v[2]]
        assert (r.FiscalFirstDayOfQuarter, r.FiscalLastDayOfQuarter) == groups["q", v[4], v[3]]
        assert (r.FiscalFirstDayOfYear, r.FiscalLastDayOfYear) == groups["y", v[4]]


def test_fiscal_facts(calendar):
    lengths = Counter(r.FiscalYear for r in calendar if r.FiscalYear)
    assert lengths["2018"] == lengths["2024"] == 371 and lengths["2019"] == 364
    assert sum(r.FiscalYear is None for r in calendar) == 3649
    first = {r.FiscalYear: r.FiscalFirstDayOfYear for r in calendar}
    assert first["2025"] == date(2024, 12, 30)
    assert {r.FiscalQuarterName for r in calendar if r.FiscalYear is None} == {None}


def test_long_years(spark):
    years = [r[0] for r in long_fiscal_years(spark).collect()]
    assert years == list(range(2012, 2100, 6))


def test_fiscal_arguments():
    with pytest.raises(ValueError):
        D.FiscalCalendar(pattern="544")
    with pytest.raises(ValueError):
        D.FiscalCalendar(first_year=2015, first_long_year=2030)
    with pytest.raises(ValueError):
        D.weekday_occurrence(F.lit(None), "week")


def test_spine_follows_the_data(spark):
    df = spark.createDataFrame([("1999-05-03",), ("2001-02-01",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    got = date_spine_of(df, "d").agg(F.min("day"), F.max("day"), F.count("*")).first()
    assert tuple(got) == (date(1999, 1, 1), date(2001, 12, 31), 1096)
    assert date_spine_of(df.filter("d IS NULL"), "d").count() == 0
