"""Scalar helpers with the null, rounding and failure rules of the warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31 00:00:00"
DAWN = "1900-01-01 00:00:00"


def ntz(value) -> Column:
    """A timestamp without time zone from a literal, a datetime or a column."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp_ntz")


def open_end() -> Column:
    """Sentinel end of a row that is still valid."""
    return ntz(OPEN_END)


def row_max(*cols) -> Column:
    """Largest value of one row; nulls are skipped, all null gives null."""
    items = [F.col(c) if isinstance(c, str) else c for c in cols]
    return items[0] if len(items) == 1 else F.greatest(*items)


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)


def any_differs(names, left: str, right: str) -> Column:
    """True if one of the tracked columns differs between two aliases."""
    return reduce(
        lambda a, b: a | b,
        [differs(F.col(f"{left}.`{n}`"), F.col(f"{right}.`{n}`")) for n in names],
        F.lit(False),
    )


def try_convert(col: Column, type_name: str) -> Column:
    """Cast that gives null where the value does not fit."""
    return F.trim(col.cast("string")).try_cast(type_name)


def later_of(first: Column, second: Column) -> Column:
    """Two-way date choice: the first where it is later, otherwise the second (even if null)."""
    return F.when(first > second, first).otherwise(second)


def allocate(header_amount: Column, line_total: Column, subtotal: Column, type_name: str = "decimal(19,4)") -> Column:
    """Part of a header amount that falls on a line; a zero subtotal gives null.

    The share is kept to 20 digits, so that only the final amount is rounded.
    """
    share = F.try_divide(line_total.cast("decimal(19,4)"), subtotal.cast("decimal(19,4)")).try_cast("decimal(26,20)")
    return (header_amount.cast("decimal(19,4)") * share).cast(type_name)


def line_amounts(qty: Column, price: Column, discount: Column) -> dict[str, Column]:
    """Gross, discount and net amount of an order line."""
    q = qty.cast("decimal(10,0)")
    p = price.cast("decimal(19,4)")
    d = discount.cast("decimal(5,4)")
    return {
        "LineAmount_Gross": (p * q).cast("double"),
        "LineDiscountAmount": (p * d * q).cast("double"),
        "LineAmount_Net": (p * (F.lit(1).cast("decimal(5,4)") - d) * q).cast("double"),
    }


def to_second(col: Column) -> Column:
    """Drop the fraction of a second; no time zone takes part."""
    seconds = F.extract(F.lit("SECOND"), col)
    return col - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (seconds - F.floor(seconds)).cast("decimal(18,6)"))


def survey_date(text: Column) -> Column:
    """Date text of a survey (ISO with a trailing Z, or mm/dd/yyyy) as a timestamp."""
    bare = F.replace(text, F.lit("Z"), F.lit(""))
    return F.coalesce(bare.try_cast("timestamp_ntz"), F.try_to_date(bare, "MM/dd/yyyy").cast("timestamp_ntz"))
