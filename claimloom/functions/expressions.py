"""Shared expressions with the arithmetic and null rules the warehouse relies on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, null where the denominator is zero or null (plain division would raise)."""
    return numerator / F.nullif(denominator, F.lit(0).cast("int"))


def rate(numerator: Column, denominator: Column, per: str, places: int) -> Column:
    """``per`` x numerator / denominator in decimals, rounded once, half away from zero."""
    return F.round(safe_divide(F.lit(per).cast("decimal(6,1)") * numerator, denominator), places)


def average_over(value: Column, frame: WindowSpec, places: int) -> Column:
    """Exact mean over a frame. ``avg`` of a bigint is a double; sum and count keep it decimal."""
    total = F.sum(value.cast("decimal(20,2)")).over(frame)
    return F.round(total / F.count(value).over(frame), places)


def same(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """All pairs equal, where null equals null."""
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) for a, b in zip(left, right, strict=True)])


def differs(left: Iterable[Column], right: Iterable[Column]) -> Column:
    return ~same(left, right)


def day_shift(day: Column, days: Column | int) -> Column:
    """A date moved by whole days."""
    offset = F.lit(days) if isinstance(days, int) else days
    return F.date_add(day, offset.cast("int"))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later`` as an integer."""
    return F.date_diff(later, earlier)


def pick(values: list[str], position: Column) -> Column:
    """The 1-based element of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def hash_uniform(seed: str, *identity: Column) -> Column:
    """A number in [0, 1) decided by the row's identity alone.

    Re-running a lost task, or splitting the rows differently, draws the same value again.
    """
    text = F.concat_ws(":", F.lit(seed), *[c.cast("string") for c in identity])
    digits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return digits / F.lit(float(16**12))


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Calendar columns of a date. Weeks and weekdays follow ISO: Monday is 1."""
    iso_day = F.weekday(day) + 1
    return {
        "calendar_date": day,
        "year_number": F.year(day).cast("smallint"),
        "quarter_number": F.quarter(day).cast("smallint"),
        "month_number": F.month(day).cast("smallint"),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day).cast("smallint"),
        "day_of_week": iso_day.cast("smallint"),
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day).cast("smallint"),
        "is_weekend": iso_day >= 6,
        "year_month": F.date_format(day, "yyyy-MM"),
    }
