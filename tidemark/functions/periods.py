"""Calendar expressions: period ends, bounds, expected sequences and month distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = {"monthly": 1, "quarterly": 3, "annual": 12}


def month_end(year: Column, month: Column) -> Column:
    """G05."""
    return F.last_day(F.make_date(year, month, F.lit(1)))


def quarter_end(year: Column, quarter: Column) -> Column:
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def months_between_ends(later: Column, earlier: Column) -> Column:
    """Month boundaries crossed, not elapsed months."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def bounds(period: Column, frequency: Column) -> tuple[Column, Column]:
    """First and last day of the period that ends on or holds the date."""
    step = F.when(frequency == "annual", 12).when(frequency == "quarterly", 3).otherwise(1)
    ends = F.last_day(period)
    begins = F.to_date(F.trunc(F.add_months(period, 1 - step), "month"))
    daily = frequency == "daily"
    return F.when(daily, period).otherwise(begins), F.when(daily, period).otherwise(ends)


def expected(first: Column, last: Column, months: int) -> Column:
    """Every period end from first to last."""
    each = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr(f"interval {months} month"))
    return F.transform(each, F.last_day)


def serial_date(number: Column) -> Column:
    """The date of a spreadsheet serial between 20000 and 80000."""
    return F.when((number > 20000) & (number < 80000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(number).cast("int")))


def typed_date(text: Column) -> Column:
    """A date written in one of four forms."""
    return F.coalesce(*(F.try_to_date(text, f) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")))


def inferred_frequency(median_gap_months: Column) -> Column:
    """By the median distance of neighbouring periods."""
    return F.when(median_gap_months <= 1.5, "monthly").when(median_gap_months <= 4, "quarterly").otherwise("annual")
