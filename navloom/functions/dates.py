"""Date column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navloom import fixed_values as fixed


def as_date(value) -> Column:
    """A literal date from a ``date``, an ISO text or a column."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def years_ago(day: Column, years: int) -> Column:
    """Same day ``years`` earlier; 29 February falls back to 28 February."""
    return F.add_months(day, -12 * years)


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.date_sub(day, F.weekday(day))


def period_key(day: Column) -> Column:
    """``yyyy_2`` for June and ``yyyy_4`` for December, else null."""
    quarter = F.when(F.month(day) == 6, "2").when(F.month(day) == 12, "4")
    return F.concat(F.year(day).cast("string"), F.lit("_"), quarter)


def market_date_from_millis(millis: Column) -> Column:
    """Epoch milliseconds to the calendar day at a fixed +08:00.

    A named zone would apply summer time to days before 1992.
    """
    return utc_date_from_millis(millis + 28800000)


def utc_date_from_millis(millis: Column) -> Column:
    """Epoch milliseconds to the UTC day, whatever the session zone is."""
    return F.date_from_unix_date(F.floor(millis / 86400000).cast("int"))


def report_period_end(title: Column) -> Column:
    """Last day of the period a report title names; null for other titles."""
    digits = F.translate(F.regexp_extract(title, fixed.REPORT_YEAR, 1), *fixed.CHINESE_YEAR_DIGITS)
    quarter = F.translate(F.regexp_extract(title, fixed.REPORT_QUARTER, 1), "一二三四", "1234")
    month = (
        F.when(quarter != "", (quarter.try_cast("int") * 3).cast("string"))
        .when(title.rlike(fixed.REPORT_HALF), "6")
        .when(title.rlike(fixed.REPORT_ANNUAL), "12")
    )
    first = F.try_to_date(F.concat(digits, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-01")))
    return F.when(~title.rlike(fixed.REPORT_TITLE_REJECT) & (digits != ""), F.last_day(first))


def chinese_date(text: Column, pattern: str) -> Column:
    """Date from a pattern whose groups 1 to 3 are year, month and day."""
    part = [F.lpad(F.regexp_extract(text, pattern, i), 2, "0") for i in (2, 3)]
    year = F.regexp_extract(text, pattern, 1)
    return F.when(year != "", F.try_to_date(F.concat_ws("-", year, *part)))
