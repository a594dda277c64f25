"""Date expressions."""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.scalar import as_column


def day(value: str | date) -> Column:
    """A date literal."""
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))


def between_days(column: str | Column, start: str | date, end: str | date) -> Column:
    """Both ends included; literal bounds reach the Parquet scan."""
    return as_column(column).between(day(start), day(end))


def in_months(column: str | Column, months: Iterable[str]) -> Column:
    """Whether the day lies in one of the 'yyyy-mm' months, as date ranges the scan can prune by."""
    column = as_column(column)
    hit = F.lit(False)
    for month in sorted(months):
        first = date.fromisoformat(month + "-01")
        following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
        hit = hit | ((column >= day(first)) & (column < day(following)))
    return hit


def weekday(column: str | Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(as_column(column))


def is_weekend(column: str | Column) -> Column:
    return (weekday(column) >= 5).cast("int")


def week_start(column: str | Column) -> Column:
    """The Monday on or before the day."""
    return F.trunc(as_column(column), "week")


def days_from(start: Column, end: Column) -> Column:
    """Array of days, both ends included; empty for a reversed range instead of an error."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def position_between(column: str | Column, start: str | date, end: str | date) -> Column:
    """0 at `start`, 1 at `end`, linear by calendar day."""
    return F.try_divide(F.datediff(as_column(column), day(start)), F.datediff(day(end), day(start)))
