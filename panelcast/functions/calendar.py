"""Week, school-year and period rules as column expressions."""

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK = timedelta(days=7)


@dataclass(frozen=True)
class SchoolYear:
    """Month/day pairs. A summer break that wraps the year end is not supported."""

    # Summer break and school start.
    summer_start: tuple[int, int] = (6, 20)
    summer_end: tuple[int, int] = (8, 31)
    start: tuple[int, int] = (9, 1)


@dataclass(frozen=True)
class Period:
    """A closed date interval."""

    # The covid period.
    start: date = date(2020, 3, 1)
    end: date = date(2021, 6, 30)


def as_date(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(str(value))


def grid_bounds(start, end) -> tuple[date, date]:
    """First and last Sunday within [start, end]."""
    start, end = as_date(start), as_date(end)
    first = start + timedelta(days=(6 - start.weekday()) % 7)
    last = end - timedelta(days=(end.weekday() + 1) % 7)
    if first > last:
        raise ValueError(f"no Sunday between {start} and {end}")
    return first, last


def grid_size(start, end) -> int:
    first, last = grid_bounds(start, end)
    return (last - first).days // 7 + 1


def week_starting(d: Column) -> Column:
    """Sunday on or before the date."""
    return F.next_day(F.date_sub(d, 7), "SUN")


def week_ending(d: Column) -> Column:
    """Sunday on or after the date."""
    return F.next_day(F.date_sub(d, 1), "SUN")


def _epi_wednesday(d: Column) -> Column:
    return F.date_add(week_starting(d), 3)


def epi_year(d: Column) -> Column:
    """Epidemiological year: the year that holds the Wednesday of the Sunday-based week."""
    return F.year(_epi_wednesday(d))


def epi_week(d: Column) -> Column:
    """Epidemiological week number, 1 to 53."""
    return (F.floor((F.dayofyear(_epi_wednesday(d)) - 1) / 7) + 1).cast("int")


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def in_period(d: Column, period: Period) -> Column:
    return d.between(F.lit(period.start), F.lit(period.end)).cast("int")


def after_period(d: Column, period: Period) -> Column:
    return (d > F.lit(period.end)).cast("int")


def school_in_session(d: Column, school: SchoolYear = SchoolYear()) -> Column:
    month, day = F.month(d), F.dayofmonth(d)
    (first_month, first_day), (last_month, last_day) = school.summer_start, school.summer_end
    closed = (
        ((month > first_month) & (month < last_month))
        | ((month == first_month) & (day >= first_day))
        | ((month == last_month) & (day <= last_day))
    )
    return F.when(closed, 0).otherwise(1)


def weeks_since_school(d: Column, school: SchoolYear = SchoolYear()) -> Column:
    """Weeks, with fraction, since the latest school start on or before the date."""
    month, day = (F.lit(v) for v in school.start)
    opening = F.make_date(F.year(d), month, day)
    latest = F.when(d < opening, F.make_date(F.year(d) - 1, month, day)).otherwise(opening)
    return F.greatest(F.datediff(d, latest) / F.lit(7.0), F.lit(0.0))
