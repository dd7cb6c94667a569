from datetime import date

import pytest
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal


def evaluate(spark, days, *columns):
    df = spark.createDataFrame([(date.fromisoformat(d),) for d in days], "d date")
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    "day, expected",
    [
        ("2024-07-15", 0), ("2024-08-01", 0), ("2024-06-25", 0), ("2024-09-01", 1), ("2024-12-15", 1),
        ("2024-03-10", 1), ("2024-06-19", 1), ("2024-06-20", 0), ("2024-08-31", 0),
    ],
)
def test_school_in_session(spark, day, expected):
    assert evaluate(spark, [day], cal.school_in_session(F.col("d"))) == [(expected,)]


def test_weeks_since_school(spark):
    got = evaluate(spark, ["2024-09-01", "2024-10-01", "2024-03-01"], cal.weeks_since_school(F.col("d")))
    assert [g[0] for g in got] == pytest.approx([0, 30 / 7, 26.0])


def test_school_break_within_one_month_joins_both_day_tests(spark):
    school = cal.SchoolYear(summer_start=(7, 10), summer_end=(7, 20))
    got = evaluate(spark, ["2024-07-05", "2024-07-15", "2024-07-25"], cal.school_in_session(F.col("d"), school))
    assert got == [(0,), (0,), (0,)]


def test_epi_weeks_of_a_53_week_year(spark):
    first = date(2025, 11, 16)
    days = [date.fromordinal(first.toordinal() + 7 * i).isoformat() for i in range(35)]
    got = evaluate(spark, days, cal.epi_week(F.col("d")))
    assert [g[0] for g in got] == [*range(47, 54), *range(1, 29)]


def test_epi_year_and_iso_week_differ_at_new_year(spark):
    d = F.col("d")
    got = evaluate(spark, ["2011-01-02", "2026-01-04", "2025-12-28"], cal.epi_year(d), cal.epi_week(d), cal.iso_week(d))
    assert got == [(2011, 1, 52), (2026, 1, 1), (2025, 53, 52)]


def test_week_labels(spark):
    d = F.col("d")
    got = evaluate(spark, ["2024-01-07", "2024-01-08", "2024-01-13"], cal.week_starting(d), cal.week_ending(d))
    assert got == [
        (date(2024, 1, 7), date(2024, 1, 7)), (date(2024, 1, 7), date(2024, 1, 14)), (date(2024, 1, 7), date(2024, 1, 14)),
    ]


def test_grid_bounds():
    assert cal.grid_size("2011-01-02", "2025-11-09") == 776
    assert cal.grid_bounds("2024-01-01", "2024-01-20") == (date(2024, 1, 7), date(2024, 1, 14))
    with pytest.raises(ValueError, match="no Sunday"):
        cal.grid_bounds("2024-01-01", "2024-01-06")


def test_period_flags(spark):
    d, covid = F.col("d"), cal.Period()
    got = evaluate(
        spark, ["2020-02-29", "2020-03-01", "2021-06-30", "2021-07-01"],
        cal.in_period(d, covid), cal.after_period(d, covid),
    )
    assert got == [(0, 0), (1, 0), (1, 0), (0, 1)]
