from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast.operators import panel as pn


def day(text):
    return date.fromisoformat(text)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(*columns[:2]).collect()]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [
            ("a", day("2024-01-07"), None), ("a", day("2024-01-07"), None), ("a", day("2024-01-28"), 5.0),
            ("a", day("2024-01-28"), None), ("a", None, 9.0), ("b", day("2023-01-01"), 7.0), ("b", day("2023-01-08"), 1.0),
            ("c", day("2024-01-14"), 2.0), ("c", day("2024-01-17"), 50.0),
        ],
        "series_id string, week_start date, value double",
    )


def test_weekly_sum_of_nulls_is_zero_and_null_weeks_go(facts):
    got = rows(pn.weekly_sum(facts.filter("series_id = 'a'")), "series_id", "week_start", "y")
    assert got == [("a", day("2024-01-07"), 0.0), ("a", day("2024-01-28"), 5.0)]


def test_weekly_panel_keeps_series_without_facts_on_the_grid(facts):
    got = rows(pn.weekly_panel(facts, "2024-01-01", "2024-01-31"), "series_id", "week_start", "y")
    weeks = [day("2024-01-07") + timedelta(days=7 * i) for i in range(4)]
    assert got == (
        list(zip("aaaa", weeks, (0.0, None, None, 5.0)))
        + list(zip("bbbb", weeks, (None,) * 4))
        + list(zip("cccc", weeks, (None, 2.0, None, None)))
    )


def test_weekly_panel_equals_the_join(facts):
    grid = pn.week_grid(facts.select("series_id").distinct(), "2024-01-01", "2024-01-31")
    joined = pn.join_grid(grid, pn.weekly_sum(facts))
    single = pn.weekly_panel(facts, "2024-01-01", "2024-01-31")
    columns = ("series_id", "week_start", "year", "week", "y")
    assert rows(joined, *columns) == rows(single, *columns)


def test_temperature_bins_end_on_sunday(spark):
    days = [(day("2024-01-01") + timedelta(days=i), float(i), float(i)) for i in range(9)]
    daily = spark.createDataFrame([("s", *d) for d in days] + [("s", day("2024-01-03"), None, 1.0)],
                                  "station string, date date, tmax double, tmin double")
    got = rows(pn.weekly_mean_temperature(daily), "week_start", "tmean_c")
    assert got == [(day("2024-01-07"), 3.0), (day("2024-01-14"), 7.5)]


def test_weekly_wide_has_every_week_of_any_code(spark, facts):
    wide = pn.weekly_wide(facts, ["a", "c"])
    assert rows(wide, "week_start", "a_ILI_CASE", "c_ILI_CASE") == [
        (day("2024-01-07"), 0.0, None), (day("2024-01-14"), None, 2.0), (day("2024-01-17"), None, 50.0),
        (day("2024-01-28"), 5.0, None),
    ]
    with pytest.raises(ValueError, match="no leading series"):
        pn.weekly_wide(facts, [])


def test_split(weekly):
    panel = weekly("2020-01-05", a=range(100))
    parts = {r["part"]: r for r in pn.split(panel, "2021-01-01").groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("week_start").alias("lo"), F.max("week_start").alias("hi")).collect()}
    assert (parts["train"]["n"], parts["test"]["n"]) == (52, 48)
    assert parts["train"]["hi"] <= day("2021-01-01") < parts["test"]["lo"]


@pytest.mark.parametrize("bounds", [None, ("2020-01-05", "2020-03-08")])
def test_split_with_an_empty_part(weekly, bounds):
    panel = weekly("2020-01-05", a=range(10))
    with pytest.raises(ValueError, match="empty train"):
        pn.split(panel, "2019-01-01", bounds=bounds)
    with pytest.raises(ValueError, match="empty test"):
        pn.split(panel, "2020-03-08", bounds=bounds)


def test_reference_grid_and_split(spark):
    grid = pn.week_grid(spark.createDataFrame([("x",)], "series_id string"), "2011-01-02", "2025-11-09")
    counts = pn.split(grid, "2023-06-01").groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in counts} == {"train": 648, "test": 128}


def test_null_audit(weekly):
    got = {r["column"]: r for r in pn.null_audit(weekly(a=[None, 1, 2, None]), ["y", "week_start"]).collect()}
    assert (got["y"]["n_null"], got["y"]["pct_null"], got["week_start"]["n_null"]) == (2, 50.0, 0)


def test_horizon_and_last_weeks(weekly):
    panel = weekly("2024-01-07", a=range(70), b=range(3))
    ahead = pn.horizon(panel, 2)
    assert rows(ahead.filter("series_id = 'b'"), "series_id", "step", "week_start", "week") == [
        ("b", 1, day("2024-01-28"), 5), ("b", 2, day("2024-02-04"), 6)]
    kept = {r["series_id"]: r["count"] for r in pn.last_weeks(panel).groupBy("series_id").count().collect()}
    assert kept == {"a": 61, "b": 3}
