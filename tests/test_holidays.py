from datetime import date

import pytest

from panelcast.operators import holidays as hol


def source(spark, *rows):
    return spark.createDataFrame(
        [(date.fromisoformat(d) if d else None, n, i) for i, (d, n) in enumerate(rows)], "ds date, name string, seq long"
    )


def collect(df):
    return sorted((r["holiday"], r["ds"].isoformat(), r["lower_window"], r["upper_window"]) for r in df.collect())


@pytest.fixture
def calendar(spark):
    return source(
        spark, ("2020-10-03", "Sukkot (Day 1) "), ("2020-10-04", "Sukkot (Day 2)"), ("2020-03-10", "Purim"),
        ("2020-03-02", "Election Day"), ("2020-03-02", "Second Name"), ("2019-03-21", "Purim"), (None, "Purim"),
        ("2021-02-26", None),
    )


def test_names_as_they_come_mostly_miss_their_group(calendar):
    got = collect(hol.holiday_table([calendar], "2020-01-01", "2020-12-31"))
    assert got == [("other", "2020-03-02", 0, 7), ("purim", "2020-03-10", 0, 7)]


def test_underscored_names_find_their_group(calendar):
    rules = hol.HolidayRules(normalize="underscore")
    got = collect(hol.holiday_table([calendar], "2019-01-01", "2020-12-31", rules))
    assert got == [
        ("other", "2020-03-02", 0, 7), ("purim", "2019-03-21", 0, 7), ("purim", "2020-03-10", 0, 7),
        ("sukkot", "2020-10-03", 0, 14),
    ]


def test_range_filter_comes_after_the_first_day_rule(calendar):
    rules = hol.HolidayRules(normalize="underscore")
    assert collect(hol.holiday_table([calendar], "2020-10-04", "2020-12-31", rules)) == []


def test_primary_source_and_file_order_win(spark, calendar):
    second = source(spark, ("2020-03-10", "other name"), ("2020-05-01", "Shavuot"))
    kept = {r["ds"].isoformat(): (r["name"], r["n_dropped"]) for r in hol.one_per_date(hol.stack_sources(calendar, second)).collect()}
    assert kept["2020-03-10"] == ("purim", 1)
    assert kept["2020-03-02"] == ("election day", 1)
    assert kept["2020-05-01"] == ("shavuot", 0)
    assert len(kept) == 6


def test_unknown_mode():
    with pytest.raises(ValueError, match="name mode"):
        hol.HolidayRules(normalize="upper")
