import random
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.operators import seasons

# The published seasons (label, onset and its ISO week, peak and week, end and week, rows, peak value).
SEASONS = [
    (2011, "2011-01-02", 52, "2011-01-09", 1, "2011-03-27", 12, 13, 9784.0),
    (2012, "2011-11-06", 44, "2012-02-26", 8, "2012-04-01", 13, 22, 2924.0),
    (2013, "2012-11-04", 44, "2013-01-27", 4, "2013-03-17", 11, 20, 7450.0),
    (2014, "2013-11-17", 46, "2014-02-16", 7, "2014-04-06", 14, 21, 5478.0),
    (2015, "2014-11-02", 44, "2015-02-01", 5, "2015-03-29", 13, 22, 4900.0),
    (2016, "2015-11-15", 46, "2016-01-17", 2, "2016-03-13", 10, 18, 7262.0),
    (2017, "2016-11-13", 45, "2017-01-01", 52, "2017-03-12", 10, 18, 4562.0),
    (2018, "2017-11-05", 44, "2018-01-07", 1, "2018-03-25", 12, 21, 4818.0),
    (2019, "2018-10-21", 42, "2019-01-20", 3, "2019-03-24", 12, 23, 6292.0),
    (2020, "2019-11-10", 45, "2020-01-05", 1, "2020-03-08", 10, 18, 8380.0),
    (2022, "2021-12-05", 48, "2021-12-26", 51, "2022-01-30", 4, 9, 6392.0),
    (2023, "2022-11-06", 44, "2023-01-08", 1, "2023-03-26", 12, 21, 4214.0),
    (2024, "2023-11-19", 46, "2024-02-11", 6, "2024-04-14", 15, 22, 10424.0),
    (2025, "2024-11-03", 44, "2025-01-12", 2, "2025-04-20", 16, 25, 12646.0),
    (2026, "2025-10-19", 42, "2025-11-09", 45, "2025-11-09", 45, 4, 1982.0),
]


@pytest.fixture
def flagged(weekly):
    def build(flags, start="2024-01-07"):
        return weekly(start, name="is_season", a=flags).withColumn("is_season", F.col("is_season").cast("int"))

    return build


@pytest.mark.parametrize(
    "flags, expected",
    [([0, 1, 1, 1, 0, 0, 1, 1, 0], [(1, 3), (6, 7)]), ([0, 0, 0], []), ([1, 1, 1], [(0, 2)])],
)
def test_blocks(flagged, flags, expected):
    assert sorted((r["start"], r["end"]) for r in seasons.blocks(flagged(flags)).collect()) == expected


def test_short_blocks(flagged, values):
    kept = values(seasons.drop_short_blocks(flagged([0, 1, 1, 0, 1, 1, 1, 1, 1, 0])), "is_season")
    assert kept == [0, 0, 0, 0, 1, 1, 1, 1, 1, 0]


def test_label_collision(flagged, values):
    # Two blocks of 2024, one of them in January, the other after it with no winter rows of its own.
    labels = values(seasons.label_seasons(flagged([1, 1, 0, 1, 1])), "season_label")
    assert labels == [2024, 2024, None, 2025, 2025]


def by_loop(days, flags):
    """Blocks one after the other, each taking the first free year."""
    labels, used, i = [None] * len(flags), set(), 0
    while i < len(flags):
        if not flags[i]:
            i += 1
            continue
        j = i
        while j < len(flags) and flags[j]:
            j += 1
        winter = [d.year for d in days[i:j] if d.month in (1, 2)]
        label = min(winter, key=lambda y: (-winter.count(y), y)) if winter else days[i].year + 1
        while label in used:
            label += 1
        used.add(label)
        labels[i:j] = [label] * (j - i)
        i = j
    return labels


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 40), min_size=1, max_size=24), st.integers(0, 1), st.integers(0, 51))
def test_labels_equal_the_loop(flagged, values, runs, first, shift):
    flags = [f for i, n in enumerate(runs) for f in [(i + first) % 2] * n]
    start = date(2020, 1, 5) + timedelta(days=7 * shift)
    days = [start + timedelta(days=7 * i) for i in range(len(flags))]
    assert values(seasons.label_seasons(flagged(flags, start.isoformat())), "season_label") == by_loop(days, flags)


@pytest.fixture
def published(spark):
    """The full grid, flagged by the published spans, with the published peaks."""
    rows, day = [], date(2011, 1, 2)
    while day <= date(2025, 11, 9):
        row = (0, 10.0)
        for _, onset, _, peak, _, end, _, _, top in SEASONS:
            if onset <= day.isoformat() <= end:
                row = (1, top if day.isoformat() == peak else 100.0)
        rows.append(("a", day, *row))
        day += timedelta(days=7)
    return spark.createDataFrame(rows, "series_id string, week_start date, is_season int, y double")


def test_published_seasons(published):
    labelled = seasons.detect(published)
    got = [
        (r["season_label"], r["onset_date"].isoformat(), r["onset_week"], r["peak_date"].isoformat(), r["peak_week"],
         r["end_date"].isoformat(), r["end_week"], r["duration_weeks"], r["peak_ili"])
        for r in seasons.season_stats(labelled).orderBy("season_label").collect()
    ]
    assert got == SEASONS
    assert labelled.filter("is_season = 1").count() == 277
    assert labelled.filter("is_season = 1 AND week_start > date'2023-06-01'").count() == 51


def test_cross_season_summary(published):
    stats = seasons.season_stats(seasons.detect(published))
    got = {(r["metric"], r["statistic"]): r["value"] for r in seasons.cross_season_summary(stats).collect()}
    assert len(got) == 20
    expected = {"mean": 18.4667, "std": 5.6804, "min": 4, "max": 25}
    assert {s: got[("duration_weeks", s)] for s in expected} == pytest.approx(expected, abs=1e-4)
    expected = {"mean": 6500.5333, "std": 2898.8121, "min": 1982, "max": 12646}
    assert {s: got[("peak_ili", s)] for s in expected} == pytest.approx(expected, abs=1e-4)
    one = seasons.cross_season_summary(stats.filter("season_label = 2012")).filter("statistic = 'std'").collect()
    assert [r["value"] for r in one] == [None] * 5


def test_count_and_recent(published):
    labelled = seasons.detect(published)
    assert seasons.season_count(labelled).collect()[0]["n_seasons"] == 15
    # The season of 2026 is cut off by the end of the data and has four rows.
    last = seasons.recent_seasons(seasons.complete_seasons(labelled), 3).orderBy("season_label").collect()
    assert [(r["season_label"], r["n_weeks"], r["peak"]) for r in last] == [
        (2023, 21, 4214.0), (2024, 22, 10424.0), (2025, 25, 12646.0)]


def test_first_peak_wins_ties(spark, weekly):
    rows = weekly(a=[3, 9, 9, 1]).withColumn("season_label", F.lit(2024))
    stats = seasons.season_stats(rows).collect()[0]
    assert stats["peak_date"] == date(2024, 1, 14)
    index = [r["week_index"] for r in seasons.weeks_from_peak(rows).orderBy("week_start").collect()]
    assert index == [-1, 0, 1, 2]


def test_trailing_season_cut_off_by_the_data_is_left_out(weekly):
    rows = weekly(a=range(40)).withColumn(
        "season_label", F.when(F.col("y") < 12, 2024).when(F.col("y") >= 35, 2025))
    assert [r["season_label"] for r in seasons.complete_seasons(rows).collect()] == [2024]
    longer = rows.withColumn("season_label", F.when(F.col("y") < 12, 2024).when(F.col("y") >= 30, 2025))
    assert {r["season_label"] for r in seasons.complete_seasons(longer).collect()} == {2024, 2025}


def test_block_table_gives_what_the_weeks_give(spark, weekly):
    """Labels, statistics and complete seasons of runs against those grouped from the weeks; unknown flags stay NULL."""
    rng = random.Random(6)
    flags = {k: [rng.choice((0, 0, 1, 1, None)) if rng.random() < 0.3 else int((i // 11) % 2) for i in range(170)] for k in "abc"}
    flags["c"] = [None] * 100 + [1] * 70
    panel = weekly(name="is_season", **flags).withColumn("is_season", F.col("is_season").cast("int"))
    panel = panel.withColumn("y", F.when(F.rand(3) > 0.1, F.round(F.rand(1) * 9)))
    panel = spark.createDataFrame(panel.collect(), panel.schema)
    for least in (1, 4):
        found = seasons.detect(panel, least)
        assert found.columns == [*panel.columns, "season_label"] and found.count() == 510
        before = {(r.series_id, r.week_start): r for r in panel.collect()}
        assert all(before[r.series_id, r.week_start].y == r.y for r in found.collect())
        runs = seasons.season_blocks(panel, least)
        assert sorted(seasons.block_stats(runs).collect()) == sorted(seasons.season_stats(found).collect())
        whole = seasons.complete_seasons(found).select("series_id", "season_label", "peak", "total", "n_weeks")
        assert sorted(seasons.complete_blocks(runs).collect()) == sorted(whole.collect())
        unknown = found.filter("is_season IS NULL").count()
        assert unknown == sum(f is None for v in flags.values() for f in v)
