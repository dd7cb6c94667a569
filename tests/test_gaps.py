"""What is unknown stays unknown, and what cannot be used is counted."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from panelcast.operators import arima, hmm, seasons
from panelcast.operators import holidays as hol
from panelcast.operators import panel as pn
from panelcast.operators import sequence as sq
from panelcast.plans.features import FeatureConfig, feature_matrix
from panelcast.sources.readers import read_facts, read_holidays



def test_order_search_keeps_short_series(weekly):
    values = [10 + (i * 7 % 11) + (i % 5) for i in range(105)]
    panel = weekly(name="log_y", a=values, b=values[::-1], c=values[:60]).withColumn("part", F.lit("train"))
    bounds = {"p": 1, "d": 1, "q": 0, "P": 1, "D": 1, "Q": 0}
    found = arima.auto_order(panel, (), bounds=bounds, slices=4).collect()
    assert sorted(r.series_id for r in found) == ["a", "b", "c"]


def test_common_reach_leaves_out_what_looks_too_far_back():
    orders = [s.kernel_order() for _, s in arima.order_candidates((), 52, {"p": 2, "d": 1, "q": 0, "P": 1, "D": 1, "Q": 0})]
    assert arima.common_reach(400, orders) == 107
    assert arima.common_reach(105, orders) == 55
    assert arima.common_reach(2, orders) == 0


def test_directions_do_not_depend_on_magnitude(weekly, values):
    signs = [None, 1.0, -1.0, 0.0, 1.0]
    for scale in (1e-12, 1.0, 1e12):
        df = weekly(a=[v * scale for v in (5, 7, 6, 6 * (1 + 1e-12), 8)])
        assert values(df.withColumn("c", sq.direction("y")), "c") == signs


def test_unknown_season_stays_unknown(weekly, values):
    df = weekly(a=[1.0] * 12).withColumn("is_season", F.when(F.col("week_start") > F.lit(date(2024, 2, 1)), 1))
    out = seasons.detect(df)
    assert values(out, "is_season") == [None] * 4 + [1] * 8
    assert values(out, "season_label")[:4] == [None] * 4


def test_decoding_keeps_a_series_with_a_gap(weekly):
    out = hmm.decode_given(weekly(a=[1.0, 9.0, 1.0], b=[1.0, None, 2.0]), (1, 9), (1, 1), (0.5, 0.5), ((0.9, 0.1), (0.1, 0.9)))
    rows = {r.series_id: r for r in out.collect()}
    assert set(rows) == {"a", "b"} and rows["b"].states is None and rows["b"].log_likelihood is None
    assert rows["a"].states == [0, 1, 0] or len(rows["a"].states) == 3


def test_weather_of_named_stations(spark, weekly):
    facts = weekly(name="value", a=[1.0] * 10)
    daily = [(s, date(2024, 1, 1 + d), t, t) for d in range(28) for s, t in (("coast", 10.0), ("hills", 20.0))]
    weather = spark.createDataFrame(daily, "station string, date date, tmax double, tmin double")
    cfg = {"start": "2024-01-07", "end": "2024-03-10", "lead_codes": ()}
    assert {r.tmean_c for r in feature_matrix(facts, FeatureConfig(**cfg), weather=weather).collect()} == {15.0}
    one = feature_matrix(facts, FeatureConfig(**cfg, station="hills"), weather=weather)
    assert {r.tmean_c for r in one.collect()} == {20.0}
    with pytest.raises(ValueError, match="no weather of station 'moon'"):
        feature_matrix(facts, FeatureConfig(**cfg, station="moon"), weather=weather)


def test_facts_off_the_grid_are_counted_and_buckets_put_them_on(spark, tmp_path):
    (tmp_path / "facts.csv").write_text(
        "COUNTRY_CODE,MMWR_WEEKSTARTDATE,ILI_CASE\nA,2024-01-07,1\nA,2024-01-09,2\nA,bad,3\nB,2023-01-01,4\n"
    )
    raw = read_facts(spark, str(tmp_path / "facts.csv"))
    found = {(r.series_id, r.reason): r.n_facts for r in pn.off_grid(raw, "2024-01-01", "2024-12-31").collect()}
    assert found == {("A", "not a Sunday"): 1, ("A", "no date"): 1, ("B", "outside the grid"): 1}
    weeks = read_facts(spark, str(tmp_path / "facts.csv"), bucket="week")
    assert pn.weekly_sum(weeks.filter("series_id = 'A'")).first().y == 3.0
    assert [r.series_id for r in pn.without_facts(raw, ["A", "C"]).collect()] == ["C"]
    with pytest.raises(ValueError):
        read_facts(spark, str(tmp_path / "facts.csv"), bucket="day")


def test_first_holiday_follows_the_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,name\n1/1/2024,first\n")
    (tmp_path / "b.csv").write_text("date,name\n1/1/2024,second\n" + "1/2/2024,filler with a longer name\n" * 500)
    rows = hol.one_per_date(hol.stack_sources(read_holidays(spark, str(tmp_path))))
    assert {str(r.ds): r.name for r in rows.collect()}["2024-01-01"] == "first"


def test_holiday_dates_shrink_before_any_sort(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), "x", 1)], "ds date, name string, seq long")
    plan = hol.one_per_date(hol.stack_sources(df))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in below and "SortAggregate" not in below
