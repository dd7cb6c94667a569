from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.operators import baselines, evaluate
from panelcast.operators import panel as pn

ACTUAL, PREDICTED = [100, 200, 300, 400, 500], [110, 190, 310, 380, 520]


@pytest.fixture
def predictions(spark):
    def build(actual, season=None, **models):
        rows = [
            ("a", m, date(2024, 1, 7) + timedelta(days=7 * i), float(y), None if p is None else float(p), None if season is None else season[i])
            for m, predicted in models.items()
            for i, (y, p) in enumerate(zip(actual, predicted))
        ]
        df = spark.createDataFrame(
            rows, "series_id string, model string, week_start date, y double, y_hat double, is_season int")
        return df if season is not None else df.drop("is_season")

    return build


def scores(df):
    return {(r["model"], r["section"]): r.asDict() for r in evaluate.full_evaluation(df).collect()}


def test_metrics(predictions):
    got = scores(predictions(ACTUAL, m=PREDICTED))[("m", "overall")]
    want = {"mae": 14, "rmse": 14.832397, "mape": 5.466667, "smape": 5.396095, "r2": 0.989,
            "directional_accuracy": 100, "within_20pct": 100}
    assert {k: got[k] for k in want} == pytest.approx(want, rel=1e-6)


def test_perfect_and_constant(predictions):
    got = scores(predictions([100, 200, 300], m=[100, 200, 300]))[("m", "overall")]
    assert (got["mae"], got["rmse"], got["r2"]) == (0, 0, 1)
    flat = scores(predictions([5, 5], hit=[5, 5], miss=[5, 6]))
    assert (flat[("hit", "overall")]["r2"], flat[("miss", "overall")]["r2"]) == (1, 0)


def test_short_and_zero(predictions):
    got = scores(predictions([1], m=[2]))[("m", "overall")]
    assert got["directional_accuracy"] is None and got["r2"] is None
    zero = scores(predictions([0, 0, 0], m=[1, 2, 3]))[("m", "overall")]
    assert zero["within_20pct"] is None and zero["mape"] is None and zero["smape"] == pytest.approx(200)
    both = scores(predictions([0, 0], m=[0, 0]))[("m", "overall")]
    assert both["smape"] == 0


def test_an_error_of_just_the_band_counts(predictions):
    got = scores(predictions([3.9999999999999996, 10], m=[3.2, 13]))[("m", "overall")]
    assert (got["within_20pct"], got["within_30pct"]) == (50, 100)


def test_sections_and_direction_across_the_gap(predictions):
    df = predictions([100, 200, 50, 300, 40], [1, 0, 1, 0, 1], m=[100, 200, 150, 100, 160])
    got = scores(df)
    assert set(got) == {("m", s) for s in ("overall", "in_season", "off_season")}
    # In season the actual goes 100, 50, 40 and the forecast 100, 150, 160.
    assert got[("m", "in_season")]["directional_accuracy"] == 0
    assert got[("m", "off_season")]["directional_accuracy"] == 0
    assert got[("m", "overall")]["directional_accuracy"] == pytest.approx(50)
    no_season = scores(predictions([1, 2], [0, 0], m=[1, 2]))
    assert set(no_season) == {("m", "overall"), ("m", "off_season")}


def test_long_form(predictions):
    rows = evaluate.metric_rows(evaluate.full_evaluation(predictions(ACTUAL, m=PREDICTED), bands=[20]))
    assert set(rows.columns) == {"series_id", "model", "section", "metric", "value"}
    assert {r["metric"] for r in rows.collect()} == {
        "mae", "rmse", "mape", "smape", "r2", "directional_accuracy", "within_20pct"}


def test_compare_models(predictions):
    df = predictions(ACTUAL, [0, 0, 1, 1, 1], a=PREDICTED, b=[x + 5 for x in ACTUAL])
    got = {r["model"]: r for r in evaluate.compare_models(df).collect()}
    assert (got["a"]["mae"], got["b"]["mae"]) == (14, 5)
    assert got["a"]["mae_season"] == pytest.approx(50 / 3) and got["b"]["rmse_season"] == 5
    off = evaluate.compare_models(predictions([1, 2], [0, 0], m=[1, 2])).collect()[0]
    assert off["mae_season"] is None


def test_missing_predictions_are_not_scored(predictions):
    got = scores(predictions([1, 2, 3], m=[1, None, 5]))[("m", "overall")]
    assert got["mae"] == 1


def test_baselines_by_hand(spark, weekly, values):
    n = 160
    panel = weekly("2020-01-05", a=range(n)).withColumns(
        {"year": cal.epi_year(F.col("week_start")), "week": cal.epi_week(F.col("week_start")), "log_y": F.log1p("y")})
    split = pn.split(panel, "2021-12-31").cache()
    rows = baselines.all_baselines(split)
    train = [(r["year"], r["week"], r["y"]) for r in split.filter("part = 'train'").collect()]
    for r in rows.collect():
        same = [y for yr, w, y in train if w == r["week"]]
        last = [y for yr, w, y in train if w == r["week"] and yr == r["year"] - 1]
        mean = sum(same) / len(same) if same else None
        assert r["naive"] == pytest.approx(r["y"] - 1)
        assert r["weekly_mean"] == mean
        assert r["seasonal_naive"] == (last[0] if last else mean)
    # More than a year past the split the last year is no train row: the mean of the week steps in.
    late = rows.filter("year = 2023").collect()
    assert late and all(r["seasonal_naive"] == r["weekly_mean"] for r in late)
    assert baselines.long_predictions(rows, ["series_id", "week_start"]).count() == 4 * rows.count()
