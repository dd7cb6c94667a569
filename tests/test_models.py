import os
import subprocess
import sys
import time
from datetime import date, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.simulate import sarima

from panelcast.functions import calendar as cal
from panelcast.kernels import arima as kernel
from panelcast.operators import arima, diagnostics, evaluate, hmm, project
from panelcast.operators import panel as pn
from panelcast.session import new_path, stage
from panelcast.streaming.walk_forward import score_arrivals

ORDER = kernel.Order(1, 1, 1, 1, 0, 1, 4, 1)
PARAMS = np.array([0.3, 0.5, 0.2, -0.3, 0.4])
SPEC = arima.SarimaxSpec((1, 1, 1), (1, 0, 1, 4), ("x",))


@pytest.fixture(scope="module")
def panel(spark):
    """Three simulated series with a regressor and an epi calendar, 300 weeks, 250 of them train."""
    rows, first = [], date(2015, 1, 4)
    for seed, name in enumerate("abc"):
        rng = np.random.default_rng(seed)
        x = rng.normal(size=(300, 1))
        y = 2 + sarima(rng, 300, ORDER, PARAMS, x, 0.1) / 4
        rows += [(name, first + timedelta(days=7 * t), float(y[t]), float(x[t, 0])) for t in range(300)]
    df = spark.createDataFrame(rows, "series_id string, week_start date, log_y double, x double")
    df = df.withColumns({"y": F.expm1("log_y"), "year": cal.epi_year(F.col("week_start")), "week": cal.epi_week(F.col("week_start"))})
    return stage(pn.split(df, first + timedelta(days=7 * 249)), "panel")


@pytest.fixture(scope="module")
def models(panel):
    return stage(arima.fit(panel.filter("part = 'train'"), SPEC), "models")


def frame(df, *order):
    return df.toPandas().sort_values(list(order or ("series_id", "week_start"))).reset_index(drop=True)


def test_fit_gives_one_row_per_series(models):
    rows = models.collect()
    assert sorted(r["series_id"] for r in rows) == ["a", "b", "c"]
    assert all(r["converged"] and r["message"] is None and list(r["exog"]) == ["x"] for r in rows)


def test_walk_forward_uses_only_the_past(panel, models):
    got = frame(arima.walk_forward(panel, models, ["x"]))
    assert len(got) == 150
    assert (got["ci_lower"] <= got["y_hat"]).all() and (got["y_hat"] <= got["ci_upper"]).all()
    last = panel.agg(F.max("week_start")).first()[0]
    changed = panel.withColumn("log_y", F.when(F.col("week_start") == F.lit(last), 9.0).otherwise(F.col("log_y")))
    again = frame(arima.walk_forward(changed, models, ["x"]))
    assert again["log_hat"].to_numpy() == pytest.approx(got["log_hat"].to_numpy())


def test_walk_forward_beats_multistep(panel, models):
    error = {
        name: float((f["log_hat"] - f["log_y"]).abs().mean())
        for name, f in (
            ("walk", frame(arima.walk_forward(panel, models, ["x"]))),
            ("multi", frame(arima.forecast_multistep(panel, models, ["x"]))),
        )
    }
    assert error["walk"] < error["multi"]


def test_first_test_week_is_the_same_one_step_and_multistep(panel, models):
    one = frame(arima.walk_forward(panel, models, ["x"])).groupby("series_id").first()
    multi = frame(arima.forecast_multistep(panel, models, ["x"])).groupby("series_id").first()
    assert one["log_hat"].to_numpy() == pytest.approx(multi["log_hat"].to_numpy())


def test_lag_expressions_equal_the_filter(panel):
    spec = arima.SarimaxSpec((2, 1, 0), (1, 1, 0, 4), ("x",))
    fitted = stage(arima.fit(panel.filter("part = 'train'"), spec), "ar")
    a = frame(arima.walk_forward(panel, fitted, ["x"]))
    b = frame(arima.walk_forward_by_lags(panel, fitted, spec.order, spec.seasonal, ["x"]))
    for c in ("log_hat", "y_hat", "ci_lower", "ci_upper"):
        assert b[c].to_numpy() == pytest.approx(a[c].to_numpy())
    with pytest.raises(ValueError, match="moving-average"):
        arima.walk_forward_by_lags(panel, fitted, (1, 0, 1), (0, 0, 0, 4))


def test_unfitted_model(panel):
    model = arima.SeasonalArima(SPEC)
    assert (model.spec.order, model.models) == ((1, 1, 1), None)
    for forecast in (model.walk_forward, model.forecast_multistep):
        with pytest.raises(RuntimeError, match="must be fitted"):
            forecast(panel)
    with pytest.raises(RuntimeError, match="must be fitted"):
        model.save("unused")


def test_save_and_load(spark, panel, models):
    model = arima.SeasonalArima(SPEC)
    model.models = models
    path = new_path(spark, "saved")
    model.save(path)
    loaded = arima.SeasonalArima.load(spark, path)
    assert loaded.exog == ("x",)
    assert frame(loaded.walk_forward(panel)).equals(frame(model.walk_forward(panel)))


def test_load_series_with_their_own_regressors(spark, panel):
    """One series without, two with a regressor, in one table."""
    train = panel.filter("part = 'train'")
    plain = arima.fit(train.filter("series_id = 'a'"), arima.SarimaxSpec((2, 0, 0), (0, 0, 0, 4), ()))
    other = arima.fit(train.filter("series_id <> 'a'"), arima.SarimaxSpec((1, 0, 0), (0, 0, 0, 4), ("x",)))
    path = new_path(spark, "mixed")
    arima.save_models(plain.unionByName(other), path)
    got = frame(arima.SeasonalArima.load(spark, path).walk_forward(panel))
    want = frame(arima.walk_forward(panel.filter("series_id = 'a'"), plain, ()))
    assert got["log_hat"].notna().all()
    mine = got[got["series_id"] == "a"]
    assert mine["log_hat"].to_numpy() == pytest.approx(want["log_hat"].to_numpy())


def test_a_failed_fit_is_a_row(panel):
    gap = panel.withColumn("x", F.when(F.col("series_id") != "b", F.col("x")))
    rows = {r["series_id"]: r for r in arima.fit(gap, SPEC).collect()}
    assert rows["b"]["message"] == "missing values" and rows["b"]["aic"] is None
    assert rows["a"]["message"] is None
    fitted = stage(arima.fit(gap, SPEC), "gap")
    for forecast in (arima.walk_forward(gap, fitted, ["x"]), arima.forecast_multistep(gap, fitted, ["x"])):
        got = {r["series_id"]: (r["n"], r["known"]) for r in forecast.groupBy("series_id").agg(
            F.count(F.lit(1)).alias("n"), F.count("y_hat").alias("known")).collect()}
        assert got == {"a": (50, 50), "b": (50, 0), "c": (50, 50)}
    future = project.future_regressors(gap, ["x"], 3)
    assert project.project(gap, fitted, future, ["x"]).filter("y_hat IS NULL").select("series_id").distinct().collect()[0][0] == "b"


def test_grid_has_288_candidates():
    grid = arima.grid_candidates()
    assert len(grid) == 288
    assert arima.feature_sets()["temp_lagged"] == ("tmean_lag1", "tmean_lag2")
    assert arima.feature_sets()["temp_only"] == ("tmean_c", "tmean_lag1", "tmean_lag2")
    assert len(arima.order_candidates()) == 5 * 2 * 3 * 2 * 2 * 2


def test_search_ranks_and_keeps_failures(panel):
    long_season = ("full", arima.SarimaxSpec((1, 1, 0), (1, 1, 0, 300), ("x",)))
    candidates = [("full", SPEC), ("none", arima.SarimaxSpec((0, 1, 0), (0, 0, 0, 4), ()))]
    results = stage(arima.search(panel, candidates, slices=5), "search")
    ranked = frame(arima.ranked(results), "series_id", "rank")
    assert ranked["rank"].tolist() == [1, 2] * 3
    assert ranked["features"].tolist() == ["full", "none"] * 3
    assert results.filter("mae IS NULL OR rmse < mae").count() == 0
    failed = arima.search(panel, [*candidates, long_season]).filter("message IS NOT NULL")
    assert failed.filter("aic IS NULL").count() >= 3


def test_auto_order_and_per_series_orders(panel):
    bounds = {"p": 1, "d": 1, "q": 1, "P": 0, "D": 0, "Q": 0}
    orders = stage(arima.auto_order(panel, ["x"], s=4, bounds=bounds), "orders")
    chosen = {r["series_id"]: list(r["order"]) for r in orders.collect()}
    assert set(chosen) == {"a", "b", "c"}
    fitted = arima.fit(panel, SPEC, orders=orders).collect()
    assert {r["series_id"]: list(r["order"]) for r in fitted} == chosen


def test_projection_interval_never_widens(panel, models):
    future = stage(project.future_regressors(panel, ["x"], 20), "future")
    got = frame(project.project(panel, models, future, ["x"]))
    assert len(got) == 60
    half = (np.log1p(got["ci_upper"]) - got["log_hat"]).groupby(got["series_id"])
    assert (half.max() - half.min()).max() < 1e-9
    totals = {r["series_id"]: r for r in project.projection_totals(project.project(panel, models, future, ["x"])).collect()}
    for name, f in got.groupby("series_id"):
        assert totals[name]["total"] == pytest.approx(f["y_hat"].sum())
        assert totals[name]["peak_date"] == f.loc[f["y_hat"].idxmax(), "week_start"]


def test_future_regressors_fall_back(panel):
    history = panel.withColumn("x", F.when(F.col("week") != 45, F.col("x"))).filter("week <> 46")
    exog = ["x", "school_in_session", "is_covid", "post_covid", "unheard_of"]
    got = frame(project.future_regressors(history, exog, 52))
    one = frame(history)
    one = one[one["series_id"] == "a"]
    rows = got[got["series_id"] == "a"].set_index("week")
    assert np.isnan(rows.loc[45, "x"])
    assert rows.loc[46, "x"] == pytest.approx(one["x"].median())
    assert rows.loc[10, "x"] == pytest.approx(one[one["week"] == 10]["x"].median())
    assert set(got["is_covid"]) == {0} and set(got["unheard_of"]) == {0.0}


def test_hmm_over_a_panel(spark, weekly, values):
    rng = np.random.default_rng(0)
    high = (np.arange(208) % 52) < 15
    base = np.where(high, 2000.0, 100.0)
    noisy = weekly("2020-01-05", a=base + rng.normal(size=208) * 20, b=(base + rng.normal(size=208) * 20).tolist() + [None])
    fitted = stage(hmm.fit_decode(noisy), "hmm")
    rows = {r["series_id"]: r for r in hmm.season_state(fitted).collect()}
    assert rows["b"]["means"] is None
    assert rows["a"]["means"][rows["a"]["season_state"]] == pytest.approx(2000, rel=0.02)
    found = hmm.detect_seasons(noisy.filter("series_id = 'a'"), fitted)
    assert values(found, "is_season") == high.astype(int).tolist()
    assert sorted({v for v in values(found, "season_label") if v}) == [2020, 2021, 2022, 2023]
    q = hmm.quality(fitted.filter("series_id = 'a'")).collect()[0]
    assert q["aic"] == pytest.approx(-2 * q["log_likelihood"] + 12)
    assert q["bic"] == pytest.approx(-2 * q["log_likelihood"] + 6 * np.log(208))


def test_residual_tables(spark, weekly):
    r = np.random.default_rng(2).normal(size=90)
    rows = weekly(a=r, flat=[1.0] * 90).select("series_id", F.lit("m").alias("model"), "week_start", F.col("y").alias("residual"))
    counts = frame(diagnostics.residual_histogram(rows), "series_id", "bin")
    want, edges = np.histogram(r, bins=30)
    assert counts[counts["series_id"] == "a"]["n"].tolist() == want.tolist()
    assert counts[counts["series_id"] == "a"]["left_edge"].to_numpy() == pytest.approx(edges[:-1])
    assert counts[counts["series_id"] == "flat"]["n"].sum() == 90
    acf = frame(diagnostics.autocorrelation(rows.filter("series_id = 'a'")), "lag")
    x = r - r.mean()
    rho = np.array([(x[: 90 - k] * x[k:]).sum() / (x * x).sum() for k in range(41)])
    assert acf["acf"].to_numpy() == pytest.approx(rho)
    bartlett = [0.0] + [1.959963984540054 * np.sqrt((1 + 2 * (rho[1:k] ** 2).sum()) / 90) for k in range(1, 41)]
    assert acf["half_width"].to_numpy() == pytest.approx(bartlett)
    pacf = frame(diagnostics.partial_autocorrelation(rows.filter("series_id = 'a'")), "lag")
    for k in range(1, 41):
        toeplitz = rho[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        assert pacf["pacf"][k] == pytest.approx(np.linalg.solve(toeplitz, rho[1 : k + 1])[-1])


def test_constant_residuals_have_no_autocorrelation(weekly):
    rows = weekly(a=[1.0] * 60).select("series_id", F.lit("m").alias("model"), "week_start", F.col("y").alias("residual"))
    acf = diagnostics.autocorrelation(rows).collect()
    pacf = diagnostics.partial_autocorrelation(rows).collect()
    assert len(acf) == len(pacf) == 41
    assert {r["acf"] for r in acf} == {None} and {r["pacf"] for r in pacf} == {None}


def test_forecast_frame_band(panel, models):
    forecasts = arima.walk_forward(panel, models, ["x"])
    with_ci = frame(diagnostics.forecast_frame(panel, forecasts))
    assert with_ci["y_hat"].notna().sum() == 150 and len(with_ci) == 900
    banded = frame(diagnostics.forecast_frame(panel, forecasts.drop("ci_lower", "ci_upper"))).dropna(subset=["y_hat"])
    assert (banded["ci_lower"] / banded["y_hat"]).to_numpy() == pytest.approx(0.8)
    assert (banded["ci_upper"] / banded["y_hat"]).to_numpy() == pytest.approx(1.2)


def test_stream_equals_batch_in_any_order(spark, panel, models):
    """Each file is one micro-batch; shuffled rows wait for their turn."""
    numbered = panel.withColumn("tick", F.datediff("week_start", F.lit("2015-01-04").cast("date")) / 7).withColumn(
        "tick", F.col("tick").cast("long"))
    source, sink, progress = (new_path(spark, n) for n in ("in", "out", "log"))
    rows = numbered.select("series_id", "tick", "log_y", "x")
    rows.repartition(5).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    scored = score_arrivals(stream, models, ["x"])
    (scored.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True)
     .start(sink).awaitTermination())
    got = frame(spark.read.parquet(sink), "series_id", "tick")
    assert len(got) == 900
    everything = panel.withColumn("part", F.lit("test"))
    want = frame(arima.walk_forward(everything, models, ["x"]))
    assert got["log_hat"].to_numpy() == pytest.approx(want["log_hat"].to_numpy(), nan_ok=True, abs=1e-9)
    assert got["y_hat"].to_numpy() == pytest.approx(want["y_hat"].to_numpy(), nan_ok=True)


def test_stream_goes_on_after_a_restart(spark, panel, models):
    """A second run over new files picks up the state of the first; a series without a model has no forecasts."""
    numbered = panel.withColumn("tick", (F.datediff("week_start", F.lit("2015-01-04").cast("date")) / 7).cast("long"))
    rows = numbered.select("series_id", "tick", "log_y", "x")
    source, sink, progress = (new_path(spark, n) for n in ("in", "out", "log"))
    known = models.filter("series_id <> 'c'")
    for part in (rows.filter("tick < 140"), rows.filter("tick >= 140")):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        writer = score_arrivals(stream, known, ["x"]).writeStream.format("parquet")
        writer.option("checkpointLocation", progress).trigger(availableNow=True).start(sink).awaitTermination()
    got = frame(spark.read.parquet(sink), "series_id", "tick")
    assert len(got) == 900
    want = frame(arima.walk_forward(panel.withColumn("part", F.lit("test")), known, ["x"]))
    assert got["log_hat"].to_numpy() == pytest.approx(want["log_hat"].to_numpy(), nan_ok=True, abs=1e-9)
    assert got[got["series_id"] == "c"]["y_hat"].isna().all()


def test_stream_reports_late_and_gives_up_lost_ticks(spark, panel, models):
    """Every arrival has a row; a lost tick holds a series for ``max_wait`` ticks only."""
    numbered = panel.withColumn("tick", (F.datediff("week_start", F.lit("2015-01-04").cast("date")) / 7).cast("long"))
    rows = numbered.filter("series_id = 'a'").select("series_id", "tick", "log_y", "x")
    source, sink, progress = (new_path(spark, n) for n in ("in", "out", "log"))
    again = rows.filter("tick IN (3, 40)").withColumn("tick", F.when(F.col("tick") == 3, -1).otherwise(F.col("tick")))
    for part in (rows.filter("tick <> 100 AND tick < 130"), again, rows.filter("tick >= 130 OR tick = 100")):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        writer = score_arrivals(stream, models, ["x"], max_wait=20).writeStream.format("parquet")
        writer.option("checkpointLocation", progress).trigger(availableNow=True).start(sink).awaitTermination()
    got = frame(spark.read.parquet(sink), "tick", "status")
    status = {s: sorted(got[got["status"] == s]["tick"]) for s in ("late", "missing", "scored")}
    assert status["late"] == [-1, 40, 100] and status["missing"] == [100]
    assert status["scored"] == [t for t in range(300) if t != 100]
    scored = got[got["status"] == "scored"].set_index("tick")
    want = frame(arima.walk_forward(panel.filter("series_id = 'a'").withColumn("part", F.lit("test")), models, ["x"]))
    assert scored["log_hat"][:100].to_numpy() == pytest.approx(want["log_hat"][:100].to_numpy(), nan_ok=True, abs=1e-9)
    assert scored["log_hat"][100:].notna().all() and abs(scored["log_hat"][250] - want["log_hat"][250]) < 0.05


def test_timer_gives_up_what_others_wait_for(spark, panel, models):
    """Without another arrival a timer closes the gap; the tick that was waited for is late then."""
    numbered = panel.withColumn("tick", (F.datediff("week_start", F.lit("2015-01-04").cast("date")) / 7).cast("long"))
    rows = numbered.filter("series_id = 'a' AND tick <= 150").select("series_id", "tick", "log_y", "x")
    source, sink, progress = (new_path(spark, n) for n in ("in", "out", "log"))
    rows.filter("tick <> 90 AND tick < 150").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    scored = score_arrivals(stream, models, ["x"], patience=0.001)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", progress)
    running = writer.trigger(processingTime="200 milliseconds").start(sink)

    def until(status, tick):
        for _ in range(120):
            got = frame(spark.read.schema(scored.schema).parquet(sink), "tick", "status") if Path(sink).exists() else None
            if got is not None and ((got["status"] == status) & (got["tick"] == tick)).any():
                return got
            time.sleep(0.5)
        raise AssertionError(f"no {status} {tick}")

    try:
        assert until("missing", 90)["tick"].max() == 149
        rows.filter("tick IN (90, 150)").coalesce(1).write.mode("append").parquet(source)
        until("late", 90)
        got = until("scored", 150)
    finally:
        running.stop()
    assert got[got["status"] == "scored"]["tick"].tolist() == [t for t in range(151) if t != 90]


@pytest.mark.parametrize("order", [(1, 1, 0, 0, 0, 0), (2, 0, 2, 0, 0, 0), (0, 1, 1, 1, 0, 1), (0, 0, 0, 0, 0, 0)])
def test_runs_of_any_length_give_the_same_forecasts(order):
    """A history in one run, tick by tick and in between."""
    from panelcast.streaming.walk_forward import run_ahead

    rng = np.random.default_rng(sum(order))
    spec = kernel.Order(*order, 4)
    params = kernel.natural(rng.normal(size=(1, spec.size)) / 2, spec, True)[0]
    ar, ma = kernel.polynomials(spec, params)
    y = np.cumsum(rng.normal(size=60))
    want = kernel.one_step(y, np.zeros((60, 0)), spec, params)
    for cuts in ([60], [1] * 60, [2, 3, 1, 30, 24]):
        u, e, got = np.zeros(0), np.zeros(0), []
        for n in cuts:
            run = y[len(u) : len(u) + n]
            ahead, errors = run_ahead(u[max(len(u) + 1 - len(ar), 0) :], e[max(len(e) + 1 - len(ma), 0) :], run, ar, ma)
            u, e, got = np.concatenate([u, run]), np.concatenate([e, errors]), got + ahead.tolist()
        assert got == pytest.approx(want.tolist(), nan_ok=True, abs=1e-9)


def test_tasks_need_no_installed_package(tmp_path):
    """Fit from a working directory where the workers cannot import the package."""
    root = Path(__file__).resolve().parents[1]
    script = f"""
import sys; sys.path.insert(0, {str(root)!r})
from panelcast.session import local_session
from panelcast.operators import arima, hmm
from pyspark.sql import functions as F
spark = local_session("pickle", "2", 2)
rows = spark.range(80).select(F.lit("a").alias("series_id"), F.expr("date_add(date'2020-01-05', cast(7 * id as int))").alias("week_start"),
    F.sin(F.col("id") * F.col("id")).alias("log_y"), F.col("id").cast("double").alias("y"))
assert arima.fit(rows, arima.SarimaxSpec((1, 0, 0), (0, 0, 0, 4), ())).first()["message"] is None
assert hmm.fit_decode(rows).first()["means"] is not None
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
