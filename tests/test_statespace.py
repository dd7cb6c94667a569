"""The exact likelihood against plain matrices, the conditional fit and closed forms."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.kernels import arima as kernel
from panelcast.kernels import statespace as st
from panelcast.kernels.arima import Order
from panelcast.operators import arima, project
from tests.simulate import sarima


def autocovariance(order, lanes, n, terms=4_000):
    ar, ma = (a[0] for a in st.companion(order, lanes[None]))
    psi = np.zeros(terms)
    for j in range(terms):
        reach = min(j, len(ar))
        psi[j] = (ma[j] if j < len(ma) else 0.0) + ar[:reach] @ psi[j - reach : j][::-1]
    return np.array([psi[: terms - k] @ psi[k:] for k in range(n)])


def dense(order, lanes, y, x):
    """The same likelihood from the covariance matrix of all observations and a flat prior on what lies before them."""
    n, b, delta = len(y), order.differenced, st.lag_coefficients(order)
    weights, before = np.zeros((n, n)), np.zeros((n, b))
    for t in range(n):
        weights[t, t] = 1
        for j in range(1, b + 1):
            if t >= j:
                weights[t] += delta[j - 1] * weights[t - j]
                before[t] += delta[j - 1] * before[t - j]
            else:
                before[t, j - t - 1] += delta[j - 1]
    gamma = autocovariance(order, lanes, n)
    cover = weights @ gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))] @ weights.T
    seen = np.isfinite(y)
    cover, before, y, x = cover[np.ix_(seen, seen)], before[seen], y[seen], x[seen]
    inverse = np.linalg.inv(cover)
    known = before.T @ inverse @ before
    inner = inverse - inverse @ before @ np.linalg.solve(known, before.T @ inverse) if b else inverse
    beta = np.linalg.solve(x.T @ inner @ x, x.T @ inner @ y) if x.shape[1] else np.zeros(0)
    rest, m = y - x @ beta, seen.sum() - b
    penalty = np.linalg.slogdet(cover)[1] + (np.linalg.slogdet(known)[1] if b else 0.0)
    return -0.5 * (m * (np.log(2 * np.pi * (rest @ inner @ rest) / m) + 1) + penalty)


ORDERS = [
    Order(2, 0, 1, 0, 0, 0, 1, 0), Order(1, 1, 1, 0, 0, 0, 1, 1), Order(1, 1, 0, 1, 1, 1, 4, 2),
    Order(0, 1, 2, 1, 0, 1, 4, 1), Order(0, 2, 0, 0, 0, 0, 1, 0), Order(0, 0, 0, 0, 1, 0, 7, 0),
]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("gaps", [0, 14])
def test_likelihood_is_that_of_the_dense_normal(order, gaps):
    rng = np.random.default_rng(order.size + gaps)
    free = replace(order, k=0)
    lanes = kernel.natural(rng.normal(size=(1, free.size)) / 2, free, True)[0]
    y, x = np.cumsum(rng.normal(size=60)), rng.normal(size=(60, order.k))
    y[rng.choice(60, gaps, replace=False)] = np.nan
    if gaps:
        y[0] = np.nan
    got = st.log_likelihood(order, np.concatenate([np.zeros(order.k), lanes]), y, x)
    assert got == pytest.approx(dense(free, lanes, y, x), abs=1e-6)


def test_fit_stands_at_the_top():
    """No small step from the fitted parameters raises the likelihood; series of a stack do not touch each other."""
    rng = np.random.default_rng(3)
    order = Order(1, 1, 1, 0, 0, 0, 1, 1)
    y, x = np.cumsum(rng.normal(size=(3, 120)), axis=1), rng.normal(size=(3, 120, 1))
    y[1, 20:40] = np.nan
    found = st.fit_stack(y, x, order)
    for i, one in enumerate(found):
        assert one["converged"]
        alone = st.fit_stack(y[i : i + 1], x[i : i + 1], order)[0]
        assert np.allclose(one["params"], alone["params"], atol=1e-5)
        best = one["log_likelihood"]
        assert best == pytest.approx(st.log_likelihood(order, one["params"], y[i], x[i]), abs=1e-8)
        for k in (1, 2):
            for step in (-0.02, 0.02):
                moved = one["params"].copy()
                moved[k] += step
                if abs(moved[k]) < 1:
                    assert st.log_likelihood(order, moved, y[i], x[i]) <= best + 1e-6


def test_long_series_agree_with_the_conditional_fit():
    rng, order = np.random.default_rng(5), Order(1, 0, 0, 0, 0, 0, 1, 1)
    x = rng.normal(size=(900, 1))
    y = sarima(rng, 900, order, np.array([0.5, 0.6]), x)
    exact, css = st.fit_stack(y[None], x[None], order)[0], kernel.fit(y, x, order)
    assert np.allclose(exact["params"], css["params"], atol=0.02)
    assert exact["sigma2"] == pytest.approx(css["sigma2"], rel=0.02)


def test_gaps_cost_little_and_are_bridged():
    """Parameters from two thirds of the weeks stay near the truth; forecasts in a gap are the path over it."""
    rng = np.random.default_rng(0)
    e = rng.normal(size=1_500)
    y = np.zeros(1_500)
    for t in range(1, 1_500):
        y[t] = 0.8 * y[t - 1] + e[t]
    holes = y.copy()
    holes[rng.choice(1_500, 500, replace=False)] = np.nan
    order, none = Order(1, 0, 0, 0, 0, 0, 1, 0), np.zeros((1_500, 0))
    found = st.fit_stack(holes[None], none[None], order)[0]
    assert found["params"][0] == pytest.approx(0.8, abs=0.05) and found["sigma2"] == pytest.approx(1.0, abs=0.12)
    holes[700:720] = np.nan
    mean, variance = st.predict(holes, none, order, [0.8])
    last = max(t for t in range(700) if np.isfinite(holes[t]))
    for t in range(700, 720):
        assert mean[t] == pytest.approx(0.8 ** (t - last) * holes[last])
        assert variance[t] == pytest.approx((1 - 0.64 ** (t - last)) / 0.36)


@pytest.mark.parametrize("order", [Order(1, 1, 0, 0, 0, 0, 1, 0), Order(2, 1, 1, 1, 0, 1, 4, 0), Order(1, 0, 1, 0, 1, 0, 4, 0)])
def test_horizon_variances_are_those_of_the_filter(order):
    rng = np.random.default_rng(1)
    params = kernel.natural(rng.normal(size=(1, order.size)) / 2, order, True)[0]
    y = np.cumsum(rng.normal(size=400))
    mean, variance = st.predict(np.concatenate([y, np.full(12, np.nan)]), np.zeros((412, 0)), order, params)
    widths = kernel.horizon_variances(order, params, 12)
    assert np.allclose(variance[-12:], widths, rtol=1e-6) and (np.diff(widths) >= 0).all() and widths[0] == 1
    path = kernel.path(y, np.zeros((400, 0)), np.zeros((12, 0)), order, params)
    assert np.allclose(mean[-12:], path, atol=1e-6)


def test_undetermined_start_gives_no_forecast():
    order, y = Order(0, 1, 0, 0, 1, 0, 4, 0), np.arange(30.0)
    y[:3] = np.nan
    mean, _ = st.predict(y, np.zeros((30, 0)), order, [])
    assert np.isnan(mean[:8]).all() and np.isfinite(mean[10:]).all()
    with pytest.raises(ValueError):
        st.fit_stack(np.full((1, 10), np.nan), np.zeros((1, 10, 0)), order)


def test_panel_with_gaps(spark, weekly):
    rng = np.random.default_rng(2)
    walk = np.cumsum(rng.normal(size=90)).tolist()
    gapped = [None if i % 7 == 3 else v for i, v in enumerate(walk)]
    panel = weekly(name="log_y", full=walk, gapped=gapped, none=[None] * 90)
    panel = panel.withColumn("part", F.when(F.col("week_start") < "2025-07-01", "train").otherwise("test"))
    spec = arima.SarimaxSpec((1, 1, 0), (0, 0, 0, 1), (), method="exact")
    models = arima.fit(panel.filter("part = 'train'"), spec)
    by = {r.series_id: r for r in models.collect()}
    assert by["full"].message is None and by["gapped"].message is None and by["gapped"].nobs < by["full"].nobs
    assert by["none"].message == "too few observations"
    css = {r.series_id: r for r in arima.fit(panel, arima.SarimaxSpec((1, 1, 0), (0, 0, 0, 1), ())).collect()}
    assert css["gapped"].message == "missing values"
    rows = arima.walk_forward(panel, models, (), method="exact").collect()
    assert all((r.log_hat is None) == (r.series_id == "none") for r in rows)
    assert any(r.log_y is None and r.log_hat is not None for r in rows)
    ahead = arima.forecast_multistep(panel, models, (), method="exact").filter("series_id = 'gapped'").collect()
    assert all(r.log_hat is not None for r in ahead)
    history = panel.withColumns({"week": F.weekofyear("week_start")})
    future = project.future_regressors(history, (), 8)
    wide = project.project(history, models, future, (), interval="horizon", method="exact").filter("series_id = 'gapped'")
    spans = [np.log1p(r.ci_upper) - r.log_hat for r in wide.orderBy("week_start").collect()]
    assert len(spans) == 8 and all(b > a for a, b in zip(spans, spans[1:]))
    for wrong in (lambda: arima.SarimaxSpec(method="ml"), lambda: project.project(history, models, future, (), interval="wide")):
        with pytest.raises(ValueError):
            wrong()
