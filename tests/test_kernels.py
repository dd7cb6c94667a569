from dataclasses import replace
from itertools import product

import numpy as np
import pytest
from tests.simulate import sarima

from panelcast.kernels import arima, hmm
from panelcast.kernels import arima as kernel


def brute_force(x, means, covars, start, trans):
    """Likelihood, best path and state probabilities by enumeration."""
    weight = {}
    for path in product(range(len(means)), repeat=len(x)):
        p = start[path[0]]
        for a, b in zip(path, path[1:]):
            p *= trans[a][b]
        for s, v in zip(path, x):
            p *= np.exp(-0.5 * (v - means[s]) ** 2 / covars[s]) / np.sqrt(2 * np.pi * covars[s])
        weight[path] = p
    total = sum(weight.values())
    probs = [[sum(p for path, p in weight.items() if path[t] == s) / total for s in range(len(means))] for t in range(len(x))]
    return np.log(total), max(weight, key=weight.get), probs


def test_hmm_decoding_equals_enumeration():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4, 6)) * 2
    means, covars = np.array([-1.0, 0.5, 2.0]), np.array([0.5, 1.0, 2.0])
    start = np.array([0.5, 0.3, 0.2])
    trans = np.array([[0.7, 0.2, 0.1], [0.1, 0.8, 0.1], [0.3, 0.3, 0.4]])
    same = [np.repeat(v[None], 4, axis=0) for v in (means, covars, start, trans)]
    path, gamma, loglik = hmm.decode(x, *same)
    for i in range(4):
        want_loglik, want_path, want_probs = brute_force(x[i], means, covars, start, trans)
        assert loglik[i] == pytest.approx(want_loglik)
        assert tuple(path[i]) == want_path
        assert gamma[i] == pytest.approx(np.array(want_probs))


def test_hmm_recovers_two_states():
    rng = np.random.default_rng(5)
    state = np.zeros((6, 700), dtype=int)
    for t in range(1, 700):
        state[:, t] = np.where(rng.random(6) < 0.95, state[:, t - 1], 1 - state[:, t - 1])
    x = np.where(state == 1, 3000.0, 300.0) + rng.normal(size=state.shape) * np.where(state == 1, 500.0, 80.0)
    found = hmm.fit(x)
    path, _, loglik = hmm.decode(x, found["means"], found["covars"], found["startprob"], found["transmat"])
    assert found["converged"].all()
    assert found["means"] == pytest.approx(np.tile([300.0, 3000.0], (6, 1)), rel=0.06)
    stays = [(s[1:][s[:-1] == 0] == 0).mean() for s in state]
    assert found["transmat"][:, 0, 0] == pytest.approx(stays, abs=0.02)
    assert (path == state).mean() > 0.99
    alone = hmm.fit(x[2:3])
    assert alone["means"][0] == pytest.approx(found["means"][2])


def test_hmm_survives_a_constant_series():
    found = hmm.fit(np.full((1, 50), 7.0))
    assert np.isfinite(found["means"]).all() and (found["covars"] > 0).all()


def by_recursion(y, x, order, params):
    """Innovations one observation at a time."""
    ar, ma = arima.polynomials(order, params)
    u = y - x @ params[: order.k]
    lead = len(ar) - 1
    e = np.zeros(len(y))
    for t in range(lead, len(y)):
        e[t] = sum(ar[i] * u[t - i] for i in range(len(ar))) - sum(ma[j] * e[t - j] for j in range(1, min(len(ma), t + 1)))
    return e


ORDERS = [
    arima.Order(3, 1, 0, 1, 0, 1, 12, 2), arima.Order(2, 1, 2, 1, 1, 1, 12, 2), arima.Order(0, 0, 2, 0, 0, 1, 7, 0),
    arima.Order(1, 0, 3, 0, 1, 0, 5, 1), arima.Order(0, 1, 0, 0, 0, 0, 1, 0),
]


@pytest.mark.parametrize("order", ORDERS)
def test_innovations_equal_the_recursion(order):
    rng = np.random.default_rng(1)
    y, x = rng.normal(size=150), rng.normal(size=(150, order.k))
    params = rng.uniform(-0.4, 0.4, size=order.size)
    ahead = arima.one_step(y, x, order, params)
    lead = order.differenced + order.presample
    assert np.isnan(ahead[:lead]).all()
    assert (y - ahead)[lead:] == pytest.approx(by_recursion(y, x, order, params)[lead:], abs=1e-9)


@pytest.mark.parametrize("order", ORDERS)
def test_path_equals_repeated_one_step_forecasts(order):
    rng = np.random.default_rng(2)
    y, x, future = rng.normal(size=120), rng.normal(size=(120, order.k)), rng.normal(size=(9, order.k))
    params = rng.uniform(-0.4, 0.4, size=order.size)
    path = arima.path(y, x, future, order, params)
    for row in future:
        # Append a placeholder, forecast it, and put the forecast in its place.
        y, x = np.append(y, 0.0), np.vstack([x, row])
        y[-1] = arima.one_step(y, x, order, params)[-1]
    assert path == pytest.approx(y[120:], abs=1e-9)


def test_inverse_filter_near_the_unit_root():
    w = np.random.default_rng(0).normal(size=(1, 500))
    e = arima.invert(w, np.array([[1.0, -0.999]]), 1)[0]
    want = np.zeros(500)
    for t in range(500):
        want[t] = w[0, t] + (0.999 * want[t - 1] if t else 0.0)
    assert e == pytest.approx(want, abs=1e-8)


def test_stable_coefficients_have_roots_outside_the_circle():
    for c in arima.stable(np.random.default_rng(4).normal(scale=3, size=(50, 3))):
        assert (np.abs(np.roots([1.0, *c])) < 1 + 1e-9).all()


def test_fit_recovers_the_default_model():
    order = arima.Order(3, 1, 0, 1, 0, 1, 52, 2)
    truth = np.array([0.05, -0.1, 0.4, 0.2, 0.1, 0.5, -0.3])
    found = []
    for seed in range(3):
        rng = np.random.default_rng(seed)
        x = rng.normal(size=(776, 2))
        y = sarima(rng, 776, order, truth, x)
        fit = arima.fit(y, x, order)
        assert fit["converged"]
        assert fit["params"][:2] == pytest.approx(truth[:2], abs=0.03)
        assert fit["params"][2:5] == pytest.approx(truth[2:5], abs=0.12)
        assert np.sqrt(fit["sigma2"]) == pytest.approx(0.28, abs=0.03)
        found.append(fit["params"])
    assert np.mean(found, axis=0) == pytest.approx(truth, abs=0.2)


def test_fit_recovers_moving_average_terms():
    order = arima.Order(1, 1, 1, 0, 1, 1, 12, 0)
    truth = np.array([0.5, 0.4, -0.6])
    rng = np.random.default_rng(8)
    y = sarima(rng, 900, order, truth, np.zeros((900, 0)))
    assert arima.fit(y, np.zeros((900, 0)), order)["params"] == pytest.approx(truth, abs=0.12)


def test_a_stack_equals_its_series_alone():
    order = arima.Order(2, 1, 1, 1, 0, 0, 12, 1)
    rng = np.random.default_rng(12)
    truth = np.array([0.3, 0.4, 0.1, 0.3, -0.4])
    x = rng.normal(size=(7, 240, 1))
    y = np.stack([sarima(rng, 240, order, truth * rng.uniform(0, 1), x[i]) for i in range(7)])
    for i, found in enumerate(arima.fit_stack(y, x, order)):
        alone = arima.fit(y[i], x[i], order)
        assert found["params"] == pytest.approx(alone["params"], abs=1e-6)
        assert found["n_iter"] == alone["n_iter"] and found["aic"] == pytest.approx(alone["aic"])


def test_overdifferenced_noise_stays_invertible():
    y = np.random.default_rng(9).normal(size=300)
    fit = arima.fit(y, np.zeros((300, 0)), arima.Order(1, 1, 2, 0, 0, 0, 1, 0))
    assert fit["converged"] and (np.abs(np.roots([1.0, *fit["params"][1:]])) <= 1 + 1e-9).all()


def test_stationary_fit_of_a_random_walk():
    y = np.cumsum(np.random.default_rng(10).normal(size=300))
    fit = arima.fit(y, np.zeros((300, 0)), arima.Order(1, 0, 0, 0, 0, 0, 1, 0), stationary=True)
    assert 0.9 < fit["params"][0] < 1


def test_unusable_data():
    order = arima.Order(1, 0, 0, 0, 0, 0, 1, 0)
    with pytest.raises(ValueError, match="missing"):
        arima.fit(np.array([1.0, np.nan, 2.0]), np.zeros((3, 0)), order)
    with pytest.raises(ValueError, match="too few"):
        arima.fit(np.array([1.0, 2.0]), np.zeros((2, 0)), order)


@pytest.mark.parametrize("theta", [[0.4], [2.5], [-1.7], [0.5, -0.3], [1.9, 0.6], [0.2, 3.0], [1.0, 4.0], [0.3, 0.0]])
def test_reflection_keeps_autocorrelations_and_inverts(theta):
    twin = kernel.reflected(np.array([theta]))[0]
    roots = np.roots(np.concatenate([[1.0], twin])[::-1])
    assert (np.abs(roots[np.isfinite(roots)]) >= 1 - 1e-9).all()

    def rho(c):
        full = np.concatenate([[1.0], c])
        gamma = np.array([full[: len(full) - k] @ full[k:] for k in range(len(full))])
        return gamma[1:] / gamma[0]

    assert rho(twin) == pytest.approx(rho(np.array(theta)), abs=1e-4)


@pytest.mark.parametrize("order, params", [
    (kernel.Order(0, 0, 1, 0, 0, 0, 1), [0.7]), (kernel.Order(0, 1, 2, 0, 0, 0, 1), [0.5, 0.3]),
    (kernel.Order(1, 0, 1, 0, 0, 1, 4), [0.5, -0.6, 0.4]),
])
def test_search_with_and_without_the_invertible_map_ends_alike(order, params):
    rng = np.random.default_rng(8)
    y = np.stack([sarima(rng, 400, replace(order, d=0), np.array(params), np.zeros((400, 0))) for _ in range(4)])
    y = np.cumsum(y, axis=1) if order.d else y
    x = np.zeros((4, 400, 0))
    kept, free = kernel.fit_stack(y, x, order), kernel.fit_stack(y, x, order, free_moving=True)
    for a, b in zip(kept, free):
        assert a["sigma2"] == pytest.approx(b["sigma2"], rel=1e-4)
        assert a["params"] == pytest.approx(b["params"], abs=0.02)
    # From the far side of the unit circle too.
    far = kernel.fit_stack(y, x, order, free_moving=True, starts=np.full((4, order.size), 1.4))
    assert [f["sigma2"] for f in far] == pytest.approx([f["sigma2"] for f in kept], rel=1e-3)


def test_nested_starts_are_no_worse_and_quicker():
    """Families of the grid on a seasonal series: as good as from the common start (one in fifty may end in another dip of
    the sum), at least as good as with a lag less, in fewer turns."""
    from panelcast.operators import arima as operators

    rng = np.random.default_rng(9)
    x = rng.normal(size=(260, 2))
    y = np.cumsum(sarima(rng, 260, kernel.Order(2, 0, 1, 1, 0, 0, 12, 2), np.array([0.3, -0.2, 0.4, 0.2, 0.3, 0.3]), x))
    warm = cold = worse = 0
    candidates = [c for c in operators.grid_candidates(("tmean_c", "other"), 12) if c[0] == "full"]
    families = operators.nested(candidates)
    assert sorted(map(repr, candidates)) == sorted(repr(c) for f in families for c in f) and len(families) == 8
    reach = max(s.kernel_order().differenced + s.kernel_order().presample for _, s in candidates)
    for family in families:
        known = {}
        for _, spec in family:
            order, (p, _, q) = spec.kernel_order(), spec.order
            smaller = [known[o] for o in ((p - 1, q), (p, q - 1)) if o in known]
            start = operators._best_start(smaller, order)
            starts = None if start is None else start[None]
            found = kernel.fit_stack(y[None], x[None], order, 300, reach, starts=starts)[0]
            plain = kernel.fit_stack(y[None], x[None], order, 300, reach)[0]
            known[p, q] = (found["sigma2"], found["point"], order)
            worse += found["sigma2"] > plain["sigma2"] * (1 + 1e-3)
            assert not smaller or found["sigma2"] <= min(s[0] for s in smaller) * (1 + 1e-3)
            warm, cold = warm + found["n_iter"], cold + plain["n_iter"]
    assert warm < 0.85 * cold and worse <= 2
