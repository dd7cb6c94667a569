"""Exact Gaussian likelihood of seasonal ARIMA with regressors, missing observations included (numpy).

The state holds the stationary part w_t = phi(B)^-1 theta(B) e_t in companion form and, for differenced orders, the last
values of the disturbance u_t = w_t + sum_j delta_j u_{t-j}. The values before the sample have a flat prior, which is
carried as extra columns of the data (augmented filter): their part of the likelihood is that of any full set of
contrasts, and no large number stands in for an infinite variance. Regression coefficients are a further set of
columns, concentrated out as maximum likelihood has it. Lanes (parameter vectors) of all series go through one pass.
"""

from dataclasses import replace

import numpy as np

from panelcast.kernels import arima as kernel

# Largest number of doublings of the start covariance; 2**40 steps are beyond any series.
DOUBLINGS = 40
# Numbers in the state covariances of all lanes that go through one pass together.
PASS_NUMBERS = 2_000_000


def lag_coefficients(order):
    """delta_1, delta_2, … with u_t = w_t + sum_j delta_j u_{t-j}: the differencing, turned round."""
    c = np.ones(1)
    for _ in range(order.d):
        c = np.convolve(c, [1.0, -1.0])
    for _ in range(order.D):
        c = np.convolve(c, kernel.expand([], [-1.0], order.s))
    return -c[1:]


def companion(order, lanes):
    """``(phi, r)`` per lane, both as long as the companion state: autoregressive and moving-average sides, expanded."""
    _, phi, sphi, theta, stheta = order.parts(lanes)
    m = max(order.p + order.P * order.s, order.q + order.Q * order.s + 1)
    ar, ma = np.zeros((len(lanes), m)), np.zeros((len(lanes), m))
    for i in range(len(lanes)):
        full = -kernel.expand(-phi[i], -sphi[i], order.s)[1:]
        ar[i, : len(full)] = full
        full = kernel.expand(theta[i], stheta[i], order.s)
        ma[i, : len(full)] = full
    return ar, ma


def start_covariance(ar, ma):
    """Covariance of the companion state in equilibrium, sum_k T^k r r' T'^k, by doubling; infinite where it has none."""
    lanes, m = ar.shape
    t = np.zeros((lanes, m, m))
    t[:, :, 0] = ar
    t[:, np.arange(m - 1), np.arange(1, m)] = 1
    total = ma[:, :, None] * ma[:, None, :]
    for _ in range(DOUBLINGS):
        step = t @ total @ t.transpose(0, 2, 1)
        total = total + step
        t = t @ t
        if np.abs(t).max() < 1e-20 or not np.isfinite(total).all():
            break
    return np.where((np.abs(t).max(axis=(1, 2)) < 1e-8)[:, None, None], total, np.inf)


def _forward(state, ar, delta):
    """The transition applied to the rows of a (lane, state, column) array."""
    m = ar.shape[1]
    out = np.empty_like(state)
    out[:, : m - 1] = state[:, 1:m]
    out[:, m - 1] = 0
    out[:, :m] += ar[:, :, None] * state[:, :1]
    if len(delta):
        out[:, m] = state[:, 0] + np.einsum("j,ljc->lc", delta, state[:, m:])
        out[:, m + 1 :] = state[:, m:-1]
    return out


def innovations(order, lanes, columns, observed):
    """One pass of the filter: ``(ahead, errors, variances)``.

    ``columns`` is (lane, time, column): data, regressors. ``observed`` is (lane, time). The results have one more column
    per value before the sample: ``ahead`` is each column's forecast from the values before, ``errors`` what is left of
    the column, 0 where nothing is observed, ``variances`` that of an error over sigma2, missing values included.
    """
    ar, ma = companion(order, lanes)
    delta = lag_coefficients(order)
    count, n, width = columns.shape
    m, b = ar.shape[1], len(delta)
    state = np.zeros((count, m + b, width + b))
    # Data less coefficient times column is the rule for regressors; -1 makes it hold for values before the sample.
    state[:, m + np.arange(b), width + np.arange(b)] = -1
    spread = np.zeros((count, m + b, m + b))
    spread[:, :m, :m] = start_covariance(ar, ma)
    noise = np.zeros((count, m + b))
    noise[:, :m] = ma
    look = np.concatenate([[1.0], np.zeros(m - 1), delta])
    ahead, variances = np.zeros((count, n, width + b)), np.zeros((count, n))
    errors = np.zeros_like(ahead)
    data = np.concatenate([columns, np.zeros((count, n, b))], axis=2)
    for t in range(n):
        seen = observed[:, t]
        gain = spread @ look
        variance = gain @ look
        ahead[:, t], variances[:, t] = np.einsum("s,lsc->lc", look, state), variance
        error = errors[:, t] = (data[:, t] - ahead[:, t]) * seen[:, None]
        gain = gain * (seen / np.where(seen, variance, 1.0))[:, None]
        state = state + gain[:, :, None] * error[:, None, :]
        spread = spread - gain[:, :, None] * (gain * variance[:, None])[:, None, :]
        state = _forward(state, ar, delta)
        spread = _forward(_forward(spread, ar, delta).transpose(0, 2, 1), ar, delta).transpose(0, 2, 1)
        spread += noise[:, :, None] * noise[:, None, :]
    return ahead, errors, variances


def _project_out(y, x):
    """``(rest, coefficients, log det x'x)`` of least squares of y (lane, time, c) on x (lane, time, k)."""
    if not x.shape[2]:
        return y, np.zeros((len(y), 0, y.shape[2])), np.zeros(len(y))
    q, r = np.linalg.qr(x)
    diagonal = np.abs(np.diagonal(r, axis1=1, axis2=2))
    if (diagonal <= 1e-10 * diagonal.max(axis=1, keepdims=True)).any():
        raise np.linalg.LinAlgError("a value before the sample or a coefficient is not determined")
    coefficients = np.linalg.solve(r, q.transpose(0, 2, 1) @ y)
    return y - x @ coefficients, coefficients, 2 * np.log(diagonal).sum(axis=1)


def stack_size(order):
    """How many series to fit together: their lanes' state covariances stay in cache."""
    m = max(order.p + order.P * order.s, order.q + order.Q * order.s + 1) + order.differenced
    return max(1, PASS_NUMBERS // (m * m * (order.size + 5)))


def concentrated(order, lanes, y, x):
    """``(rest, beta, penalty, n)`` per lane of the autoregressive and moving-average parameters (no regression part).

    The likelihood at the best sigma2 and coefficients is that of ``n`` errors ``rest`` whose variances and determined
    values before the sample add ``penalty`` to -2 log L. y is (lane, time) with NaN where missing.
    """
    observed = np.isfinite(y)
    columns = np.concatenate([np.where(observed, y, 0.0)[:, :, None], x], axis=2)
    _, errors, variances = innovations(order, lanes, columns, observed)
    scaled = errors / np.sqrt(np.where(observed, variances, 1.0))[:, :, None]
    width = columns.shape[2]
    rest, _, log_det = _project_out(scaled[:, :, :width], scaled[:, :, width:])
    final, beta, _ = _project_out(rest[:, :, :1], rest[:, :, 1:])
    penalty = np.log(np.where(observed, variances, 1.0)).sum(axis=1) + log_det
    return final[:, :, 0], beta[:, :, 0], penalty, observed.sum(axis=1) - order.differenced


def log_likelihood(order, params, y, x, sigma2=None):
    """Exact log-likelihood of one series at the given parameters; at its best variance without ``sigma2``.

    With regressors, at their best coefficients: ``params`` holds the laid-out vector, of which the regression part is
    not used.
    """
    free = replace(order, k=0)
    rest, _, penalty, n = concentrated(free, np.asarray(params, float)[None, order.k :], y[None], x[None])
    total = float((rest[0] ** 2).sum())
    sigma2 = total / n[0] if sigma2 is None else sigma2
    return float(-0.5 * (n[0] * np.log(2 * np.pi * sigma2) + penalty[0] + total / sigma2))


def fit_stack(y, x, order, maxiter=500):
    """Exact maximum likelihood for a stack of equally long series, NaN for a missing observation.

    The likelihood is exp(penalty / n) times a sum of squares, so scaled errors go through the same Levenberg-Marquardt
    steps as conditional sums of squares do. The start distribution needs a stationary autoregressive side, which is
    kept so as ``natural`` does. Regression coefficients are solved for at every point.
    """
    free = replace(order, k=0)
    n = np.isfinite(y).sum(axis=1) - order.differenced
    if (n <= order.size + 1).any():
        raise ValueError("too few observations")
    def errors(points, who):
        width = points.shape[1]
        lanes = kernel.natural(points.reshape(len(who) * width, free.size), free, True)
        rows = np.repeat(who, width)
        rest, _, penalty, count = concentrated(free, lanes, y[rows], x[rows])
        return (rest * np.exp(penalty / (2 * count))[:, None]).reshape(len(who), width, -1)

    found = kernel.descend(errors, np.full((len(y), free.size), 0.01), maxiter)
    lanes = kernel.natural(found["point"], free, True)
    rest, beta, penalty, _ = concentrated(free, lanes, y, x)
    sigma2 = np.maximum((rest**2).sum(axis=1) / n, 1e-300)
    out = []
    for i in range(len(y)):
        likelihood = float(-0.5 * (n[i] * (np.log(2 * np.pi * sigma2[i]) + 1) + penalty[i]))
        out.append(
            {
                "params": np.concatenate([beta[i], lanes[i]]), "sigma2": float(sigma2[i]), "nobs": int(n[i]),
                "n_iter": int(found["turns"][i]), "converged": bool(found["converged"][i]),
                "log_likelihood": likelihood, "aic": -2 * likelihood + 2 * (order.size + 1),
            }
        )
    return out


def predict(y, x, order, params):
    """``(mean, variance)`` of every observation given the ones before it, the variance over sigma2.

    A missing observation (NaN) moves nothing: what follows the last known one is a multi-step path, with the variance
    of its horizon. NaN as long as the values before the sample are not determined.
    """
    params, b = np.asarray(params, float), order.differenced
    u = y - x @ params[: order.k]
    observed = np.isfinite(u)
    lanes, columns = params[None, order.k :], np.where(observed, u, 0.0)[None, :, None]
    ahead, errors, variances = (a[0] for a in innovations(replace(order, k=0), lanes, columns, observed[None]))
    mean, variance = np.full(len(y), np.nan), np.full(len(y), np.nan)
    information, score, known, found = np.zeros((b, b)), np.zeros(b), 0, b == 0
    for t in range(len(y)):
        effect = ahead[t, 1:]
        if found and np.abs(effect).max(initial=0) < 1e-12:
            mean[t], variance[t] = ahead[t, 0], variances[t]
        elif known >= b:
            value, cover = _before_sample(information, score)
            found = bool(np.isfinite(value).all())
            mean[t] = ahead[t, 0] - effect @ value
            variance[t] = variances[t] + effect @ cover @ effect
        if observed[t]:
            scaled = errors[t] / np.sqrt(variances[t])
            information += np.outer(scaled[1:], scaled[1:])
            score += scaled[1:] * scaled[0]
            known += 1
    return mean + x @ params[: order.k], variance


def _before_sample(information, score):
    """Values before the sample and their covariance over sigma2; NaN while not all are determined."""
    values, vectors = np.linalg.eigh(information)
    if values[0] <= 1e-10 * max(values[-1], 1e-300):
        return np.full(len(score), np.nan), np.full((len(score),) * 2, np.nan)
    cover = (vectors / values) @ vectors.T
    return cover @ score, cover
