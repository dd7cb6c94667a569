"""Seasonal ARIMA with regressors by conditional sum of squares (numpy).

y = X b + u, phi(B) Phi(B^s) (1-B)^d (1-B^s)^D u = theta(B) Theta(B^s) e. Parameter vectors are laid
out as [b, phi, Phi, theta, Theta]; a "lane" is one such vector, and all lanes of a pass (the Jacobian,
or a set of trial steps) are filtered together. This is not the exact Gaussian likelihood, so
coefficients and AIC differ slightly from a Kalman-filter fit.
"""

from dataclasses import dataclass

import numpy as np

# Turns that two starts of one fit go side by side.
RACE = 6
# Stop when a step lowers the sum of squares by less than this share.
GAIN = 1e-8
# Largest partial coefficient, just inside the unit circle.
LIMIT = 1 - 1e-6


@dataclass(frozen=True)
class Order:
    p: int
    d: int
    q: int
    P: int
    D: int
    Q: int
    s: int
    k: int = 0

    @property
    def differenced(self):
        return self.d + self.D * self.s

    @property
    def presample(self):
        """Differenced values the autoregression looks back on."""
        return self.p + self.P * self.s

    @property
    def size(self):
        return self.k + self.p + self.P + self.q + self.Q

    def parts(self, lanes):
        """Split parameter lanes into b, phi, Phi, theta, Theta."""
        return np.split(lanes, np.cumsum([self.k, self.p, self.P, self.q]), axis=-1)


def difference(x, order):
    """(1-B)^d (1-B^s)^D along the first axis."""
    for _ in range(order.d):
        x = x[1:] - x[:-1]
    for _ in range(order.D):
        x = x[order.s :] - x[: -order.s]
    return x


def apply(w, coefficients, step):
    """w plus sum_j c_j B^(j*step) w, from j = 1 up, zeros before the sample: the polynomial with
    constant term 1 and per-lane coefficients c applied to lanes w."""
    out = w.copy()
    for j in range(1, coefficients.shape[1]):
        shift = j * step
        if shift >= w.shape[1]:
            break
        out[:, shift:] += coefficients[:, j : j + 1] * w[:, :-shift]
    return out


def invert(w, coefficients, step):
    """Solve c(B^step) e = w with zeros before the sample.

    1/c(x) = c(-x) / (c(x) c(-x)) and the new denominator has even powers only, so the lag doubles
    with each turn and log2(length) turns replace the recursion over time.
    """
    c = coefficients
    while step < w.shape[1] and c.shape[1] > 1 and np.any(c[:, 1:]):
        mirrored = c * (-1.0) ** np.arange(c.shape[1])
        w = apply(w, mirrored, step)
        product = np.zeros((len(c), 2 * c.shape[1] - 1))
        for j in range(c.shape[1]):
            product[:, j : j + c.shape[1]] += c[:, j : j + 1] * mirrored
        c, step = product[:, ::2], 2 * step
    return w


def with_one(coefficients):
    return np.concatenate([np.ones((len(coefficients), 1)), coefficients], axis=1)


def innovations(lanes, z, order, skip):
    """One-step errors from position ``skip`` of the differenced disturbances z on, per lane."""
    _, phi, sphi, theta, stheta = order.parts(lanes)
    w = apply(apply(z, with_one(-phi), 1), with_one(-sphi), order.s)[:, skip:]
    return invert(invert(w, with_one(stheta), order.s), with_one(theta), 1)


def stable(free):
    """Coefficients c of a polynomial 1 + c_1 x + … with every root outside the unit circle, from
    any real numbers: their tanh serves as partial coefficients."""
    partial = LIMIT * np.tanh(free)
    c = partial[:, :0]
    for k in range(partial.shape[1]):
        last = partial[:, k : k + 1]
        c = np.concatenate([c + last * c[:, ::-1], last], axis=1)
    return c


def reflected(c):
    """Coefficients of the invertible twins of the polynomials 1 + c_1 x + …, from any real numbers: every root inside the
    unit circle gives way to its reciprocal, which leaves the autocorrelations as they are."""
    if not c.shape[1]:
        return c
    if c.shape[1] == 1:
        inverse = 1 / np.where(np.abs(c) > 1, c, 1.0)
        return LIMIT * np.where(np.abs(c) > 1, inverse, c)
    out = np.empty_like(c)
    for i, row in enumerate(np.where(np.isfinite(c), c, 0.0)):
        # The roots of the reversed polynomial are the reciprocals: invertible are those within the circle.
        turned = np.roots(np.concatenate([[1.0], row]))
        size = np.abs(turned)
        turned = LIMIT * np.where(size > 1, turned / np.maximum(size, 1.0) ** 2, turned)
        full = np.real(np.poly(turned)) if len(turned) else np.ones(1)
        out[i] = np.concatenate([full[1:], np.zeros(c.shape[1] + 1 - len(full))])
    return out


def natural(lanes, order, stationary, free_moving=False):
    """Search space to model parameters.

    The moving-average side comes out invertible: a model that is not has an invertible twin with the same
    likelihood, while the recursion for its innovations explodes. It is searched through partial coefficients
    (``stable``), or with ``free_moving`` as plain coefficients that stand for their twin (``reflected``). The
    autoregressive side is free unless ``stationary``.
    """
    b, phi, sphi, theta, stheta = order.parts(lanes)
    if stationary:
        phi, sphi = -stable(phi), -stable(sphi)
    invertible = reflected if free_moving else stable
    return np.concatenate([b, phi, sphi, invertible(theta), invertible(stheta)], axis=1)


def descend(errors, start, maxiter):
    """Levenberg-Marquardt on sums of squares for a stack of problems: ``point``, ``best``, ``turns``, ``converged``.

    ``errors(points, who)`` gives the errors (problem, lane, error) of the lanes of trial points (problem, lane,
    parameter) for the problems ``who``. All lanes of all problems that still move go through one call.
    """
    count, size = start.shape

    def loss(e):
        total = (e * e).sum(axis=-1)
        return np.where(np.isfinite(total), total, np.inf)

    active = np.arange(count)
    point = start.copy()
    turns, converged = np.zeros(count, dtype=np.int64), np.full(count, size == 0)
    damping, descended = np.full(count, 1e-3), np.zeros(count, dtype=bool)
    with np.errstate(all="ignore"):
        e = errors(point[:, None], active)[:, 0]
        best = loss(e)
        active = active[~converged]
        for _ in range(maxiter):
            if not len(active):
                break
            turns[active] += 1
            at, now = point[active], e[active]
            h = 1e-6 * np.maximum(1.0, np.abs(at))
            slope = (errors(at[:, None] + h[:, :, None] * np.eye(size), active) - now[:, None]) / h[:, :, None]
            slope = np.nan_to_num(slope, posinf=0.0, neginf=0.0)
            hessian, gradient = slope @ slope.transpose(0, 2, 1), slope @ now[:, :, None]
            scale = np.eye(size) * (np.diagonal(hessian, axis1=1, axis2=2) + 1e-12)[:, None]
            tries = damping[active, None] * 10.0 ** np.arange(-1, 4)
            system = hessian[:, None] + tries[:, :, None, None] * scale[:, None]
            lanes = at[:, None] - np.linalg.solve(system, gradient[:, None])[..., 0]
            trial = errors(lanes, active)
            losses = loss(trial)
            pick, rows = losses.argmin(axis=1), np.arange(len(active))
            low, before = losses[rows, pick], best[active]
            better = low < before
            done = better & (before - low <= GAIN * before)
            moved, taken = active[better], (rows[better], pick[better])
            point[moved], e[moved], best[moved] = lanes[taken], trial[taken], low[better]
            damping[moved] = np.maximum(tries[taken], 1e-9)
            stuck = active[~better]
            damping[stuck] *= 1e4
            done[~better] = damping[stuck] > 1e9
            # No descent is convergence only where the slope is flat or steps have led there.
            flat = np.abs(gradient[:, :, 0]).max(axis=1) <= 1e-6 * np.maximum(before, 1e-300)
            descended[moved] = True
            converged[active[done]] = (np.isfinite(best[active]) & (descended[active] | flat))[done]
            active = active[~done]
    return {"point": point, "best": best, "turns": turns, "converged": converged}


def fit(y, x, order, maxiter=500, condition_on=None, stationary=False, free_moving=False):
    """``fit_stack`` for one series."""
    if not (np.isfinite(y).all() and np.isfinite(x).all()):
        raise ValueError("missing values")
    return fit_stack(y[None], x[None], order, maxiter, condition_on, stationary, free_moving)[0]


def widened(point, order, wider):
    """A point of the search space of ``order`` in that of ``wider``, which has more lags: the same model there."""
    old, new = order.parts(point), wider.parts(np.zeros(wider.size))
    for small, large in zip(old, new):
        large[: len(small)] = small
    return np.concatenate(new)


def fit_stack(y, x, order, maxiter=500, condition_on=None, stationary=False, free_moving=False, starts=None):
    """Levenberg-Marquardt on the sum of squared innovations, for a stack of equally long series.

    y is (series, time), x is (series, time, regressor). All lanes of all series that still move go
    through one pass of the filters, which costs little more than a single one. ``condition_on`` is the
    number of leading observations left out of the sum; candidates of one search share it, so that
    their AICs rest on the same weeks. ``starts`` (series, parameter) are further points to start from, NaN where
    there is none: each series begins at the better one.
    """
    least = order.differenced + order.presample
    skip = max(condition_on or 0, least) - order.differenced
    count, size, n = len(y), order.size, y.shape[1] - order.differenced - skip
    if n <= size + 1:
        raise ValueError("too few observations")
    dy = difference(y.T, order).T
    dx = difference(x.transpose(1, 0, 2), order).transpose(1, 0, 2)

    def errors(points, who):
        width = points.shape[1]
        lanes = natural(points.reshape(len(who) * width, size), order, stationary, free_moving)
        b = lanes[:, : order.k].reshape(len(who), width, order.k)
        z = dy[who, None] - b @ dx[who].transpose(0, 2, 1)
        return innovations(lanes, z.reshape(len(lanes), -1), order, skip).reshape(len(who), width, n)

    start = np.full((count, size), 0.01)
    if order.k:
        start[:, : order.k] = (np.linalg.pinv(dx) @ dy[:, :, None])[:, :, 0]
    given = np.zeros(count, bool) if starts is None else np.isfinite(starts).all(axis=1)
    raced = np.zeros(count, dtype=np.int64)
    if given.any() and size:
        # Both starts go a few turns side by side; the better one goes on alone.
        pairs = np.flatnonzero(given)
        both = descend(lambda points, who: errors(points, pairs[who // 2]), np.stack([start[pairs], starts[pairs]], 1).reshape(-1, size), RACE)
        ahead = both["best"].reshape(-1, 2).argmin(axis=1) + 2 * np.arange(len(pairs))
        start[pairs], raced[pairs] = both["point"][ahead], both["turns"][ahead]
    found = descend(errors, start, maxiter)
    point, best, turns, converged = (found[name] for name in ("point", "best", "turns", "converged"))
    turns = turns + raced
    sigma2 = np.maximum(best / n, 1e-300)
    params = natural(point, order, stationary, free_moving)
    return [
        {
            "params": params[i], "point": point[i], "sigma2": float(sigma2[i]), "nobs": n,
            "n_iter": int(turns[i]), "converged": bool(converged[i]),
            "log_likelihood": float(-0.5 * n * (np.log(2 * np.pi * sigma2[i]) + 1)),
            "aic": float(n * np.log(2 * np.pi * sigma2[i]) + n + 2 * (size + 1)),
        }
        for i in range(count)
    ]


def one_step_stack(y, x, order, lanes):
    """``one_step`` for a stack of equally long series (series, time), each with its own parameters (series, parameter)."""
    dx = difference(x.transpose(1, 0, 2), order).transpose(1, 0, 2)
    z = difference(y.T, order).T - np.einsum("stk,sk->st", dx, lanes[:, : order.k])
    with np.errstate(all="ignore"):
        e = innovations(lanes, z, order, order.presample)
    lead = min(order.differenced + order.presample, y.shape[1])
    return np.concatenate([np.full((len(y), lead), np.nan), y[:, lead:] - e], axis=1)


def one_step(y, x, order, params):
    """Forecast of every observation from the ones before it; NaN where the history is too short."""
    return one_step_stack(y[None], x[None], order, np.asarray(params, float)[None])[0]


def expand(plain, seasonal, step):
    """Product of 1 + sum plain_i B^i and 1 + sum seasonal_j B^(j*step)."""
    stretched = np.zeros(len(seasonal) * step + 1)
    stretched[0] = 1
    stretched[step::step] = seasonal
    return np.convolve(np.concatenate([[1.0], plain]), stretched)


def polynomials(order, params):
    """Coefficients of the full autoregressive side, differencing included, and of the
    moving-average side, from lag 0 up."""
    _, phi, sphi, theta, stheta = order.parts(params)
    ar = expand(-phi, -sphi, order.s)
    for _ in range(order.d):
        ar = np.convolve(ar, [1.0, -1.0])
    for _ in range(order.D):
        ar = np.convolve(ar, expand([], [-1.0], order.s))
    return ar, expand(theta, stheta, order.s)


def next_value(u, e, ar, ma):
    """Expected next disturbance after the histories u and e, newest last."""
    return ma[1:] @ e[len(e) - len(ma) + 1 :][::-1] - ar[1:] @ u[len(u) - len(ar) + 1 :][::-1]


def horizon_variances(order, params, steps):
    """Variance of the error of a forecast 1, 2, … steps ahead over that of one innovation: the sums of squares of the
    weights psi of ma(B) / ar(B), differencing included, so they never fall."""
    ar, ma = polynomials(order, params)
    psi = np.zeros(steps)
    for j in range(steps):
        reach = min(j, len(ar) - 1)
        psi[j] = (ma[j] if j < len(ma) else 0.0) - ar[1 : reach + 1] @ psi[j - reach : j][::-1]
    return np.cumsum(psi**2)


def path_stack(y, x, future_x, order, lanes):
    """``path`` for a stack of equally long series, each with its own parameters."""
    sides = [polynomials(order, params) for params in lanes]
    ar, ma = (np.stack(side) for side in zip(*sides))
    (count, n), steps, b = y.shape, future_x.shape[1], lanes[:, : order.k]
    p, q = ar.shape[1] - 1, ma.shape[1] - 1
    if n < p:
        return np.full((count, steps), np.nan)
    # Innovations before the sample and after it are zero.
    e = np.zeros((count, q + n + steps))
    e[:, q : q + n] = np.nan_to_num(y - one_step_stack(y, x, order, lanes))
    u = np.zeros((count, n + steps))
    u[:, :n] = y - np.einsum("stk,sk->st", x, b)
    back, moved = ar[:, :0:-1], ma[:, :0:-1]
    for t in range(n, n + steps):
        u[:, t] = (moved * e[:, t : t + q]).sum(axis=1) - (back * u[:, t - p : t]).sum(axis=1)
    return u[:, n:] + np.einsum("stk,sk->st", future_x, b)


def path(y, x, future_x, order, params):
    """Forecasts of the steps after y, each fed by the ones before it, future innovations zero; NaN
    where the history is shorter than the autoregression looks back."""
    return path_stack(y[None], x[None], future_x[None], order, np.asarray(params, float)[None])[0]
