"""Simulated series for the model tests."""

import numpy as np


def sarima(rng, n, order, params, x, sigma=0.28, burn=300):
    """A path of the model, by recursion from zero history."""
    from panelcast.kernels import arima as kernel

    ar, ma = kernel.polynomials(order, params)
    e = rng.normal(scale=sigma, size=n + burn)
    u = np.zeros(n + burn)
    for t in range(len(u)):
        past = sum(-ar[i] * u[t - i] for i in range(1, min(len(ar), t + 1)))
        u[t] = past + sum(ma[j] * e[t - j] for j in range(min(len(ma), t + 1)))
    return u[burn:] + x @ params[: order.k]
