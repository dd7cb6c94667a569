"""Seasonal ARIMA with regressors over a panel: fit, forecast, search.

Every fit is one packed series in a task (see ``packing``); the numeric part lives in
``kernels.arima``. Estimation is by conditional sum of squares, or by the exact likelihood
(``method="exact"``, ``kernels.statespace``), which takes series with missing weeks as they are.
"""

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial
from itertools import product
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.scalars import from_log, nan_to_null
from panelcast.functions.windows import by_time
from panelcast.kernels import arima as kernel
from panelcast.kernels import statespace
from panelcast.operators.packing import key_schema, pack, spread
from panelcast.session import task_slots

KEYS = ("series_id",)
SCORED = {"week_start": "date", "log_y": "double", "log_hat": "double"}
# Default orders, regressors, iteration limits and the name of the scored model.
ORDER, SEASONAL = (3, 1, 0), (1, 0, 1, 52)
REGRESSORS = ("tmean_c", "tmean_lag1", "tmean_lag2", "AUS_ILI_LAG1", "school_in_session")
MAXITER, SEARCH_MAXITER = 500, 300
MODEL_NAME = "SARIMAX (rolling)"

# Series fitted together: enough to share the cost of a pass, few enough to stay in cache.
STACK = 64
COEFFICIENTS = ("beta", "ar", "sar", "ma", "sma")
MODEL_FIELDS = {
    "order": "array<int>",
    "seasonal": "array<int>",
    "exog": "array<string>",
    **dict.fromkeys(COEFFICIENTS, "array<double>"),
    "sigma2": "double",
    "log_likelihood": "double",
    "aic": "double",
    "nobs": "long",
    "n_iter": "long",
    "converged": "boolean",
    "message": "string",
}


def _ddl(fields: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


def known_method(method: str) -> str:
    if method not in ("css", "exact"):
        raise ValueError(f"unknown method {method!r}")
    return method


@dataclass(frozen=True)
class SarimaxSpec:
    """Orders, regressors, limits and method. The moving-average side always comes out invertible (see
    ``kernels.arima.natural``); ``enforce_invertibility`` says whether the search itself keeps it so, or runs over all
    coefficients and ends at the invertible twin.

    ``method``: ``css`` minimises the conditional sum of squares of complete series; ``exact`` maximises the Gaussian
    likelihood with a flat prior on what lies before the sample. It fits series with missing values of the target,
    keeps the autoregressive side stationary, and is slower by the size of the state.
    """

    order: tuple[int, int, int] = ORDER
    seasonal: tuple[int, int, int, int] = SEASONAL
    exog: tuple[str, ...] = REGRESSORS
    enforce_stationarity: bool = False
    maxiter: int = MAXITER
    method: str = "css"
    enforce_invertibility: bool = True

    def __post_init__(self):
        known_method(self.method)

    def kernel_order(self) -> kernel.Order:
        (p, d, q), (P, D, Q, s) = self.order, self.seasonal
        return kernel.Order(p, d, q, P, D, Q, max(s, 1), len(self.exog))


# -- rows of a packed batch -----------------------------------------------------------------------


def values(row) -> np.ndarray:
    return np.asarray(row["y"], dtype=float)


def design(row, exog):
    y = row["y"]
    return np.column_stack([np.asarray(row[c], dtype=float) for c in exog]) if exog else np.zeros((len(y), 0))


def _model_row(spec: SarimaxSpec, found: dict | None, message: str | None = None) -> dict:
    """Model row of one fit; a failed one is a row with a message, never a failed task."""
    out = dict.fromkeys(MODEL_FIELDS)
    out.update(order=list(spec.order), seasonal=list(spec.seasonal), exog=list(spec.exog), converged=False, message=message)
    if found is not None:
        b, ar, sar, ma, sma = spec.kernel_order().parts(found["params"])
        out.update({k: v for k, v in found.items() if k not in ("params", "point")})
        out.update(beta=b.tolist(), ar=ar.tolist(), sar=sar.tolist(), ma=ma.tolist(), sma=sma.tolist())
    return out


def common_reach(n: int, orders: Sequence[kernel.Order]) -> int:
    """Leading weeks that the candidates of a search leave out for a series of ``n`` weeks: the longest
    reach with which every candidate that looks no further back can still be fitted."""
    needs = sorted({o.differenced + o.presample for o in orders})
    fits = [r for r in needs if all(n - r > o.size + 1 for o in orders if o.differenced + o.presample <= r)]
    return max(fits, default=needs[0] if needs else 0)


def _fit_rows(spec: SarimaxSpec, data, condition_on=None, starts=None) -> list[tuple[dict, dict | None]]:
    """Model row and fit for every (y, x); equally long series are fitted as stacks. ``starts`` has a point to start from,
    or None, for every one.

    ``condition_on`` gives the leading weeks to leave out by the length of a series; an order that looks
    further back is not fitted.
    """
    out: list = [(_model_row(spec, None, "missing values"), None)] * len(data)
    lengths: dict[int, list[int]] = {}
    order, exact = spec.kernel_order(), spec.method == "exact"
    size = statespace.stack_size(order) if exact else STACK
    for i, (y, x) in enumerate(data):
        if np.isfinite(x).all() and (exact or np.isfinite(y).all()):
            lengths.setdefault(len(y), []).append(i)

    def fit_together(stack, skip):
        y, x = np.stack([data[i][0] for i in stack]), np.stack([data[i][1] for i in stack])
        if exact:
            return statespace.fit_stack(y, x, order, spec.maxiter)
        nowhere = np.full(order.size, np.nan)
        known = None if starts is None else np.stack([nowhere if starts[i] is None else starts[i] for i in stack])
        free_moving = not spec.enforce_invertibility
        return kernel.fit_stack(y, x, order, spec.maxiter, skip, spec.enforce_stationarity, free_moving, known)

    for length, members in lengths.items():
        skip = condition_on(length) if condition_on else None
        if skip is not None and skip < order.differenced + order.presample:
            for i in members:
                out[i] = (_model_row(spec, None, "too few observations"), None)
            continue
        for first in range(0, len(members), size):
            stack = members[first : first + size]
            try:
                found = dict(zip(stack, fit_together(stack, skip)))
            except (ValueError, np.linalg.LinAlgError):
                # One of them cannot be fitted; the others still can.
                found = {}
                for i in stack:
                    try:
                        found[i] = fit_together([i], skip)[0]
                    except (ValueError, np.linalg.LinAlgError) as failure:
                        out[i] = (_model_row(spec, None, str(failure)), None)
            for i, one in found.items():
                out[i] = (_model_row(spec, one), one)
    return out


def fitted_model(model) -> tuple[SarimaxSpec, np.ndarray]:
    spec = SarimaxSpec(tuple(model["order"]), tuple(model["seasonal"]), tuple(model["exog"]))
    return spec, np.concatenate([np.asarray(model[c], dtype=float) for c in COEFFICIENTS])


def score_series(packed: DataFrame, keys: Sequence[str], score, columns: Mapping[str, str]) -> DataFrame:
    """Apply ``score`` (packed rows to equally long sequences of every row, one per column) to all series.

    A task returns one row of arrays per series; Spark makes the rows of them.
    """
    keys = list(keys)

    def batch(batches):
        for pdf in batches:
            rows = pdf.to_dict("records")
            if rows:
                yield pd.DataFrame([{**{k: row[k] for k in keys}, **found} for row, found in zip(rows, score(rows))])

    arrays = ", ".join(f"{name} array<{kind}>" for name, kind in columns.items())
    scored = spread(packed, keys).mapInPandas(batch, f"{key_schema(packed, keys)}, {arrays}")
    return scored.select(*keys, F.inline(F.arrays_zip(*columns)))


def with_equal_models(rows: Sequence[dict], shape, ahead) -> list[np.ndarray | None]:
    """``ahead`` of every row that has a model, None of the others. Rows of one spec and ``shape`` go through it together:
    ``ahead(rows, spec, lanes)`` gives a sequence for each."""
    groups: dict = {}
    lanes = {}
    for i, row in enumerate(rows):
        if row["model"] is not None:
            spec, lanes[i] = fitted_model(row["model"])
            groups.setdefault((spec, shape(row)), []).append(i)
    found: list = [None] * len(rows)
    for (spec, _), members in groups.items():
        for first in range(0, len(members), STACK):
            stack = members[first : first + STACK]
            values = ahead([rows[i] for i in stack], spec, np.stack([lanes[i] for i in stack]))
            for i, value in zip(stack, values):
                found[i] = value
    return found


# -- packed inputs --------------------------------------------------------------------------------


def pack_history(
    panel: DataFrame, keys: Sequence[str], exog: Sequence[str], value: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Per series: arrays ``weeks``, ``y``, one per regressor and per extra column."""
    columns = ["y", *exog, *extra]
    rows = panel.withColumns(
        {"y": F.col(value).cast("double"), **{c: F.col(c).cast("double") for c in exog}}
    )
    return pack(rows, keys, columns).select(
        *keys, F.col("rows.week_start").alias("weeks"), *(F.col(f"rows.{c}").alias(c) for c in columns)
    )


def with_models(history: DataFrame, models: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Join the fitted parameters; both sides hold one row per series. A series whose fit failed keeps
    its rows with a NULL model, and gets NULL forecasts."""
    if models is None:
        raise RuntimeError("Model must be fitted before forecasting")
    model = F.struct("order", "seasonal", "exog", *COEFFICIENTS, "sigma2").alias("model")
    return history.join(models.filter("message IS NULL").select(*keys, model), list(keys), "left")


def without_nan(forecasts: DataFrame) -> DataFrame:
    return forecasts.withColumns(
        {c: nan_to_null(F.col(c)) for c in ("log_y", "log_hat", "sigma") if c in forecasts.columns}
    )


def with_interval(forecasts: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``y_hat, ci_lower, ci_upper`` from ``log_hat`` and ``sigma``, back from logs, clipped at 0."""
    half = F.lit(NormalDist().inv_cdf(1 - alpha / 2)) * F.col("sigma")
    return forecasts.withColumns(
        {
            "y_hat": from_log(F.col("log_hat")),
            "ci_lower": from_log(F.col("log_hat") - half),
            "ci_upper": from_log(F.col("log_hat") + half),
        }
    )


# -- fit and forecast -----------------------------------------------------------------------------


def fit(
    panel: DataFrame,
    spec: SarimaxSpec = SarimaxSpec(),
    keys: Sequence[str] = KEYS,
    value: str = "log_y",
    orders: DataFrame | None = None,
    placed: bool = False,
) -> DataFrame:
    """One parameter row per series, fitted on all rows handed in.

    ``orders`` (keys, ``order``, ``seasonal``; the result of ``auto_order``) replaces the orders of the
    spec series by series. ``placed`` says that the panel lies by series already in enough parts (a table from
    ``writers.write_bucketed``): it is packed and fitted where it is, without an exchange.
    """
    keys = list(keys)

    def fit_batch(batches):
        for pdf in batches:
            groups: dict[SarimaxSpec, list[dict]] = {}
            for row in pdf.to_dict("records"):
                own = spec
                if row.get("order") is not None:
                    own = replace(spec, order=tuple(row["order"]), seasonal=tuple(row["seasonal"]))
                groups.setdefault(own, []).append(row)
            for own, rows in groups.items():
                data = [(np.asarray(r["y"], dtype=float), design(r, spec.exog)) for r in rows]
                models = [model for model, _ in _fit_rows(own, data)]
                yield pd.DataFrame([{**{k: r[k] for k in keys}, **m} for r, m in zip(rows, models)])

    history = pack_history(panel, keys, spec.exog, value)
    if orders is not None:
        history = history.join(orders.select(*keys, "order", "seasonal"), keys, "left")
    ready = history if placed else spread(history, keys)
    return ready.mapInPandas(fit_batch, f"{key_schema(panel, keys)}, {_ddl(MODEL_FIELDS)}")


def save_models(models: DataFrame, path: str) -> None:
    models.write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def walk_forward(
    panel: DataFrame,
    models: DataFrame | None,
    exog: Sequence[str] = REGRESSORS,
    keys: Sequence[str] = KEYS,
    value: str = "log_y",
    alpha: float = 0.05,
    method: str = "css",
) -> DataFrame:
    """One-step forecasts of the test rows, each from the actuals before it, parameters fixed.

    With fixed parameters the forecast is the actual less its innovation, so one filter pass over
    train and test stands for the loop of forecast and append. ``method="exact"`` runs the state-space filter: a
    missing actual gets a forecast too and is bridged by it, and ``sigma`` is that of the week, wider after gaps.
    """
    keys, exog, exact = list(keys), list(exog), known_method(method) == "exact"

    def ahead(rows, spec, lanes):
        y, x, order = np.stack([values(r) for r in rows]), np.stack([design(r, spec.exog) for r in rows]), spec.kernel_order()
        if exact:
            return [statespace.predict(*one, order, params) for *one, params in zip(y, x, lanes)]
        return [(mean, np.ones(len(mean))) for mean in kernel.one_step_stack(y, x, order, lanes)]

    def score(rows):
        for row, found in zip(rows, with_equal_models(rows, lambda r: len(r["y"]), ahead)):
            y, test = values(row), np.asarray(row["part"]) == "test"
            mean, sigma = np.full(len(y), np.nan), np.full(len(y), np.nan)
            if found is not None:
                mean, sigma = found[0], np.sqrt(row["model"]["sigma2"] * found[1])
            yield {"week_start": np.asarray(row["weeks"])[test], "log_y": y[test], "log_hat": mean[test], "sigma": sigma[test]}

    history = with_models(pack_history(panel, keys, exog, value, ["part"]), models, keys)
    scored = score_series(history, keys, score, SCORED | {"sigma": "double"})
    return with_interval(without_nan(scored), alpha)


def walk_forward_by_lags(
    panel: DataFrame,
    models: DataFrame | None,
    order: Sequence[int],
    seasonal: Sequence[int],
    exog: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    value: str = "log_y",
    alpha: float = 0.05,
) -> DataFrame:
    """``walk_forward`` for orders without moving-average terms, as lag expressions: no Python."""
    (p, d, q), (P, D, Q, s) = order, seasonal
    if q or Q:
        raise ValueError("moving-average terms need walk_forward")

    def times(a: dict[int, Column], b: dict[int, Column]) -> dict[int, Column]:
        out: dict[int, Column] = {}
        for (i, x), (j, y) in product(a.items(), b.items()):
            out[i + j] = out[i + j] + x * y if i + j in out else x * y
        return out

    one = F.lit(1.0)
    lhs = times(
        {0: one, **{i: -F.get("model.ar", F.lit(i - 1)) for i in range(1, p + 1)}},
        {0: one, **{j * s: -F.get("model.sar", F.lit(j - 1)) for j in range(1, P + 1)}},
    )
    for _ in range(d):
        lhs = times(lhs, {0: one, 1: -one})
    for _ in range(D):
        lhs = times(lhs, {0: one, s: -one})
    if models is None:
        raise RuntimeError("Model must be fitted before forecasting")
    fitted = models.filter("message IS NULL").select(
        *keys, F.struct("beta", "ar", "sar", "sigma2").alias("model")
    )
    effect = F.lit(0.0)
    for i, c in enumerate(exog):
        effect = effect + F.get("model.beta", F.lit(i)) * F.col(c)
    rows = panel.join(fitted, list(keys), "left").withColumn("_effect", effect)
    rows = rows.withColumn("_u", F.col(value) - F.col("_effect"))
    w = by_time(keys)
    ahead = F.col("_effect")
    for step, coefficient in sorted(lhs.items(), key=lambda item: item[0]):
        if step:
            ahead = ahead - coefficient * F.lag("_u", step).over(w)
    rows = rows.withColumns({"log_hat": ahead, "sigma": F.sqrt("model.sigma2")}).filter("part = 'test'")
    return with_interval(rows, alpha).select(
        *keys, "week_start", F.col(value).alias("log_y"), "log_hat", "sigma", "y_hat", "ci_lower", "ci_upper"
    )


def _split_row(row, exog):
    """Train and test arrays of a packed row, in time order."""
    y, x = np.asarray(row["y"], dtype=float), design(row, exog)
    train = np.asarray(row["part"]) == "train"
    return y[train], x[train], y[~train], x[~train], train


def forecast_multistep(
    panel: DataFrame,
    models: DataFrame | None,
    exog: Sequence[str] = REGRESSORS,
    keys: Sequence[str] = KEYS,
    value: str = "log_y",
    method: str = "css",
) -> DataFrame:
    """All test rows at once from the end of train, with their regressors. ``method="exact"`` goes on from train with
    missing weeks; the test rows are one more gap to it."""
    keys, exog, exact = list(keys), list(exog), known_method(method) == "exact"

    def ahead(rows, spec, lanes):
        y, x, _, future, _ = (np.stack(part) for part in zip(*(_split_row(r, spec.exog) for r in rows)))
        order = spec.kernel_order()
        if not exact:
            return kernel.path_stack(y, x, future, order, lanes)
        gap = np.concatenate([y, np.full(future.shape[:2], np.nan)], axis=1)
        design_ = np.concatenate([x, future], axis=1)
        return [statespace.predict(*one, order, params)[0][y.shape[1] :] for *one, params in zip(gap, design_, lanes)]

    def score(rows):
        shape = lambda r: (len(r["y"]), sum(p == "train" for p in r["part"]))
        for row, found in zip(rows, with_equal_models(rows, shape, ahead)):
            train = np.asarray(row["part"]) == "train"
            actual = values(row)[~train]
            mean = np.full(len(actual), np.nan) if found is None else found
            yield {"week_start": np.asarray(row["weeks"])[~train], "log_y": actual, "log_hat": mean}

    history = with_models(pack_history(panel, keys, exog, value, ["part"]), models, keys)
    return without_nan(score_series(history, keys, score, SCORED)).withColumn("y_hat", from_log(F.col("log_hat")))


# -- order search ---------------------------------------------------------------------------------


# The regressor sets of the grid, each by the name fragment that its columns share.
FEATURE_SETS = {"full": "", "temp_only": "tmean", "temp_current": "tmean_c", "temp_lagged": "tmean_lag"}


def feature_sets(exog: Sequence[str] = REGRESSORS) -> dict[str, tuple[str, ...]]:
    """The regressors of every set of the grid."""
    return {name: tuple(filter(lambda c: fragment in c, exog)) for name, fragment in FEATURE_SETS.items()}


# The orders p, q, P, D and Q of the grid.
GRID_RANGES = ((2, 3, 4), (0, 1, 2), (0, 1), (0, 1), (0, 1))


def grid_candidates(exog: Sequence[str] = REGRESSORS, s: int = 52) -> list[tuple[str, SarimaxSpec]]:
    """288 candidates: three p, three q, two each of P, D and Q, four regressor sets."""
    return [
        (name, SarimaxSpec((p, 1, q), (P, D, Q, s), columns, maxiter=SEARCH_MAXITER))
        for p, q, P, D, Q in product(*GRID_RANGES)
        for name, columns in feature_sets(exog).items()
    ]


# Upper bounds of the order search.
ORDER_BOUNDS = {"p": 4, "d": 1, "q": 2, "P": 1, "D": 1, "Q": 1}


def order_candidates(
    exog: Sequence[str] = REGRESSORS, s: int = 52, bounds: Mapping[str, int] = ORDER_BOUNDS
) -> list[tuple[str, SarimaxSpec]]:
    """Every order within the bounds, with all regressors."""
    ranges = (range(bounds[name] + 1) for name in ("p", "d", "q", "P", "D", "Q"))
    return [
        ("full", SarimaxSpec((p, d, q), (P, D, Q, s), tuple(exog), maxiter=SEARCH_MAXITER))
        for p, d, q, P, D, Q in product(*ranges)
    ]


def nested(candidates: Sequence[tuple[str, SarimaxSpec]]) -> list[list[tuple[str, SarimaxSpec]]]:
    """Families of candidates that differ in p and q alone, each from the fewest lags up."""
    families: dict = {}
    for name, spec in candidates:
        (_, d, _), rest = spec.order, replace(spec, order=(0, spec.order[1], 0))
        families.setdefault((name, d, rest), []).append((name, spec))
    return [sorted(f, key=lambda c: (c[1].order[0] + c[1].order[2], c[1].order)) for f in families.values()]


def _best_start(fits: Sequence[tuple | None], order: kernel.Order) -> np.ndarray | None:
    """Where to start from, out of fits (sigma2, point, order) with fewer lags."""
    found = [f for f in fits if f is not None]
    if not found:
        return None
    _, point, smaller = min(found, key=lambda f: f[0])
    return kernel.widened(point, smaller, order)


def search(
    panel: DataFrame,
    candidates: Sequence[tuple[str, SarimaxSpec]],
    keys: Sequence[str] = KEYS,
    value: str = "log_y",
    slices: int = 32,
) -> DataFrame:
    """Fit every candidate on train and score its multi-step forecast on test.

    The unit of work is a (series, slice of candidates) pair. Every part holds one slice and a share of
    the series, so one series alone keeps ``slices`` tasks busy, many series are fitted as stacks, and a
    history is shipped ``slices`` times rather than once per candidate. A slice holds whole families (``nested``): the
    fit of a candidate also starts from the better one of those with a lag less. A failed fit is a row with a
    message and no AIC. All candidates of a series leave out the same leading weeks, so their AICs compare;
    a short series leaves out the candidates that look too far back for it, and those alone.
    ``time`` is a candidate's share of its batch.
    """
    keys, candidates = list(keys), list(candidates)
    families = nested(candidates)
    slices = min(slices, len(families))
    exog = sorted({c for _, spec in candidates for c in spec.exog})
    orders = [spec.kernel_order() for _, spec in candidates]
    reach = partial(common_reach, orders=orders)

    def score_batch(batches):
        for pdf in batches:
            for number, group in pdf.groupby("slice"):
                rows = group.to_dict("records")
                for family in families[number::slices]:
                    known: dict = {}
                    for name, spec in family:
                        yield pd.DataFrame(score(rows, name, spec, known))

    def score(rows, name, spec, known):
        parts = [_split_row(row, spec.exog) for row in rows]
        began = time.perf_counter()
        (p, _, q), order = spec.order, spec.kernel_order()
        smaller = [known[o] for o in ((p - 1, q), (p, q - 1)) if o in known]
        starts = [_best_start([found[i] for found in smaller], order) for i in range(len(rows))]
        fits = _fit_rows(spec, [(y, x) for y, x, *_ in parts], reach, starts)
        known[p, q] = [found and (found["sigma2"], found["point"], order) for _, found in fits]
        seconds = (time.perf_counter() - began) / len(rows)
        out = []
        for row, (y, x, actual, future, _), (model, found) in zip(rows, parts, fits):
            mae = rmse = None
            if found is not None and len(actual):
                with np.errstate(all="ignore"):
                    path = kernel.path(y, x, future, order, found["params"])
                    error = np.expm1(actual) - np.maximum(np.expm1(path), 0.0)
                    mae, rmse = float(np.abs(error).mean()), float(np.sqrt((error**2).mean()))
            out.append(
                {
                    **{k: row[k] for k in keys},
                    "features": name, "order": model["order"], "seasonal": model["seasonal"],
                    "aic": model["aic"], "mae": mae, "rmse": rmse, "time": seconds,
                    "converged": model["converged"], "message": model["message"],
                }
            )
        return out

    history = pack_history(panel, keys, exog, value, ["part"])
    shares = max(task_slots(panel.sparkSession, per_core=4) // slices, 1)
    work = history.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    part = F.col("slice") + slices * F.pmod(F.xxhash64(*keys), F.lit(shares))
    return work.repartitionById(slices * shares, part.cast("int")).mapInPandas(
        score_batch,
        f"{key_schema(panel, keys)}, features string, `order` array<int>, seasonal array<int>, aic double, "
        "mae double, rmse double, time double, converged boolean, message string",
    )


def ranked(results: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Successful candidates with their rank by AIC within the series."""
    best_first = Window.partitionBy(*keys).orderBy("aic", "features", "order", "seasonal")
    return results.filter(F.col("aic").isNotNull()).withColumn("rank", F.row_number().over(best_first))


def grid_search(
    panel: DataFrame, exog: Sequence[str] = REGRESSORS, keys: Sequence[str] = KEYS, s: int = 52, slices: int = 32
) -> DataFrame:
    return ranked(search(panel, grid_candidates(exog, s), keys, slices=slices), keys)


def auto_order(
    panel: DataFrame, exog: Sequence[str] = REGRESSORS, keys: Sequence[str] = KEYS, s: int = 52,
    bounds: Mapping[str, int] = ORDER_BOUNDS, slices: int = 32,
) -> DataFrame:
    """``order, seasonal, aic`` of each series' best candidate within the bounds, fitted on train."""
    results = search(panel.filter("part = 'train'"), order_candidates(exog, s, bounds), keys, slices=slices)
    return ranked(results, keys).filter("rank = 1").select(*keys, "order", "seasonal", "aic")


class SeasonalArima:
    """Fit once, then forecast, save or load: the model table with its orders and regressors."""

    def __init__(self, spec: SarimaxSpec = SarimaxSpec(), keys: Sequence[str] = KEYS):
        self.spec, self.keys, self.models = spec, tuple(keys), None
        self.exog = spec.exog

    def fit(self, panel: DataFrame, value: str = "log_y") -> "SeasonalArima":
        self.models = fit(panel, self.spec, self.keys, value)
        return self

    def walk_forward(self, panel: DataFrame, value: str = "log_y", alpha: float = 0.05) -> DataFrame:
        return walk_forward(panel, self.models, self.exog, self.keys, value, alpha)

    def forecast_multistep(self, panel: DataFrame, value: str = "log_y") -> DataFrame:
        return forecast_multistep(panel, self.models, self.exog, self.keys, value)

    def save(self, path: str) -> None:
        if self.models is None:
            raise RuntimeError("Model must be fitted before saving")
        save_models(self.models, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> "SeasonalArima":
        """Each series keeps the order and the regressors of its own row; the panel must have them all."""
        models = load_models(spark, path)
        used = models.agg(F.count(F.lit(1)), F.array_sort(F.array_distinct(F.flatten(F.collect_set("exog"))))).first()
        if not used[0]:
            raise ValueError(f"no models in {path}")
        loaded = cls(keys=keys)
        loaded.models, loaded.exog = models, tuple(used[1])
        return loaded
