"""Projection past the data: future regressors, recursive path, summary."""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.functions.windows import whole
from panelcast.kernels import arima as kernel
from panelcast.kernels import statespace
from panelcast.operators import seasons
from panelcast.operators.arima import (
    REGRESSORS, design, known_method, pack_history, score_series, values, with_equal_models, with_interval, with_models,
    without_nan,
)
from panelcast.operators.panel import future_weeks
from panelcast.session import stage

KEYS = ("series_id",)
# Fixed value: length of the projection.
N_WEEKS = 35


def exact_features(
    d: Column, school: cal.SchoolYear = cal.SchoolYear(), covid: cal.Period = cal.Period()
) -> dict[str, Column]:
    """Regressors the calendar alone decides. No future week lies in the covid period."""
    return {
        "weeks_since_school": cal.weeks_since_school(d, school),
        "school_in_session": cal.school_in_session(d, school),
        "is_covid": F.lit(0),
        "post_covid": cal.after_period(d, covid),
    }


def week_medians(history: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Exact median per series and epi week; a group has one row per year."""
    return history.groupBy(*keys, "week").agg(*(F.median(c).alias(c) for c in columns))


def overall_medians(history: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    return history.groupBy(*keys).agg(*(F.median(c).alias(c) for c in columns))


def future_regressors(
    history: DataFrame,
    exog: Sequence[str],
    n_weeks: int = N_WEEKS,
    keys: Sequence[str] = KEYS,
    school: cal.SchoolYear = cal.SchoolYear(),
    covid: cal.Period = cal.Period(),
) -> DataFrame:
    """Future weeks with their regressors: calendar ones exact, others the historical median of the
    epi week, else the overall median, else 0. An epi week that history holds but without any value
    stays NULL."""
    exact = exact_features(F.col("week_start"), school, covid)
    looked_up = [c for c in exog if c not in exact]
    present = [c for c in looked_up if c in history.columns]
    future = horizon_with_medians(history, present, n_weeks, keys)
    columns = {c: exact[c] for c in exog if c in exact}
    for c in looked_up:
        columns[c] = F.lit(0.0)
        if c in present:
            columns[c] = F.when(
                F.map_contains_key("by_week", F.col("week")), F.try_element_at("by_week", F.col("week"))[c]
            ).otherwise(F.col("overall")[c])
    return future.select(*keys, "step", "week_start", "week", *(e.alias(c) for c, e in columns.items()))


def horizon_with_medians(
    history: DataFrame, columns: Sequence[str], n_weeks: int, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Future weeks, each with its series' medians: ``by_week`` (a map with at most 53 epi weeks) and
    ``overall``.

    History is read once, and everything happens within its partitioning by series; the form with
    joins would run the history's plan three times.
    """
    everything = whole(keys)
    rows = history.select(
        *keys, "week", *columns,
        F.max("week_start").over(everything).alias("last_week"),
        F.struct(F.lit(True).alias("_any"), *(F.median(c).over(everything).alias(c) for c in columns)).alias("overall"),
    )
    weeks = rows.groupBy(*keys, "week").agg(
        F.struct(F.lit(True).alias("_any"), *(F.median(c).alias(c) for c in columns)).alias("medians"),
        F.first("last_week").alias("last_week"),
        F.first("overall").alias("overall"),
    )
    series = weeks.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("week", "medians"))).alias("by_week"),
        F.first("last_week").alias("last_week"),
        F.first("overall").alias("overall"),
    )
    return series.select(*keys, "by_week", "overall", future_weeks(n_weeks)).withColumn(
        "week", cal.epi_week(F.col("week_start"))
    )


def project(
    history: DataFrame,
    models: DataFrame | None,
    future: DataFrame,
    exog: Sequence[str] = REGRESSORS,
    keys: Sequence[str] = KEYS,
    value: str = "log_y",
    alpha: float = 0.05,
    interval: str = "one_step",
    method: str = "css",
) -> DataFrame:
    """Weekly path past the data. Each step feeds on the predictions before it, so its innovations
    are zero and the interval is the one-step interval at every horizon; it does not widen.

    ``interval="horizon"`` gives each step the interval of its own horizon, from the weights with which past innovations
    enter it (differencing included); widths in logs never fall. ``method="exact"`` takes history with missing weeks.
    """
    keys, exog = list(keys), list(exog)
    if interval not in ("one_step", "horizon"):
        raise ValueError(f"unknown interval {interval!r}")
    exact = known_method(method) == "exact"

    def ahead(rows, spec, lanes):
        y, x = np.stack([values(r) for r in rows]), np.stack([design(r, spec.exog) for r in rows])
        steps, order = len(rows[0]["future_weeks"]), spec.kernel_order()
        future_x = np.zeros((len(rows), steps, len(spec.exog)))
        for k, c in enumerate(spec.exog):
            future_x[:, :, k] = [np.asarray(r[f"future_{c}"], dtype=float) for r in rows]
        if exact:
            gap = np.concatenate([y, np.full((len(rows), steps), np.nan)], axis=1)
            found = [statespace.predict(*one, order, params) for *one, params in zip(gap, np.concatenate([x, future_x], 1), lanes)]
            return [(mean[-steps:], variance[-steps:]) for mean, variance in found]
        paths = kernel.path_stack(y, x, future_x, order, lanes)
        return [(path, kernel.horizon_variances(order, params, steps)) for path, params in zip(paths, lanes)]

    def score(rows):
        for row, found in zip(rows, with_equal_models(rows, lambda r: (len(r["y"]), len(r["future_weeks"])), ahead)):
            steps = len(row["future_weeks"])
            path, sigma = np.full(steps, np.nan), np.full(steps, np.nan)
            if found is not None:
                path, variance = found
                sigma = np.sqrt(row["model"]["sigma2"] * (variance if interval == "horizon" else np.ones(steps)))
            yield {"week_start": row["future_weeks"], "log_hat": path, "sigma": sigma}

    future_rows = pack_history(future.withColumn("_none", F.lit(0.0)), keys, exog, "_none").select(
        *keys, F.col("weeks").alias("future_weeks"), *(F.col(c).alias(f"future_{c}") for c in exog)
    )
    packed = with_models(pack_history(history, keys, exog, value), models, keys).join(future_rows, keys)
    scored = score_series(packed, keys, score, {"week_start": "date", "log_hat": "double", "sigma": "double"})
    out = with_interval(without_nan(scored), alpha)
    return out.withColumn("week", cal.epi_week(F.col("week_start"))).drop("sigma")


def projection_totals(projection: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """First and last week, total, and the first peak with its interval."""
    top = F.max(
        F.struct(
            F.col("y_hat").alias("value"), (-F.unix_date("week_start")).alias("neg_day"), "ci_lower", "ci_upper"
        )
    )
    return (
        projection.groupBy(*keys)
        .agg(
            F.min("week_start").alias("first_week"),
            F.max("week_start").alias("last_week"),
            F.sum("y_hat").alias("total"),
            top.alias("peak"),
        )
        .select(
            *keys, "first_week", "last_week", "total",
            F.col("peak.value").alias("peak_value"),
            seasons.peak_date("peak").alias("peak_date"),
            F.col("peak.ci_lower").alias("peak_lower"),
            F.col("peak.ci_upper").alias("peak_upper"),
        )
    )


def season_comparison(history: DataFrame, keys: Sequence[str] = KEYS, k: int = 3) -> DataFrame:
    """Peak, total and length of the last complete seasons."""
    return seasons.recent_seasons(seasons.complete_seasons(history, keys), k, keys)


def next_season(
    history: DataFrame,
    models: DataFrame,
    exog: Sequence[str] = REGRESSORS,
    n_weeks: int = N_WEEKS,
    keys: Sequence[str] = KEYS,
    school: cal.SchoolYear = cal.SchoolYear(),
    covid: cal.Period = cal.Period(),
    interval: str = "one_step",
) -> dict[str, DataFrame]:
    """Projection, its totals, and the last seasons beside it if the history is labelled.

    ``models`` are fitted on the whole history. Both are best staged tables; the projection is staged
    here because two results read it.
    """
    future = future_regressors(history, exog, n_weeks, keys, school, covid)
    projection = stage(project(history, models, future, exog, keys, interval=interval), "projection")
    out = {"next_season": projection, "next_season_totals": projection_totals(projection, keys)}
    if "season_label" in history.columns:
        out["next_season_comparison"] = season_comparison(history, keys)
    return out
