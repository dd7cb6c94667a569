"""Season detection with a Gaussian hidden Markov model per series."""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.kernels import hmm as kernel
from panelcast.operators import seasons
from panelcast.operators.packing import key_schema, pack, spread

KEYS = ("series_id",)
BLOCK = 256
RESULT = ("means", "covars", "startprob", "transmat", "n_iter", "converged", "log_likelihood", "states", "probs")
PARAMETERS = (
    "means array<double>, covars array<double>, startprob array<double>, "
    "transmat array<array<double>>"
)


@dataclass(frozen=True)
class HmmSpec:
    n_components: int = 2
    n_iter: int = 1000

    def __post_init__(self):
        if self.n_components < 2 or self.n_iter < 1:
            raise ValueError("at least two states and one iteration are needed")


def _complete(pdf: pd.DataFrame) -> pd.Series:
    return pdf["y"].map(lambda y: len(y) > 1 and bool(np.isfinite(y).all())).astype(bool)


def _stacks(pdf: pd.DataFrame):
    """Series of equal length, in blocks that fit in cache, with their values as one array."""
    for _, group in pdf.groupby(pdf["y"].map(len)):
        for first in range(0, len(group), BLOCK):
            block = group.iloc[first : first + BLOCK]
            yield block, np.stack(block["y"].to_numpy()).astype(float)


def fit_decode(
    panel: DataFrame, spec: HmmSpec = HmmSpec(), keys: Sequence[str] = KEYS, value: str = "y", placed: bool = False
) -> DataFrame:
    """One row per series: parameters, log likelihood, and the decoded states and probabilities, the
    latter week by week with all states of a week in a row.

    A series with missing values gets NULL parameters. Fitting and decoding share one pass. ``placed``: see ``arima.fit``.
    """
    keys = list(keys)
    n, max_iter = spec.n_components, spec.n_iter

    def fit_batch(batches):
        for pdf in batches:
            complete = _complete(pdf)
            for rows, x in _stacks(pdf[complete]):
                found = kernel.fit(x, n, max_iter)
                path, gamma, loglik = kernel.decode(
                    x, found["means"], found["covars"], found["startprob"], found["transmat"]
                )
                yield rows[keys + ["weeks"]].assign(
                    means=list(found["means"]), covars=list(found["covars"]),
                    startprob=list(found["startprob"]), transmat=[list(m) for m in found["transmat"]],
                    n_iter=found["n_iter"], converged=found["converged"], log_likelihood=loglik,
                    states=list(path), probs=list(gamma.reshape(len(rows), -1)),
                )
            gaps = pdf[~complete]
            if len(gaps):
                yield gaps[keys + ["weeks"]].assign(**dict.fromkeys(RESULT))

    packed = pack(panel.withColumn("y", F.col(value)), keys, ["y"])
    ready = (packed if placed else spread(packed, keys)).select(
        *keys, F.col("rows.week_start").alias("weeks"), F.col("rows.y").alias("y")
    )
    schema = (
        f"{key_schema(panel, keys)}, weeks array<date>, {PARAMETERS}, n_iter long, converged boolean, "
        "log_likelihood double, states array<int>, probs array<double>"
    )
    return ready.mapInPandas(fit_batch, schema)


def decode_given(panel: DataFrame, means, covars, startprob, transmat, keys: Sequence[str] = KEYS, value: str = "y") -> DataFrame:
    """``fit_decode`` with given parameters in place of a fit; a series with a gap keeps one NULL row."""
    keys = list(keys)
    given = [np.asarray(v, dtype=float) for v in (means, covars, startprob, transmat)]

    def decode_batch(batches):
        for pdf in batches:
            complete = _complete(pdf)
            for rows, x in _stacks(pdf[complete]):
                same = [np.repeat(v[None], len(x), axis=0) for v in given]
                path, gamma, loglik = kernel.decode(x, *same)
                yield rows[keys + ["weeks"]].assign(
                    log_likelihood=loglik, states=list(path), probs=list(gamma.reshape(len(rows), -1))
                )
            gaps = pdf[~complete]
            if len(gaps):
                yield gaps[keys + ["weeks"]].assign(log_likelihood=np.nan, states=None, probs=None)

    packed = pack(panel.withColumn("y", F.col(value)), keys, ["y"])
    ready = spread(packed, keys).select(
        *keys, F.col("rows.week_start").alias("weeks"), F.col("rows.y").alias("y")
    )
    fitted = ready.mapInPandas(
        decode_batch,
        f"{key_schema(panel, keys)}, weeks array<date>, log_likelihood double, states array<int>, probs array<double>",
    )
    fitted = fitted.withColumn("log_likelihood", F.nanvl("log_likelihood", F.lit(None).cast("double")))

    def array(values):
        return F.array(*(array(v) if np.ndim(v) else F.lit(float(v)) for v in values))

    return fitted.withColumns({name: array(v) for name, v in zip(("means", "covars", "startprob", "transmat"), given)})


def season_state(fitted: DataFrame) -> DataFrame:
    """The state with the highest mean, the first on ties."""
    return fitted.withColumn(
        "season_state", (F.array_position("means", F.array_max("means")) - 1).cast("int")
    )


def decoded_rows(fitted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``week_start, hmm_state, season_prob, is_season`` per series and week."""
    n, season = F.size("means"), F.col("season_state")
    in_season = F.transform("states", lambda state, i: F.get("probs", i * n + season))
    arrays = season_state(fitted).select(
        *keys, "season_state", "weeks", "states", in_season.alias("probs")
    )
    rows = arrays.select(*keys, "season_state", F.explode(F.arrays_zip("weeks", "states", "probs")).alias("step"))
    return rows.select(
        *keys,
        F.col("step.weeks").alias("week_start"),
        F.col("step.states").alias("hmm_state"),
        F.col("step.probs").alias("season_prob"),
        (F.col("step.states") == season).cast("int").alias("is_season"),
    )


def detect_seasons(
    panel: DataFrame, fitted: DataFrame, keys: Sequence[str] = KEYS, min_weeks: int = seasons.MIN_SEASON_WEEKS
) -> DataFrame:
    """Panel with state, probability, cleaned season flag and label."""
    rows = panel.join(decoded_rows(fitted, keys), [*keys, "week_start"], "left")
    return seasons.detect(rows, min_weeks, keys)


def quality(fitted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Log likelihood, AIC and BIC with n(n-1) + 2n free parameters, and the fitted parameters."""
    n = F.size("means")
    k = n * (n - 1) + n + n
    return fitted.select(
        *keys,
        "log_likelihood",
        (-2 * F.col("log_likelihood") + 2 * k).alias("aic"),
        (-2 * F.col("log_likelihood") + k * F.log(F.size("weeks"))).alias("bic"),
        F.col("means").alias("state_means"),
        F.col("covars").alias("state_covariances"),
        F.col("transmat").alias("transition_matrix"),
    )
