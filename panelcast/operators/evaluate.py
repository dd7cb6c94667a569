"""Forecast scores per series and model, overall and by season flag.

Predictions are long: keys, ``model``, ``week_start``, ``y``, ``y_hat`` and optionally ``is_season``.
Rows without an actual or a prediction are not scored.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.sequence import direction

KEYS = ("series_id",)
# Tolerance bands in percent.
BANDS = (20, 30, 50)


def _when(condition: Column | None, value: Column) -> Column:
    return value if condition is None else F.when(condition, value)


def mae(where: Column | None = None) -> Column:
    return F.avg(_when(where, F.abs(F.col("y") - F.col("y_hat"))))


def rmse(where: Column | None = None) -> Column:
    e = F.col("y") - F.col("y_hat")
    return F.sqrt(F.avg(_when(where, e * e)))


def _pct_error() -> Column:
    y = F.col("y")
    return F.when(y != 0, F.abs((y - F.col("y_hat")) / y)) * 100


def mape() -> Column:
    """Over non-zero actuals; NULL when there is none."""
    return F.avg(_pct_error())


def smape() -> Column:
    y, p = F.col("y"), F.col("y_hat")
    size = F.abs(y) + F.abs(p)
    return F.avg(F.when(size == 0, 0.0).otherwise(2 * F.abs(y - p) / size)) * 100


def r2() -> Column:
    """1 - SSE/SST. Constant actuals score 1 when hit exactly, else 0; NULL below two rows."""
    y = F.col("y")
    e = y - F.col("y_hat")
    sse, n = F.sum(e * e), F.count(F.lit(1))
    sst = n * F.var_pop(y)
    return (
        F.when(n < 2, None)
        .when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - sse / sst)
    )


def directional_accuracy() -> Column:
    """Share of equal signs of change; needs the column ``same_direction`` of ``with_direction``."""
    return F.avg(F.col("same_direction").cast("double")) * 100


def within(band: int) -> Column:
    """Share of non-zero actuals missed by at most ``band`` percent. Rounding takes out the noise of
    the way to logs and back, so an error of just the band counts."""
    return F.avg((F.round(_pct_error(), 9) <= band).cast("double")) * 100


def with_direction(predictions: DataFrame, group: Sequence[str]) -> DataFrame:
    """Does the prediction move the way the actual does, from one row of the group to the next?"""
    return predictions.withColumn("same_direction", direction("y", group) == direction("y_hat", group))


def _scorable(predictions: DataFrame) -> DataFrame:
    return predictions.dropna(subset=["y", "y_hat"])


def by_section(predictions: DataFrame) -> DataFrame:
    """Every row once as ``overall`` and once as ``in_season`` or ``off_season``."""
    sections = [F.lit("overall")]
    if "is_season" in predictions.columns:
        flag = F.col("is_season")
        sections.append(F.when(flag == 1, "in_season").when(flag == 0, "off_season"))
    return predictions.withColumn("section", F.explode(F.array_compact(F.array(*sections))))


def full_evaluation(
    predictions: DataFrame, keys: Sequence[str] = KEYS, bands: Sequence[int] = BANDS
) -> DataFrame:
    """One row per series, model and section with all metrics.

    The changes behind the directional accuracy run from row to row *within* a section, across the
    gaps between seasons. Window and aggregate share one shuffle.
    """
    group = [*keys, "model", "section"]
    rows = with_direction(by_section(_scorable(predictions)), group)
    return rows.groupBy(*group).agg(
        mae().alias("mae"),
        rmse().alias("rmse"),
        mape().alias("mape"),
        smape().alias("smape"),
        r2().alias("r2"),
        directional_accuracy().alias("directional_accuracy"),
        *(within(b).alias(f"within_{b}pct") for b in bands),
    )


def metric_rows(evaluation: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Long form ``section, metric, value`` of ``full_evaluation``."""
    ids = [*keys, "model", "section"]
    metrics = [c for c in evaluation.columns if c not in ids]
    return evaluation.unpivot(ids, metrics, "metric", "value")


def compare_models(predictions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per series and model; in-season errors NULL when no week is in season."""
    group = [*keys, "model"]
    rows = with_direction(_scorable(predictions), group)
    season = []
    if "is_season" in predictions.columns:
        flag = F.col("is_season") == 1
        season = [mae(flag).alias("mae_season"), rmse(flag).alias("rmse_season")]
    return rows.groupBy(*group).agg(
        mae().alias("mae"),
        rmse().alias("rmse"),
        mape().alias("mape"),
        smape().alias("smape"),
        r2().alias("r2"),
        directional_accuracy().alias("dir_accuracy"),
        *season,
    )
