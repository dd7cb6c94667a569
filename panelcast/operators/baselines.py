"""Four reference forecasts for the test part of a split panel.

The panel carries ``part`` (train/test), ``year``, ``week``, ``y`` and ``log_y``. All four are window
expressions that share the panel's partitioning by series, so no train/test self-join is needed and
the panel is read once.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.windows import by_time

KEYS = ("series_id",)
# Model names in result tables.
MODEL_NAMES = {
    "naive": "Naive (last week)",
    "seasonal_naive": "Seasonal Naive (ly)",
    "weekly_mean": "Weekly Mean",
    "weekly_median": "Weekly Median",
}


def _train(value: Column) -> Column:
    return F.when(F.col("part") == "train", value)


def naive(keys: Sequence[str] = KEYS) -> Column:
    """The week before; the first test row takes the last train value."""
    return F.expm1(F.lag("log_y").over(by_time(keys)))


def weekly_mean(keys: Sequence[str] = KEYS) -> Column:
    return F.avg(_train(F.col("y"))).over(Window.partitionBy(*keys, "week"))


def weekly_median(keys: Sequence[str] = KEYS) -> Column:
    return F.median(_train(F.col("y"))).over(Window.partitionBy(*keys, "week"))


def seasonal_naive(keys: Sequence[str] = KEYS) -> Column:
    """Same epi week of the year before if that is a train row, else the train mean of the week."""
    same_week = Window.partitionBy(*keys, "week").orderBy("year")
    is_last_year = (F.lag("year").over(same_week) == F.col("year") - 1) & (
        F.lag("part").over(same_week) == "train"
    )
    return F.coalesce(F.when(is_last_year, F.lag("y").over(same_week)), weekly_mean(keys))


def all_baselines(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Test rows with one column per baseline."""
    return panel.withColumns(
        {
            "naive": naive(keys),
            "seasonal_naive": seasonal_naive(keys),
            "weekly_mean": weekly_mean(keys),
            "weekly_median": weekly_median(keys),
        }
    ).filter(F.col("part") == "test")


def long_predictions(wide: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per model and test week: ``keep`` columns, actual ``y`` (back from log), ``y_hat``."""
    models = F.explode(
        F.array(
            *(
                F.struct(F.lit(label).alias("model"), F.col(c).alias("y_hat"))
                for c, label in MODEL_NAMES.items()
            )
        )
    ).alias("m")
    return wide.select(*keep, F.expm1("log_y").alias("y"), models).select(
        *keep, "y", "m.model", "m.y_hat"
    )
