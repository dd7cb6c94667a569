"""Weekly partial sums as a table: facts are added as they come and read back by year.

One row per series and week and addition; the rows of a week add up, so a panel over any range costs its weeks and
not its facts.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal

KEYS = ("series_id",)


def weekly_counts(
    facts: DataFrame, keys: Sequence[str] = KEYS, week: str = "week_start", value: str = "value"
) -> DataFrame:
    """``keys, week_start, value, n_facts`` by week; a week whose values are all NULL sums to 0, a NULL week stays a row."""
    sums = facts.groupBy(*keys, F.col(week).alias("week_start")).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("value"), F.count(F.lit(1)).alias("n_facts")
    )
    return sums


def add_weekly(
    facts: DataFrame,
    path: str,
    keys: Sequence[str] = KEYS,
    week: str = "week_start",
    value: str = "value",
    replace: bool = False,
) -> None:
    """Add the weekly sums of ``facts`` to the table at ``path``, in one folder per calendar year.

    ``replace`` puts them in the place of the years they touch: for facts that are delivered again. Rows without a
    week have no place in the table.
    """
    sums = weekly_counts(facts.filter(F.col(week).isNotNull()), keys, week, value)
    # One file per year and task at most; the years of a task lie together.
    rows = sums.withColumn("year", F.year("week_start")).sortWithinPartitions("year", *keys, "week_start")
    writer = rows.write.partitionBy("year")
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def read_weekly(spark: SparkSession, path: str, start, end) -> DataFrame:
    """``keys, week_start, value, n_facts`` of the Sundays within [start, end]: other years' folders are not opened, and
    the weeks reach the scan. Feeds ``panel.weekly_panel``, which adds up the rows of a week."""
    first, last = cal.grid_bounds(start, end)
    rows = spark.read.parquet(path).filter(F.col("year").between(first.year, last.year))
    return rows.filter(F.col("week_start").between(F.lit(first), F.lit(last))).drop("year")
