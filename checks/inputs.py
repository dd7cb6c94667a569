"""The engine's inputs made from the driver tables, shared by the registered queries and the bench.

Series are the order priorities, a week's value is its number of orders; the finer panel by priority
and status has real gaps. Daily quantities of the line items stand in for the weather.
"""

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.functions.windows import whole
from panelcast.operators import arima
from panelcast.operators import panel as pn
from panelcast.plans import features as ft
from panelcast.plans.forecast import weekly_facts
from panelcast.sources import readers

START, END, SPLIT = "1995-01-01", "2001-07-29", "2000-01-02"
COVID = cal.Period(date(1998, 3, 1), date(1999, 6, 30))
CFG = ft.FeatureConfig(START, END, lead_codes=("LOW",), covid=COVID)
LEAD_CFG = replace(CFG, targets=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
EXOG = ("tmean_c", "tmean_lag1", "tmean_lag2", "LOW_ILI_LAG1", "school_in_session")
SPEC = arima.SarimaxSpec(exog=EXOG)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        cal.week_starting(order_day()).alias("week_start"),
        F.lit(1.0).alias("value"),
    )


def fine_facts(spark: SparkSession, sf_dir: str, on_grid_only: bool = False) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if on_grid_only:
        orders = readers.between_days(orders, "o_orderdate", START, END, "week")
    return orders.select(
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("series_id"),
        cal.week_starting(order_day()).alias("week_start"),
        F.lit(1.0).alias("value"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("finished_price"),
    )


# The order priorities and states, the dimension of the panels made of them.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATES = ("F", "O", "P")


def fine_series(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"{p}/{s}",) for p in PRIORITIES for s in STATES], "series_id string")


def supplier_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by supplier and week, without what was shipped off the grid."""
    items = readers.between_days(table(spark, sf_dir, "lineitem"), "l_shipdate", START, END, "week")
    return items.select(
        F.col("l_suppkey").alias("series_id"),
        cal.week_starting(F.col("l_shipdate").cast("date")).alias("week_start"),
        F.lit(1.0).alias("value"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("series_id"))


def supplier_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled target of every supplier, with part: many series."""
    filled = ft.target(supplier_facts(spark, sf_dir), CFG, series=suppliers(spark, sf_dir))
    return pn.split(filled, SPLIT, bounds=(START, END))


def lead_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished low-priority orders under the code LOW."""
    low = table(spark, sf_dir, "orders").filter("o_orderpriority = '5-LOW' AND o_orderstatus = 'F'")
    return low.select(F.lit("LOW").alias("series_id"), cal.week_starting(order_day()).alias("week_start"), F.lit(1.0).alias("value"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.max("l_quantity").alias("tmax"), F.min("l_quantity").alias("tmin"))
        .withColumn("station", F.lit("all"))
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.weekly_panel(facts(spark, sf_dir), START, END)


def fine_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fine_facts(spark, sf_dir, on_grid_only=True)
    return pn.weekly_panel(facts, START, END, series=fine_series(spark))


def split_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled target with log and part."""
    return pn.split(ft.target(facts(spark, sf_dir), CFG), SPLIT, bounds=(START, END))


def flagged(df: DataFrame) -> DataFrame:
    """A season flag that SQL can check: above the series' mean."""
    return df.withColumn("is_season", (F.col("y") > F.avg("y").over(whole(["series_id"]))).cast("int"))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sums of targets and the leading series from one scan: a finished low-priority order counts for both."""
    lead = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"), F.lit("LOW"))
    orders = readers.between_days(table(spark, sf_dir, "orders"), "o_orderdate", START, END, "week")
    both = orders.select(
        F.explode(F.array_compact(F.array("o_orderpriority", lead))).alias("series_id"),
        cal.week_starting(order_day()).alias("week_start"),
        F.lit(1.0).alias("value"),
    )
    return weekly_facts(both, LEAD_CFG)


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = weekly(spark, sf_dir)
    return ft.feature_matrix(sums, LEAD_CFG, sums, weather(spark, sf_dir))


def split_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.split(matrix(spark, sf_dir), SPLIT, bounds=(START, END))


def given_models(series: DataFrame, order, seasonal, exog, beta, ar, sar, sigma2) -> DataFrame:
    """A model table with the same given coefficients for every series."""

    def array(values, kind="double"):
        return F.array(*(F.lit(v) for v in values)).cast(f"array<{kind}>")

    return series.select("series_id").distinct().select(
        "series_id",
        array(order, "int").alias("order"), array(seasonal, "int").alias("seasonal"),
        array(exog, "string").alias("exog"), array(beta).alias("beta"), array(ar).alias("ar"),
        array(sar).alias("sar"), array(()).alias("ma"), array(()).alias("sma"),
        F.lit(float(sigma2)).alias("sigma2"), F.lit(None).cast("string").alias("message"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event counts per type and hour from the first midnight to the last hour, zeros included."""
    tick = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) * 24 + F.hour("ts")
    counts = (
        table(spark, sf_dir, "events")
        .select(F.col("event_type").alias("series_id"), tick.cast("long").alias("tick"))
        .groupBy("series_id", "tick")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    # One row per event type, so the window over all of them is as small.
    ends = counts.groupBy("series_id").agg(F.max("tick").alias("last"))
    ends = ends.withColumn("last", F.max("last").over(whole([])))
    grid = ends.select("series_id", F.explode(F.expr("sequence(0L, last)")).alias("tick"))
    return grid.join(counts, ["series_id", "tick"], "left").select(
        "series_id", "tick", F.log1p(F.coalesce("n", F.lit(0.0))).alias("log_y")
    )
