"""The tables behind forecast, residual and season charts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.windows import by_time, so_far, whole
from panelcast.operators import seasons

KEYS = ("series_id",)
# Histogram bins, autocorrelation lags, the 95 % normal quantile and the fallback band.
BINS, LAGS, Z95, BAND = 30, 40, 1.959963984540054, 0.2
PROBABILITY_THRESHOLD = 0.5
Y_CAP = 1.3


def forecast_frame(panel: DataFrame, forecasts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every week with its part and actual, and for test weeks forecast and interval.

    Forecasts without interval columns, or with NULL limits, get a band of 20 % around the forecast.
    """
    has_interval = {"ci_lower", "ci_upper"} <= set(forecasts.columns)
    limits = ["ci_lower", "ci_upper"] if has_interval else []
    rows = panel.select(*keys, "week_start", "part", F.expm1("log_y").alias("actual")).join(
        forecasts.select(*keys, "week_start", "y_hat", *limits), [*keys, "week_start"], "left"
    )

    def limit(name, share):
        band = F.col("y_hat") * share
        return F.coalesce(F.col(name), band) if has_interval else band

    return rows.withColumns(
        {"ci_lower": limit("ci_lower", 1 - BAND), "ci_upper": limit("ci_upper", 1 + BAND)}
    )


def actual_vs_predicted(predictions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Pairs with the axis maximum shared by both."""
    group = [*keys, "model"]
    return predictions.select(
        *group, "week_start", "y", "y_hat",
        F.max(F.greatest("y", "y_hat")).over(whole(group)).alias("axis_max"),
    )


def model_lines(predictions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All models against the actual, the actual as one more line: the first model's row of a week
    brings it along, so the predictions are read once."""
    group = [*keys, "week_start"]
    first = F.row_number().over(Window.partitionBy(*group).orderBy("model")) == 1
    own = F.struct("model", F.col("y_hat").alias("value"))
    actual = F.when(F.col("_first"), F.struct(F.lit("Actual").alias("model"), F.col("y").alias("value")))
    lines = predictions.withColumn("_first", first).select(
        *group, F.explode(F.array_compact(F.array(own, actual))).alias("line")
    )
    return lines.select(*keys, "line.model", "week_start", "line.value")


def residuals(predictions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return predictions.select(
        *keys, "model", "week_start", (F.col("y") - F.col("y_hat")).alias("residual")
    ).dropna(subset=["residual"])


def residual_histogram(resid: DataFrame, keys: Sequence[str] = KEYS, bins: int = BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included, the maximum in the last."""
    group = [*keys, "model"]
    low, high = (f("residual").over(whole(group)) for f in (F.min, F.max))
    flat = F.col("_lo") == F.col("_hi")
    rows = resid.withColumns({"_lo": low, "_hi": high}).withColumns(
        {
            "lo": F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")),
            "hi": F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")),
        }
    )
    # Rounding puts a residual on an edge into the bin that starts there.
    place = F.floor(F.round((F.col("residual") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins, 9))
    rows = rows.withColumn("bin", (F.least(place, F.lit(bins - 1)) + 1).cast("int"))
    columns = [str(b) for b in range(1, bins + 1)]
    wide = rows.groupBy(*group, "lo", "hi").agg(
        *(F.count(F.when(F.col("bin") == int(b), 1)).alias(b) for b in columns)
    )
    return wide.unpivot([*group, "lo", "hi"], columns, "bin", "n").select(
        *group,
        F.col("bin").cast("int").alias("bin"),
        (F.col("lo") + (F.col("hi") - F.col("lo")) / bins * (F.col("bin").cast("int") - 1)).alias("left_edge"),
        "n",
    )


def autocorrelation_arrays(resid: DataFrame, keys: Sequence[str] = KEYS, n_lags: int = LAGS) -> DataFrame:
    """One row per series and model: ``n`` and the array of autocorrelations for lags 0 to n_lags, NULL
    for constant residuals.

    All lags come from one window and one aggregate over the same partitioning.
    """
    group = [*keys, "model"]
    centred = resid.withColumn("_x", F.col("residual") - F.avg("residual").over(whole(group)))
    w = by_time(group)
    products = [
        (F.col("_x") * (F.lag("_x", k).over(w) if k else F.col("_x"))).alias(f"_p{k}")
        for k in range(n_lags + 1)
    ]
    sums = [F.coalesce(F.sum(f"_p{k}"), F.lit(0.0)) for k in range(n_lags + 1)]
    return (
        centred.select(*group, *products)
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("_s"))
        .select(
            *group, "n",
            F.transform("_s", lambda s: F.try_divide(s, F.get("_s", F.lit(0)))).alias("acf"),
        )
    )


def autocorrelation(resid: DataFrame, keys: Sequence[str] = KEYS, n_lags: int = LAGS) -> DataFrame:
    """Autocorrelation per lag with Bartlett's 95 % half width (0 at lag 0)."""
    group = [*keys, "model"]
    rows = autocorrelation_arrays(resid, keys, n_lags).select(
        *group, "n", F.posexplode("acf").alias("lag", "acf")
    )
    before = so_far(group, "lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf"))).over(before), F.lit(0.0))
    variance = F.when(F.col("lag") == 0, 0.0).otherwise((1 + 2 * squares) / F.col("n"))
    return rows.withColumn("half_width", F.lit(Z95) * F.sqrt(variance)).drop("n")


def durbin_levinson(acf: Column, n_lags: int = LAGS) -> Column:
    """Partial autocorrelations for lags 0 to n_lags from the array of autocorrelations, all NULL if
    that is."""

    def state(phi, variance, out):
        return F.struct(phi.alias("phi"), variance.alias("v"), out.alias("out"))

    def turn(s, k):
        known = F.slice(acf, 2, k - 1)
        explained = F.aggregate(
            F.zip_with(s["phi"], F.reverse(known), lambda a, r: a * r), F.lit(0.0), lambda t, x: t + x
        )
        # The variance stays positive: no biased autocorrelation beyond lag 0 reaches 1.
        partial = (F.get(acf, k) - explained) / s["v"]
        shrunk = F.zip_with(s["phi"], F.reverse(s["phi"]), lambda a, b: a - partial * b)
        return state(
            F.concat(shrunk, F.array(partial)), s["v"] * (1 - partial * partial), F.concat(s["out"], F.array(partial))
        )

    none = F.array().cast("array<double>")
    start = state(none, F.lit(1.0), F.array(F.lit(1.0)))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(n_lags)), start, turn, lambda s: s["out"])
    missing = F.array_repeat(F.lit(None).cast("double"), n_lags + 1)
    return F.when(F.get(acf, F.lit(0)).isNotNull(), found).otherwise(missing)


def partial_autocorrelation(resid: DataFrame, keys: Sequence[str] = KEYS, n_lags: int = LAGS) -> DataFrame:
    """Yule-Walker partial autocorrelation per lag with the 95 % half width 1.96/sqrt(n)."""
    group = [*keys, "model"]
    rows = autocorrelation_arrays(resid, keys, n_lags).select(
        *group, "n", F.posexplode(durbin_levinson(F.col("acf"), n_lags)).alias("lag", "pacf")
    )
    half = F.when(F.col("lag") == 0, 0.0).otherwise(F.lit(Z95) / F.sqrt("n"))
    return rows.withColumn("half_width", half).drop("n")


def season_panels(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Target and temperature of every season week."""
    return panel.filter("season_label IS NOT NULL").select(
        *keys, "season_label", "week_start", "y", "tmean_c"
    )


def season_spans(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Start, end and annotated first peak of each season."""
    stats = seasons.season_stats(panel, keys)
    text = F.format_string(
        "%d W%d-W%d peak W%d", F.col("season_label"), F.col("onset_week"), F.col("end_week"), F.col("peak_week")
    )
    return stats.select(
        *keys, "season_label", F.col("onset_date").alias("start_date"), "end_date", "peak_date",
        F.col("peak_ili").alias("peak_value"), text.alias("annotation"),
    )


def probability_line(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return panel.select(
        *keys, "week_start", "season_prob", F.lit(PROBABILITY_THRESHOLD).alias("threshold"),
    )


def next_season_frame(history: DataFrame, projection: DataFrame, keys: Sequence[str] = KEYS, recent: int = 60) -> DataFrame:
    """History and projection in one line with the chart's y cap; the interval is clipped to the cap
    and rows of the last 60 weeks or of the projection are marked ``recent``."""
    none = F.lit(None).cast("double")
    past = history.select(
        *keys, "week_start", F.lit("history").alias("kind"), F.col("y").alias("value"),
        none.alias("ci_lower"), none.alias("ci_upper"),
    )
    ahead = projection.select(
        *keys, "week_start", F.lit("forecast").alias("kind"), F.col("y_hat").alias("value"), "ci_lower", "ci_upper"
    )
    last_week = F.max(F.when(F.col("kind") == "history", F.col("week_start"))).over(whole(keys))
    rows = past.unionByName(ahead).withColumns(
        {"y_cap": F.max("value").over(whole(keys)) * Y_CAP, "_last": last_week}
    )
    return rows.select(
        *keys, "week_start", "kind", "value", "ci_lower",
        F.when(F.col("ci_upper").isNotNull(), F.least("ci_upper", "y_cap")).alias("ci_upper"),
        "y_cap",
        (F.col("week_start") >= F.date_sub("_last", 7 * recent)).alias("recent"),
    )


def peak_aligned(history: DataFrame, projection: DataFrame, keys: Sequence[str] = KEYS, k: int = 4) -> DataFrame:
    """The last seasons and the projection by distance in weeks from their first peak."""
    past = seasons.weeks_from_peak(history, k, keys).select(
        *keys, F.col("season_label").cast("string").alias("season"), "week_index", F.col("y").alias("value")
    )
    position = projection.withColumn("_n", F.row_number().over(by_time(keys)))
    top = F.max(F.struct("y_hat", (-F.col("_n")).alias("neg"))).over(whole(keys))
    ahead = position.withColumn("_top", top).select(
        *keys, F.lit("next").alias("season"), (F.col("_n") + F.col("_top.neg")).alias("week_index"),
        F.col("y_hat").alias("value"),
    )
    return past.unionByName(ahead)
