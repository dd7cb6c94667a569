"""One query per operator over the driver tables, each a callable (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs as inp
from panelcast.functions import calendar as cal
from panelcast.functions import scalars as sc
from panelcast.functions.windows import by_time, whole
from panelcast.operators import arima, baselines, diagnostics, evaluate, hmm, project, seasons
from panelcast.operators import holidays as hol
from panelcast.operators import panel as pn
from panelcast.operators import sequence as sq
from panelcast.plans import features as ft
from panelcast.plans.forecast import RunConfig, rolling_predictions, run, scored_baselines
from panelcast.session import new_path, stage
from panelcast.sources import readers, weekly_store, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Given coefficients for the model operators whose result SQL can check.
AR = {"order": (2, 1, 0), "seasonal": (1, 0, 0, 52), "exog": ("school_in_session",),
      "beta": (0.1,), "ar": (-0.6, -0.3), "sar": (0.2,), "sigma2": 0.09}
AR1 = {"order": (1, 1, 0), "seasonal": (0, 0, 0, 52), "exog": ("school_in_session",),
       "beta": (0.1,), "ar": (-0.5,), "sar": (), "sigma2": 0.09}
HOURLY_AR = {"order": (1, 0, 0), "seasonal": (1, 0, 0, 24), "exog": (), "beta": (), "ar": (0.4,),
             "sar": (0.3,), "sigma2": 0.25}
HOURLY_AR1 = {**HOURLY_AR, "seasonal": (0, 0, 0, 24), "sar": ()}
ONE_GAP_AR = {"order": (1, 0, 0), "seasonal": (0, 0, 0, 52), "exog": ("school_in_session",),
              "beta": (0.4,), "ar": (0.7,), "sar": (), "sigma2": 0.16}
HMM = {"startprob": (0.6, 0.4), "transmat": ((0.9, 0.1), (0.2, 0.8))}
RULES = hol.HolidayRules(
    groups={"urgent": ("1-urgent",), "high": ("2-high", "high"), "low": ("5-low",)}, long_holidays=("high",)
)


def publish(df: DataFrame) -> DataFrame:
    """Doubles to six places without negative zero, dates as ISO text: the same in every engine."""

    def column(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            r = F.round(c, 6)
            return F.when(r == 0, 0.0).otherwise(r).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        return c

    return df.select(*(column(f) for f in df.schema.fields))


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: publish(build(spark, sf_dir))
    return build


def staged_split(spark, sf_dir):
    """Split panel, written once, for queries that use it more than once."""
    return stage(ft.calendar_features(inp.split_panel(spark, sf_dir), inp.CFG), "split")


def order_days(spark, sf_dir):
    return inp.table(spark, sf_dir, "orders").select(inp.order_day().alias("d")).distinct()


def flagged_split(spark, sf_dir):
    return inp.flagged(inp.split_panel(spark, sf_dir))


def labelled(spark, sf_dir):
    return seasons.detect(flagged_split(spark, sf_dir), min_weeks=2)


def season_blocks(spark, sf_dir):
    """One row per run of flagged and other weeks, seasons labelled."""
    weeks = flagged_split(spark, sf_dir).select("series_id", "week_start", "y", "is_season")
    return seasons.season_blocks(weeks, min_weeks=2)


def predictions(spark, sf_dir):
    return scored_baselines(flagged_split(spark, sf_dir), ["series_id"])


def residuals(spark, sf_dir):
    return diagnostics.residuals(predictions(spark, sf_dir))


# -- sources and sinks ----------------------------------------------------------------------------


@query
def s1_csv_facts(spark, sf_dir):
    path = new_path(spark, "facts-csv")
    inp.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ROW"),
        F.col("o_orderpriority").alias("COUNTRY_CODE"),
        F.date_format(cal.week_starting(inp.order_day()), "yyyy-MM-dd").alias("MMWR_WEEKSTARTDATE"),
        F.col("o_totalprice").cast("string").alias("ILI_CASE"),
    ).write.csv(path, header=True)
    return pn.weekly_sum(readers.read_facts(spark, path))


@query
def s2_lenient_numbers(spark, sf_dir):
    text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    status = F.col("o_orderstatus")
    spelled = F.when(status == "F", F.concat(F.lit(" "), text)).when(status == "O", text).otherwise(
        F.concat(text, F.lit("d"))
    )
    return inp.table(spark, sf_dir, "orders").select(
        "o_orderkey", sc.lenient_double(spelled).alias("price")
    )


@query
def s3_lenient_dates(spark, sf_dir):
    day, status = inp.order_day(), F.col("o_orderstatus")
    spelled = F.when(status == "F", F.date_format(day, "yyyy-MM-dd")).when(
        status == "O", F.date_format(day, "M/d/yyyy")
    ).otherwise("n/a")
    return inp.table(spark, sf_dir, "orders").select(
        "o_orderkey", sc.lenient_date(spelled, ("yyyy-MM-dd", "M/d/yyyy")).alias("day")
    )


@query
def s4_weather_csv(spark, sf_dir):
    path = new_path(spark, "weather-csv")
    inp.weather(spark, sf_dir).select(
        F.date_format("date", "d/M/yyyy").alias("Obs Date"),
        F.col("tmax").alias("Temp MAX"),
        F.col("tmin").alias("Temp MIN"),
    ).write.csv(path, header=True)
    return pn.weekly_mean_temperature(readers.read_weather(spark, path))


@query
def s4_weather_stations(spark, sf_dir):
    """A file of several stations: each keeps its own weeks."""
    path = new_path(spark, "stations-csv")
    daily = inp.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", F.col("l_shipdate").cast("date").alias("day"))
    daily.agg(F.max("l_quantity").alias("tmax"), F.min("l_quantity").alias("tmin")).select(
        F.col("l_returnflag").alias("Station Name"), F.date_format("day", "d-M-yyyy").alias("Obs Date"),
        F.col("tmax").alias("Temp MAX"), F.col("tmin").alias("Temp MIN"),
    ).write.csv(path, header=True)
    return pn.weekly_mean_temperature(readers.read_weather(spark, path))


@query
def s5_p2_holiday_csv(spark, sf_dir):
    path = new_path(spark, "holiday-csv")
    inp.table(spark, sf_dir, "orders").select(
        F.date_format(inp.order_day(), "M/d/yyyy").alias("when"),
        F.col("o_orderpriority").alias("what"),
        "o_orderstatus",
    ).write.csv(path, header=True)
    return readers.read_holidays(spark, path).groupBy("ds", "name").agg(F.count("seq").alias("n"))


@query
def s7_feature_matrix_parquet(spark, sf_dir):
    path = new_path(spark, "matrix")
    writers.write_features(inp.matrix(spark, sf_dir), path, ["series_id"])
    back = spark.read.parquet(path)
    return back.select("series_id", "week_start", "y", "LOW_ILI_LAG1", "tmean_lag2")


@query
def s8_comparison_csv(spark, sf_dir):
    path = new_path(spark, "comparison")
    table = evaluate.compare_models(predictions(spark, sf_dir))
    writers.write_table(table, path, order_by=["series_id", "model"])
    return spark.read.schema(table.schema).csv(path, header=True)


@query
def s9_saved_models(spark, sf_dir):
    path = new_path(spark, "models")
    rows = staged_split(spark, sf_dir)
    arima.save_models(inp.given_models(rows, **AR), path)
    return arima.SeasonalArima.load(spark, path).walk_forward(rows)


# -- projection, filter, scalar functions ---------------------------------------------------------


@query
def p1_series_filter(spark, sf_dir):
    chosen = readers.for_series(inp.facts(spark, sf_dir), ["1-URGENT", "5-LOW"])
    return chosen.groupBy("series_id").agg(F.count("value").alias("n"))


@query
def p3_drop_null_rows(spark, sf_dir):
    rows = inp.fine_facts(spark, sf_dir).dropna(subset=["finished_price"])
    return rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


@query
def p4_daily_mean_temperature(spark, sf_dir):
    return inp.weather(spark, sf_dir).select("date", ((F.col("tmax") + F.col("tmin")) / 2).alias("tmean"))


@query
def p5_log_round_trip(spark, sf_dir):
    log_y = F.log1p("y")
    return inp.fine_panel(spark, sf_dir).select(
        "series_id", "week_start", log_y.alias("log_y"), sc.from_log(log_y).alias("back"),
        sc.from_log(log_y - 2).alias("clipped"),
    )


@query
def p6_epi_calendar(spark, sf_dir):
    d = F.col("d")
    return order_days(spark, sf_dir).select("d", cal.epi_year(d).alias("year"), cal.epi_week(d).alias("week"))


@query
def p7_iso_week(spark, sf_dir):
    return order_days(spark, sf_dir).select("d", cal.iso_week(F.col("d")).alias("week"))


@query
def p8_period_flags(spark, sf_dir):
    d = F.col("d")
    return order_days(spark, sf_dir).select(
        "d", cal.in_period(d, inp.COVID).alias("is_covid"), cal.after_period(d, inp.COVID).alias("post_covid")
    )


@query
def p9_school_in_session(spark, sf_dir):
    return order_days(spark, sf_dir).select("d", cal.school_in_session(F.col("d")).alias("school_in_session"))


@query
def p10_weeks_since_school(spark, sf_dir):
    return order_days(spark, sf_dir).select("d", cal.weeks_since_school(F.col("d")).alias("weeks_since_school"))


@query
def p11_clean_names(spark, sf_dir):
    name = sc.clean_name(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")))
    return inp.table(spark, sf_dir, "orders").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query
def p12_p13_holiday_groups(spark, sf_dir):
    name = sc.clean_name(F.col("o_orderpriority"))
    rows = inp.table(spark, sf_dir, "orders").select(hol.to_group(name, RULES).alias("holiday"))
    return hol.with_windows(rows, RULES).groupBy("holiday", "lower_window", "upper_window").agg(
        F.count(F.lit(1)).alias("n")
    )


def holiday_source(spark, sf_dir):
    return inp.table(spark, sf_dir, "orders").select(
        inp.order_day().alias("ds"), F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("seq")
    )


def second_source(spark, sf_dir):
    return inp.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("ds"), F.lit("High ").alias("name"),
        F.col("l_orderkey").alias("seq"),
    )


@query
def s6_u1_two_sources(spark, sf_dir):
    stacked = hol.stack_sources(holiday_source(spark, sf_dir), second_source(spark, sf_dir))
    return stacked.groupBy("source", "name").agg(F.count(F.lit(1)).alias("n"))


@query
def t2_one_per_date(spark, sf_dir):
    return hol.one_per_date(hol.stack_sources(holiday_source(spark, sf_dir), second_source(spark, sf_dir)))


@query
def a5_first_per_year(spark, sf_dir):
    rows = holiday_source(spark, sf_dir).withColumnRenamed("name", "holiday")
    return hol.first_per_year(rows)


@query
def p14_holiday_table(spark, sf_dir):
    sources = [holiday_source(spark, sf_dir), second_source(spark, sf_dir)]
    return hol.holiday_table(sources, "1996-01-01", "2000-12-31", RULES)


@query
def p15_split(spark, sf_dir):
    return inp.split_panel(spark, sf_dir).groupBy("series_id", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("week_start").alias("first_week"), F.max("week_start").alias("last_week")
    )


@query
def p16_horizon(spark, sf_dir):
    return pn.horizon(inp.panel(spark, sf_dir), 35).select("series_id", "step", "week_start", "week")


@query
def p17_j7_future_regressors(spark, sf_dir):
    exog = ("school_in_session", "weeks_since_school", "is_covid", "post_covid", "tmean_c", "LOW_ILI_LAG1", "unknown")
    return project.future_regressors(inp.matrix(spark, sf_dir), exog, covid=inp.COVID)


# -- joins and aggregates -------------------------------------------------------------------------


@query
def j1_grid_left_join(spark, sf_dir):
    facts = inp.fine_facts(spark, sf_dir)
    grid = pn.week_grid(facts.select("series_id").distinct(), inp.START, inp.END)
    return pn.join_grid(grid, pn.weekly_sum(facts))


@query
def j1_a1_weekly_panel(spark, sf_dir):
    return inp.fine_panel(spark, sf_dir)


@query
def j1_a1_supplier_panel(spark, sf_dir):
    """Many series, named by their dimension table; what was shipped off the grid is not read."""
    return pn.weekly_panel(inp.supplier_facts(spark, sf_dir), inp.START, inp.END, series=inp.suppliers(spark, sf_dir))


@query
def a1_weekly_store(spark, sf_dir):
    """A panel of two years from a table of weekly sums that was filled in three turns, one of them again."""
    path, facts = new_path(spark, "weekly-store"), stage(inp.fine_facts(spark, sf_dir), "fine-facts")
    cut = F.lit("1998-06-14").cast("date")
    last = facts.filter(F.year("week_start") >= 1999)
    for part in (facts.filter(F.col("week_start") <= cut), facts.filter((F.col("week_start") > cut) & (F.year("week_start") < 1999)), last):
        weekly_store.add_weekly(part, path)
    weekly_store.add_weekly(last, path, replace=True)
    sums = weekly_store.read_weekly(spark, path, "1998-01-01", "1999-12-31")
    return pn.weekly_panel(sums, "1998-01-01", "1999-12-31", series=inp.fine_series(spark))


@query
def j2_leading_series_join(spark, sf_dir):
    sums = inp.weekly(spark, sf_dir)
    return ft.feature_matrix(sums, inp.LEAD_CFG, sums).select(
        "series_id", "week_start", "y", "LOW_ILI_CASE", "LOW_ILI_LAG1", "LOW_delta_1w"
    )


@query
def j3_temperature_join(spark, sf_dir):
    return ft.feature_matrix(inp.facts(spark, sf_dir), inp.CFG, weather=inp.weather(spark, sf_dir)).select(
        "series_id", "week_start", "tmean_c", "tmean_lag1", "tmean_lag2"
    )


@query
def j4_wide_by_code(spark, sf_dir):
    return pn.weekly_wide(inp.fine_facts(spark, sf_dir), ["1-URGENT/F", "5-LOW/O"])


@query
def a1_weekly_sum(spark, sf_dir):
    return pn.weekly_sum(inp.fine_facts(spark, sf_dir), value="finished_price")


@query
def a2_weekly_mean_temperature(spark, sf_dir):
    return pn.weekly_mean_temperature(inp.weather(spark, sf_dir))


@query
def a3_week_means(spark, sf_dir):
    train = inp.split_panel(spark, sf_dir).filter("part = 'train'")
    return train.groupBy("series_id", "week").agg(F.avg("y").alias("mean_y"))


@query
def a4_week_medians(spark, sf_dir):
    history = staged_split(spark, sf_dir)
    weeks = project.week_medians(history, ["y"]).withColumnRenamed("y", "week_median")
    overall = project.overall_medians(history, ["y"]).withColumnRenamed("y", "overall_median")
    return weeks.join(overall, "series_id")


@query
def a6_season_stats(spark, sf_dir):
    return seasons.block_stats(season_blocks(spark, sf_dir))


@query
def a7_cross_season_summary(spark, sf_dir):
    return seasons.cross_season_summary(seasons.block_stats(season_blocks(spark, sf_dir)))


@query
def a9_season_count(spark, sf_dir):
    return seasons.season_count(labelled(spark, sf_dir))


@query
def a10_null_audit(spark, sf_dir):
    rows = sq.lags(inp.fine_panel(spark, sf_dir), "y", {1: "y_lag1"})
    return pn.null_audit(rows, ["y", "y_lag1", "week"])


def stand_in_projection(panel):
    """Weekly means of the test weeks in the form of a projection."""
    rows = baselines.all_baselines(panel)
    y_hat = F.col("weekly_mean")
    return rows.select(
        "series_id", "week_start", y_hat.alias("y_hat"), (y_hat * 0.5).alias("ci_lower"), (y_hat * 3).alias("ci_upper")
    )


@query
def a11_projection_totals(spark, sf_dir):
    return project.projection_totals(stand_in_projection(inp.split_panel(spark, sf_dir)))


# -- ordered operators ----------------------------------------------------------------------------


@query
def w1_lags(spark, sf_dir):
    rows = sq.lags(inp.fine_panel(spark, sf_dir), "y", {1: "y_lag1", 2: "y_lag2"})
    return rows.select("series_id", "week_start", "y_lag1", "y_lag2")


@query
def w2_first_difference(spark, sf_dir):
    rows = sq.first_difference(inp.fine_panel(spark, sf_dir), "y", "delta")
    return rows.select("series_id", "week_start", "delta")


@query
def w3_next_week_target(spark, sf_dir):
    return sq.next_week_target(inp.split_panel(spark, sf_dir)).select("series_id", "week_start", "target")


@query
def w4_interpolate(spark, sf_dir):
    return sq.interpolate(inp.fine_panel(spark, sf_dir), "y").select("series_id", "week_start", "y")


@query
def w5_interpolate_zero(spark, sf_dir):
    return sq.interpolate(inp.fine_panel(spark, sf_dir), "y", fill=0.0).select("series_id", "week_start", "y")


@query
def w6_back_then_forward_fill(spark, sf_dir):
    rows = sq.lags(inp.fine_panel(spark, sf_dir), "y", {1: "y_lag1"})
    return sq.fill_back_then_forward(rows, ["y", "y_lag1"]).select("series_id", "week_start", "y", "y_lag1")


@query
def w7_target_fill(spark, sf_dir):
    rows = ft.target(inp.fine_facts(spark, sf_dir), inp.CFG)
    return rows.select("series_id", "week_start", "year", "week", "y", "log_y")


@query
def w8_safe_fill(spark, sf_dir):
    rows = sq.lags(inp.fine_panel(spark, sf_dir).withColumnRenamed("y", "X_ILI_CASE"), "X_ILI_CASE",
                   {1: "X_ILI_LAG1", 3: "other_lag3"})
    return sq.fill_back_then_forward(rows, sq.safe_fill_columns(rows.columns)).select(
        "series_id", "week_start", "X_ILI_CASE", "X_ILI_LAG1", "other_lag3"
    )


@query
def w9_blocks(spark, sf_dir):
    return seasons.blocks(flagged_split(spark, sf_dir))


@query
def w10_drop_short_blocks(spark, sf_dir):
    return seasons.drop_short_blocks(flagged_split(spark, sf_dir), 2).select("series_id", "week_start", "is_season")


@query
def w11_season_labels(spark, sf_dir):
    return labelled(spark, sf_dir).select("series_id", "week_start", "is_season", "season_label")


@query
def w12_direction_small(spark, sf_dir):
    """The same directions at a magnitude of 1e-10."""
    rows = inp.split_panel(spark, sf_dir).withColumn("tiny", F.col("y") * 1e-12)
    return rows.withColumn("change", sq.direction("tiny")).select("series_id", "week_start", "change")


@query
def a10_off_grid_facts(spark, sf_dir):
    """Orders by raw day: how many the weekly grid has no place for, and why."""
    raw = inp.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"), inp.order_day().alias("week_start")
    )
    return pn.off_grid(raw, "1996-01-07", "2000-12-31")


@query
def w12_direction(spark, sf_dir):
    return inp.split_panel(spark, sf_dir).withColumn("change", sq.direction("y")).select(
        "series_id", "week_start", "change"
    )


@query
def w13_weeks_from_peak(spark, sf_dir):
    return seasons.weeks_from_peak(labelled(spark, sf_dir)).select(
        "series_id", "season_label", "week_start", "week_index"
    )


@query
def t1_sorted_positions(spark, sf_dir):
    rows = inp.panel(spark, sf_dir).withColumn("position", F.row_number().over(by_time(["series_id"])) - 1)
    return rows.select("series_id", "position", "week_start").orderBy("series_id", "position")


@query
def t3_peak_week(spark, sf_dir):
    top = inp.split_panel(spark, sf_dir).groupBy("series_id").agg(seasons.first_peak().alias("peak"))
    return top.select("series_id", F.col("peak.value").alias("peak_value"), seasons.peak_date("peak").alias("peak_week"))


@query
def t4_m12_recent_seasons(spark, sf_dir):
    return seasons.recent_seasons(seasons.complete_blocks(season_blocks(spark, sf_dir)), 3)


@query
def t5_last_60_weeks(spark, sf_dir):
    return pn.last_weeks(inp.split_panel(spark, sf_dir)).select("series_id", "week_start", "y")


@query
def t6_rank_by_aic(spark, sf_dir):
    e = F.col("y") - F.col("y_hat")
    none = F.array().cast("array<int>")
    aic = F.count(F.lit(1)) * F.log(F.avg(e * e)) + 2
    scored = predictions(spark, sf_dir).groupBy("series_id", F.col("model").alias("features")).agg(aic.alias("aic"))
    results = scored.withColumns({"order": none, "seasonal": none})
    return arima.ranked(results).select("series_id", "features", "aic", "rank")


# -- baselines and evaluation ---------------------------------------------------------------------


def one_baseline(name):
    def build(spark, sf_dir):
        rows = inp.split_panel(spark, sf_dir).withColumn(name, getattr(baselines, name)())
        return rows.filter("part = 'test'").select("series_id", "week_start", name)

    return build


for _id, _name in (
    ("b1_w14_naive", "naive"), ("b2_j5_seasonal_naive", "seasonal_naive"),
    ("b3_j6_weekly_mean", "weekly_mean"), ("b4_weekly_median", "weekly_median"),
):
    _build = one_baseline(_name)
    _build.__name__ = _id
    query(_build)


@query
def b5_all_baselines(spark, sf_dir):
    return predictions(spark, sf_dir)


def scores(*columns):
    def build(spark, sf_dir):
        table = evaluate.full_evaluation(predictions(spark, sf_dir))
        return table.filter("section = 'overall'").select("series_id", "model", *columns)

    return build


for _id, _columns in {
    "e1_mae_rmse": ("mae", "rmse"), "e2_mape": ("mape",), "e3_smape": ("smape",), "e4_r2": ("r2",),
    "e5_directional_accuracy": ("directional_accuracy",),
    "e6_band_accuracy": ("within_20pct", "within_30pct", "within_50pct"),
}.items():
    _build = scores(*_columns)
    _build.__name__ = _id
    query(_build)


@query
def e7_full_evaluation(spark, sf_dir):
    return evaluate.full_evaluation(predictions(spark, sf_dir))


@query
def e7_supplier_evaluation(spark, sf_dir):
    """Four baselines of every supplier by section."""
    rows = inp.flagged(inp.supplier_split(spark, sf_dir))
    return evaluate.full_evaluation(scored_baselines(rows, ["series_id"]))


@query
def a8_metric_rows(spark, sf_dir):
    return evaluate.metric_rows(evaluate.full_evaluation(predictions(spark, sf_dir)))


@query
def e8_compare_models(spark, sf_dir):
    return evaluate.compare_models(predictions(spark, sf_dir))


# -- models ---------------------------------------------------------------------------------------


def hmm_given(panel):
    """Decoding with the same given parameters for every series."""
    return hmm.decode_given(panel, means=(7.0, 11.0), covars=(6.0, 9.0), **HMM)


@query
def m1_hmm_fit(spark, sf_dir):
    fitted = hmm.season_state(hmm.fit_decode(inp.split_panel(spark, sf_dir)))
    return fitted.select(
        "series_id", "means", "covars", "startprob", "transmat", "n_iter", "converged", "log_likelihood", "season_state"
    )


@query
def m2_m3_hmm_decode(spark, sf_dir):
    return hmm.decoded_rows(hmm_given(inp.split_panel(spark, sf_dir)))


@query
def m4_hmm_seasons(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    return hmm.detect_seasons(rows, hmm.fit_decode(rows)).select(
        "series_id", "week_start", "y", "hmm_state", "season_prob", "is_season", "season_label"
    )


@query
def m4_hmm_seasons_given(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    found = hmm.detect_seasons(rows, hmm_given(rows))
    return found.select("series_id", "week_start", "hmm_state", "season_prob", "is_season", "season_label")


@query
def m5_hmm_quality_given(spark, sf_dir):
    fitted = hmm_given(inp.split_panel(spark, sf_dir))
    return flat_quality(hmm.quality(fitted))


def flat_quality(rows):
    """Arrays as columns, which SQL can compare."""
    vectors = [F.get(c, F.lit(i)).alias(f"{c}_{i}") for c in ("state_means", "state_covariances") for i in (0, 1)]
    moves = [F.get(F.get("transition_matrix", F.lit(i)), F.lit(j)).alias(f"move_{i}{j}") for i in (0, 1) for j in (0, 1)]
    return rows.select("series_id", "log_likelihood", "aic", "bic", *vectors, *moves)


def planted(spark, sf_dir):
    """Weekly orders with a step of 1 000 from November to March: two states that do not overlap."""
    winter = F.when(F.month("week_start").isin(11, 12, 1, 2, 3), 1_000.0).otherwise(0.0)
    return inp.split_panel(spark, sf_dir).withColumn("y", F.col("y") + winter)


@query
def m1_hmm_fit_planted(spark, sf_dir):
    """Where the states do not overlap, the fit ends at the moments of each and the counts of the moves."""
    fitted = hmm.season_state(hmm.fit_decode(planted(spark, sf_dir)))
    start = [F.get("startprob", F.lit(i)).alias(f"start_{i}") for i in (0, 1)]
    quality = flat_quality(hmm.quality(fitted)).drop("aic", "bic")
    return fitted.select("series_id", *start, "converged", "season_state").join(quality, "series_id")


@query
def m4_hmm_seasons_planted(spark, sf_dir):
    rows = stage(planted(spark, sf_dir), "planted")
    found = hmm.detect_seasons(rows, hmm.fit_decode(rows))
    return found.select("series_id", "week_start", "hmm_state", "season_prob", "is_season", "season_label")


@query
def m5_hmm_quality_planted(spark, sf_dir):
    return flat_quality(hmm.quality(hmm.fit_decode(planted(spark, sf_dir))))


@query
def m5_hmm_quality(spark, sf_dir):
    return hmm.quality(hmm.fit_decode(inp.split_panel(spark, sf_dir)))


@query
def m6_sarimax_fit(spark, sf_dir):
    return arima.fit(inp.split_matrix(spark, sf_dir).filter("part = 'train'"), inp.SPEC)


# Orders whose conditional sum of squares has a closed form: one lag, and one regressor alone.
ONE_LAG = arima.SarimaxSpec((1, 0, 0), (0, 0, 0, 1), ())
ONE_REGRESSOR = arima.SarimaxSpec((0, 0, 0), (0, 0, 0, 1), ("school_in_session",))


def to_places(df, places, *columns):
    """An iterative fit agrees with the closed form to a few places."""
    return df.withColumns({c: F.round(c, places) for c in columns})


@query
def m6_fit_one_lag(spark, sf_dir):
    rows = arima.fit(inp.split_panel(spark, sf_dir).filter("part = 'train'"), ONE_LAG)
    return to_places(rows.select("series_id", F.get("ar", F.lit(0)).alias("ar"), "sigma2", "aic", "nobs"), 4, "ar", "sigma2", "aic")


TWO_LAGS = arima.SarimaxSpec((2, 0, 0), (0, 0, 0, 1), ())
TWO_REGRESSORS = arima.SarimaxSpec((0, 0, 0), (0, 0, 0, 1), ("school_in_session", "weeks_since_school"))


@query
def m6_fit_two_lags(spark, sf_dir):
    rows = arima.fit(inp.split_panel(spark, sf_dir).filter("part = 'train'"), TWO_LAGS)
    lags = [F.get("ar", F.lit(i)).alias(f"ar_{i + 1}") for i in (0, 1)]
    return to_places(rows.select("series_id", *lags, "sigma2", "aic", "nobs"), 4, "ar_1", "ar_2", "sigma2", "aic")


@query
def m6_fit_two_regressors(spark, sf_dir):
    panel = ft.calendar_features(inp.split_panel(spark, sf_dir), inp.CFG).filter("part = 'train'")
    betas = [F.get("beta", F.lit(i)).alias(f"beta_{i + 1}") for i in (0, 1)]
    rows = arima.fit(panel, TWO_REGRESSORS).select("series_id", *betas, "sigma2", "aic", "nobs")
    return to_places(rows, 4, "beta_1", "beta_2", "sigma2", "aic")


@query
def s7_m6_bucketed_suppliers(spark, sf_dir):
    """The matrix of many series as a bucketed table, and a fit of each where its part lies."""
    name = new_path(spark, "suppliers").rsplit("/", 1)[1].replace("-", "_")
    rows = writers.write_bucketed(inp.supplier_split(spark, sf_dir), name, new_path(spark, name), ["series_id"], 8)
    models = arima.fit(rows.filter("part = 'train'"), ONE_LAG, placed=True)
    return to_places(models.select("series_id", F.get("ar", F.lit(0)).alias("ar"), "sigma2", "nobs"), 3, "ar", "sigma2")


@query
def m9_order_one_lag(spark, sf_dir):
    bounds = {"p": 1, "d": 0, "q": 0, "P": 0, "D": 0, "Q": 0}
    return to_places(arima.auto_order(inp.split_panel(spark, sf_dir), (), s=1, bounds=bounds), 4, "aic").select(
        "series_id", F.get("order", F.lit(0)).alias("p"), "aic"
    )


@query
def m9_order_short_series(spark, sf_dir):
    """Bounds whose seasonal orders look back further than any series: they are left out, not the series."""
    bounds = {"p": 1, "d": 0, "q": 0, "P": 1, "D": 1, "Q": 0}
    found = arima.auto_order(inp.split_panel(spark, sf_dir), (), s=400, bounds=bounds)
    return to_places(found, 4, "aic").select("series_id", F.get("order", F.lit(0)).alias("p"), "aic")


@query
def m10_t6_search_closed_form(spark, sf_dir):
    found = arima.search(staged_split(spark, sf_dir), [("lag", ONE_LAG), ("regressor", ONE_REGRESSOR)])
    ranks = arima.ranked(found).select("series_id", "features", "rank", "aic", "mae", "rmse")
    return to_places(ranks, 4, "aic", "mae", "rmse")


@query
def m6_m8_sarimax_walk_forward(spark, sf_dir):
    rows = stage(inp.split_matrix(spark, sf_dir), "matrix")
    model = arima.SeasonalArima(inp.SPEC).fit(rows.filter("part = 'train'"))
    return model.walk_forward(rows)


@query
def m7_multistep_given(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    return arima.forecast_multistep(rows, inp.given_models(rows, **AR1), AR1["exog"])


@query
def m8_walk_forward_given(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    return arima.walk_forward(rows, inp.given_models(rows, **AR), AR["exog"])


@query
def m8_walk_forward_by_lags(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    return arima.walk_forward_by_lags(
        rows, inp.given_models(rows, **AR), AR["order"], AR["seasonal"], AR["exog"]
    )


def gapped_split(spark, sf_dir):
    """Panel by priority and status with its empty weeks left empty."""
    rows = inp.fine_panel(spark, sf_dir).withColumn("log_y", F.log1p("y"))
    rows = ft.calendar_features(pn.split(rows, inp.SPLIT, bounds=(inp.START, inp.END)), inp.CFG)
    return stage(rows, "gapped")


@query
def m6_exact_random_walk(spark, sf_dir):
    """Exact likelihood of a random walk seen with gaps: every step counts by its length."""
    spec = arima.SarimaxSpec((0, 1, 0), (0, 0, 0, 1), (), method="exact")
    found = arima.fit(gapped_split(spark, sf_dir).filter("part = 'train'"), spec)
    return found.select("series_id", "sigma2", "log_likelihood", "aic", "nobs", "message")


@query
def m6_exact_regressor(spark, sf_dir):
    """White noise round one regressor, fitted on the weeks that are there."""
    spec = arima.SarimaxSpec((0, 0, 0), (0, 0, 0, 1), ("school_in_session",), method="exact")
    found = arima.fit(gapped_split(spark, sf_dir).filter("part = 'train'"), spec)
    return found.select("series_id", F.get("beta", F.lit(0)).alias("beta"), "sigma2", "log_likelihood", "aic", "nobs")


@query
def m7_exact_multistep_given(spark, sf_dir):
    rows = gapped_split(spark, sf_dir)
    return arima.forecast_multistep(rows, inp.given_models(rows, **ONE_GAP_AR), ONE_GAP_AR["exog"], method="exact")


@query
def m8_exact_walk_forward_given(spark, sf_dir):
    rows = gapped_split(spark, sf_dir)
    return arima.walk_forward(rows, inp.given_models(rows, **ONE_GAP_AR), ONE_GAP_AR["exog"], method="exact")


@query
def m9_auto_order(spark, sf_dir):
    return arima.auto_order(stage(inp.split_matrix(spark, sf_dir), "matrix"), inp.EXOG)


@query
def m10_grid_search(spark, sf_dir):
    found = arima.grid_search(stage(inp.split_matrix(spark, sf_dir), "matrix"), inp.EXOG)
    return found.select("series_id", "rank", "order", "seasonal", "features", "aic", "mae", "rmse")


@query
def m11_projection_given(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    future = project.future_regressors(rows, AR1["exog"], covid=inp.COVID)
    return project.project(rows, inp.given_models(rows, **AR1), future, AR1["exog"])


@query
def m11_horizon_interval_given(spark, sf_dir):
    """The same path with the interval of each step's own horizon."""
    rows = staged_split(spark, sf_dir)
    future = project.future_regressors(rows, AR1["exog"], covid=inp.COVID)
    return project.project(rows, inp.given_models(rows, **AR1), future, AR1["exog"], interval="horizon")


@query
def m11_exact_horizon_given(spark, sf_dir):
    """Path and interval after a history with missing weeks."""
    rows = gapped_split(spark, sf_dir)
    future = project.future_regressors(rows, ONE_GAP_AR["exog"], covid=inp.COVID)
    models = inp.given_models(rows, **ONE_GAP_AR)
    return project.project(rows, models, future, ONE_GAP_AR["exog"], interval="horizon", method="exact")


@query
def m12_m13_next_season_given(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    return project.next_season(rows, inp.given_models(rows, **AR1), AR1["exog"], covid=inp.COVID)["next_season_totals"]


def next_season(spark, sf_dir):
    rows = stage(inp.matrix(spark, sf_dir), "matrix")
    models = stage(arima.fit(rows, inp.SPEC), "models")
    return project.next_season(rows, models, inp.EXOG, covid=inp.COVID)


@query
def m11_next_season(spark, sf_dir):
    return next_season(spark, sf_dir)["next_season"]


@query
def m13_next_season_totals(spark, sf_dir):
    return next_season(spark, sf_dir)["next_season_totals"]


# -- diagnostic tables ----------------------------------------------------------------------------


@query
def d1_forecast_frame(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    forecasts = baselines.all_baselines(rows).select("series_id", "week_start", F.col("weekly_mean").alias("y_hat"))
    return diagnostics.forecast_frame(rows, forecasts)


@query
def d2_actual_vs_predicted(spark, sf_dir):
    return diagnostics.actual_vs_predicted(predictions(spark, sf_dir))


@query
def d3_model_lines(spark, sf_dir):
    return diagnostics.model_lines(predictions(spark, sf_dir))


@query
def d4_residuals(spark, sf_dir):
    return residuals(spark, sf_dir)


@query
def d4_residual_histogram(spark, sf_dir):
    return diagnostics.residual_histogram(residuals(spark, sf_dir))


@query
def d5_autocorrelation(spark, sf_dir):
    return diagnostics.autocorrelation(residuals(spark, sf_dir))


@query
def d6_partial_autocorrelation(spark, sf_dir):
    return diagnostics.partial_autocorrelation(residuals(spark, sf_dir))


@query
def d7_season_panels(spark, sf_dir):
    rows = inp.flagged(inp.matrix(spark, sf_dir))
    return diagnostics.season_panels(seasons.detect(rows, min_weeks=2))


@query
def d8_season_spans(spark, sf_dir):
    return diagnostics.season_spans(labelled(spark, sf_dir))


@query
def d8_probability_line(spark, sf_dir):
    return diagnostics.probability_line(hmm.decoded_rows(hmm_given(inp.split_panel(spark, sf_dir))))


@query
def d9_next_season_frame(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    return diagnostics.next_season_frame(rows.filter("part = 'train'"), stand_in_projection(rows))


@query
def d9_peak_aligned(spark, sf_dir):
    rows = staged_split(spark, sf_dir)
    return diagnostics.peak_aligned(seasons.detect(inp.flagged(rows), min_weeks=2), stand_in_projection(rows))


# -- plans and streaming --------------------------------------------------------------------------


@query
def feature_matrix(spark, sf_dir):
    return inp.matrix(spark, sf_dir)


@query
def full_run_comparison(spark, sf_dir):
    results = run(
        inp.facts(spark, sf_dir), RunConfig(inp.CFG, inp.SPLIT, sarimax=inp.SPEC),
        inp.weather(spark, sf_dir), lead_facts=inp.lead_facts(spark, sf_dir),
    )
    return results["comparison"]


def streamed(spark, rows, batches, models, **options):
    """Scores of ``rows`` that arrive in the given batches; every batch is a run that goes on from the checkpoint."""
    # Typed state needs a library that nothing else does.
    from panelcast.streaming.walk_forward import score_arrivals

    source, sink, progress = (new_path(spark, n) for n in ("arrivals", "scored", "progress"))
    for batch in batches:
        batch.write.mode("append").parquet(source)
        arrivals = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
        scored = score_arrivals(arrivals, models, **options)
        writer = scored.writeStream.format("parquet").option("checkpointLocation", progress)
        writer.outputMode("append").trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema(scored.schema).parquet(sink)


@query
def st1_stream_walk_forward(spark, sf_dir):
    rows = inp.hourly(spark, sf_dir)
    return streamed(spark, rows, [rows.repartitionByRange(4, "tick")], inp.given_models(rows, **HOURLY_AR))


@query
def st1_stream_lost_and_late(spark, sf_dir):
    """Every hundredth-odd tick never comes, others come when they have been given up; the rest is scored past them."""
    rows = stage(inp.hourly(spark, sf_dir), "hourly")
    early = F.col("tick") <= F.max("tick").over(whole(["series_id"])) - 40
    kind = F.when(early & (F.col("tick") % 97 == 50), "lost").when(early & (F.col("tick") % 97 == 10), "late").otherwise("on time")
    marked = rows.withColumn("kind", kind)
    batches = [marked.filter(F.col("kind") == k).drop("kind") for k in ("on time", "late")]
    return streamed(spark, rows, batches, inp.given_models(rows, **HOURLY_AR1), max_wait=20)
