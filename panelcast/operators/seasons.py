"""Season blocks, labels and statistics from a 0/1 flag, all as windows over one partitioning."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.functions.windows import by_time, so_far, whole

KEYS = ("series_id",)
# Fixed value: shorter season blocks are noise.
MIN_SEASON_WEEKS = 4


def with_blocks(panel: DataFrame, flag: str = "is_season", keys: Sequence[str] = KEYS) -> DataFrame:
    """Number the runs of equal flags in time order (``block``) and the rows (``position``, from 0)."""
    w = by_time(keys)
    changed = F.when(F.lag(flag).over(w).eqNullSafe(F.col(flag)), 0).otherwise(1)
    return (
        panel.withColumns({"position": F.row_number().over(w) - 1, "_changed": changed})
        .withColumn("block", F.sum("_changed").over(so_far(keys)).cast("int"))
        .drop("_changed")
    )


def block_table(panel: DataFrame, flag: str = "is_season", keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per run of equal flags: ``keys, block, flag``, the inclusive positions ``start`` and ``end``, ``length``, and
    ``rows``, the run's rows in time order (at most one per grid week).

    One sort by series and week makes the runs; everything about them is then work on their few rows, without a join
    back to the weeks.
    """
    rows = with_blocks(panel, flag, keys)
    row = F.struct("position", *(F.col(f"`{c}`") for c in panel.columns if c not in keys))
    return rows.groupBy(*keys, "block").agg(
        F.first(flag).alias("flag"),
        F.min("position").alias("start"),
        F.max("position").alias("end"),
        F.count(F.lit(1)).alias("length"),
        F.sort_array(F.collect_list(row)).alias("rows"),
    )


def blocks(
    panel: DataFrame, flag: str = "is_season", target: int = 1, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Inclusive [start, end] row positions of the runs where the flag equals the target."""
    runs = block_table(panel.select(*keys, "week_start", flag), flag, keys)
    return runs.filter(F.col("flag") == target).select(*keys, "start", "end", "length")


def drop_short_blocks(
    panel: DataFrame, min_weeks: int = MIN_SEASON_WEEKS, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Clear the season flag in blocks shorter than ``min_weeks``; an unknown flag stays NULL."""
    return _weeks_of(_without_short(block_table(panel, "is_season", keys), min_weeks), panel, ["is_season"], keys)


def _without_short(runs: DataFrame, min_weeks: int) -> DataFrame:
    kept = (F.col("flag") == 1) & (F.col("length") >= min_weeks)
    return runs.withColumn("is_season", F.when(F.col("flag").isNotNull(), F.when(kept, 1).otherwise(0)))


def _weeks_of(runs: DataFrame, panel: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The rows of the runs again, with the runs' ``columns`` in the place of their own."""
    found = [F.col(c).alias(f"_{c}") for c in columns]
    weeks = runs.select(*keys, *found, F.inline("rows"))
    kept = [F.col(f"`{c}`") for c in panel.columns if c not in columns]
    placed = {c: F.col(f"_{c}").alias(c) for c in columns}
    order = [*panel.columns, *(c for c in columns if c not in panel.columns)]
    return weeks.select(*kept, *placed.values()).select(*(F.col(f"`{c}`") for c in order))


def _labelled(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs with their ``season_label``; see ``label_seasons``."""
    season = F.col("is_season") == 1
    winters = F.transform(
        F.filter("rows", lambda r: F.month(r["week_start"]).isin(1, 2)), lambda r: F.year(r["week_start"])
    )
    votes = F.transform(
        F.array_distinct(winters),
        lambda year: F.struct(F.size(F.filter(winters, lambda other: other == year)).alias("n"), (-year).alias("less")),
    )
    candidate = F.coalesce(-F.array_max(votes)["less"], F.year(F.get("rows", F.lit(0))["week_start"]) + 1)
    so_far_blocks = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = runs.withColumns({"_candidate": candidate, "_j": F.sum(F.when(season, 1).otherwise(0)).over(so_far_blocks)})
    lead = F.max(F.when(season, F.col("_candidate") - F.col("_j"))).over(so_far_blocks)
    label = F.when(season, (F.col("_j") + lead).cast("int"))
    return numbered.withColumn("season_label", label).drop("_candidate", "_j")


def label_seasons(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Give each season block a year.

    The candidate is the most frequent year among the block's January and February rows (the smaller
    on ties), or else the first row's year plus one. A taken label moves up by one until free: with
    blocks numbered j in time order and candidates that never fall, label_i = i + max(cand_j - j), a running
    maximum over the blocks of a series.
    """
    runs = block_table(panel, "is_season", keys).withColumn("is_season", F.col("flag"))
    return _weeks_of(_labelled(runs, keys), panel, ["season_label"], keys)


def season_blocks(panel: DataFrame, min_weeks: int = MIN_SEASON_WEEKS, keys: Sequence[str] = KEYS) -> DataFrame:
    """The block table with ``is_season`` after short blocks are out, and ``season_label``."""
    return _labelled(_without_short(block_table(panel, "is_season", keys), min_weeks), keys)


def detect(panel: DataFrame, min_weeks: int = MIN_SEASON_WEEKS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Short blocks out, the rest labelled, from one block table."""
    return _weeks_of(season_blocks(panel, min_weeks, keys), panel, ["is_season", "season_label"], keys)


def first_peak(value: str = "y", date: str = "week_start") -> Column:
    """(value, date) of the maximum, the earliest date on ties."""
    return F.max(F.struct(F.col(value).alias("value"), (-F.unix_date(F.col(date))).alias("neg_day")))


def peak_date(peak: str) -> Column:
    return F.date_from_unix_date(-F.col(f"{peak}.neg_day"))


def season_stats(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per season of a labelled panel: onset, first peak and end with ISO weeks, length, peak and total."""
    grouped = (
        panel.filter(F.col("season_label").isNotNull())
        .groupBy(*keys, "season_label")
        .agg(
            F.min("week_start").alias("onset_date"),
            F.max("week_start").alias("end_date"),
            F.count(F.lit(1)).alias("duration_weeks"),
            F.sum("y").alias("total_ili_burden"),
            first_peak().alias("peak"),
        )
    )
    return _stats(grouped, keys)


def _stats(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    return grouped.withColumn("peak_date", peak_date("peak")).select(
        *keys,
        "season_label",
        "onset_date",
        cal.iso_week(F.col("onset_date")).alias("onset_week"),
        "peak_date",
        cal.iso_week(F.col("peak_date")).alias("peak_week"),
        "end_date",
        cal.iso_week(F.col("end_date")).alias("end_week"),
        "duration_weeks",
        F.col("peak.value").alias("peak_ili"),
        "total_ili_burden",
    )


def _total(rows: str = "rows") -> Column:
    known = F.filter(rows, lambda r: r["y"].isNotNull())
    summed = F.aggregate(known, F.lit(0.0), lambda total, r: total + r["y"])
    return F.when(F.size(known) > 0, summed)


def block_stats(runs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``season_stats`` of a table from ``season_blocks``: one row of it is one season, so nothing is grouped again."""
    peak = F.array_max(
        F.transform("rows", lambda r: F.struct(r["y"].alias("value"), (-F.unix_date(r["week_start"])).alias("neg_day")))
    )
    seasons = runs.filter(F.col("season_label").isNotNull()).select(
        *keys, "season_label",
        F.get("rows", F.lit(0))["week_start"].alias("onset_date"),
        F.element_at("rows", -1)["week_start"].alias("end_date"),
        F.col("length").alias("duration_weeks"),
        _total().alias("total_ili_burden"),
        peak.alias("peak"),
    )
    return _stats(seasons, keys)


def complete_blocks(runs: DataFrame, keys: Sequence[str] = KEYS, min_weeks: int = 10) -> DataFrame:
    """``complete_seasons`` of a table from ``season_blocks``: a trailing season is the last block of its series."""
    last = F.col("block") == F.max("block").over(whole(keys))
    found = runs.withColumn("_open", last & (F.col("length") < min_weeks)).filter(F.col("season_label").isNotNull())
    return found.filter(~F.col("_open")).select(
        *keys, "season_label", F.array_max(F.transform("rows", lambda r: r["y"])).alias("peak"), _total().alias("total"),
        F.col("length").alias("n_weeks"),
    )


# The columns summarised across seasons, and the statistics.
SUMMARY_COLUMNS = ("duration_weeks", "onset_week", "peak_week", "peak_ili", "total_ili_burden")
SUMMARY_STATISTICS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def cross_season_summary(stats: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Long ``metric, statistic, value``; the sample deviation of a single season is NULL."""
    long = stats.select(
        *keys, *(F.col(c).cast("double").alias(c) for c in SUMMARY_COLUMNS)
    ).unpivot(list(keys), list(SUMMARY_COLUMNS), "metric", "x")
    wide = long.groupBy(*keys, "metric").agg(
        *(f("x").alias(name) for name, f in SUMMARY_STATISTICS.items())
    )
    return wide.unpivot([*keys, "metric"], list(SUMMARY_STATISTICS), "statistic", "value")


def season_count(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return panel.groupBy(*keys).agg(F.countDistinct("season_label").alias("n_seasons"))


def complete_seasons(
    panel: DataFrame, keys: Sequence[str] = KEYS, min_weeks: int = 10
) -> DataFrame:
    """Per-season peak, total and length without a trailing season that is cut off by the end of the
    data and has fewer than ``min_weeks`` rows."""
    rows = panel.withColumn("_end", F.max("week_start").over(whole(keys))).filter(
        F.col("season_label").isNotNull()
    )
    stats = rows.groupBy(*keys, "season_label").agg(
        F.max("y").alias("peak"),
        F.sum("y").alias("total"),
        F.count(F.lit(1)).alias("n_weeks"),
        (F.max("week_start") >= F.first("_end")).alias("_open"),
    )
    is_last = F.col("season_label") == F.max("season_label").over(whole(keys))
    return (
        stats.withColumn("_last", is_last)
        .filter(~(F.col("_last") & F.col("_open") & (F.col("n_weeks") < min_weeks)))
        .drop("_open", "_last")
    )


def recent_seasons(
    stats: DataFrame, k: int = 3, keys: Sequence[str] = KEYS, label: str = "season_label"
) -> DataFrame:
    """The last ``k`` labels of each series."""
    newest = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(label).desc()))
    return stats.withColumn("_rank", newest).filter(F.col("_rank") <= k).drop("_rank")


def weeks_from_peak(panel: DataFrame, k: int = 4, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of the last ``k`` seasons with their distance in rows from the season's first peak."""
    rows = recent_seasons(panel.filter(F.col("season_label").isNotNull()), k, keys)
    in_season = [*keys, "season_label"]
    rows = rows.withColumn("_n", F.row_number().over(by_time(in_season)))
    top = F.max(F.struct("y", (-F.col("_n")).alias("neg"))).over(whole(in_season))
    return rows.withColumn("_top", top).withColumn(
        "week_index", F.col("_n") + F.col("_top.neg")
    ).drop("_n", "_top")
