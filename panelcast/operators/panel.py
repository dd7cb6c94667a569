"""From raw facts to continuous weekly panels."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.functions.windows import whole

KEYS = ("series_id",)
BROADCAST_LIMIT_BYTES = 64 << 20


def weekly_sum(
    facts: DataFrame, keys: Sequence[str] = KEYS, week: str = "week_start", value: str = "value"
) -> DataFrame:
    """One row per series and week. A week whose values are all NULL sums to 0; NULL weeks go.

    The partial aggregate runs before the shuffle, so a series that holds a large share of the facts
    sends one row per week and map task.
    """
    return (
        facts.filter(F.col(week).isNotNull())
        .groupBy(*keys, week)
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("y"))
    )


def week_grid(series: DataFrame, start, end, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every Sunday of [start, end], both ends included, for every row of ``series``."""
    first, last = cal.grid_bounds(start, end)
    weeks = F.expr(f"sequence(date'{first}', date'{last}', interval 7 days)")
    return with_epi(series.select(*keys, F.explode(weeks).alias("week_start")))


def with_epi(df: DataFrame, week: str = "week_start") -> DataFrame:
    """Epi year and week of rows dated by their Sunday."""
    wednesday = f"date_add({week}, 3)"
    return df.withColumns(
        {
            "year": F.expr(f"year({wednesday})"),
            "week": F.expr(f"int(floor((dayofyear({wednesday}) - 1) / 7)) + 1"),
        }
    )


def join_grid(grid: DataFrame, weekly: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Left join of weekly values to a given grid."""
    return grid.join(weekly, [*keys, "week_start"], "left")


def weekly_panel(
    facts: DataFrame,
    start,
    end,
    keys: Sequence[str] = KEYS,
    week: str = "week_start",
    value: str = "value",
    series: DataFrame | None = None,
) -> DataFrame:
    """Weekly sums on the full Sunday grid, NULL where a series has no fact in a week.

    Same rows as ``join_grid(week_grid(distinct series), weekly_sum(facts))`` from a single scan:
    each observed week emits itself and the empty weeks up to the next one. Facts off the grid fold
    into one NULL slot per series, which keeps the series in the result.

    ``series`` names the series (a dimension table with the keys; repeated rows do no harm). Then facts off the grid
    need not be read: the grid's bounds become a plain filter, which reaches the scan where ``week`` is a stored column
    (``readers.between_days`` does the same for a raw day). Series without a fact give NULLs; facts of others are kept.
    """
    first, last = cal.grid_bounds(start, end)
    d = F.col(week)
    in_bounds = d.between(F.lit(first), F.lit(last))
    if series is None:
        rows = facts.select(*keys, F.when(in_bounds & (F.dayofweek(d) == 1), d).alias("slot"), F.col(value).alias("value"))
    else:
        rows = facts.filter(in_bounds & (F.dayofweek(d) == 1)).select(*keys, d.alias("slot"), F.col(value).alias("value"))
        empty = (F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("slot", "value"))
        rows = rows.unionByName(series.select(*keys, *empty))
    sums = rows.groupBy(*keys, "slot").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))
    return _fill_slots(sums, first, last, keys, "total", "y")


def _fill_slots(slots, first, last, keys, value, name) -> DataFrame:
    names = ", ".join(f"`{k}`" for k in keys)
    order = f"PARTITION BY {names} ORDER BY slot ASC NULLS FIRST"
    spans = slots.selectExpr(
        "*",
        f"CASE WHEN row_number() OVER ({order}) = 1 THEN date'{first}' ELSE slot END AS from",
        f"coalesce(date_sub(lead(slot) OVER ({order}), 7), date'{last}') AS to",
    ).filter("`from` <= `to`")
    rows = spans.selectExpr(
        *(f"`{k}`" for k in keys), "slot", value,
        "explode(sequence(`from`, `to`, interval 7 days)) AS week_start",
    )
    return with_epi(
        rows.selectExpr(
            *(f"`{k}`" for k in keys), "week_start", f"CASE WHEN week_start = slot THEN {value} END AS {name}"
        )
    )


def on_grid(
    weekly: DataFrame, start, end, keys: Sequence[str] = KEYS, value: str = "y"
) -> DataFrame:
    """``weekly_panel`` for a frame that already has at most one row per series and week."""
    first, last = cal.grid_bounds(start, end)
    d = F.col("week_start")
    inside = d.between(F.lit(first), F.lit(last)) & (F.dayofweek(d) == 1)
    slots = weekly.groupBy(*keys, F.when(inside, d).alias("slot")).agg(F.max(value).alias(value))
    return _fill_slots(slots, first, last, keys, value, value)


def weekly_mean_temperature(daily: DataFrame, keys: Sequence[str] = ("station",)) -> DataFrame:
    """Mean of (tmax + tmin) / 2 over the seven days that end on each Sunday."""
    tmean = (F.col("tmax") + F.col("tmin")) / 2
    return (
        daily.select(*keys, "date", tmean.alias("tmean"))
        .dropna(subset=["date", "tmean"])
        .groupBy(*keys, cal.week_ending(F.col("date")).alias("week_start"))
        .agg(F.avg("tmean").alias("tmean_c"))
    )


def weekly_wide(
    facts: DataFrame,
    codes: Sequence[str],
    code: str = "series_id",
    week: str = "week_start",
    value: str = "value",
    suffix: str = "_ILI_CASE",
) -> DataFrame:
    """One column per code from one scan; weeks known to any code appear once."""
    if not codes:
        raise ValueError("no leading series specified")
    sums = weekly_sum(facts.filter(F.col(code).isin(*codes)), [code], week, value)
    wide = sums.groupBy(week).pivot(code, list(codes)).agg(F.first("y"))
    return wide.select(F.col(week).alias("week_start"), *(F.col(c).alias(f"{c}{suffix}") for c in codes))


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint when the row bound proves the frame small; else leave the choice to Spark."""
    return F.broadcast(df) if max_rows * len(df.columns) * 16 <= BROADCAST_LIMIT_BYTES else df


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, NULLs and percent NULL per column, all columns in one pass."""
    columns = list(columns or df.columns)
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns),
    )
    return totals.unpivot("n_rows", columns, "column", "n_null").select(
        "column", "n_null", "n_rows",
        F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows") * 100).alias("pct_null"),
    )


def off_grid(
    facts: DataFrame, start, end, keys: Sequence[str] = KEYS, week: str = "week_start", n_facts: str | None = None
) -> DataFrame:
    """Facts per series that the panel does not use, by reason; series without any are left out.

    ``n_facts`` names the column that says how many facts a row stands for, where it is not one."""
    first, last = cal.grid_bounds(start, end)
    d = F.col(week)
    reason = (
        F.when(d.isNull(), "no date")
        .when(~d.between(F.lit(first), F.lit(last)), "outside the grid")
        .when(F.dayofweek(d) != 1, "not a Sunday")
    )
    count = F.sum(n_facts) if n_facts else F.count(F.lit(1))
    return facts.groupBy(*keys, reason.alias("reason")).agg(count.alias("n_facts")).dropna(subset=["reason"])


def without_facts(facts: DataFrame, codes: Sequence[str], code: str = "series_id") -> DataFrame:
    """The requested codes of which no fact is known."""
    asked = facts.sparkSession.createDataFrame([(c,) for c in codes], f"`{code}` string")
    return asked.join(facts.filter(F.col(code).isin(*codes)).select(code).distinct(), code, "left_anti")


def split(
    panel: DataFrame, split_date, week: str = "week_start", bounds: tuple | None = None
) -> DataFrame:
    """Mark every row ``train`` (week on or before the date) or ``test``.

    With ``bounds`` (the grid's first and last day) an empty part is seen without touching the data;
    otherwise two existence probes look for one row on each side.
    """
    cut = cal.as_date(split_date)
    if bounds is not None:
        first, last = cal.grid_bounds(*bounds)
        n_train, n_test = first <= cut, last > cut
    else:
        n_train = not panel.filter(F.col(week) <= F.lit(cut)).isEmpty()
        n_test = not panel.filter(F.col(week) > F.lit(cut)).isEmpty()
    if not (n_train and n_test):
        empty = "train" if not n_train else "test"
        raise ValueError(f"split date {cut} leaves an empty {empty} part")
    return panel.withColumn("part", F.when(F.col(week) <= F.lit(cut), "train").otherwise("test"))


def future_weeks(n_weeks: int) -> Column:
    """Generator of ``step, week_start`` for the Sundays after the column ``last_week``."""
    weeks = F.expr(f"sequence(date_add(last_week, 7), date_add(last_week, {7 * n_weeks}), interval 7 days)")
    steps = F.transform(weeks, lambda w, i: F.struct((i + 1).alias("step"), w.alias("week_start")))
    return F.inline(steps)


def horizon(panel: DataFrame, n_weeks: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ``n_weeks`` Sundays after each series' last week, with their epi weeks."""
    last = panel.groupBy(*keys).agg(F.max("week_start").alias("last_week"))
    return last.select(*keys, future_weeks(n_weeks)).withColumn("week", cal.epi_week(F.col("week_start")))


def last_weeks(panel: DataFrame, n: int = 60, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows no older than ``n`` weeks before each series' last week."""
    newest = F.max("week_start").over(whole(keys))
    return panel.withColumn("newest", newest).filter(
        F.col("week_start") >= F.date_sub("newest", 7 * n)
    ).drop("newest")
