"""Facts, leading series, weather and calendar to one feature matrix, as one lazy plan."""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.operators import panel as pn
from panelcast.operators import sequence as sq


@dataclass(frozen=True)
class FeatureConfig:
    start: str
    end: str
    keys: tuple[str, ...] = ("series_id",)
    # Key column that names the series, and the names to forecast; none means all.
    code: str = "series_id"
    targets: tuple[str, ...] = ()
    # Leading series, its lags, and the temperature lags.
    lead_codes: tuple[str, ...] = ("AUS",)
    lead_lags: tuple[int, ...] = (1,)
    temperature_lags: tuple[int, ...] = (1, 2)
    # The station that serves all series of a panel without a station column; "all": the mean of all.
    station: str = "all"
    school: cal.SchoolYear = field(default_factory=cal.SchoolYear)
    covid: cal.Period = field(default_factory=cal.Period)

    def __post_init__(self):
        if cal.as_date(self.start) >= cal.as_date(self.end):
            raise ValueError(f"start_date {self.start} must be before end_date {self.end}")

    def is_target(self) -> Column:
        return F.col(self.code).isin(*self.targets) if self.targets else F.lit(True)

    def is_lead(self) -> Column:
        return F.col(self.code).isin(*self.lead_codes)

    @property
    def n_weeks(self) -> int:
        return cal.grid_size(self.start, self.end)


def target(facts: DataFrame, cfg: FeatureConfig, fill: bool = True, series: DataFrame | None = None) -> DataFrame:
    """Weekly target on the grid, interpolated; ``fill`` also closes a leading gap. ``series``: see ``weekly_panel``."""
    panel = pn.weekly_panel(facts.filter(cfg.is_target()), cfg.start, cfg.end, cfg.keys, series=series)
    panel = sq.interpolate(panel, "y", cfg.keys)
    if fill:
        panel = sq.fill_back_then_forward(panel, ["y"], cfg.keys)
    return panel.withColumn("log_y", F.log1p("y"))


def lead_columns(cfg: FeatureConfig) -> list[str]:
    return [
        f"{code}_{name}"
        for code in cfg.lead_codes
        for name in ("ILI_CASE", *(f"ILI_LAG{k}" for k in cfg.lead_lags), "delta_1w")
    ]


def lead_features(facts: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """One row per grid week: value, lags and change of every leading series.

    The order-dependent work runs once per leading series and not once per target series.
    """
    keys = [cfg.code]
    rows = pn.weekly_panel(facts.filter(cfg.is_lead()), cfg.start, cfg.end, keys).drop("year", "week")
    rows = sq.interpolate(rows, "y", keys, fill=0.0)
    names = {k: f"ILI_LAG{k}" for k in cfg.lead_lags}
    rows = sq.first_difference(sq.lags(rows, "y", names, keys), "y", "delta_1w", keys)
    rows = sq.fill_back_then_forward(rows, [*names.values(), "delta_1w"], keys)
    values = [F.first("y").alias("ILI_CASE"), *(F.first(c).alias(c) for c in (*names.values(), "delta_1w"))]
    return rows.groupBy("week_start").pivot(cfg.code, list(cfg.lead_codes)).agg(*values)


def temperature_features(daily: DataFrame, cfg: FeatureConfig, keys: Sequence[str] = ("station",)) -> DataFrame:
    """Weekly mean temperature on the grid with lags; lags are taken before the gaps are filled."""
    weekly = pn.weekly_mean_temperature(daily, keys)
    rows = pn.on_grid(weekly, cfg.start, cfg.end, keys, "tmean_c").drop("year", "week")
    names = {k: f"tmean_lag{k}" for k in cfg.temperature_lags}
    rows = sq.lags(rows, "tmean_c", names, keys)
    return sq.fill_back_then_forward(rows, ["tmean_c", *names.values()], keys)


def calendar_features(panel: DataFrame, cfg: FeatureConfig) -> DataFrame:
    week = F.col("week_start")
    return panel.withColumns(
        {
            "is_covid": cal.in_period(week, cfg.covid),
            "post_covid": cal.after_period(week, cfg.covid),
            "school_in_session": cal.school_in_session(week, cfg.school),
            "weeks_since_school": cal.weeks_since_school(week, cfg.school),
        }
    )


def feature_matrix(
    facts: DataFrame,
    cfg: FeatureConfig,
    lead_facts: DataFrame | None = None,
    weather: DataFrame | None = None,
    series: DataFrame | None = None,
) -> DataFrame:
    """The full matrix, one row per series and grid week.

    Two exchanges carry the target: the weekly sums, then the series for every window. The leading
    frame has one row per grid week and is broadcast. Weather joins on station and week if the panel
    has a ``station`` column; else the configured station, again one row per grid week, serves all.
    """
    out = target(facts, cfg, fill=lead_facts is not None, series=series)
    if lead_facts is not None:
        lead = lead_features(lead_facts, cfg)
        out = out.join(pn.broadcast_if_bounded(lead, cfg.n_weeks), "week_start", "left")
        # A leading series without any fact counts as 0 throughout.
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in lead_columns(cfg)})
    if weather is not None:
        if "station" in out.columns:
            out = out.join(temperature_features(weather, cfg), ["station", "week_start"], "left")
        else:
            if cfg.station == "all":
                only = weather.withColumn("station", F.lit("all"))
            else:
                only = weather.filter(F.col("station") == cfg.station)
                if only.isEmpty():
                    raise ValueError(f"no weather of station {cfg.station!r}")
            by_week = temperature_features(only, cfg).drop("station")
            out = out.join(pn.broadcast_if_bounded(by_week, cfg.n_weeks), "week_start", "left")
    return calendar_features(out, cfg)
