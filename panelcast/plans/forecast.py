"""The whole run: features, seasons, split, baselines, SARIMAX, scores, next season."""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.operators import arima, baselines, evaluate, hmm, project, seasons
from panelcast.operators import panel as pn
from panelcast.operators.holidays import HolidayRules, holiday_table
from panelcast.plans.features import FeatureConfig, feature_matrix
from panelcast.session import stage
from panelcast.sources.weekly_store import weekly_counts
from panelcast.sources.writers import write_features, write_table


@dataclass(frozen=True)
class RunConfig:
    features: FeatureConfig
    split_date: str
    states: hmm.HmmSpec = field(default_factory=hmm.HmmSpec)
    sarimax: arima.SarimaxSpec = field(default_factory=arima.SarimaxSpec)
    holidays: HolidayRules = field(default_factory=HolidayRules)
    bands: tuple[int, ...] = evaluate.BANDS
    n_weeks: int = project.N_WEEKS
    auto_order: bool = False
    # Count the facts that the grid has no place for; without it they are not read where the scan can leave them out.
    count_unused: bool = True

    def __post_init__(self):
        start, cut, end = (cal.as_date(d) for d in (self.features.start, self.split_date, self.features.end))
        if not start < cut < end:
            raise ValueError(f"split_date {cut} must be between {start} and {end}")


def scored_baselines(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long baseline predictions of a split panel with its season flag, if there is one."""
    keep = [*keys, "week_start", *(["is_season"] if "is_season" in panel.columns else [])]
    return baselines.long_predictions(baselines.all_baselines(panel, keys), keep)


def rolling_predictions(panel: DataFrame, rolling: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The walk-forward result in the form of the baseline predictions."""
    flags = panel.filter("part = 'test'").select(*keys, "week_start", "is_season")
    return rolling.join(flags, [*keys, "week_start"]).select(
        *keys, "week_start", "is_season", F.expm1("log_y").alias("y"),
        F.lit(arima.MODEL_NAME).alias("model"), "y_hat",
    )


def weekly_facts(facts: DataFrame, cfg: FeatureConfig, on_grid_only: bool = False) -> DataFrame:
    """Weekly sums of targets and leading series with the number of facts, still in the form of facts. Staged, they let
    targets, leading series and the count of unused facts come from one scan of the raw rows.

    ``on_grid_only`` leaves out what lies outside the grid, at the scan where the week is a stored column."""
    wanted = facts.filter(cfg.is_target() | cfg.is_lead())
    if on_grid_only:
        first, last = cal.grid_bounds(cfg.start, cfg.end)
        wanted = wanted.filter(F.col("week_start").between(F.lit(first), F.lit(last)))
    return stage(weekly_counts(wanted, cfg.keys), "weekly")


def run(
    facts: DataFrame,
    cfg: RunConfig,
    weather: DataFrame | None = None,
    holidays: Sequence[DataFrame] = (),
    lead_facts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All result tables by name.

    Leading series come from the same facts unless ``lead_facts`` names another table. The facts are
    read once, for their weekly sums; matrix and fitted tables are staged, so everything later reads
    weekly rows and parameters, and no model is fitted twice.
    """
    keys, spec = cfg.features.keys, cfg.sarimax
    weekly = weekly_facts(facts, cfg.features, not cfg.count_unused)
    leads = weekly if lead_facts is None else lead_facts
    matrix = stage(feature_matrix(weekly, cfg.features, leads, weather), "features")
    states = stage(hmm.fit_decode(matrix, cfg.states, keys), "hmm")
    labelled = hmm.detect_seasons(matrix, states, keys)
    bounds = (cfg.features.start, cfg.features.end)
    panel = stage(pn.split(labelled, cfg.split_date, bounds=bounds), "panel")
    train = panel.filter("part = 'train'")

    out = {"features": panel, "hmm_quality": hmm.quality(states, keys)}
    # What the engine closed or could not use: gaps before interpolation, facts off the grid, codes without facts.
    raw = pn.weekly_panel(weekly.filter(cfg.features.is_target()), *bounds, keys)
    out["null_audit"] = pn.null_audit(raw, ["y"])
    if cfg.count_unused:
        out["unused_facts"] = pn.off_grid(weekly.filter(cfg.features.is_target()), *bounds, keys, n_facts="n_facts")
    if cfg.features.targets:
        out["missing_codes"] = pn.without_facts(weekly, cfg.features.targets, cfg.features.code)
    orders = None
    if cfg.auto_order:
        orders = stage(arima.auto_order(panel, spec.exog, keys, spec.seasonal[-1]), "orders")
        out["auto_order"] = orders
    models = stage(arima.fit(train, spec, keys, orders=orders), "models")
    rolling = stage(arima.walk_forward(panel, models, spec.exog, keys), "rolling")
    sarimax = rolling_predictions(panel, rolling, keys)
    predictions = stage(scored_baselines(panel, keys).unionByName(sarimax), "predictions")
    stats = seasons.season_stats(panel, keys)
    full_models = stage(arima.fit(panel, spec, keys, orders=orders), "full-models")
    only_sarimax = predictions.filter(F.col("model") == arima.MODEL_NAME)
    out |= {
        "models": models,
        "rolling_forecast": rolling,
        "predictions": predictions,
        "evaluation": evaluate.metric_rows(evaluate.full_evaluation(only_sarimax, keys, cfg.bands), keys),
        "comparison": evaluate.compare_models(predictions, keys),
        "season_stats": stats,
        "season_summary": seasons.cross_season_summary(stats, keys),
        "season_count": seasons.season_count(panel, keys),
    }
    out |= project.next_season(
        panel, full_models, spec.exog, cfg.n_weeks, keys, cfg.features.school, cfg.features.covid
    )
    if holidays:
        out["holidays"] = holiday_table(holidays, *bounds, cfg.holidays)
    return out


# Result tables written as CSV, with their sort order after the keys.
REPORTS = {
    "comparison": ["model"],
    "season_stats": ["season_label"],
    "evaluation": ["section", "metric"],
    "next_season": ["week_start"],
    "next_season_totals": [],
    "next_season_comparison": ["season_label"],
    "season_summary": [],
    "season_count": [],
    "holidays": ["ds", "holiday"],
    "null_audit": ["column"],
    "unused_facts": ["reason"],
    "missing_codes": [],
}


def write_results(results: dict[str, DataFrame], folder: str, keys: Sequence[str]) -> None:
    """Feature matrix as Parquet, reports as CSV, parameters of both models as tables."""
    write_features(results["features"], f"{folder}/weekly_features")
    arima.save_models(results["models"], f"{folder}/models")
    write_table(results["hmm_quality"], f"{folder}/hmm_quality", "parquet")
    for name, order in REPORTS.items():
        if name in results:
            order = [c for c in (*keys, *order) if c in results[name].columns]
            write_table(results[name], f"{folder}/{name}", order_by=order)
