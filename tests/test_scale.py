"""Plan shapes that must hold at any size."""

import re
from pathlib import Path

import pytest

from checks import inputs as inp
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not there")


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, exchanges",
    [("j1_a1_weekly_panel", 2), ("w7_target_fill", 2), ("b5_all_baselines", 2), ("e7_full_evaluation", 2), ("a6_season_stats", 2)],
)
def test_facts_are_scanned_once_and_shuffled_as_partial_sums(spark, name, exchanges):
    text = plan(spark, name)
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == exchanges
    # The innermost exchange carries partial aggregates, not facts.
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_sum" in below
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def test_scan_reads_only_the_used_columns(spark):
    text = plan(spark, "e7_full_evaluation")
    assert re.search(r"ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>", text)


def test_filters_reach_the_scan(spark):
    text = plan(spark, "p1_series_filter")
    assert re.search(r"PushedFilters: \[.*In\(o_orderpriority, \[1-URGENT,5-LOW\]\)", text)


def test_grid_bounds_reach_the_scan(spark):
    """What lies outside the grid is not read where the series are known from elsewhere."""
    bound = r"GreaterThanOrEqual\({0},1995-01-01.*LessThan\({0},2"
    for name, column in (("j1_a1_weekly_panel", "o_orderdate"), ("j1_a1_supplier_panel", "l_shipdate")):
        text = plan(spark, name)
        assert re.search(r"PushedFilters: \[[^\]]*" + bound.format(column), text), name
        assert "partial_sum" in text[text.rindex("Exchange hashpartitioning"):]


def test_stored_weekly_sums_are_pruned_by_year(spark, tmp_path):
    from panelcast.sources import weekly_store

    weekly_store.add_weekly(inp.fine_facts(spark, SF), str(tmp_path / "weeks"))
    rows = weekly_store.read_weekly(spark, str(tmp_path / "weeks"), "1998-01-01", "1999-12-31")
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 1998.*year#\d+ <= 1999", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(week_start,1998-01-04", text)


def test_matrix_reads_the_facts_once(spark):
    """Targets and leading series come from one staged table of weekly sums; the weather reads the line items."""
    text = plan(spark, "j2_leading_series_join")
    assert "orders.parquet" not in text and text.count("FileScan") == 2
    assert plan(spark, "feature_matrix").count("lineitem.parquet") <= 1


@pytest.mark.parametrize("name, sorts", [("w11_season_labels", 3), ("a6_season_stats", 3), ("t4_m12_recent_seasons", 4)])
def test_seasons_are_made_on_blocks(spark, name, sorts):
    text = plan(spark, name)
    assert len(re.findall(r"\bSort \[", text)) <= sorts and "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text


def test_bucketed_matrix_is_fitted_where_it_lies(spark, tmp_path):
    """No exchange between the table and the fit, and the same models as from a matrix that is dealt out."""
    from panelcast.operators import arima, hmm
    from panelcast.sources.writers import write_bucketed

    panel = inp.split_panel(spark, SF)
    table = write_bucketed(panel, "scale_matrix", str(tmp_path / "matrix"), ["series_id"], 4)
    spec = arima.SarimaxSpec((1, 0, 0), (0, 0, 0, 1), ())
    for build in (lambda df, **o: arima.fit(df, spec, **o), lambda df, **o: hmm.fit_decode(df, **o)):
        placed = build(table, placed=True)
        assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
        key = lambda r: r.series_id
        found, want = sorted(placed.collect(), key=key), sorted(build(panel).collect(), key=key)
        assert [r.log_likelihood for r in found] == pytest.approx([r.log_likelihood for r in want]) and len(found) == 5
    spark.sql("DROP TABLE scale_matrix")


def test_dates_of_holidays_are_hashed_before_the_first_exchange(spark):
    text = plan(spark, "t2_one_per_date")
    assert "SortAggregate" not in text[text.rindex("Exchange"):]


def test_no_query_crosses_tables(spark):
    light = [n for n in QUERIES if not re.match(r"(s|m|st)\d|full_run", n)]
    for name in light:
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name)), name


def test_leading_frame_is_broadcast_by_its_row_bound(spark):
    from panelcast.operators.panel import broadcast_if_bounded

    small, large = (broadcast_if_bounded(inp.panel(spark, SF), n) for n in (344, 10**9))
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()


def test_fits_are_not_coalesced_into_one_task(spark):
    from panelcast.operators.packing import pack, spread

    packed = spread(pack(inp.fine_panel(spark, SF), ["series_id"], ["y"]), ["series_id"])
    sizes = packed.rdd.glom().map(len).collect()
    assert len(sizes) >= 4 and sum(sizes) == 15 and max(sizes) < 10
