from datetime import date
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelcast.operators import arima
from panelcast.operators import panel as pn
from panelcast.plans.features import FeatureConfig, feature_matrix
from panelcast.plans.forecast import RunConfig, run, write_results
from panelcast.session import new_path, shared_folder
from panelcast.sources import readers

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def cells(rows, columns, order):
    def cell(v):
        return None if v is None else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted((tuple(cell(r[columns.index(c)]) for c in order) for r in rows), key=repr)


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not there")
@pytest.mark.parametrize(
    "name", ["j1_a1_weekly_panel", "w6_back_then_forward_fill", "w4_interpolate", "w7_target_fill", "e7_full_evaluation",
             "w11_season_labels", "feature_matrix", "m8_walk_forward_given", "b2_j5_seasonal_naive"],
)
def test_query_equals_oracle_on_the_sparse_tables(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    assert cells(df.collect(), df.columns, sorted(names)) == cells(want.fetchall(), names, sorted(names))


def test_config_dates():
    with pytest.raises(ValueError, match="start_date.*must be before"):
        FeatureConfig("2025-01-01", "2020-01-01")
    with pytest.raises(ValueError, match="split_date.*between"):
        RunConfig(FeatureConfig("2020-01-01", "2025-01-01"), "2026-01-01")


@pytest.fixture
def folder(tmp_path):
    def write(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.write_text(text, encoding=encoding)
        return str(path)

    return write


def test_read_facts(spark, folder):
    path = folder("facts.csv", "X,ILI_CASE,COUNTRY_CODE,MMWR_WEEKSTARTDATE\n1,5,AAA,2024-01-07\n2,x,AAA,2024-01-07\n3,2,BBB,bad\n")
    facts = readers.read_facts(spark, path)
    got = [tuple(r) for r in pn.weekly_sum(facts).collect()]
    assert got == [("AAA", date(2024, 1, 7), 5.0)]
    assert readers.for_series(facts, ["BBB"]).count() == 1
    assert readers.for_series(facts, ["ZZZ"]).isEmpty()


def test_read_weather_finds_its_columns(spark, folder):
    english = readers.read_weather(spark, folder("w.csv", "Station,Obs Date,Max Temp,Min Temp\nx,07/01/2024,20,10\nx,bad,1,1\n"))
    assert [tuple(r) for r in english.collect()] == [("x", date(2024, 1, 7), 20.0, 10.0), ("x", None, 1.0, 1.0)]
    named = readers.read_weather(spark, folder("o.csv", "Station,Obs Date,Max Temp,Min Temp\nx,07/01/2024,20,10\n"), station="all")
    assert named.first().station == "all"
    hebrew = readers.read_weather(spark, folder("h.csv", "תאריך,טמפרטורה עליונה,טמפרטורה תחתונה\n13/01/2024,20,-\n"))
    assert [tuple(r) for r in hebrew.collect()] == [("all", date(2024, 1, 13), 20.0, None)]
    with pytest.raises(ValueError, match="no date column"):
        readers.read_weather(spark, folder("n.csv", "a,max,min\n1,2,3\n"))
    with pytest.raises(ValueError, match="temperature columns"):
        readers.read_weather(spark, folder("m.csv", "date,max\n1,2\n"))


def test_read_holidays_with_byte_order_mark(spark, folder):
    rows = readers.read_holidays(spark, folder("h.csv", "date,eng_name\n9/30/2008,Purim\n3/2/2020,Election Day\n", "utf-8-sig"))
    assert [(r["ds"], r["name"]) for r in rows.orderBy("seq").collect()] == [
        (date(2008, 9, 30), "Purim"), (date(2020, 3, 2), "Election Day")]


def synthetic(spark):
    """Eight years of two seasonal series and one leading series half a year ahead."""
    days = spark.range(0, 8 * 366).select(F.expr("date_add(date'2012-01-01', cast(id as int))").alias("date"))
    season = 0.5 + F.cos(F.dayofyear("date") / 365.25 * 6.283185) / 2
    noise = F.hash("date", F.lit(1)) % 1000 / 10000.0
    weather = days.select(
        F.lit("all").alias("station"), "date", (30 - 15 * season + noise * 20).alias("tmax"), (18 - 12 * season).alias("tmin"))
    weekly = days.filter(F.dayofweek("date") == 1)
    level = F.exp(3 + 4 * season + noise)
    facts = weekly.select(F.lit("ISR").alias("series_id"), F.col("date").alias("week_start"), level.alias("value")).unionByName(
        weekly.select(F.lit("XYZ"), F.col("date"), (level * 2).alias("value")).toDF("series_id", "week_start", "value"))
    lead = weekly.select(F.lit("AUS").alias("series_id"), F.col("date").alias("week_start"), F.exp(7 - 4 * season).alias("value"))
    return facts, lead, weather


def test_whole_run(spark):
    facts, lead, weather = synthetic(spark)
    features = FeatureConfig("2012-01-01", "2019-12-29", targets=("ISR", "XYZ"))
    cfg = RunConfig(features, "2018-06-01", n_weeks=35)
    holidays = spark.createDataFrame([(date(2015, 3, 5), "Purim")], "ds date, name string")
    results = run(facts.unionByName(lead), cfg, weather, [holidays])
    matrix = results["features"]
    assert matrix.count() == 2 * 418
    assert matrix.select(*arima.REGRESSORS, "y", "log_y").dropna().count() == 2 * 418
    comparison = {(r["series_id"], r["model"]): r for r in results["comparison"].collect()}
    assert len(comparison) == 10
    assert comparison[("ISR", "SARIMAX (rolling)")]["r2"] > 0.95
    sections = {r["section"] for r in results["evaluation"].collect()}
    assert sections == {"overall", "in_season", "off_season"}
    counts = {r["series_id"]: r["n_seasons"] for r in results["season_count"].collect()}
    assert counts["ISR"] >= 7
    assert results["next_season"].groupBy("series_id").count().filter("count <> 35").count() == 0
    peaks = [r["peak_date"] for r in results["next_season_totals"].collect()]
    assert all(p.month in (12, 1, 2) for p in peaks)
    assert results["holidays"].count() == 1
    out = new_path(spark, "results")
    write_results(results, out, cfg.features.keys)
    assert spark.read.parquet(f"{out}/weekly_features").count() == 2 * 418
    assert spark.read.csv(f"{out}/comparison", header=True).count() == 10
    for name in ("season_summary", "season_count", "next_season_totals", "holidays", "null_audit"):
        assert spark.read.csv(f"{out}/{name}", header=True).count() == results[name].count() > 0
    assert spark.read.parquet(f"{out}/hmm_quality").count() == 2
    assert results["missing_codes"].isEmpty() and results["unused_facts"].filter("reason <> 'outside the grid'").isEmpty()


def test_a_leading_series_without_facts_counts_as_zero(spark):
    facts, lead, weather = synthetic(spark)
    cfg = FeatureConfig("2012-01-01", "2012-06-30", lead_codes=("AUS", "NZL"))
    rows = feature_matrix(facts, cfg, lead, weather)
    assert {"AUS_ILI_LAG1", "NZL_ILI_LAG1", "NZL_delta_1w"} <= set(rows.columns)
    assert rows.agg(F.max("NZL_ILI_CASE"), F.count("NZL_ILI_LAG1")).first()[0] == 0


def test_shared_folder(spark):
    assert shared_folder(spark) == shared_folder(spark)

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
    Cluster.conf.get = staticmethod(lambda key, default: {"spark.checkpoint.dir": "hdfs:///shared"}[key])
    assert shared_folder(Cluster) == "hdfs:///shared"


def test_a_panel_with_two_keys(spark):
    facts, lead, weather = synthetic(spark)
    lead = lead.withColumnRenamed("series_id", "country")
    keyed = facts.select(
        F.col("series_id").alias("country"), F.explode(F.array(F.lit(1), F.lit(2))).alias("age"), "week_start", "value")
    features = FeatureConfig("2014-01-05", "2019-12-29", keys=("country", "age"), code="country")
    cfg = RunConfig(features, "2018-12-30", sarimax=arima.SarimaxSpec((1, 0, 0), (0, 1, 0, 52)), n_weeks=4)
    results = run(keyed, cfg, weather, lead_facts=lead)
    assert results["comparison"].select("country", "age").distinct().count() == 4
    assert results["next_season"].count() == 16
    assert results["models"].filter("message IS NULL").count() == 4


def test_staged_tables_can_be_cleared(spark):
    from panelcast import session

    known, session._staged[:] = list(session._staged), []
    try:
        copies = [session.stage(spark.range(5), "clear-me") for _ in range(2)]
        paths = [c.inputFiles()[0] for c in copies]
        assert session.clear_staged(spark) == 2 and not session._staged
        assert not any(Path(p.removeprefix("file:")).exists() for p in paths) and session.clear_staged(spark) == 0
    finally:
        session._staged[:] = known
