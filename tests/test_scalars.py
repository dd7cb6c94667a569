from datetime import date

import pytest
from pyspark.sql import functions as F

from panelcast.functions import scalars as sc


def column(spark, values, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(expr(F.col("x"))).collect()]


def test_lenient_double(spark):
    got = column(
        spark, ["1e3", " 7 ", "1d", "2f", "inf", "-Infinity", "NaN", "", "1,000", "abc", None, "-.5", "+2."], sc.lenient_double
    )
    inf = float("inf")
    assert got == [1000.0, 7.0, None, None, inf, -inf, None, None, None, None, None, -0.5, 2.0]


def test_lenient_date_takes_the_first_format_that_parses(spark):
    got = column(
        spark, ["3/4/2020", "2020-04-03", "31/12/2020", "x", None],
        lambda c: sc.lenient_date(c, ("d/M/yyyy", "yyyy-MM-dd")),
    )
    assert got == [date(2020, 4, 3), date(2020, 4, 3), date(2020, 12, 31), None, None]


def test_log_round_trip(spark):
    values = [0.0, 10.0, 100.0, 1000.0, 12000.0]
    logs = column(spark, values, F.log1p, "double")
    assert logs == sorted(logs)
    assert column(spark, logs, sc.from_log, "double") == pytest.approx(values, rel=1e-10)


def test_clip_keeps_null(spark):
    assert column(spark, [-1.0, None, 2.0], sc.floor_at_zero, "double") == [0.0, None, 2.0]


def test_clean_name_and_nan(spark):
    assert column(spark, ["  Rosh Hashana "], sc.clean_name) == ["rosh hashana"]
    assert column(spark, [float("nan"), 1.0], sc.nan_to_null, "double") == [None, 1.0]
