import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast.operators import sequence as sq

GAPS = [None, 1, None, 3, None]


def test_interpolate_edges(weekly, values):
    assert values(sq.interpolate(weekly(a=GAPS), "y"), "y") == [None, 1, 2, 3, 3]
    assert values(sq.interpolate(weekly(a=GAPS), "y", fill=0.0), "y") == [0, 1, 2, 3, 3]
    assert values(sq.interpolate(weekly(a=[None, None]), "y"), "y") == [None, None]


def test_back_then_forward(weekly, values):
    assert values(sq.fill_back_then_forward(weekly(a=GAPS), ["y"]), "y") == [1, 1, 3, 3, 3]


def test_lags_are_taken_before_the_fill(weekly, values):
    rows = sq.fill_back_then_forward(sq.lags(weekly(a=GAPS), "y", {1: "lag1"}), ["y", "lag1"])
    assert values(rows, "lag1") == [1, 1, 1, 3, 3]
    assert values(rows, "y") == [1, 1, 3, 3, 3]


def test_difference_target_direction(weekly, values):
    panel = weekly(a=[1, 4, 4, 2])
    assert values(sq.first_difference(panel, "y", "d"), "d") == [None, 3, 0, -2]
    assert values(sq.next_week_target(panel, "y"), "target") == [4, 4, 2]
    assert values(panel.withColumn("s", sq.direction("y")), "s") == [None, 1, 0, -1]


def test_series_do_not_touch(weekly, values):
    rows = sq.interpolate(weekly(a=[1, None], b=[None, 9]), "y")
    assert values(rows, "y", "a") == [1, 1]
    assert values(rows, "y", "b") == [None, 9]


def test_safe_columns():
    columns = ["y", "tmean_c", "tmean_lag2", "AUS_ILI_CASE", "AUS_ILI_LAG1", "AUS_delta_1w", "is_covid", "school_in_session"]
    assert sq.safe_fill_columns(columns) == [c for c in columns if c not in ("y", "is_covid")]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=12), min_size=1, max_size=6
    )
)
def test_fills_equal_pandas(weekly, values, panels):
    series = {f"s{i}": v for i, v in enumerate(panels)}
    panel = weekly(**series)
    straight = sq.interpolate(panel, "y")
    filled = sq.fill_back_then_forward(panel, ["y"])
    for name, v in series.items():
        s = pd.Series(v, dtype=float)
        for got, want in ((straight, s.interpolate("linear")), (filled, s.bfill().ffill())):
            mine = [np.nan if x is None else x for x in values(got, "y", name)]
            assert mine == pytest.approx(want.tolist(), nan_ok=True)
