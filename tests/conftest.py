import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def weekly(spark):
    """Panel of one or more series from lists of values, one Sunday after the other."""

    def build(start="2024-01-07", name="y", **series):
        first = date.fromisoformat(start)
        rows = [
            (key, first + timedelta(days=7 * i), None if v is None else float(v))
            for key, values in series.items()
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, f"series_id string, week_start date, {name} double")

    return build


@pytest.fixture
def values():
    """A column's values in week order, per series or of the only one."""

    def read(df, column, series=None):
        rows = df.filter(df.series_id == series) if series else df
        return [r[column] for r in rows.orderBy("week_start").collect()]

    return read
