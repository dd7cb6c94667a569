"""Order-dependent operators: lags, differences and the gap-filling rules."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.windows import by_time, last_known, next_known, spec

KEYS = ("series_id",)
# Relative difference up to which two values are the same.
SAME = 1e-9


def lags(
    df: DataFrame, column: str, names: dict[int, str], keys: Sequence[str] = KEYS, order: str = "week_start"
) -> DataFrame:
    """Add one lagged column per ``{lag: name}``."""
    w = by_time(keys, order)
    return df.withColumns({name: F.lag(column, k).over(w) for k, name in names.items()})


def first_difference(
    df: DataFrame, column: str, name: str, keys: Sequence[str] = KEYS, order: str = "week_start"
) -> DataFrame:
    return df.withColumn(name, F.col(column) - F.lag(column).over(by_time(keys, order)))


def next_week_target(
    df: DataFrame, column: str = "log_y", keys: Sequence[str] = KEYS, order: str = "week_start"
) -> DataFrame:
    """Next week's value as ``target``; rows without one are dropped."""
    return df.withColumn("target", F.lead(column).over(by_time(keys, order))).dropna(
        subset=["target"]
    )


def interpolate(
    df: DataFrame,
    column: str,
    keys: Sequence[str] = KEYS,
    order: str = "week_start",
    fill: float | None = None,
) -> DataFrame:
    """Linear by row position. A trailing gap repeats the last value; a leading gap stays NULL or
    takes ``fill``."""
    at = f"CASE WHEN `{column}` IS NOT NULL THEN _i END"
    around = df.selectExpr("*", f"row_number() OVER ({spec(keys, order)}) AS _i").selectExpr(
        "*",
        f"{last_known(f'`{column}`', keys, order)} AS _pv",
        f"{last_known(at, keys, order)} AS _pi",
        f"{next_known(f'`{column}`', keys, order)} AS _nv",
        f"{next_known(at, keys, order)} AS _ni",
    )
    between = "_pv + (_nv - _pv) * ((_i - _pi) / (_ni - _pi))"
    value = f"coalesce(`{column}`, CASE WHEN _nv IS NULL THEN _pv ELSE {between} END)"
    if fill is not None:
        value = f"coalesce({value}, {float(fill)!r}D)"
    return around.withColumn(column, F.expr(value)).drop("_i", "_pv", "_pi", "_nv", "_ni")


def fill_back_then_forward(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, order: str = "week_start"
) -> DataFrame:
    """An inner or leading gap takes the next value, a trailing gap the last one."""
    return df.withColumns(
        {
            c: F.expr(
                f"coalesce(`{c}`, {next_known(f'`{c}`', keys, order)}, {last_known(f'`{c}`', keys, order)})"
            )
            for c in columns
        }
    )


def safe_fill_columns(columns: Sequence[str]) -> list[str]:
    """Columns whose edge gaps may be filled: temperature, leading series, school calendar."""
    # The column names and name fragments that mark a safe column.
    names = ("tmean_c", "school_in_session", "weeks_since_school")
    prefixes, suffixes, fragments = ("tmean_lag",), ("_ILI_CASE", "_delta_1w"), ("_ILI_LAG",)
    return [
        c
        for c in columns
        if c in names
        or c.startswith(prefixes)
        or c.endswith(suffixes)
        or any(f in c for f in fragments)
    ]


def direction(
    column: str | Column, keys: Sequence[str] = KEYS, order: str = "week_start"
) -> Column:
    """Sign of the change from the row before, whatever the values' magnitude. Changes under a billionth
    of the larger value are the noise of a way to logs and back, and count as none."""
    value = F.col(column) if isinstance(column, str) else column
    before = F.lag(value).over(by_time(keys, order))
    change = value - before
    noise = F.greatest(F.abs(value), F.abs(before)) * SAME
    return F.when(F.abs(change) <= noise, 0.0).otherwise(F.signum(change))
