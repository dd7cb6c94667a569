"""One row per series with its history as arrays: the unit that model fits work on.

A packed series has one element per grid week, so its size is bounded by the calendar, not by the
number of facts.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import task_slots


def pack(panel: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "rows") -> DataFrame:
    """Keys plus ``rows``: an array of (week_start, columns…) in time order."""
    row = F.struct("week_start", *columns)
    return panel.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias(name))


def spread(packed: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Spread packed rows over the tasks by key. A handful of series would otherwise be coalesced into
    one task, although each one takes much longer to fit than to read. Placement by key, unlike dealing
    the rows out in turn, is the same when a lost task runs again.

    The hash of the keys stands for the keys: rows already partitioned by the keys themselves would
    make Spark drop this shuffle, and with it the fixed number of parts.
    """
    return packed.repartition(parts or task_slots(packed.sparkSession), F.xxhash64(*keys))


def key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    """DDL of the key columns, for the result schema of a map over packed rows."""
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
