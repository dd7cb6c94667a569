"""Ordered-window building blocks shared by the sequence operators.

Every helper uses the same partition and order, so Spark runs them in one exchange and one sort.
The next known value is read with an offset function rather than a frame that reaches to the end of
the partition: the latter is quadratic in the series length.
"""

from collections.abc import Sequence

from pyspark.sql import Window


def by_time(keys: Sequence[str], order: str = "week_start"):
    return Window.partitionBy(*keys).orderBy(order)


def so_far(keys: Sequence[str], order: str = "week_start"):
    return by_time(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(keys: Sequence[str]):
    return Window.partitionBy(*keys)


def spec(keys: Sequence[str], order: str = "week_start") -> str:
    """Partition and order as SQL text."""
    partition = ", ".join(f"`{k}`" for k in keys)
    return f"PARTITION BY {partition} ORDER BY `{order}`"


def last_known(value: str, keys: Sequence[str], order: str = "week_start") -> str:
    """SQL for the current value, or the closest non-null one before it."""
    return (
        f"last({value}) IGNORE NULLS OVER "
        f"({spec(keys, order)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


def next_known(value: str, keys: Sequence[str], order: str = "week_start") -> str:
    """SQL for the closest non-null value strictly after the current row."""
    return f"lead({value}) IGNORE NULLS OVER ({spec(keys, order)})"
