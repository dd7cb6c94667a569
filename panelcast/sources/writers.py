"""Result tables on disk."""

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Feature matrix as Parquet. A partitioned write first brings each key's rows together, so a
    key gets one file rather than one per task."""
    if partition_by:
        df.repartition(*partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, order: str = "week_start"
) -> DataFrame:
    """Feature matrix as a table of ``buckets`` parts by key, each sorted by key and ``order``; the table read back.

    For many series: a folder per key does not carry tens of thousands of them. What groups or joins the table by its
    keys reads every part in a task of its own, without an exchange. ``path`` is a folder that all executors reach.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys, order).saveAsTable(table)
    return df.sparkSession.table(table)


def write_table(df: DataFrame, path: str, fmt: str = "csv", order_by: Sequence[str] = ()) -> None:
    """Result table as CSV with header or as Parquet, sorted at the sink when asked."""
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)
