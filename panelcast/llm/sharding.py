"""Contiguous shards of nearly equal bytes, cut on a global prefix sum."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import row_hash

BLOCKS, SPREAD = 256, 64


def byte_size(text: Column) -> Column:
    """UTF-8 bytes (null: none) and eight of framing."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def byte_shards(
    docs: DataFrame, shards: int, text: str = "text", key: str = "doc_id", blocks: int = BLOCKS, spread: int = SPREAD
) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Rows lie in one global order: block of the text's hash, part of the key's hash, text hash, key. Each
    (block, part) is a partition with a known total of bytes and rows; the running sum of these totals
    plus the running sum within the partition is a row's offset, and the shard is the one in whose equal
    share of all bytes the middle of the row falls. Shards are therefore contiguous in the order and
    differ by one row's size at most. Equal texts share a block, and lie together unless a cut or their
    number spreads them; a group with a third of all rows still falls into ``spread`` partitions. The
    totals are ``blocks * spread`` rows at most, whatever the input, and so may be broadcast.

    Nulls: a null text is 8 bytes with crc32 0; null keys are ordinary keys. Rows alike in all columns are
    interchangeable. An empty table gives no rows. Columns of the input named like an added one are
    replaced. A row longer than a share makes its shard as long as itself; nothing is split.
    """
    bytes_of = F.col(text)
    rows = (
        docs.withColumn("__tie", row_hash(docs))
        .withColumn("__hash", F.xxhash64(bytes_of))
        .withColumn(
            "__part",
            F.shiftrightunsigned("__hash", 32) % F.lit(blocks) * spread
            + F.pmod(F.xxhash64(F.col(key)), F.lit(spread)),
        )
        .withColumn("size", byte_size(bytes_of))
        .withColumn("text_crc32", F.crc32(F.coalesce(bytes_of, F.lit(""))))
    )
    totals = rows.groupBy("__part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("__part"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("__all"),
    )
    inside = Window.partitionBy("__part").orderBy("__hash", F.col(key), "__tie")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = 2 * (F.col("__bytes_before") + F.col("__end")) - F.col("size")
    placed = (
        rows.withColumn("__end", F.sum("size").over(upto))
        .withColumn("__row", F.row_number().over(inside))
        .join(F.broadcast(starts), "__part")
        .withColumn("shard", F.floor(middle * F.lit(float(shards)) / (2 * F.col("__all"))).cast("int"))
        .withColumn("shard", F.least(F.col("shard"), F.lit(shards - 1)))
        .withColumn("__row", F.col("__rows_before") + F.col("__row"))
    )
    firsts = placed.groupBy("shard").agg(F.min("__row").alias("__first"))
    kept = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    return placed.join(F.broadcast(firsts), "shard").select(
        *kept, "size", "text_crc32", "shard", (F.col("__row") - F.col("__first")).cast("long").alias("slot")
    )
