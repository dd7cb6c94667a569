"""Mixing sources to target weights: packed blocks, drawn slots, permuted indexes."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import n_words, row_hash
from panelcast.session import stage

BLOCK_WORDS, OUTPUT_SHARDS, MOST, CHUNK_ROWS, MOST_CHUNKS, SLOT_RANGE = 512, 16, 3, 1_000, 4_096, 4_096


def source_targets(sizes: DataFrame, cycle: tuple = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows; the targets add up to all sizes.

    Sources in code point order, null last, weigh ``cycle`` over and over. Targets stop at ``most`` times
    the source's size and the excess goes to the open sources by weight. With sources sorted by cap per
    weight the capped ones come first, so the level of the others follows from two running sums. One row
    per source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in cycle)), (rank % len(cycle) + 1).cast("int"))
    by = by.withColumn("__w", weight).withColumn("__cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__w").over(after)
    by = by.withColumn("__level", level).withColumn("__open", F.col("__cap") > F.col("__level") * F.col("__w"))
    common = F.max(F.when(F.col("__open"), F.col("__level"))).over(whole)
    target = F.when(F.col("__open"), common * F.col("__w")).otherwise(F.col("__cap"))
    return by.select("source", "source_size", target.alias("target"))


def _spread_counts(shards: int, seed: int):
    """Each source's slots over the output shards: one multinomial draw, so every total holds."""

    def draw(batches):
        for pdf in batches:
            counts = [
                np.random.default_rng([seed, int(h) & (2**63 - 1)]).multinomial(int(k), np.full(shards, 1 / shards))
                for h, k in zip(pdf["__seed"], pdf["__slots"])
            ]
            out = pdf.loc[pdf.index.repeat(shards)].reset_index(drop=True)
            out["shard"] = np.tile(np.arange(shards, dtype="int32"), len(pdf))
            out["__count"] = np.concatenate(counts).astype("int64") if counts else np.zeros(0, "int64")
            yield out

    return draw


def permuted(position: Column, size: Column, key: Column) -> Column:
    """A pseudorandom permutation of ``0 .. size-1`` per key: a Feistel network, walked until inside."""

    @F.pandas_udf("long")
    def walk(position: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        x, n, k = (s.to_numpy(dtype="int64").astype("uint64") for s in (position, size, key))
        half = np.zeros(len(x), "uint64")
        while (short := (np.uint64(1) << (half + half)) < n).any():
            half[short] += np.uint64(1)
        mask, out, todo = (np.uint64(1) << half) - np.uint64(1), x.copy(), np.arange(len(x))
        while len(todo):
            value, h, m, salt = out[todo], half[todo], mask[todo], k[todo]
            left, right = value >> h, value & m
            for turn in range(1, 5):
                mixed = (right + salt + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= n[todo]]
        return pd.Series(out.astype("int64"))

    return walk(position, size, key)


def slots(targets: DataFrame, block_words: int, shards: int, seed: int) -> DataFrame:
    """``(source, block, shard, slot, epoch, __take)``: the slots of every output shard and the block each one shows.

    A source passes whole over its blocks (full ones in an order permuted anew for each pass, then the
    short last one) until its target is reached; the last slot takes only what is missing.
    """
    words, quota = F.col("source_size"), F.col("__quota")
    drawn = (
        targets.filter("source_size > 0")
        .withColumn("__quota", F.round("target").cast("long"))
        .withColumn("__full", F.floor(words / block_words).cast("long"))
        .withColumn("__tail", words % block_words)
        .withColumn("__blocks", F.col("__full") + (F.col("__tail") > 0).cast("long"))
        .withColumn("__passes", F.floor(quota / words).cast("long"))
        .withColumn("__rest", quota % words)
        .withColumn("__slots", F.col("__passes") * F.col("__blocks") + F.least(F.col("__blocks"), F.ceil(F.col("__rest") / block_words)))
        .withColumn("__seed", F.xxhash64(F.lit(seed), "source"))
    )
    counted = drawn.mapInPandas(
        _spread_counts(shards, seed), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in drawn.schema) + ", shard int, __count long"
    )
    ends = F.sum("__count").over(Window.partitionBy("__seed").orderBy("shard"))
    # Ranges first: they are dealt out before their slots are made, so no task makes all slots of a large source. The
    # number of parts is fixed, since a range is small until its slots are made.
    parts = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = (
        counted.withColumns({"__from": ends - F.col("__count"), "__upto": ends})
        .filter("__count > 0")
        .withColumn("__range", F.explode(F.sequence(F.col("__from"), F.col("__upto") - 1, F.lit(SLOT_RANGE).cast("long"))))
        .repartition(parts, F.xxhash64("__seed", "__range"))
    )
    last = F.least(F.col("__upto"), F.col("__range") + SLOT_RANGE) - 1
    each = (
        ranges.withColumn("slot", F.explode(F.sequence(F.col("__range"), last)))
        .withColumn("epoch", F.floor(F.col("slot") / F.col("__blocks")).cast("int"))
        .withColumn("__at", F.col("slot") % F.col("__blocks"))
    )
    inside = F.col("__at") < F.col("__full")
    whole = F.when(inside, F.lit(block_words)).otherwise(F.col("__tail"))
    left = F.when(F.col("epoch") < F.col("__passes"), whole).otherwise(F.col("__rest") - F.col("__at") * block_words)
    # The short last block stays last; its slots still pass the function, with a position inside.
    index = permuted(F.when(inside, F.col("__at")).otherwise(0), F.greatest("__full", F.lit(1)), F.xxhash64("__seed", "epoch"))
    return each.select(
        "source",
        F.when(inside, index).otherwise(F.col("__full")).alias("block"),
        "shard", "slot", "epoch",
        F.least(whole, left).cast("long").alias("__take"),
    )


def blocks(sized: DataFrame, block_words: int, chunks: int, tie: str | None = None) -> DataFrame:
    """The rows of ``sized`` cut into the fixed-length blocks of their source.

    Adds ``block``, ``__first`` and ``__upto`` (the row's words in this block) and ``__at`` (where they
    start within it). A source's stream follows a hash of the rows, in ``chunks`` pieces with known
    totals, so a source with a third of all rows is as many window partitions as others are. The column ``tie``
    is no part of the hash: it orders equal rows and nothing else.
    """
    hashed = row_hash(sized.drop(tie) if tie else sized)
    rows = sized.filter("size > 0").withColumn("__order", hashed).withColumn("__chunk", F.pmod(F.xxhash64("__order"), F.lit(chunks)))
    totals = rows.groupBy("source", "__chunk").agg(F.sum("size").alias("__words"))
    running = Window.partitionBy("source").orderBy("__chunk")
    totals = totals.select(F.col("source").alias("__source"), F.col("__chunk").alias("__piece"), (F.sum("__words").over(running) - F.col("__words")).alias("__start"))
    inside = Window.partitionBy("source", "__chunk").orderBy("__order", *([tie] if tie else [])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__end", F.sum("size").over(inside))
    rows = rows.join(totals, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__chunk") == F.col("__piece")))
    start = F.col("__start") + F.col("__end") - F.col("size")
    cut = rows.withColumn("__offset", start).withColumn(
        "block", F.explode(F.sequence(F.floor(start / block_words), F.floor((start + F.col("size") - 1) / block_words)))
    )
    first = F.greatest(F.lit(0), F.col("block") * block_words - F.col("__offset"))
    return (
        cut.withColumn("__first", first.cast("long"))
        .withColumn("__upto", F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("__offset")).cast("long"))
        .withColumn("__at", F.greatest(F.lit(0), F.col("__offset") - F.col("block") * block_words).cast("long"))
        .drop("__order", "__chunk", "__end", "__source", "__piece", "__start", "__offset")
    )


def mix_spans(
    sized: DataFrame,
    block_words: int = BLOCK_WORDS,
    shards: int = OUTPUT_SHARDS,
    seed: int = 0,
    chunk_rows: int = CHUNK_ROWS,
    tie: str | None = None,
) -> DataFrame:
    """The mixture as spans: rows of ``sized`` (``source``, ``size`` and any others) with ``shard``,
    ``slot``, ``epoch``, ``block``, ``first_word`` and ``n_taken``.

    A source's words form one stream of blocks; its slots, spread over the output shards by a multinomial
    draw, show the blocks through a pseudorandom permutation; slots and blocks join by source and index,
    which no large source can make uneven. A row is taken once per pass, so never more often than its
    source's cap, and a source's words taken equal its target rounded. Rows without words take no part;
    a null source is a source. Everything follows from seeds and hashes of the rows: reruns agree, however the rows
    lie. A column that numbers rows as they lie is named by ``tie``; it decides between equal rows alone.
    """
    sized = sized.drop("shard", "slot", "epoch", "block", "first_word", "n_taken")
    n = sized.count()
    cut = blocks(sized, block_words, min(MOST_CHUNKS, 1 + n // chunk_rows), tie)
    shown = slots(source_targets(sized.select("source", "size")), block_words, shards, seed).select(
        F.col("source").alias("__source"), F.col("block").alias("__block"), "shard", "slot", "epoch", "__take"
    )
    taken = F.least(F.col("__upto"), F.col("__first") + F.col("__take") - F.col("__at")) - F.col("__first")
    # Slots are few to the optimizer and many in truth, so the join is told to move both sides.
    return (
        cut.join(shown.hint("merge"), F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block")))
        .withColumn("n_taken", taken)
        .filter("n_taken > 0")
        .withColumnRenamed("__first", "first_word")
        .drop("__source", "__block", "__upto", "__at", "__take")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mixture takes them: a row per span with its own text, and ``shard`` and ``slot``.

    The text of a span keeps the white space after its words, so the spans of one pass over a document
    put together give the document (but for white space before its first word). ``n_chars``, where
    there, is counted anew; all other columns are the document's. Texts without words (null, empty) take
    no part; an empty table gives no rows. Input columns named like an added one are replaced.
    """
    added = ("size", "shard", "slot", "epoch", "block", "first_word", "n_taken")
    own = [c for c in docs.columns if c not in added]
    rows = docs.select(*own)
    rows = rows.withColumns({"__h1": row_hash(rows, 1), "__h2": row_hash(rows, 2)})
    key = ["__h1", "__h2"]
    # Spans are drawn on rows without texts; then each text moves once, to the list of its own spans.
    sized = stage(rows.select("source", *key, n_words(F.col("text")).alias("size")).filter("size > 0"), "mix-sizes")
    span = F.struct("shard", "slot", "first_word", "n_taken")
    spans = mix_spans(sized, **options).groupBy(*key).agg(F.collect_list(span).alias("__spans"))
    if not sized.groupBy(*key).count().filter("count > 1").isEmpty():
        # Equal rows have their spans in one list, so one of them is enough.
        rows = rows.withColumn("__copy", F.row_number().over(Window.partitionBy(*key).orderBy("__h1"))).filter("__copy = 1")
    pieces = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))

    def cut(words: Column) -> Column:
        def one(s: Column) -> Column:
            text = F.array_join(F.slice(words, (s["first_word"] + 1).cast("int"), s["n_taken"].cast("int")), "")
            return F.struct(*(s[c].alias(c) for c in ("shard", "slot", "first_word", "n_taken")), text.alias("text"))

        return F.transform("__spans", one)

    # The words are the argument of an outer transform, so a text is taken apart once, not once a span.
    cut = F.get(F.transform(F.array(pieces), cut), F.lit(0))
    joined = rows.join(spans.hint("merge"), key)
    each = joined.select(*(c for c in own if c != "text"), F.explode(cut).alias("__span"))
    each = each.withColumn("text", F.col("__span.text"))
    if "n_chars" in own:
        each = each.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return each.select(*own, *(F.col(f"__span.{c}").alias(c) for c in ("shard", "slot", "first_word", "n_taken")))
