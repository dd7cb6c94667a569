"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact similarity."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import words
from panelcast.session import stage

SHINGLE, BLOCKS, BLOCK_BITS, BLOCK_ERRORS = 5, 8, 8, 2
RADIUS = BLOCKS * (BLOCK_ERRORS + 1) - 1
FEW_SHINGLES, FEW_DOCUMENTS = 1_000_000, 100_000


def shingles(tokens: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words of the array column ``tokens``, in order."""
    hashed = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - size + 1),
        lambda i: F.xxhash64(*(F.element_at(F.col(tokens), i + k) for k in range(size))),
    )
    return F.when(F.size(tokens) >= size, hashed).otherwise(F.array().cast("array<long>"))


def simhash(hashes: Column) -> Column:
    """64-bit fingerprint: each bit is the majority of that bit over the hashes, each as often as it occurs."""

    def bit(i: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("shiftrightunsigned", h, i).bitwiseAND(F.lit(1)).cast("int"))
        return F.call_function("shiftleft", F.when(2 * ones > F.size(hashes), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")), i)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda whole, i: whole.bitwiseOR(bit(i)))


def block(fingerprint: str, i: Column) -> Column:
    return F.call_function("shiftrightunsigned", F.col(fingerprint), i * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1)).cast("int")


def shared(left: str, right: str) -> Column:
    """Shingles in common, each as often as it occurs in both."""

    def times(array: str, h: Column) -> Column:
        return F.size(F.filter(F.col(array), lambda x: x == h))

    return F.aggregate(F.array_intersect(left, right), F.lit(0), lambda n, h: n + F.least(times(left, h), times(right, h)))


def contaminated(
    docs: DataFrame, items: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id", item_key: str = "item_id"
) -> DataFrame:
    """``(doc_id, text_hash, item_id, start, n_words, similarity)``: the best window of a document per item.

    A window is as long as the item (or the whole text, if shorter). The similarity is that of the two
    multisets of five-word shingles, lower-cased: the sum of the smaller counts over the sum of the larger.

    1. A similar window shares shingles with its item, so windows start where a shared shingle puts the
       item's beginning; all other windows have similarity 0 by this alignment. One pass over whole texts
       finds the shared shingles; only their places are kept.
    2. Windows and items get a SimHash fingerprint. Of eight blocks of eight bits, one differs in at most
       two bits whenever two fingerprints differ in at most 23: items enter the index under every value
       within two bits of each block, so the lookup finds every item within the radius. At similarity 0.8
       fingerprints differ in about 10 bits, with a standard deviation of 3.
    3. The candidates' shingles are compared exactly.

    Items are broadcast only while their shingles are under ``FEW_SHINGLES``, candidate documents only
    under ``FEW_DOCUMENTS``; beyond, the same joins shuffle.

    An item of fewer than five words is one shingle of all its words. Items and texts without words, null
    ones included, match nothing. Rows with equal id and text are one document; a null id is an id.
    Several items, or one item several times, may match a document: one row for each item. Empty tables
    give no rows.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_key).alias("item_id"), words(F.lower(F.col(text))).alias("item_words")).filter("size(item_words) > 0")
    items = items.withColumn("m", F.size("item_words")).withColumn("size", F.least("m", F.lit(SHINGLE)))
    sizes = [r[0] for r in items.select("size").distinct().collect()]
    if not sizes:
        return spark.createDataFrame([], f"doc_id {docs.schema[key].dataType.simpleString()}, text_hash long, item_id {items.schema['item_id'].dataType.simpleString()}, start int, n_words int, similarity double")
    of_size = {s: items.filter(F.col("size") == s).withColumn("item_hashes", shingles("item_words", s)) for s in sizes}
    items = of_size[sizes[0]]
    for s in sizes[1:]:
        items = items.unionByName(of_size[s])
    items = stage(items.select("item_id", "m", "size", "item_hashes", simhash(F.col("item_hashes")).alias("item_print")), "items")

    base = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), words(F.lower(F.col(text))).alias("tokens"))
    anchors = items.select("m", "size", F.posexplode("item_hashes").alias("offset", "hash")).distinct()
    few = anchors.count() <= FEW_SHINGLES
    starts = None
    for s in sizes:
        own = anchors.filter(F.col("size") == s).select("m", "offset", "hash")
        placed = base.select("doc_id", "text_hash", F.size("tokens").alias("n"), F.posexplode(shingles("tokens", s)).alias("at", "hash"))
        met = placed.join(F.broadcast(own) if few else own, "hash")
        start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("n") - F.col("m")))
        found = met.select("doc_id", "text_hash", "m", F.lit(s).alias("size"), start.alias("start"))
        starts = found if starts is None else starts.unionByName(found)
    wanted = stage(starts.distinct().groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("size", "m", "start")).alias("w")), "windows")
    wanted = wanted.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "w")
    if wanted.count() <= FEW_DOCUMENTS:
        wanted = F.broadcast(wanted)
    again = base.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))

    windows = None
    for s in sizes:
        own = again.select("doc_id", "text_hash", "tokens", F.filter("w", lambda x: x["size"] == s).alias("w")).filter("size(w) > 0")
        own = own.withColumn("hashes", shingles("tokens", s)).select("doc_id", "text_hash", "hashes", F.explode("w").alias("w"))
        n = F.greatest(F.lit(1), F.col("w.m") - s + 1)
        cut = own.select("doc_id", "text_hash", "w.m", "w.start", F.slice("hashes", F.col("w.start") + 1, n).alias("hashes"))
        windows = cut if windows is None else windows.unionByName(cut)
    windows = stage(windows.distinct().withColumn("print", simhash(F.col("hashes"))).withColumn("window", F.monotonically_increasing_id()), "windows")

    numbers = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    near = F.filter(
        F.sequence(F.lit(0), F.lit(2**BLOCK_BITS - 1)),
        lambda v: F.bit_count(v.bitwiseXOR(F.col("value"))) <= BLOCK_ERRORS,
    )
    index = items.select("item_id", "m", "item_print", numbers.alias("i")).withColumn("value", block("item_print", F.col("i")))
    index = index.withColumn("value", F.explode(near))
    probes = windows.select("window", "m", "print", numbers.alias("i")).withColumn("value", block("print", F.col("i")))
    pairs = (
        probes.join(index, ["i", "value", "m"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("window", "item_id")
        .distinct()
    )
    both = pairs.join(windows.select("window", "doc_id", "text_hash", "start", "hashes"), "window").join(items.select("item_id", "m", "item_hashes"), "item_id")
    both = both.withColumn("shared", shared("hashes", "item_hashes"))
    union = F.size("hashes") + F.size("item_hashes") - F.col("shared")
    hits = both.filter(100 * F.col("shared") >= percent * union).withColumn("similarity", F.col("shared") / union)
    best = hits.groupBy("doc_id", "text_hash", "item_id", "m").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    return best.select(
        "doc_id", "text_hash", "item_id", (-F.col("best.back")).alias("start"), F.col("m").alias("n_words"), F.col("best.similarity").alias("similarity")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns and all other rows stay as they are."""
    found = contaminated(docs, items, text=text, key=key, **options).select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    found = stage(found, "contaminated")
    if found.count() <= FEW_DOCUMENTS:
        found = F.broadcast(found)
    same = F.col(key).eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col(text)) == F.col("__hash"))
    return docs.join(found, same, "left_anti")
