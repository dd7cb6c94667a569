import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.llm import mixing
from panelcast.llm.common import n_words

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes):
    """Targets by plain rounds: cap, share the excess, again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] >= 3 * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            open_.remove(s)


def sizes_of(rows):
    out = Counter()
    for _, text, _, source, _ in rows:
        out[source] += len(WORDS.findall(text or ""))
    return dict(out)


def test_targets_match_rounds_of_sharing(spark, rows):
    for sizes in (sizes_of(rows), {"a": 1, "b": 1, "c": 1000, None: 5, "d": 0}, {"x": 7}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(shares(sizes))


@pytest.mark.parametrize("block_words", [7, 64])
def test_spans_fill_targets_whole_words_only_and_rerun_alike(docs, rows, block_words):
    spans = mixing.mix(docs, block_words=block_words, shards=3).collect()
    again = mixing.mix(docs.repartition(5), block_words=block_words, shards=3).collect()
    assert sorted(map(repr, spans)) == sorted(map(repr, again))
    taken = Counter()
    texts = {}
    for doc_id, text, _, source, _ in rows:
        texts.setdefault(doc_id, set()).add(text)
    for s in spans:
        mine = WORDS.findall(s.text)
        taken[s.source] += len(mine)
        assert len(mine) == s.n_taken and s.n_chars == len(s.text)
        assert any(t and WORDS.findall(t)[s.first_word : s.first_word + s.n_taken] == mine for t in texts[s.doc_id])
    target = shares(sizes_of(rows))
    for source, words in target.items():
        assert abs(taken[source] - words) <= 0.5 + 1e-9
    # Slots of a source are gapless and spread over the shards.
    slots = {(s.source, s.slot) for s in spans}
    for source in taken:
        own = sorted(k for x, k in slots if x == source)
        assert own == list(range(len(own)))


def test_query_reruns_alike_however_the_rows_lie(spark, rows, tmp_path):
    """The registered query over the same rows in one file, in many, in another order and with other splits."""
    from panelcast.llm.queries import QUERIES

    usable = [r for r in rows if r[0] is not None]
    docs = spark.createDataFrame(usable, "doc_id long, text string, lang string, source string, n_chars long")
    found = []
    for k, (parts, split) in enumerate(((1, "128m"), (7, "128m"), (3, "4k"))):
        folder = tmp_path / str(k)
        docs.orderBy(F.xxhash64("doc_id", F.lit(k))).repartition(parts).write.parquet(f"{folder}/documents.parquet")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            got = QUERIES["op1_mixing"](spark, str(folder)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        found.append(sorted((r.doc_id, r.size, r.taken, round(r.target, 6)) for r in got))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(usable)
    target, sizes = shares(sizes_of(usable)), sizes_of(usable)
    assert sum(r[2] for r in found[0]) == pytest.approx(sum(sizes.values()), abs=len(sizes))
    assert all(r[2] <= 3 * r[1] for r in found[0]) and target


def test_slots_of_a_large_source_are_made_in_ranges(spark):
    targets = spark.createDataFrame([("a", 9_000_000, 2.0e7), ("b", 100, 50.0)], "source string, source_size long, target double")
    made = mixing.slots(targets, 512, 16, 0)
    per = {r.source: (r.n, r.d, r.words) for r in made.groupBy("source").agg(
        F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.sum("__take").alias("words")).collect()}
    assert per["a"][0] == per["a"][1] and per["a"][2] == 20_000_000 and per["b"][2] == 50
    parts = made.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 0.9 * per["a"][0]


def test_no_row_is_taken_more_often_than_its_cap(docs):
    sized = docs.select("source", n_words(F.col("text")).alias("size")).withColumn("row", F.monotonically_increasing_id())
    taken = mixing.mix_spans(sized, block_words=16).groupBy("row", "size").agg(F.sum("n_taken").alias("n"))
    assert taken.filter("n > 3 * size").isEmpty()


def test_every_size_is_permuted_whole(spark):
    for size in (1, 2, 3, 4, 5, 16, 17, 100, 1000):
        df = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit(42)).alias("p"))
        assert sorted(r.p for r in df.collect()) == list(range(size))


def test_shards_get_counts_that_add_up():
    pdf = pd.DataFrame({"__seed": [1, 2], "__slots": [1000, 7]})
    (out,) = mixing._spread_counts(16, 0)(iter([pdf]))
    assert out.groupby("__seed")["__count"].sum().tolist() == [1000, 7]
    assert np.ptp(out[out["__seed"] == 1]["__count"]) < 60


def test_edges(no_docs, clashing):
    assert mixing.mix(no_docs).count() == 0
    assert set(mixing.mix(clashing, block_words=50).columns) >= {"doc_id", "take", "row", "shard", "slot"}
    assert mixing.mix(clashing, block_words=50).filter("row <> 'theirs'").isEmpty()
