import random
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from panelcast.llm import quality
from panelcast.session import stage


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents with junk, copies and a leak; labels; one benchmark item."""
    rng, path = random.Random(9), tmp_path_factory.mktemp("tables")
    item = " ".join(f"q{rng.randrange(999)}" for _ in range(30))
    rows, labels = [], []
    for i in range(200):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(40, 90))]
        if i % 6 == 0:
            words = [w + "###" for w in words]
        text = " ".join(words)
        if i % 10 == 3:
            text = rows[i - 2][1] + " end"
        if i in (20, 40):
            text = f"{text} {item.upper()} tail"
        rows.append((i, text, "en", f"s{i % 4}" if i % 3 else "big", len(text)))
        labels.append((i, int(i % 6 != 0), 0))
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in cp.STAGES:
        out.append(docs)
        docs = stage(step(spark, docs, sf_dir), "step")
    return [*out, docs]


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_decides_on_what_came_before(spark, sf_dir, steps):
    docs, good, single, clean, mixed, sharded = steps
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(good) == ids(docs.filter(model.score(F.col("text")) >= cp.KEEP_SCORE))
    assert not [i for i in ids(good) if i % 6 == 0 and i < 200 and i % 10 != 3]

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    rows = sorted((r.doc_id, shingles(r.text)) for r in good.collect())
    dropped = {b for i, (a, x) in enumerate(rows) for b, y in rows[i + 1 :] if x and 100 * len(x & y) >= 80 * len(x | y)}
    assert set(ids(single)) == {i for i, _ in rows} - dropped and len(dropped) > 10
    assert set(ids(single)) - set(ids(clean)) == {20, 40} & set(ids(single))
    assert mixed.columns == clean.columns == docs.columns
    spans = {}
    for r in clean.collect():
        spans[r.doc_id] = (r.text or "").split()
    assert all(" ".join(r.text.split()) in " ".join(spans[r.doc_id]) for r in mixed.collect())
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert abs(words(mixed) - words(clean)) <= 5
    assert ids(sharded) == ids(mixed) and {r.shard for r in sharded.collect()} <= set(range(cp.SHARDS))


def test_run_is_the_stages_in_turn(spark, sf_dir, steps):
    want = sorted(map(tuple, steps[-1].collect()))
    assert sorted(map(tuple, cp.run(spark, sf_dir).collect())) == want
    assert [name for name, _ in cp.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "sharding",
    ]


def test_empty_documents(spark, sf_dir, tmp_path):
    shutil.copytree(f"{sf_dir}/labels.parquet", tmp_path / "labels.parquet")
    shutil.copytree(f"{sf_dir}/benchmark.parquet", tmp_path / "benchmark.parquet")
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
