import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from panelcast.llm import brown
from panelcast.llm.brown import BrownConfig, _encoded, _log_transition, exchange, gains, likelihood, score_documents

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = BrownConfig(classes=4, clustered=30, batch_bytes=4_000)


@pytest.fixture(scope="module")
def corpus():
    """Two languages of their own words: classes tell them apart."""
    rng, rows = random.Random(8), []
    for i in range(150):
        lang = "ab"[i % 2]
        rows.append((i, " ".join(f"{lang}{int(rng.paretovariate(0.7)) % 400}".title() for _ in range(rng.randrange(20, 90)))))
    return rows + [(200, None), (201, ""), (202, " \t"), (203, "unknown words only"), (None, "a1 a1"), (3, rows[3][1])]


def test_base_scores_and_counts(spark, corpus):
    train = (F.col("doc_id") % 5 != 0) & (F.col("doc_id") != 203)
    out = score_documents(spark.createDataFrame(corpus, "doc_id long, text string"), train, SMALL).collect()
    assert len(out) == len(corpus)
    learnt = [WORDS.findall((t or "").translate(LOWER)) + ["\n"] for d, t in corpus if d is not None and d % 5 and d != 203]
    counts = Counter(w for text in learnt for w in text)
    n, v = sum(counts.values()), len(counts)
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, r)
    for d, t in corpus:
        tokens = WORDS.findall((t or "").translate(LOWER)) + ["\n"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        r = by_id[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), n)
        assert r.base_score == pytest.approx(base) and r.perplexity == pytest.approx(10 ** (-r.score / len(tokens)))
    held = [r for r in out if r.doc_id is not None and r.doc_id % 5 == 0 and r.doc_id < 150]
    assert sum(r.score for r in held) > 1.02 * sum(r.base_score for r in held)


def test_one_word_texts_have_at_most_all_probability(spark, corpus):
    """The empty text and every one-word text exclude each other; of two-word texts some is left."""
    df = spark.createDataFrame(corpus[:150], "doc_id long, text string")
    vocabulary = sorted({w for _, t in corpus[:150] for w in WORDS.findall(t.lower())})
    probes = [(1000 + i, w) for i, w in enumerate([*vocabulary, "neverseen", ""])]
    out = score_documents(df.union(spark.createDataFrame(probes, df.schema)), F.col("doc_id") < 150, SMALL)
    total = sum(10**r.score for r in out.filter("doc_id >= 1000").collect())
    assert 0 < total < 1


def test_exchange_raises_the_likelihood_and_finds_blocks():
    rng = np.random.default_rng(3)
    words, size = 24, 25
    group = np.arange(words) % 3
    counts = np.zeros((size, size))
    for _ in range(20_000):
        a = rng.integers(words)
        b = rng.choice(np.flatnonzero(group == (group[a] + 1) % 3))
        counts[a, b] += 1
    found = exchange(counts, 3, 20)
    assert {tuple(sorted(np.flatnonzero(found == c) % 3)) for c in range(3)} == {(k,) * 8 for k in range(3)}

    def grid(where):
        member = np.eye(4)[np.append(where, 3)]
        return member.T @ counts @ member

    assert likelihood(grid(found)) >= likelihood(grid(np.arange(words) % 3)) - 1e-6
    assert likelihood(grid(found)) > likelihood(grid(np.arange(words) // 8))


def test_edges(no_docs, clashing, rows, spark):
    assert score_documents(no_docs, F.lit(True), SMALL).count() == 0
    assert score_documents(clashing, F.col("doc_id") > 3, SMALL).count() == len(rows)
    out = score_documents(clashing, F.lit(False), SMALL).collect()
    assert len(out) == len(rows) and {r.n_known for r in out} == {0}
    assert all(r.score == pytest.approx(r.base_score) for r in out)


def test_gains_are_those_of_the_likelihood():
    rng = np.random.default_rng(5)
    words, classes = 9, 4
    counts = rng.poisson(1.0, (words, words))
    now = rng.integers(classes, size=words)

    def grid(where):
        member = np.eye(classes, dtype=int)[where]
        return member.T @ counts @ member

    member = np.eye(classes, dtype=int)[now]
    found = gains(grid(now), now, counts.T @ member, counts @ member, np.diagonal(counts))
    for w in range(words):
        true = [likelihood(grid(np.where(np.arange(words) == w, c, now))) for c in range(classes)]
        assert found[w] - found[w, now[w]] == pytest.approx(np.array(true) - true[now[w]], abs=1e-8)


def _turns(n=240):
    """Texts in which words of two equal halves of the vocabulary take turns; none is more frequent than others."""
    rng, rows = random.Random(4), []
    for i in range(n):
        side = rng.randrange(2)
        rows.append((i, " ".join(f"{'xy'[(side + k) % 2]}{rng.randrange(60)}" for k in range(40))))
    return rows


def test_words_beyond_the_most_frequent_go_through_exchange(spark):
    """Most words are past ``clustered``; what class they are in shows only by their places among each other."""
    cfg = BrownConfig(classes=2, clustered=3)
    out = score_documents(spark.createDataFrame(_turns(), "doc_id long, text string"), F.col("doc_id") % 5 != 0, cfg)
    held = out.filter("doc_id % 5 = 0").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] > held[1] + 0.2 * held[2]  # knowing whose turn it is is worth log10(2) = 0.3 a word


def test_batches_and_shards_do_not_change_scores(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    one = score_documents(df, F.col("doc_id") % 5 != 0, BrownConfig(classes=4, clustered=30)).collect()
    cut = BrownConfig(classes=4, clustered=30, batch_bytes=3_000, shard_words=100)
    many = score_documents(df.repartition(5), F.col("doc_id") % 5 != 0, cut).collect()

    def order(r):
        return (r.doc_id is None, r.doc_id, r.n_tokens, r.base_score)

    assert len(one) == len(many) == len(corpus)
    for a, b in zip(sorted(one, key=order), sorted(many, key=order)):
        assert (a.doc_id, a.n_tokens, a.n_known, a.train_tokens) == (b.doc_id, b.n_tokens, b.n_known, b.train_tokens)
        assert a.score == pytest.approx(b.score)


def test_steps_from_every_state_add_up_to_one():
    cfg, rng = BrownConfig(classes=2), np.random.default_rng(1)
    mass = np.append(rng.uniform(1, 9, cfg.rest), 0)
    for moves in (rng.integers(0, 9, (cfg.states, cfg.states)).astype(float), np.zeros((cfg.states, cfg.states))):
        step = 10 ** _log_transition(moves, mass, 0.01, cfg)
        assert step[:, : cfg.all_classes].sum(1) == pytest.approx(np.ones(cfg.states))


def test_gains_take_logarithms_of_equal_counts_once(monkeypatch):
    """Rare words share their counts: fewer logarithms than two for each word and class, whatever the entries."""
    rng = np.random.default_rng(7)
    words, classes = 2_000, 40
    now = rng.integers(classes, size=words)
    left, right = (rng.poisson(0.1, (words, classes)) for _ in range(2))
    own, grid = np.zeros(words, int), rng.integers(1_000, 9_000, (classes, classes))
    taken, plog = [], brown._plog
    monkeypatch.setattr(brown, "_plog", lambda x: taken.append(np.size(x)) or plog(x))
    assert gains(grid, now, left, right, own).shape == (words, classes)
    assert sum(taken) < 2 * words * classes


def test_texts_are_encoded_as_python_splits_them():
    texts = [None, b"", b" \t\n", b"\xff A b\x0bC \x1c \x85 \xc3\x89", b"one", b" One  ONE\r", b"a" * 70]
    for kind in (pa.binary(), pa.large_binary()):
        hashes, places, lengths = _encoded(pa.array(texts, kind))
        found = [(t or b"").lower().split() + [b"\n"] for t in texts]
        assert list(lengths) == [len(f) for f in found]
        assert [int(hashes[p]) for p in places] == [xxhash.xxh3_64_intdigest(w) for f in found for w in f]
