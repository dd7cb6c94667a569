import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import quality, toxicity
from panelcast.llm.common import fold
from panelcast.llm.features import Words, ngram_indexes, word_indexes


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 80))]
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            words = [w + rng.choice(("###", "$$$")) for w in words] if i % 2 else [words[0]] * len(words)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), f"slur{rng.randrange(6)}")
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(not bad), int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, "w1 w2"), (1003, "w5 " * 20_000), (2, rows[2][1])]
    labels += [(None, 1, 0), (1, None, None), (9999, 1, 1), (2, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_holds_out(texts):
    docs, labels = texts
    model = quality.fit(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))
    out = docs.withColumn("score", model.score(F.col("text"))).collect()
    judged = [(r.score >= 0.3, r.doc_id % 5 != 0) for r in out if r.doc_id is not None and r.doc_id < 1000]
    assert np.mean([a == b for a, b in judged]) > 0.97
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    blank = {r.score for r in out if r.doc_id in (1000, 1001, 1002)}
    assert len(blank) == 1


def test_labels_beyond_the_bound_are_not_learnt(texts):
    docs, labels = texts
    cfg = quality.Ftrl(max_rows=40, trainers=2)
    few, again = quality.fit(docs, labels, cfg), quality.fit(docs.repartition(7), labels.repartition(3), cfg)
    assert (few.weights == again.weights).all() and few.bias == again.bias
    none = quality.fit(docs, labels.limit(0))
    assert not none.weights.any() and none.bias == 0


def test_ftrl_follows_the_plain_update():
    """One feature at a time, as the update rule is written."""
    rng, cfg = np.random.default_rng(1), quality.Ftrl(bits=4, epochs=2, alpha=0.5, beta=1.0, l1=0.02, l2=0.1)
    rows = [(np.sort(rng.choice(16, 3, replace=False)), rng.random(3)) for _ in range(40)]
    y = rng.integers(0, 2, 40)
    z, n, bz, bn = [0.0] * 16, [0.0] * 16, 0.0, 0.0

    def weight(i):
        return 0.0 if abs(z[i]) <= cfg.l1 else -(z[i] - np.sign(z[i]) * cfg.l1) / ((cfg.beta + n[i] ** 0.5) / cfg.alpha + cfg.l2)

    for _ in range(2):
        for (index, value), t in zip(rows, y):
            w, b = [weight(i) for i in index], -bz / ((cfg.beta + bn**0.5) / cfg.alpha)
            g = 1 / (1 + np.exp(-(np.dot(w, value) + b))) - t
            for i, v, wi in zip(index, value, w):
                sigma = ((n[i] + (g * v) ** 2) ** 0.5 - n[i] ** 0.5) / cfg.alpha
                z[i] += g * v - sigma * wi
                n[i] += (g * v) ** 2
            sigma = ((bn + g * g) ** 0.5 - bn**0.5) / cfg.alpha
            bz, bn = bz + g - sigma * b, bn + g * g
    weights, bias = quality.ftrl_weights(rows, y, cfg)
    assert weights == pytest.approx([weight(i) for i in range(16)]) and bias == pytest.approx(-bz / ((cfg.beta + bn**0.5) / cfg.alpha))


def test_toxicity_holds_out_and_leaves_clean_texts(texts):
    docs, labels = texts
    known = labels.filter(fold(F.col("doc_id"), 3) != 1)
    model = toxicity.fit(docs, known.filter("toxic = 1"), prior=1 / 7)
    out = docs.withColumn("score", model.score(F.col("text"))).collect()
    judged = [(r.score >= 0.7, r.doc_id % 7 == 0) for r in out if r.doc_id is not None and r.doc_id < 1000]
    assert np.mean([a for a, b in judged if b]) > 0.9 and np.mean([a for a, b in judged if not b]) < 0.02
    assert all(0 <= r.score <= 1 for r in out)


def test_without_confirmed_texts_nothing_is_toxic(texts, no_docs):
    docs, labels = texts
    model = toxicity.fit(docs, labels.limit(0), 0.1)
    assert docs.withColumn("s", model.score(F.col("text"))).filter("s > 0.01").isEmpty()
    empty = toxicity.fit(no_docs, labels, 0.1)
    assert no_docs.withColumn("s", empty.score(F.col("text"))).count() == 0


def test_risk_part_of_unlabelled_text_is_not_pushed_below_zero():
    """All unlabelled texts positive: an unbiased estimator would drive their risk negative for ever."""
    rng = np.random.default_rng(0)
    positive = [np.array([1, 2]) for _ in range(50)]
    unlabelled = [np.array([1, 2]) if rng.random() < 0.5 else np.array([3]) for _ in range(200)]
    weights, bias = toxicity.nn_pu(positive, unlabelled, 0.5, 8, toxicity.PuConfig(batch=32))
    assert weights[[1, 2]].sum() + bias > 0 > weights[3] + bias
    assert np.isfinite(weights).all()


def test_words_in_one_of_a_hundred_toxic_texts_are_learnt():
    """200 terms, each in about 1 % of the toxic texts, among 60 common words a text; the settings of the query."""
    rng = np.random.default_rng(5)

    def clean():
        return np.unique(rng.integers(1_000, 9_000, 60))

    def toxic():
        return np.unique(np.concatenate([clean(), rng.choice(200, 2, replace=False)]))

    positive = [toxic() for _ in range(6_000)]
    unlabelled = [toxic() if rng.random() < 0.1 else clean() for _ in range(6_000)]
    weights, bias = toxicity.nn_pu(positive, unlabelled, 0.1, 1 << 14, toxicity.PuConfig())
    score = lambda x: 1 / (1 + np.exp(-(weights[x].sum() + bias)))
    assert np.mean([score(toxic()) >= 0.7 for _ in range(500)]) > 0.9
    assert np.mean([score(clean()) >= 0.7 for _ in range(500)]) < 0.01


def test_learner_is_the_plain_risk_loop():
    """One text after the other, one feature after the other."""
    rng = np.random.default_rng(6)
    positive = [np.unique(rng.integers(0, 12, 4)) for _ in range(40)]
    unlabelled = [np.unique(rng.integers(4, 24, 5)) for _ in range(90)]
    cfg, prior, size = toxicity.PuConfig(batch=16, epochs=3), 0.3, 24
    weights, bias = toxicity.nn_pu(positive, unlabelled, prior, size, cfg)
    scale, ratio = toxicity.surprise_weights(positive, unlabelled, size, cfg)
    w = {i: cfg.start * min(max(ratio[i], 0.0), 3.0) for i in range(size) if scale[i] > 0}
    gathered, b, b_gathered = dict.fromkeys(w, 1e-6), np.log(prior / (1 - prior)), 1e-6
    draws, steps = np.random.default_rng(cfg.seed), len(unlabelled) // cfg.batch
    per = min(len(positive), max(cfg.batch // 2, -(-len(positive) // steps)))

    def output(text):
        return 1 / (1 + np.exp(-(sum(scale[i] * w[i] for i in text if i in w) + b)))

    for _ in range(cfg.epochs):
        of_u, of_p = draws.permutation(len(unlabelled)), draws.permutation(len(positive))
        for step in range(steps):
            us = [unlabelled[i] for i in of_u[step::steps]]
            ps = [positive[of_p[i % len(positive)]] for i in range(step * per, (step + 1) * per)]
            negative = np.mean([output(t) for t in us]) - prior * np.mean([output(t) for t in ps])
            slope, slope_b = dict.fromkeys(w, 0.0), 0.0
            for text, share in [(t, ("p", len(ps))) for t in ps] + [(t, ("u", len(us))) for t in us]:
                s = output(text)
                d = s * (1 - s) / share[1]
                d = (-2 if negative >= 0 else 1) * prior * d if share[0] == "p" else (1 if negative >= 0 else -1) * d
                slope_b += d
                for i in text:
                    if i in w:
                        slope[i] += scale[i] * d
            for i in w:
                gathered[i] += slope[i] ** 2
                w[i] -= cfg.rate * slope[i] / np.sqrt(gathered[i])
            b_gathered += slope_b**2
            b -= 0.3 * cfg.rate * slope_b / np.sqrt(b_gathered)
    assert bias == pytest.approx(b) and len(w) > 3
    assert weights == pytest.approx([scale[i] * w.get(i, 0.0) for i in range(size)])


def test_features_see_repetition_and_punctuation():
    memo = Words()
    same = lambda a, b: set(ngram_indexes(a, memo, 18)) & set(ngram_indexes(b, memo, 18))
    assert same(b"foo foo foo", b"bar bar") and same(b"foo###", b"bar#")
    assert len(ngram_indexes(b"a b c", memo, 18)) == 10 and not len(ngram_indexes(None, memo, 18))
    assert (word_indexes(b"A b", memo, 18) == word_indexes(b"a B", memo, 18)).all()
