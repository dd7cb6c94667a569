import random
from collections import defaultdict

import numpy as np
import pytest

from panelcast.llm.clusters import spanning_links
from panelcast.llm.common import Scratch
from panelcast.llm.features import Words
from panelcast.llm.graph import connected_components
from panelcast.llm.minhash import Bands, keep_one, near_duplicates, shingle_set

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent=85):
    """(doc_id, size, component, kept) from all pairs of rows with an id."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    usable = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for x, i in enumerate(usable):
        for j in usable[x + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i in usable:
        least[find(i)].append(rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        c = min(least[find(i)]) if i in usable else d
        out.append((d, len(sets[i]), c, d is None or c == d))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("percent", [85, 80])
def test_matches_all_pairs(docs, rows, percent):
    assert got(near_duplicates(docs, percent=percent)) == brute([r[:2] for r in rows], percent)


def test_mixed_buckets_lose_no_link(spark):
    """Copies with one to six words changed: buckets full of pairs above and below the limit."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.choice((1, 2, 2, 3, 4, 6))):
            text[rng.randrange(len(text))] = f"x{rng.random()}"
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_links_in_a_large_mixed_bucket_are_found(spark):
    """One bucket of copies too different from each other, and six pairs that differ less: few of them are centres."""
    rng, layout, memo = random.Random(8), Bands(1, 1), Words()
    base = [f"b{i}" for i in range(300)]

    def changed(places):
        while True:
            text = list(base)
            for k in places or [75 * k + rng.randrange(5, 70) for k in range(4)]:
                text[k] = f"x{rng.random()}"
            text = " ".join(text)
            if (layout.keys(shingle_set(text.encode(), memo)) == layout.keys(shingle_set(" ".join(base).encode(), memo))).all():
                return text

    rows = [(i, changed(None)) for i in range(90)]
    for i in range(6):
        # Other words in the same four places.
        rows.append((200 + i, changed([k for k, w in enumerate(rows[15 * i + 5][1].split(" ")) if w[0] == "x"])))
    want = brute(rows)
    assert [r[0] for r in want if not r[3]] == list(range(200, 206))
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), layout=layout)) == want


def test_remaining_edges_are_all_links(spark):
    """Every link between components, with and without a common text, long differences and several blocks a list."""
    rng = np.random.default_rng(4)
    base = np.sort(rng.integers(-(2**62), 2**62, 120))
    sets = []
    for i in range(150):
        start = base if i % 3 else sets[rng.integers(len(sets))] if sets else base
        kept = rng.permutation(start)[: len(start) - rng.integers(0, 14)]
        sets.append(np.unique(np.concatenate([kept, rng.integers(-(2**62), 2**62, rng.integers(0, 14))])))
    packed = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, set binary")
    met = spark.createDataFrame([(i, 0) for i in range(1, 150)], "u long, v long")
    want = set()
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                want.add((j, i))
    parent = connected_components(spark.createDataFrame(sorted(want), "u long, v long")).collect()
    for part, carry, rounds in ((1_000, 256, 3), (20, 256, 1), (20, 256, 3), (1_000, 0, 3), (20, 25, 1), (5, 25, 2)):
        edges = spanning_links(met, packed, 85, Scratch(spark), part, carry, rounds)
        found = {(r.u, r.v) for r in edges.collect()}
        assert found <= want and len(found) < 400
        again = connected_components(spark.createDataFrame(sorted(found), "u long, v long")).collect()
        assert sorted(again) == sorted(parent)


def test_keep_one_row_of_a_group(docs, rows):
    kept = keep_one(docs).collect()
    want = [r for r in brute([r[:2] for r in rows]) if r[3]]
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert sorted(ids) == sorted({r[0] for r in want if r[0] is not None})
    assert sum(r.doc_id is None for r in kept) == 2
    assert kept[0].asDict().keys() == docs.columns or list(kept[0].asDict()) == docs.columns


def test_band_agreement_follows_similarity():
    """Shares of equal bands of sets with few and many hashes, empty bins filled, near s ** rows."""
    rng, layout = np.random.default_rng(0), Bands(48, 2)
    for size in (6, 40, 2000):
        hits = []
        for _ in range(60):
            a = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
            b = a.copy()
            changed = max(1, size // 8)
            b[:changed] = rng.integers(0, 2**63, changed, dtype=np.uint64) * np.uint64(2)
            hits.append((layout.keys(np.sort(a)) == layout.keys(np.sort(b))).mean())
        s = (size - changed) / (size + changed)
        assert abs(np.mean(hits) - s**2) < 0.12


def test_shingle_sets():
    memo = Words()
    assert len(shingle_set(b"A b c d e", memo)) == 1 and len(shingle_set(b"", memo)) == 0 == len(shingle_set(None, memo))
    assert (shingle_set(b"A b C", memo) == shingle_set(b"a  B\tc\n", memo)).all()
    assert len(shingle_set(b"x " * 1000, memo)) == 1
    assert shingle_set("É b c".encode(), memo)[0] != shingle_set("é b c".encode(), memo)[0]


def test_components_of_long_chains_and_loops(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (500, 501)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_edges(no_docs, clashing, rows):
    assert near_duplicates(no_docs).count() == 0 and keep_one(no_docs).count() == 0
    assert near_duplicates(clashing).count() == len(rows)
    assert keep_one(clashing).columns == clashing.columns
