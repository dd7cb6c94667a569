import random

import numpy as np
import pytest

from panelcast.llm.sketch_join import SizeBands, similarity_components
from tests.llm.test_minhash import LOWER


def shingles(text, size):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, percent, size):
    """(doc_id, size, component) from all pairs of rows with an id."""
    sets = [shingles(t, size) for _, t in rows]
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
                parent[find(j)] = find(i)
    least = {}
    for i in usable:
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((d, len(sets[i]), least[find(i)] if i in usable else d) for i, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("percent, size", [(90, 3), (80, 5)])
def test_matches_all_pairs(spark, docs, rows, percent, size):
    assert got(similarity_components(docs, percent, size)) == brute([r[:2] for r in rows], percent, size)


def test_every_size_and_distance(spark):
    """Chains of copies from 1 to 2 000 words that differ by just under, at and just over the limit, few distinct words."""
    rng = random.Random(1)
    rows = []
    for n in (1, 2, 3, 5, 8, 9, 10, 11, 12, 13, 15, 20, 21, 25, 31, 40, 60, 90, 150, 400, 2_000):
        base = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        for copy in range(7):
            text = list(base)
            for _ in range(copy * max(1, n // 150)):
                i = rng.randrange(len(text))
                text[i : i + 1] = rng.choice(([f"x{rng.random()}"], [], [text[i], f"y{rng.random()}"]))
                text = text or ["z"]
            rows.append((len(rows), " ".join(text)))
    rows += [(1_000 + i, " ".join(rng.choices("ab", k=rng.randrange(1, 40)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(similarity_components(df, 90, 3)) == brute(rows, 90, 3)


def test_group_of_near_copies(spark):
    """Half of all rows are near copies of one text, another part copies of those: whole components, no hot list."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(200)]

    def changed(words, k):
        words = list(words)
        for _ in range(k):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        return words

    other = changed(base, 9)
    texts = [changed(base, rng.randrange(1, 9)) for _ in range(150)] + [changed(other, rng.randrange(4)) for _ in range(60)]
    texts += [[f"o{rng.random()}" for _ in range(50)] for _ in range(100)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    assert got(similarity_components(spark.createDataFrame(rows, "doc_id long, text string"), 90, 3)) == brute(rows, 90, 3)


@pytest.mark.parametrize("percent", [90, 80, 50])
def test_linked_sets_share_a_block_in_a_band(percent):
    """The pigeonhole bound, at the very distance that a link allows; bits that differ never exceed hashes that do."""
    rng, bands = np.random.default_rng(percent), SizeBands(percent)
    for n in [*range(1, 60), 100, 333, 1_000, 5_000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            lost = rng.integers(0, len(a) + 1)
            b = a
            for gained in range(len(a) + 1):
                new = np.unique(np.concatenate([a[lost:], rng.integers(0, 2**64, gained, dtype=np.uint64)]))
                if 100 * (len(a) - lost) < percent * (len(a) + gained):
                    break
                b = new
            if (a.size == b.size and (a == b).all()) or not len(b):
                continue
            common = set(bands.of(len(a))) & set(bands.of(len(b)))
            assert common
            agree = False
            for band in common:
                (x, keys), (y, others) = bands.sketch(a, band), bands.sketch(b, band)
                agree |= bool(set(keys.tolist()) & set(others.tolist()))
                differ = sum(int(v).bit_count() for v in (x.view(np.uint64) ^ y.view(np.uint64)).tolist())
                assert differ <= len(np.setxor1d(a, b))
            assert agree


def test_empty_blocks_still_meet():
    """Sets whose only equal blocks are empty ones keep a key for these."""
    bands = SizeBands(90)
    band = bands.of(60)[0]
    k = bands.blocks(band)
    crowded = np.arange(60, dtype=np.uint64) * np.uint64(7)  # all in the first block
    bits, keys = bands.sketch(np.sort(crowded), band)
    assert len(bits) == len(keys) == k
    spread = (np.arange(60, dtype=np.uint64) << np.uint64(58)) + np.uint64(1)
    assert len(bands.sketch(np.sort(spread), band)[1]) <= k


def test_edges(spark, no_docs, clashing, rows):
    assert similarity_components(no_docs).count() == 0
    assert similarity_components(clashing).count() == len(rows)
    same = spark.createDataFrame([(5, "a b"), (3, "A\tB"), (None, "a b"), (4, None), (6, " ")], "doc_id long, text string")
    assert got(similarity_components(same, 90, 3)) == sorted([(5, 1, 3), (3, 1, 3), (None, 1, None), (4, 0, 4), (6, 0, 6)], key=repr)
    with pytest.raises(ValueError):
        similarity_components(no_docs, 0)
