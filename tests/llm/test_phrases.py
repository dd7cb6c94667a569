import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm.phrases import Bitmap, _blocks, _seeds, collocations, common_cells, encode, parse, pieces, rolled, scored, word_hashes

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, max_words, top, percent=100):
    """All rows from plain counting, cutting, dropping and sorting."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        held = Counter()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        held[p[i:j]] = max(held[p[i:j]], a)
        found = []
        for p, a in candidates.items():
            if 100 * held[p] >= percent * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    """Skewed words, set phrases, repeated passages, every stop, odd blanks and letters, copies and a long text."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["Été", "漢字", "a\x1cb", "it's"]
    passage = " ".join(rng.choices(words, k=120))
    rows = []
    for i in range(150):
        kind = rng.random()
        text = " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randrange(1, 90)))
        if kind < 0.3:
            text = text.replace("w7", "New York City hall").replace("w3 ", "w3\t")
        elif kind < 0.5:
            text = passage + rng.choice(".,;:!?\n\x0b\x0c\r") + text
        elif kind < 0.6:
            text = "go go go go go " * rng.randrange(1, 9) + text
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", None), (" \t\n.,", "de"), ("one", "xx"), (" ".join(rng.choices(words, k=4_000)), "en")]
    return rows + rows[:30]


SCHEMA = "text string, lang string"


@pytest.mark.parametrize("min_count, max_words, top, modulus", [(6, 5, 2_000, 8), (12, 3, 7, 1), (4, 2, 50, 1_000_000), (9, 5, 40, 3)])
def test_matches_plain_counting(spark, texts, min_count, max_words, top, modulus):
    df = spark.createDataFrame(texts, SCHEMA).repartition(4)
    got = collocations(df, min_count, max_words, top, modulus=modulus)
    assert sorted(map(tuple, got.collect())) == brute(texts, min_count, max_words, top)


def test_filter_changes_nothing(spark, texts):
    """A filter of 64 bits lets nearly everything through."""
    df = spark.createDataFrame(texts, SCHEMA)
    assert sorted(map(tuple, collocations(df, 8, filter_bits=6).collect())) == brute(texts, 8, 5, 2_000)
    some = collocations(df, 8, percent=90)
    assert sorted(map(tuple, some.collect())) == brute(texts, 8, 5, 2_000, 90)


def test_parse_is_a_parse(spark, texts):
    """Owned words and their count, and equal passages give equal chunks wherever they stand."""
    for text, _ in texts:
        words = pieces((text or "").encode()).split()
        found = parse(spark.createDataFrame([(text, "en")], SCHEMA), 5, 8, "text", "lang") if len(words) > 500 else None
        if found is None:
            continue
        rows = found.collect()
        assert sum(r.times * r.n_words for r in rows) == sum(w != b"." for w in words)
        owned = sum(r.times * (len(r.chunk.split()) - (0 if r.last else 4)) for r in rows)
        assert owned == len(words) and sum(r.times for r in rows if r.last) == 1 and len(rows) > len(words) / 20
    copied = [(texts[-1][0], "en")] * 500
    dictionary = parse(spark.createDataFrame(copied, SCHEMA).repartition(3), 5, 8, "text", "lang")
    assert {r.times for r in dictionary.collect()} == {500}
    passage = " ".join(f"p{i}" for i in range(400))
    mixed = [(f"{i} own words {passage} tail {i}", "en") for i in range(20)]
    counts = [r.times for r in parse(spark.createDataFrame(mixed, SCHEMA), 5, 8, "text", "lang").collect()]
    assert counts.count(20) > 20


def test_arithmetic_beyond_64_bits(spark):
    big = 4_000_000_000_000_000
    rows = [("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big), ("en", 2, "a b", big + 7)]
    frequent = spark.createDataFrame(rows, "lang string, size int, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    assert scored(frequent, totals).first().score == 1000 * (big + 7) * 9 * big // (6 * big * big)


def test_bitmap_has_no_false_negative(spark):
    rows = [(lang, f"x{i} y{i % 7}") for i in range(500) for lang in ("en", "de")]
    known = Bitmap.of(spark.createDataFrame(rows[::2], "lang string, phrase string"), 2, 16)
    hashes = word_hashes([w for _, p in rows for w in p.encode().split()])
    seed = np.array([_seeds([lang])[0] for lang, _ in rows])
    held = known.holds(rolled(hashes, np.arange(len(rows)) * 2, 2, seed))
    assert held[::2].all() and held[1::2].mean() < 0.05


def test_rare_phrases_do_not_travel_as_text(spark, monkeypatch):
    """Frequent words in rare pairs: rows of text for the pairs that are frequent, not for all; the result is the same."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    rows = [(" ".join(rng.choices(words, k=200) + ["new", "york", "city"]) + "!", "en") for _ in range(130)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2).cache()
    made, real = Counter(), type(df).mapInArrow

    def spied(self, func, schema, *rest, **more):
        out = real(self, func, schema, *rest, **more)
        if {"size", "phrase", "f"} <= set(out.columns):
            made.update({r["size"]: r["count"] for r in out.groupBy("size").count().collect()})
        return out

    monkeypatch.setattr(type(df), "mapInArrow", spied)
    assert sorted(map(tuple, collocations(df).collect())) == brute(rows, 100, 5, 2_000)
    assert made[1] >= 60 and 0 < made[2] < 100, made


@pytest.mark.parametrize("bits, min_count", [(6, 40), (9, 40), (22, 40), (22, 1), (22, 1 << 40)])
def test_cells_hold_every_frequent_phrase(spark, texts, bits, min_count):
    """Repeated rows weigh as often as they come; a text in two languages counts for each."""
    df = spark.createDataFrame(texts * 2, SCHEMA).repartition(3)
    blocks = encode(parse(df, 5, 8, "text", "lang"))
    known = Bitmap(8, np.full(4, ~np.uint64(0)))
    cells = common_cells(blocks, [2], 5, known, 1, min_count, bits)
    f = defaultdict(Counter)
    for text, lang in texts * 2:
        for piece in b" ".join(pieces((text or "").encode()).split()).split(b"."):
            words = piece.split()
            f[lang or "und"].update(zip(words, words[1:]))
    pairs = [(lang, p, n) for lang, counts in f.items() for p, n in counts.items()]
    hashes = word_hashes([w for _, p, _ in pairs for w in p])
    held = cells.holds(rolled(hashes, np.arange(len(pairs)) * 2, 2, np.array([_seeds([x])[0] for x, _, _ in pairs])))
    often = np.array([n for _, _, n in pairs]) >= min_count
    assert held[often].all() and (bits < 22 or held[~often].mean() < 0.01 if (~often).any() else True)


def test_blocks_hold_the_dictionary(spark, texts):
    dictionary = parse(spark.createDataFrame(texts, SCHEMA).repartition(3), 5, 8, "text", "lang").cache()
    got, total = [], Counter()
    for batch in encode(dictionary).toArrow().to_batches():
        for row, block in zip(batch.to_pylist(), _blocks([batch])):
            words, begin = np.array(block.vocabulary.to_pylist(), object)[block.words], 0
            total[row["lang"]] += row["n"]
            for end, last in zip(block.ends.tolist(), block.last.tolist()):
                got.append((block.lang, b" ".join(words[begin:end]), last, int(block.times[begin])))
                begin = end
    rows = dictionary.collect()
    assert sorted(got) == sorted((r["lang"], bytes(r["chunk"]), r["last"], r["times"]) for r in rows)
    assert total == sum((Counter({r["lang"]: r["times"] * r["n_words"]}) for r in rows), Counter())


def test_edges(spark, texts):
    none = spark.createDataFrame([], SCHEMA)
    assert collocations(none).count() == 0
    assert collocations(spark.createDataFrame([(None, None), ("", "en"), (" . ", "en")], SCHEMA), 1).count() == 0
    df = spark.createDataFrame(texts, SCHEMA)
    theirs = df.withColumns({c: F.lit("theirs") for c in ("f", "a", "l", "r", "n", "k", "size", "phrase", "chunk", "times", "rank", "score")})
    assert sorted(map(tuple, collocations(theirs, 9).collect())) == brute(texts, 9, 5, 2_000)
    with pytest.raises(ValueError):
        collocations(df, max_words=1)
