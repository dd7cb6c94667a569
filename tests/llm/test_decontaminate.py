import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelcast.llm.decontaminate import RADIUS, contaminated, drop_contaminated, simhash


def words(rng, n, prefix="w"):
    return [f"{prefix}{rng.randrange(500)}" for _ in range(n)]


def shingles(tokens, size):
    return Counter(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))


def brute(docs, items, percent=80):
    """Best window of an item's size over every start, per document and item."""
    out = set()
    for doc, text in docs:
        tokens = (text or "").lower().split()
        for item, wording in items:
            own = (wording or "").lower().split()
            if not own or not tokens:
                continue
            size, best = min(5, len(own)), None
            mine = shingles(own, size)
            for start in range(max(1, len(tokens) - len(own) + 1)):
                window = shingles(tokens[start : start + len(own)], size)
                both = sum((mine & window).values())
                if 100 * both >= percent * sum((mine | window).values()):
                    best = max(best or 0, both / sum((mine | window).values()))
            if best:
                out.add((doc, item, round(best, 6)))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate((15, 22, 40, 59, 5, 3))]
    items += [(6, None), (7, " "), (8, items[0][1]), (9, "re pe re pe re pe re pe re pe re pe")]
    docs = []
    for i in range(40):
        text = words(rng, 60 + i, "d")
        if i % 4 == 0:
            own = items[i // 4 % 6][1].split()
            if i % 8 == 4 and len(own) > 30:
                own[len(own) // 2] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() if i % 3 else w for w in own]
        docs.append((i, " ".join(text)))
    docs += [(50, None), (51, ""), (52, items[1][1]), (53, "tiny text"), (54, "x " + items[9][1] + " y"), (None, items[2][1])]
    docs += [(0, docs[0][1]), (55, " ".join(items[3][1].split()[:30]))]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_matches_every_window(case):
    docs, items, d, i = case
    found = {(r.doc_id, r.item_id, round(r.similarity, 6)) for r in contaminated(d, i).collect()}
    assert found == brute(docs, items) and len(found) > 10


def test_clean_documents_stay_whole(case, spark):
    docs, items, d, i = case
    leaks = {doc for doc, *_ in brute(docs, items)}
    wide = d.withColumn("tokens", F.lit("theirs")).withColumn("m", F.lit(1))
    kept = drop_contaminated(wide, i)
    assert kept.columns == wide.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == sorted(r for r in docs if r[0] not in leaks and r[1])


def test_fingerprints_of_similar_windows_stay_within_the_radius(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        own = [rng.getrandbits(63) for _ in range(36)]
        near = own[:32] + [rng.getrandbits(63) for _ in range(4)]
        rows.append((own, near))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    apart = df.select(F.bit_count(simhash(F.col("a")).bitwiseXOR(simhash(F.col("b")))).alias("n"), simhash(F.col("a")).alias("p")).collect()
    assert max(r.n for r in apart) <= RADIUS
    want = sum((2 * sum(h >> k & 1 for h in rows[0][0]) > 36) << k for k in range(64))
    assert apart[0].p % 2**64 == want


def test_edges(spark, case, no_docs):
    _, _, d, i = case
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(d, none).count() == 0 and contaminated(no_docs, i).count() == 0
    assert drop_contaminated(d, none).count() == d.count()
