import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators add or use inside; an input may have them too.
CLASHING = ("size", "shard", "slot", "take", "block", "n", "row", "tokens", "word", "score", "component_id", "hash", "th", "keys", "bytes")


def words(rng, n, low=0, high=400):
    return [f"w{rng.randrange(low, high)}" for _ in range(n)]


def corpus(seed=3, n=60):
    """Rows with copies, near copies, shared lines, nulls, blanks, a long text and a source with half of all."""
    rng = random.Random(seed)
    shared = " ".join(words(rng, 12))
    rows, texts = [], []
    for i in range(n):
        kind = i % 10
        if kind == 3 and texts:
            text = rng.choice(texts)
        elif kind == 4 and texts:
            own = rng.choice(texts).split(" ")
            own[rng.randrange(len(own))] = "changed"
            text = " ".join(own)
        elif kind == 5:
            text = shared + "\n" + " ".join(words(rng, 20)) + "\n" + shared.upper() + " \n"
        else:
            text = " ".join(words(rng, rng.randrange(30, 120)))
            texts.append(text)
        rows.append((i, text, "en", "hot" if i % 2 else f"s{i % 5}", len(text)))
    long = " ".join(words(rng, 3_000, 0, 5_000))
    rows += [
        (100, None, "en", "s1", 0),
        (101, "", None, "s1", 0),
        (102, " \t\n ", "en", None, 4),
        (103, "Short text.", "en", None, 11),
        (104, long, "en", "s0", len(long)),
        (105, "Ünïcode ÄÖ 漢字 " * 3, "xx", "s0", 45),
        (None, rows[0][1], "en", "s0", 5),
        (None, None, None, None, None),
        rows[0],
        rows[0],
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("theirs") for c in CLASHING})
