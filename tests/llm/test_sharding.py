import zlib
from collections import defaultdict

import pytest

from panelcast.llm.sharding import byte_shards


def size(text):
    return len((text or "").encode()) + 8


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_balanced_gapless_whole(docs, rows, shards):
    out = byte_shards(docs, shards).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.text_crc32) for r in out) == sorted(
        (d is None, d or 0, t or "", zlib.crc32((t or "").encode())) for d, t, *_ in rows
    )
    by, largest, total = defaultdict(list), max(size(r[1]) for r in rows), sum(size(r[1]) for r in rows)
    for r in out:
        assert r.size == size(r.text)
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert abs(sum(r.size for r in members) - total / shards) <= largest
    again = byte_shards(docs.repartition(7), shards).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_equal_texts_lie_together(spark):
    rows = [(i, f"text {i % 4}") for i in range(400)]
    out = byte_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    assert max(len({r.shard for r in out if r.text == t}) for _, t in rows[:4]) <= 3


def test_edges(no_docs, clashing, rows):
    assert byte_shards(no_docs, 24).count() == 0
    out = byte_shards(clashing, 3)
    assert out.count() == len(rows) and dict(out.dtypes)["shard"] == "int" and out.filter("hash <> 'theirs'").isEmpty()
