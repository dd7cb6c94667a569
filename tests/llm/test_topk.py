import math

import numpy as np
import pytest

from panelcast.llm.topk import bounds, products, terms, top_k


def brute(rows, k):
    whole = {}
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, (i, a) in enumerate(usable):
        if i % 100 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in usable if j != i)
            whole[q, i] = [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(x for rows in whole.values() for x in rows)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((5, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + 0.3 * rng.standard_normal(8)]) for i in range(700)]
    rows[300:330] = [(i, rows[0][1]) for i in range(300, 330)]  # ties with a query
    rows += [(800, None), (801, [1.0, None] * 4), (802, [math.nan] + [0.0] * 7), (803, [math.inf] + [0.0] * 7), (None, [1.0] * 8)]
    return rows + [(900, []), (901, [5.0]), (-100, [0.25] * 8), (5, rows[5][1])]


@pytest.mark.parametrize("k, block, blocks, group", [(10, 16, 4, 3), (3, 64, 1, 256), (1000, 256, 16, 2)])
def test_matches_brute_force(spark, vectors, k, block, blocks, group):
    df = terms(spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4))
    found = top_k(df.filter("pmod(id, 100) = 0"), df, k, block, blocks, group, salts=3)
    assert sorted(map(tuple, found.collect())) == brute(vectors, k)


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(0)
    q, rows = np.floor(rng.standard_normal((9, 6)) * 1e4), np.floor(rng.standard_normal((40, 5)) * 1e4)
    high, low = rows.reshape(4, 10, 5).max(1), rows.reshape(4, 10, 5).min(1)
    scores = products(q, rows).reshape(9, 4, 10)
    assert (scores.max(2) <= bounds(q, high, low) + 1e-6).all()
    big = np.array([[2.0**40 + 1, 3.0]])
    assert products(big, big)[0, 0] == 2**63 - 1
    assert products(big, np.array([[5.0, 1.0]]))[0, 0] == 5 * (2**40 + 1) + 3


def test_edges(spark):
    none = terms(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    one = terms(spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<double>"))
    assert top_k(none, one).count() == 0 and top_k(one, none).count() == 0 and top_k(one, one).count() == 0
