import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelcast.llm.line_dedup import LineRuns, drop_repeated_lines

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=20, min_docs=3):
    """Rows are documents; a key stays in the largest id."""
    keys, out = defaultdict(list), []
    split = [(d, (t or "").split("\n")) for d, t in rows]
    for doc, lines in split:
        for key in {line.strip(SPACES).translate(LOWER) for line in lines}:
            if len(key) >= least:
                keys[key].append(doc)
    last = {k: max((d for d in ids if d is not None), default=None) for k, ids in keys.items() if len(ids) >= min_docs}
    for doc, lines in split:
        kept = [x for x in lines if (k := x.strip(SPACES).translate(LOWER)) not in last or last[k] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("h")).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("batches", [1, 4])
def test_matches_brute_force(docs, rows, batches):
    assert got(drop_repeated_lines(docs, batches=batches)) == brute([r[:2] for r in rows])


def test_positions_ends_and_case(spark):
    line = "the same long line here"
    texts = [line, f"{line}\nb\n", f"a\n {line.upper()}\t\n{line}\n\nc", f"\n{line}", line + "\n" + line, "É" + line, "x" * 30]
    rows = list(enumerate(texts)) + [(None, line), (9, None)]
    assert got(drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_runs_merge_and_leave_out_decided_keys(spark):
    runs = LineRuns(spark, min_docs=3)
    for ids in ((9, 8), (7, 6), (5,), (4,)):
        each = [(k, i) for i in ids for k in ("a", f"k{i}")]
        runs.add(spark.createDataFrame(each, "key string, doc_id long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    table = {r.key: (r.n, r.last) for r in spark.table(runs.runs()[0]).collect()}
    assert table["a"] == (4, 9) and table["k5"] == (1, 5)
    assert [tuple(r) for r in runs.repeated().collect()] == [("a", 9)]


def test_edges(no_docs, clashing, rows):
    assert drop_repeated_lines(no_docs).count() == 0
    out = drop_repeated_lines(clashing)
    assert out.count() == len(rows) and out.filter("keys <> 'theirs' OR hash <> 'theirs'").isEmpty()
