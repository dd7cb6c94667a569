"""One query per operator over whole tables, and SQL for those that SQL can express."""

from pyspark.sql import functions as F

from panelcast.llm import brown, decontaminate, licenses, line_dedup, minhash, mixing, phrases, quality, sharding, sketch_join, topk, toxicity, whitening
from panelcast.llm.common import fold, n_words, table
from panelcast.session import stage


def op1_mixing(spark, sf_dir):
    """Every document with its words, its source's target and the words the mixture takes of it."""
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size"))
    sized = stage(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    taken = mixing.mix_spans(sized, tie="row").groupBy("row").agg(F.sum("n_taken").alias("taken"))
    targets = mixing.source_targets(sized.select("source", "size")).withColumnRenamed("source", "of")
    return (
        sized.join(taken, "row", "left")
        .join(targets, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def op2_line_dedup(spark, sf_dir):
    """Lines before and after, and the digest of what is kept, per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = line_dedup.drop_repeated_lines(docs)
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_sharding(spark, sf_dir):
    """Every document's shard and its place in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.byte_shards(docs, 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_license_scan(spark, sf_dir):
    """Every license wording in the documents, with its place and its differences."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_minhash(spark, sf_dir):
    """Every document's shingle count and the smallest id of its near-duplicate component."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_topk(spark, sf_dir):
    """The ten nearest vectors of every hundredth vector among all others, by integer inner product."""
    vectors = topk.terms(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter("pmod(id, 100) = 0"), vectors)


def op6_language_model(spark, sf_dir):
    """Log probability of every document under a class model learnt from nine tenths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 10) == 0
    scored = brown.score_documents(docs, ~held_out)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item: the best window for each item."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", F.round("similarity", 9).alias("similarity"))


def op8_quality(spark, sf_dir):
    """Quality of every document, learnt from the labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, labels.filter(~held_out).select("doc_id", "quality"))
    scored = docs.select("doc_id", held_out.alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from confirmed toxic and unlabelled texts outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    known = labels.filter(~held_out)
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    model = toxicity.fit(docs.filter(~held_out), known.filter("toxic = 1").select("doc_id"), prior)
    scored = docs.select("doc_id", held_out.alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op11_sketch_join(spark, sf_dir):
    """Every document's count of three-word shingles and the smallest id that links of 0.9 reach."""
    found = sketch_join.similarity_components(table(spark, sf_dir, "documents"), 90, 3)
    return found.select("doc_id", "n_shingles", "component_id")


def op12_whitening(spark, sf_dir):
    """Every usable vector on the sixteen leading components of all distinct ones, with unit variance on each."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 16).withColumn("deviation", F.col("deviation").cast("long"))


def op13_phrases(spark, sf_dir):
    """The 2 000 best collocations of every language in the documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_minhash": op4_minhash,
    "op5_topk": op5_topk,
    "op6_language_model": op6_language_model,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
    "op11_sketch_join": op11_sketch_join,
    "op12_whitening": op12_whitening,
    "op13_phrases": op13_phrases,
}

ORACLES = {
    "op2_line_dedup": r"""
    WITH l AS (
      SELECT doc_id, i, line,
        translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
    f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT l.*, f.k IS NOT NULL AND doc_id <> last AS lost FROM l LEFT JOIN f USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
    "op4_minhash": r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
        ELSE array_to_string(w[i:i + 4], ' ') END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id, min(reached) = r.doc_id AS kept
    FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
    """,
    "op11_sketch_join": r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
        ELSE array_to_string(w[i:i + 2], ' ') END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id
    FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
    """,
    "op7_decontamination": r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
    bs AS (SELECT item_id, len(w) AS m, i - 1 AS o, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM b WHERE len(w) >= 5)),
    ds AS (SELECT doc_id, n, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT *, len(w) AS n, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
    win AS (SELECT DISTINCT doc_id, item_id, m, least(m, n) AS len, greatest(0, least(p - o, n - m)) AS start
      FROM ds JOIN bs USING (s)),
    bc AS (SELECT item_id, s, count(*) AS k FROM bs GROUP BY ALL),
    wc AS (SELECT win.doc_id, win.item_id, m, len, start, s, count(*) AS k FROM win
      JOIN ds ON ds.doc_id = win.doc_id AND p BETWEEN start AND start + len - 5 GROUP BY ALL),
    x AS (SELECT doc_id, wc.item_id, m, len, start, sum(least(wc.k, bc.k)) AS both_k
      FROM wc JOIN bc ON bc.item_id = wc.item_id AND bc.s = wc.s GROUP BY ALL),
    y AS (SELECT *, both_k / (len - 4 + m - 4 - both_k) AS sim FROM x WHERE 100 * both_k >= 80 * (len - 4 + m - 4 - both_k))
    SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(m AS INTEGER) AS n_words, round(sim, 9) AS similarity FROM y
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY sim DESC, start) = 1
    """,
    "op13_phrases": r"""
    WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
      FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
    n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    g AS (SELECT lang, size, w[i:i + size - 1] AS p, count(*) AS f
      FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, 6) AS s(size))
      GROUP BY ALL HAVING count(*) >= 100),
    c AS (SELECT c.lang, c.size, c.p, c.f AS a, x.f AS l, y.f AS r, n.n, k,
        CAST((1000 * CAST(c.f AS HUGEINT) * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, size)) AS k FROM g WHERE size > 1) c
      JOIN g x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN g y ON y.lang = c.lang AND y.p = c.p[k + 1:c.size]
      JOIN n ON n.lang = c.lang
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.p ORDER BY score, k) = 1),
    d AS (SELECT DISTINCT lang, q AS p, f FROM (
      SELECT lang, size, f, w, p[i:i + w - 1] AS q FROM (SELECT *, unnest(range(1, size - w + 2)) AS i
        FROM g, range(2, 5) AS s(w) WHERE w < size)))
    SELECT lang, row_number() OVER o AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM c
    WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.lang = c.lang AND d.p = c.p AND d.f >= c.a)
    WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' '))
    QUALIFY row_number() OVER o <= 2000
    """,
    "op5_topk": """
    WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    bad AS (SELECT DISTINCT vec_id FROM e WHERE x IS NULL OR NOT isfinite(x)),
    v AS (SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS t FROM e
      WHERE vec_id IS NOT NULL AND vec_id NOT IN (SELECT vec_id FROM bad)),
    p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.t * c.t) AS BIGINT) AS score
      FROM v q JOIN v c ON q.i = c.i AND q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id GROUP BY ALL)
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
    """,
}
