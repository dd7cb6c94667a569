"""Exact top-k inner-product search by block-at-a-time pruning."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import stage

BLOCK_ROWS, CHUNK_BLOCKS, GROUP, SALTS = 256, 16, 256, 64
CHUNK = "chunk long, ids binary, width int, forward binary, maxima binary, minima binary"


def terms(vectors: DataFrame, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, terms)``: ``floor(scale * component)`` of the vectors without a null or non-finite component.

    Rows with a null id, null vector or such a component are left out; an empty vector has no terms.
    """
    limit = F.lit(float("inf"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < limit))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), sound.alias("sound"))
    # Spark's floor gives a long; components beyond its range are integers already.
    whole = F.transform("v", lambda x: F.when(F.abs(x.cast("double") * scale) < 2.0**53, F.floor(x.cast("double") * scale).cast("double")).otherwise(x.cast("double") * scale))
    return rows.filter("id IS NOT NULL AND sound").select("id", whole.alias("terms"))


def matrix(rows, width: int = 0) -> np.ndarray:
    """Rows of unequal length as one matrix, padded with zeros."""
    width = max([width, *(len(r) for r in rows)], default=width)
    out = np.zeros((len(rows), width))
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def _range_code(bits: int = 16):
    """Signs of fixed random projections: a place in an order in which alike vectors are neighbours."""

    @F.pandas_udf("int")
    def code(rows: pd.Series) -> pd.Series:
        m = matrix(list(rows))
        planes = np.random.default_rng(5).standard_normal((1 << 12, bits))
        signs = sum(m[:, a : a + 4096] @ planes[: m[:, a : a + 4096].shape[1]] for a in range(0, max(1, m.shape[1]), 4096)) > 0
        return pd.Series((signs * (1 << np.arange(bits))[::-1]).sum(1).astype("int32"))

    return code


def _packer(block: int, blocks: int):
    def pack(frames):
        seq, ids, rows = TaskContext.get().partitionId() << 32, [], []

        def flush():
            m = matrix(rows)
            if (m.astype(np.float32) == m).all():
                m = m.astype(np.float32)
            starts = np.arange(0, len(m), block)
            high, low = (f.reduceat(m, starts, axis=0) if m.shape[1] else m[: len(starts)] for f in (np.maximum, np.minimum))
            cells = [seq, np.array(ids, np.int64).tobytes(), m.shape[1], m.tobytes(), high.astype(float).tobytes(), low.astype(float).tobytes()]
            types = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], [c.split()[0] for c in CHUNK.split(", ")])

        for frame in frames:
            for key, row in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
                ids.append(key)
                rows.append(row)
                if len(ids) == block * blocks:
                    yield flush()
                    seq, ids, rows = seq + 1, [], []
        if ids:
            yield flush()

    return pack


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Upper bound of every query's score in every block: each term's best product, summed."""
    width = max(queries.shape[1], high.shape[1])
    q, h, l = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, high, low))
    total = np.maximum(q, 0) @ h.T + np.minimum(q, 0) @ l.T
    # Sums beyond 2 ** 53 are rounded; the bound stays one.
    return total + np.abs(total) * 1e-9


def _best_blocks(frames):
    """The highest bound that each query has in each chunk."""
    for frame in frames:
        for q, rows, chunk, width, high, low in zip(*(frame[c] for c in ("queries", "vectors", "chunk", "width", "maxima", "minima"))):
            high, low = (np.frombuffer(x).reshape(-1, width) if width else np.zeros((1, 0)) for x in (high, low))
            best = bounds(matrix(list(rows)), high, low).max(1)
            yield pd.DataFrame({"q": q, "chunk": chunk, "bound": best})


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where that is exact, in Python integers otherwise, kept
    within 64 bits."""
    width = max(queries.shape[1], rows.shape[1])
    q, r = (np.pad(x.astype(float), ((0, 0), (0, width - x.shape[1]))) for x in (queries, rows))
    if not width or np.abs(q).max(initial=0) * np.abs(r).max(initial=0) * width < 2**53:
        return (q @ r.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(r).T, -(2**63), 2**63 - 1).astype(np.int64)


def _search(k: int, block: int):
    columns = ["q", "vec_id", "score"]

    def search(key, asked: pd.DataFrame, chunks: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(chunks):
            return pd.DataFrame(columns=columns)
        row, m = chunks.iloc[0], matrix(list(asked["terms"]))
        width, ids = int(row["width"]), np.frombuffer(row["ids"], np.int64)
        kind = np.float32 if len(row["forward"]) == 4 * width * len(ids) else np.float64
        forward = np.frombuffer(row["forward"], kind).reshape(len(ids), width)
        high, low = (np.frombuffer(x).reshape(-1, width) if width else np.zeros((-(-len(ids) // block), 0)) for x in (row["maxima"], row["minima"]))
        limit, own = bounds(m, high, low), asked["id"].to_numpy()
        kth = asked["floor"].to_numpy(dtype=float, copy=True)  # NaN: no floor yet
        kth[np.isnan(kth)] = -np.inf
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(m)
        rank = np.argsort(-limit, axis=1, kind="stable")
        for turn in range(limit.shape[1]):
            at = rank[:, turn]
            live = np.flatnonzero(limit[np.arange(len(m)), at] >= kth)
            if not len(live):
                break  # blocks come by falling bounds: the rest is lower still
            for b in np.unique(at[live]):
                who, part = live[at[live] == b], slice(b * block, (b + 1) * block)
                scores = products(m[who], forward[part])
                for i, row_scores in zip(who, scores):
                    use = np.flatnonzero((row_scores >= kth[i]) & (ids[part] != own[i]))
                    s, v = np.append(best[i][0], row_scores[use]), np.append(best[i][1], ids[part][use])
                    top = np.lexsort((v, -s))[:k]
                    best[i] = s[top], v[top]
                    if len(top) == k:
                        kth[i] = max(kth[i], float(s[top[-1]]))
        sizes = [len(s) for s, _ in best]
        return pd.DataFrame(
            {
                "q": np.repeat(asked["q"].to_numpy(), sizes),
                "vec_id": np.concatenate([v for _, v in best]),
                "score": np.concatenate([s for s, _ in best]),
            }
        )

    return search


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 10, block: int = BLOCK_ROWS, blocks: int = CHUNK_BLOCKS, group: int = GROUP, salts: int = SALTS
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest inner products, ties to smaller ids.

    ``queries`` and ``candidates`` are ``(id, terms)`` as ``terms`` gives them. Candidates are cut into
    blocks of an order in which alike vectors are neighbours; a block keeps its forward index and, per
    term, its largest and smallest value. ``blocks`` of them make a chunk, the unit that moves.

    1. Every query gets an upper bound for every chunk from the terms' extremes alone: queries come in
       groups and meet each chunk's extremes once, through an equi-join on a chunk's salt.
    2. Each query searches the chunk with its highest bound; its k-th score there is a floor.
    3. Chunks whose bound is under a query's floor are out. The others are searched in groups of queries,
       block after block by falling bound, until the bound falls under the k-th score.

    No query, chunk or result set is ever whole in one place; a chunk asked for by very many queries is
    searched in as many groups. Vectors of unequal length are padded with zeros. Rows that have the
    query's id are not its candidates. A repeated query row is answered again; a repeated candidate row
    counts again. Fewer than ``k`` candidates: all of them. Empty tables give no rows.
    """
    packed = candidates.withColumn("code", _range_code()("terms")).repartitionByRange("code", "id").sortWithinPartitions("code", "id")
    chunks = stage(packed.select("id", "terms").mapInArrow(_packer(block, blocks), CHUNK), "blocks")
    asked = stage(queries.select("id", "terms").withColumn("q", F.monotonically_increasing_id()), "queries")
    groups = max(1, -(-asked.count() // group))
    asked_groups = asked.groupBy((F.xxhash64("q") % groups).alias("g")).agg(F.sort_array(F.collect_list(F.struct("q", "terms"))).alias("rows"))
    asked_groups = asked_groups.select(F.col("rows.q").alias("queries"), F.col("rows.terms").alias("vectors"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    extremes = chunks.select("chunk", "width", "maxima", "minima", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int").alias("salt"))
    met = asked_groups.join(extremes.hint("shuffle_hash"), "salt").drop("salt")
    limits = stage(met.mapInPandas(_best_blocks, "q long, chunk long, bound double"), "bounds")

    def searched(pairs: DataFrame) -> DataFrame:
        """Search the chunk of each ``(q, chunk, floor)``."""
        sized = pairs.groupBy("chunk").agg(F.ceil(F.count("*") / group).cast("int").alias("parts"))
        sized = stage(sized, "asked-chunks")
        rows = pairs.join(sized, "chunk").join(asked, "q")
        rows = rows.select("chunk", F.pmod(F.xxhash64("q", F.lit(1)), F.col("parts")).cast("int").alias("part"), "q", "id", "terms", "floor")
        given = chunks.join(sized, "chunk").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        return rows.groupBy("chunk", "part").cogroup(given.groupBy("chunk", "part")).applyInPandas(_search(k, block), "q long, vec_id long, score long")

    first = limits.groupBy("q").agg(F.max_by(F.struct("chunk"), F.struct("bound", "chunk")).alias("best")).select("q", F.col("best.chunk").alias("chunk"))
    first = stage(first, "first-chunks")
    found = stage(searched(first.withColumn("floor", F.lit(None).cast("double"))), "first-scores")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id"))
    floors = found.withColumn("place", place).filter(F.col("place") == k).select("q", F.col("score").cast("double").alias("floor"))
    rest = limits.join(first.withColumn("done", F.lit(True)), ["q", "chunk"], "left").filter("done IS NULL")
    rest = rest.join(floors, "q", "left").filter("floor IS NULL OR bound >= floor").select("q", "chunk", "floor")
    every = found.unionByName(searched(stage(rest, "open-chunks")))
    ranked = every.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.join(asked.select("q", F.col("id").alias("query_id")), "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
