"""Near-duplicate documents: one-permutation hashing, banded buckets, star edges, full-set verification."""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.clusters import spanning_links
from panelcast.llm.common import Scratch
from panelcast.llm.features import MIX, TURN, Words
from panelcast.llm.graph import connected_components


def shingle_set(text: bytes | None, memo: Words, size: int = 5) -> np.ndarray:
    """Sorted unique 64-bit hashes of the text's shingles of ``size`` words; one of the whole sequence if shorter."""
    memo.trim()
    at = memo.numbers(text)
    if not len(at):
        return np.zeros(0, np.uint64)
    word = memo.word[at]
    count = max(1, len(word) - size + 1)
    mixed = np.full(count, len(word) if len(word) < size else 0, np.uint64)
    for k in range(min(size, len(word))):
        mixed = mixed * MIX + word[k : k + count]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * TURN
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


@dataclass(frozen=True)
class Bands:
    """Layout of a signature. Two sets of similarity s meet in a band with probability ``s ** rows``: with
    48 bands of 6, all bands miss 1 of 2 million pairs at 0.80 and 1 of 7 billion at 0.85."""

    bands: int = 48
    rows: int = 6

    @cached_property
    def ranks(self) -> np.ndarray:
        """For every bin, a random order of the bins to borrow from when it is empty."""
        k = self.bands * self.rows
        return np.random.default_rng(7).random((k, k), dtype=np.float32)

    def keys(self, found: np.ndarray) -> np.ndarray:
        """Band keys of a non-empty sorted hash set.

        One permutation: the top of a hash names its bin, and the smallest hash of a bin is its value.
        An empty bin takes the value of the filled bin that comes first in its own random order, which
        keeps the collision probability of a full bin (optimal densification).
        """
        k = self.bands * self.rows
        bins = (((found >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        filled = bins[first]
        values = np.zeros(k, np.uint64)
        values[filled] = found[first]
        if len(filled) < k:
            empty = np.setdiff1d(np.arange(k), filled, assume_unique=True)
            values[empty] = values[filled[self.ranks[np.ix_(empty, filled)].argmin(1)]]
        values = (values ^ (values >> np.uint64(30))) * TURN
        rows = values.reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        for i in range(self.rows):
            key = (key ^ (key >> np.uint64(31))) * MIX + rows[:, i]
        return (key ^ (key >> np.uint64(32))).astype(np.int64)


def _signer(layout: Bands, size: int):
    @F.pandas_udf("n long, k1 long, k2 long, bands array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = Words()
        for texts in batches:
            out = []
            for text in texts:
                found = shingle_set(text, memo, size)
                if len(found):
                    k1, k2 = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "int64")
                    out.append((len(found), k1, k2, layout.keys(found)))
                else:
                    out.append((0, 0, 0, np.zeros(0, np.int64)))
            yield pd.DataFrame(out, columns=["n", "k1", "k2", "bands"])

    return sign


def _set_bytes(size: int):
    @F.pandas_udf("binary")
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = Words()
        for texts in batches:
            yield pd.Series([shingle_set(t, memo, size).tobytes() for t in texts], dtype=object)

    return pack


def write_sets(base: DataFrame, wanted: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """``(node, set)``: the packed shingle sets of the wanted nodes (``node``, ``d``, ``h``), found again by id and text hash."""
    rows = base.join(wanted, (F.col("doc_id") == F.col("d")) & (F.col("text_hash") == F.col("h"))).dropDuplicates(["node"])
    return scratch.stage(rows.select("node", _set_bytes(size)("bytes").alias("set")), "shingle-sets")


def named_components(signed: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n``, ``component_id`` of every signed row, from the links between class nodes."""
    names = classes.join(connected_components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = names.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = names.join(least, "component").select("k1", "k2", "component_id")
    linked = signed.filter("n > 0 AND doc_id IS NOT NULL")
    alone = signed.filter("n = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    rows = linked.join(named, ["k1", "k2"]).select("doc_id", "text_hash", "n", "component_id")
    return rows.unionByName(alone.select("doc_id", "text_hash", "n", "component_id"))


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    layout: Bands = Bands(),
    size: int = 5,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: its id (``doc_id``), ``text_hash``, ``n_shingles``, ``component_id``, ``kept``.

    Rows are linked when the shares of their shingle sets agree to ``percent``; a component is named by
    its smallest id, and the rows with that id are ``kept``.

    1. Equal sets (128-bit digests) form classes; only one text of a class goes on, so a group of exact
       copies is one node however large.
    2. Nodes meet in the buckets of their bands. Every bucket with two nodes or more offers star-shaped candidate
       edges from its smallest node, one a member.
    3. The full sets of all nodes that met are compared by ``clusters.spanning_links``: every link between them,
       those between two members of a star included, is found or stood for by a path of found ones.

    Null ids take no part: they are kept, without a component. Null, empty and blank texts have an empty
    set and are components of their own. Rows that share an id are rows of their own. Texts count whole,
    however long. Other columns are not read, whatever their names. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    base = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).cast("binary").alias("bytes"))
    signed = base.select("doc_id", "text_hash", _signer(layout, size)("bytes").alias("s")).select("doc_id", "text_hash", "s.*")
    signed = scratch.stage(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    linked = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = linked.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"))
    classes = scratch.stage(classes, "classes")
    nodes = linked.join(classes.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "doc_id", "text_hash", "n", "bands")

    each = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = each.groupBy("bucket").agg(F.count("*").alias("members"), F.min("node").alias("centre")).filter("members > 1")
    met = each.join(buckets, "bucket").filter("node != centre").select(F.col("node").alias("u"), F.col("centre").alias("v"))
    met = scratch.stage(met.distinct(), "met")
    seen = met.select(F.col("u").alias("node")).union(met.select("v")).distinct()
    wanted = nodes.join(seen, "node").select("node", F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    sets = write_sets(base, wanted, size, scratch)
    links = scratch.stage(spanning_links(met, sets, percent, scratch), "all-links")
    scratch.drop(met, sets)
    return named_components(signed, classes, links).select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Rows that share that id and the text are one; all columns stay as they are.
    """
    kept = near_duplicates(docs, text=text, key=key, **options).filter("kept")
    kept = kept.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    hashed = docs.withColumn("__text_hash", F.xxhash64(F.col(text)))
    same = F.col(key).eqNullSafe(F.col("__doc")) & (F.col("__text_hash") == F.col("__hash"))
    known = hashed.join(kept, same, "left_semi")
    named, nameless = known.filter(F.col(key).isNotNull()), known.filter(F.col(key).isNull())
    return named.dropDuplicates([key, "__text_hash"]).unionByName(nameless).select(*docs.columns)
