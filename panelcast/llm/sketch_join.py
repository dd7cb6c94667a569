"""Similarity join of shingle sets by parity sketches: blocks of a sketch that agree, size band by size band."""

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.clusters import spanning_links
from panelcast.llm.common import Scratch
from panelcast.llm.features import MIX, TURN, Words
from panelcast.llm.minhash import named_components, shingle_set, write_sets


@dataclass
class SizeBands:
    """Size bands for a similarity of ``percent``. A band holds the pairs whose larger set has ``low`` to ``high`` hashes.

    Linked sets of a band differ in at most ``differ`` hashes, which touch at most as many of its ``blocks``; ``spare``
    more blocks are left for blocks that are empty in both.
    """

    percent: int
    starts: list[int] = field(default_factory=lambda: [1])

    def _start(self, band: int) -> int:
        while len(self.starts) <= band:
            self.starts.append(max(self.starts[-1] + 1, -(-self.starts[-1] * 5 // 4)))
        return self.starts[band]

    def differ(self, band: int) -> int:
        return 2 * (self._start(band + 1) - 1) * (100 - self.percent) // (100 + self.percent)

    def spare(self, band: int) -> int:
        return 2 + self.differ(band) // 16

    def blocks(self, band: int) -> int:
        return self.differ(band) + 1 + self.spare(band)

    def of(self, n: int) -> list[int]:
        """Bands in which a set of ``n`` hashes can be linked with another set: as the larger one in its own, as the smaller
        one in those above. Bands of such small sets that linked ones must be equal are left out."""
        while self.starts[-1] <= n:
            self._start(len(self.starts))
        own = bisect_right(self.starts, n) - 1
        found, band = [], own
        while band == own or 100 * n >= self.percent * self._start(band):
            if self.differ(band):
                found.append(band)
            band += 1
        return found

    def sketch(self, found: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
        """``(bits, keys)`` of a sorted hash set in a band.

        A hash belongs to one block and flips one of its 64 bits, so two sketches differ in no more bits than the sets
        in hashes. The key of a block is its bits with the XOR of its hashes, hashed with band and place: blocks without
        a hash that only one set holds have equal keys. Empty blocks have a key only in a set with more than ``spare``
        of them: two sets with no other equal block both have as many.
        """
        k = self.blocks(band)
        block = (((found >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        bits, checks = np.zeros(k, np.uint64), np.zeros(k, np.uint64)
        bits[block[first]] = np.bitwise_xor.reduceat(np.uint64(1) << (found & np.uint64(63)), first)
        checks[block[first]] = np.bitwise_xor.reduceat(found, first)
        keys = (np.arange(k, dtype=np.uint64) + np.uint64(band << 32)) * MIX ^ bits
        keys = (keys ^ (keys >> np.uint64(31))) * TURN + checks
        keys = ((keys ^ (keys >> np.uint64(29))) * MIX).view(np.int64)
        if k - len(first) <= self.spare(band):
            keys = keys[block[first]]
        return bits.view(np.int64), keys


def _sketched(base: DataFrame, percent: int, size: int) -> DataFrame:
    """One row per row and size band (``band`` null where it has none): ``row``, ``doc_id``, ``text_hash``, ``n``, digest ``k1``
    and ``k2``, ``main`` for the first one of a row, ``bits``, ``keys``."""
    kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields if f.name != "bytes"}
    kinds |= dict(n="long", k1="long", k2="long", main="boolean", band="int", bits="array<long>", keys="array<long>")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, bands = Words(), SizeBands(percent)
        for batch in batches:
            at, rows, bits, keys = [], [], [], []
            for i, text in enumerate(batch.column("bytes").to_pylist()):
                found = shingle_set(text, memo, size)
                k1, k2 = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "int64").tolist() if len(found) else (0, 0)
                for turn, band in enumerate(bands.of(len(found)) or [None] if len(found) else [None]):
                    at.append(i)
                    rows.append((len(found), k1, k2, turn == 0, band))
                    own = (None, None) if band is None else bands.sketch(found, band)
                    bits.append(own[0])
                    keys.append(own[1])
            same = [batch.column(name).take(pa.array(at, pa.int32())) for name in kinds if name in batch.schema.names]
            types = pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32()
            columns = zip(*rows) if rows else [()] * 5
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            lists = [pa.array(c, pa.list_(pa.int64())) for c in (bits, keys)]
            yield pa.RecordBatch.from_arrays([*same, *made, *lists], list(kinds))

    return base.mapInArrow(sketch, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))


def hamming(left: Column, right: Column) -> Column:
    """In how many bits two sketches differ."""
    differ = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("long"))
    return F.aggregate(differ, F.lit(0).cast("long"), lambda total, n: total + n)


def _met(sketches: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``(u, v)``: nodes that have a block in common.

    Where a block has two nodes alone, their whole sketches are compared first: a Hamming distance above what a link
    allows rules the pair out. A block with more gives one edge a member, to its smallest node.
    """
    each = sketches.select("node", "band", F.explode("keys").alias("key"))
    blocks = each.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("least"), F.max("node").alias("most"), F.min("band").alias("band"))
    blocks = scratch.stage(blocks.filter("least < most"), "blocks")
    pairs = blocks.filter("members = 2").select("band", F.col("least").alias("u"), F.col("most").alias("v")).distinct()
    u = sketches.select("band", F.col("node").alias("u"), F.col("n").alias("u_n"), F.col("bits").alias("u_bits"))
    v = sketches.select("band", F.col("node").alias("v"), F.col("n").alias("v_n"), F.col("bits").alias("v_bits"))
    near = (100 + percent) * hamming(F.col("u_bits"), F.col("v_bits")) <= (100 - percent) * (F.col("u_n") + F.col("v_n"))
    pairs = pairs.join(u, ["band", "u"]).join(v, ["band", "v"]).filter(near).select("u", "v")
    large = blocks.filter("members > 2").select("key", F.col("least").alias("v"))
    stars = each.join(large, "key").filter("node != v").select(F.col("node").alias("u"), "v")
    return scratch.stage(pairs.union(stars).distinct(), "met")


def similarity_components(
    docs: DataFrame, percent: int = 80, size: int = 5, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: its id (``doc_id``), ``text_hash``, ``n_shingles``, ``component_id``.

    A row's set holds the distinct shingles of ``size`` words (A-Z lower-cased; the whole sequence where there are fewer
    words). Rows are linked where 100 times the shared shingles reach ``percent`` times all of both; a component is named
    by its smallest id. The join is exact: no link is left to chance.

    1. Equal sets (128-bit digests) form classes; one text of a class goes on, so a group of copies is one node.
    2. Every node gets a parity sketch (``SizeBands``) in its own size band, and in those above whose sets it can be
       linked with. Linked sets differ in at most ``differ`` hashes, so one of ``differ`` + 1 blocks agrees (pigeonhole):
       nodes are joined by equal blocks, and pairs whose sketches are further apart than a link allows are dropped.
    3. The full sets of the nodes that met are compared by ``clusters.spanning_links``, without all pairs of a group.

    Null ids take no part and are components of their own (null). Null, empty and blank texts have an empty set and are
    linked with nothing. Rows that share an id are rows of their own; repeated rows come back as often. Texts count whole,
    however long: a sketch grows with its set. Other columns are not read, whatever their names. An empty table gives no
    rows.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0, at most 100")
    scratch = Scratch(docs.sparkSession)
    base = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).cast("binary").alias("bytes"))
    sketched = scratch.stage(_sketched(base.withColumn("row", F.monotonically_increasing_id()), percent, size), "sketches")
    signed = sketched.filter("main").select("row", "doc_id", "text_hash", "n", "k1", "k2")
    linked = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = linked.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"))
    classes = scratch.stage(classes, "classes")
    nodes = sketched.join(classes.select(F.col("node").alias("row")), "row").withColumnRenamed("row", "node")
    met = _met(nodes.filter("band IS NOT NULL").select("node", "n", "band", "bits", "keys"), percent, scratch)
    seen = met.select(F.col("u").alias("node")).union(met.select("v")).distinct()
    wanted = nodes.filter("main").join(seen, "node").select("node", F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    sets = write_sets(base, wanted, size, scratch)
    links = scratch.stage(spanning_links(met, sets, percent, scratch), "all-links")
    return named_components(signed, classes, links).select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id")
