"""Phrase collocations from a prefix-free parse.

Texts are cut into overlapping chunks where their own content says so; equal passages give equal chunks wherever
they stand, so phrases are counted once per distinct chunk, weighted with the chunk's frequency in the parse.

Words are numbered once, in blocks of chunks. Before phrases are counted as text, sums of their hashes in a fixed
number of cells show which cannot be frequent; most phrases are rare, and none of those travels as text.
"""

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Scratch
from panelcast.llm.features import MIX, TURN

# What ends a piece, and the blank between words that is not a space.
_STOPS, _TAB = b".,;:!?\n\x0b\x0c\r", b"\t"
STOP = b"."
_FOLDED = bytes.maketrans(_STOPS + _TAB, STOP * len(_STOPS) + b" ")
BATCH_BYTES = 1 << 23
# Hashes that a task gathers before it sorts them, and parts of the cells that are summed one by one.
HELD_HASHES, SHARES = 1 << 21, 64
# Places whose hashes are worked out at once: as many as stay in a core's cache.
NEAR = 1 << 15


def pieces(text: bytes | None) -> bytes:
    """Words of a text with A-Z lower-cased, and a ``STOP`` wherever a piece ends, with single spaces between."""
    if not text:
        return b""
    spaced = text.lower().translate(_FOLDED).replace(STOP, b" . ")
    while b"  " in spaced:
        spaced = spaced.replace(b"  ", b" ")
    return spaced.strip(b" ")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(words, lengths, vocabulary)``: the number of every word of all texts, words per text, the words by number."""
    split = pc.split_pattern(texts, pattern=b" ")
    coded = pc.dictionary_encode(split.flatten())
    return coded.indices.to_numpy().astype(np.int64), split.value_lengths().to_numpy().astype(np.int64), coded.dictionary


def _listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def rolled(hashes: np.ndarray, at: np.ndarray, size: int, seed: np.ndarray | int = 0) -> np.ndarray:
    """One hash for the ``size`` words from every place in ``at``."""
    out, seed = np.empty(len(at), np.uint64), np.broadcast_to(np.asarray(seed, np.uint64), len(at))
    for low in range(0, len(at), NEAR):
        here, mixed = at[low : low + NEAR], seed[low : low + NEAR]
        for k in range(size):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX + hashes[here + k]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * TURN
        out[low : low + NEAR] = mixed ^ (mixed >> np.uint64(31))
    return out


def cuts(hashes: np.ndarray, ends: np.ndarray, window: int, modulus: int) -> np.ndarray:
    """Where the chunks of texts start, which lie one after the other and end at ``ends``: at the first word of each and at
    triggers, windows of words whose hash is 0 modulo ``modulus``. A chunk runs to the end of the next trigger, so
    neighbours share a window."""
    firsts = np.concatenate([[0], ends[:-1]])
    inside = np.ones(len(hashes) + 1, bool)
    inside[firsts] = False
    for k in range(window):
        inside[np.maximum(ends - k, 0)] = False
    places = np.flatnonzero(inside[: len(hashes)])
    triggers = places[rolled(hashes, places, window) % np.uint64(modulus) == 0]
    return np.sort(np.concatenate([firsts, triggers]))


def _cut(batch: pa.RecordBatch, window: int, modulus: int) -> pa.RecordBatch:
    """The chunks of a batch of (lang, text)."""
    texts = [pieces(text) for text in batch.column(1).to_pylist()]
    kept = np.flatnonzero([len(t) > 0 for t in texts])
    texts = [texts[i] for i in kept]
    words, lengths, vocabulary = numbered(pa.array(texts, pa.binary()))
    ends = np.cumsum(lengths)
    starts = cuts(word_hashes(_listed(vocabulary))[words], ends, window, modulus) if len(words) else ends
    text = np.searchsorted(ends, starts, "right")
    last = np.append(text[1:] != text[:-1], True)[: len(starts)]
    own_end = np.where(last, ends[text], np.append(starts[1:], 0)[: len(starts)])
    # Byte places within the texts: every word is followed by one space.
    sizes = pc.binary_length(vocabulary).to_numpy()[words] + 1
    byte = np.concatenate([[0], np.cumsum(sizes)])
    origin = byte[np.concatenate([[0], ends])][text]
    begin, until = byte[starts] - origin, byte[np.where(last, own_end, own_end + window)] - origin - 1
    chunk = [texts[t][b:e] for t, b, e in zip(text.tolist(), begin.tolist(), until.tolist())]
    stop = pc.index(vocabulary, pa.scalar(STOP, pa.binary())).as_py()
    before = np.concatenate([[0], np.cumsum(words != stop)])
    owned = (before[own_end] - before[starts]).astype(np.int32)
    columns = [batch.column(0).take(pa.array(kept[text])), pa.array(chunk, pa.binary()), pa.array(last), pa.array(owned)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "last", "n_words"])


def parse(docs: DataFrame, max_words: int, modulus: int, text: str, lang: str) -> DataFrame:
    """The dictionary: distinct ``chunk`` per ``lang`` with its frequency ``times`` and ``n_words``, the words it owns.

    A chunk owns all its words but the window it shares with the next chunk; the last one of a text owns all.
    """
    window = max_words - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 1_000):
                yield _cut(batch.slice(low, 1_000), window, modulus)

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    rows = rows.mapInArrow(cut, "lang string, chunk binary, last boolean, n_words int")
    return rows.groupBy("lang", "chunk", "last", "n_words").agg(F.count("*").alias("times"))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers by their lowest bytes, then the next ones and so on, compressed."""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


_BLOCK = "lang string, n long, vocabulary binary, words binary, lengths binary, last binary, times binary"


def _block(chunks: pa.Table) -> pa.RecordBatch:
    """Chunks of one lang as a row: their words as numbers, one after the other, and what the numbers mean."""
    words, lengths, vocabulary = numbered(chunks.column("chunk").combine_chunks())
    times = chunks.column("times").to_numpy()
    row = {
        "lang": chunks.column("lang")[0].as_py(),
        "n": int((times * chunks.column("n_words").to_numpy()).sum()),
        "vocabulary": b" ".join(_listed(vocabulary)),
        "words": _packed(words.astype(np.int32)),
        "lengths": _packed(lengths),
        "last": _packed(chunks.column("last").to_numpy()),
        "times": _packed(times),
    }
    kinds = [pa.string(), pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row.values(), kinds)], list(row))


def encode(dictionary: DataFrame) -> DataFrame:
    """The dictionary in blocks of one ``lang``, a row each, with ``n``, the words that their chunks own in the parse."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for low in range(0, len(batch), 1_000):
                rows = batch.slice(low, 1_000)
                names = pc.dictionary_encode(rows.column("lang"))
                for code, name in enumerate(names.dictionary.to_pylist()):
                    held.setdefault(name, []).append(rows.filter(pc.equal(names.indices, code)))
                size += pc.sum(pc.binary_length(rows.column("chunk"))).as_py()
                if size > BATCH_BYTES:
                    yield from (_block(pa.Table.from_batches(x)) for x in held.values())
                    held, size = {}, 0
        yield from (_block(pa.Table.from_batches(x)) for x in held.values())

    return dictionary.select("lang", "chunk", "last", "n_words", "times").mapInArrow(blocks, _BLOCK)


class Chunks(NamedTuple):
    """A block: ``words`` by number with their ``hashes``, the ``ends`` of chunks, and by chunk ``last`` and ``times``."""

    lang: str
    seed: np.uint64
    vocabulary: pa.Array
    kinds: np.ndarray
    stop: int
    words: np.ndarray
    hashes: np.ndarray
    ends: np.ndarray
    last: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, row: dict) -> "Chunks":
        listed = row["vocabulary"].split(b" ")
        kinds, words, lengths = word_hashes(listed), _unpacked(row["words"], np.int32).astype(np.int64), _unpacked(row["lengths"], np.int64)
        vocabulary = pa.array(listed, pa.binary())
        stop = pc.index(vocabulary, pa.scalar(STOP, pa.binary())).as_py()
        last, times = _unpacked(row["last"], np.bool_), np.repeat(_unpacked(row["times"], np.int64), lengths)
        return cls(row["lang"], _seeds([row["lang"]])[0], vocabulary, kinds, stop, words, kinds[words], np.cumsum(lengths), last, times)

    def hashed(self, at: np.ndarray, order: int) -> np.ndarray:
        return rolled(self.hashes, at, order, self.seed)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunks]:
    for batch in batches:
        for i in range(len(batch)):
            yield Chunks.of({name: batch.column(name)[i].as_py() for name in batch.schema.names})


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)


class Bitmap:
    """Fixed-size membership filter: it may say yes too often, never no."""

    def __init__(self, bits: int, filled: np.ndarray | None = None):
        self.bits, self.filled = bits, np.zeros(1 << (bits - 6), np.uint64) if filled is None else filled

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.filled[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    @classmethod
    def of(cls, phrases: DataFrame, order: int, bits: int) -> "Bitmap":
        """Filter of the ``order``-word phrases of each ``lang``; tasks hand on 64 bits at a time."""

        def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                names = pc.dictionary_encode(batch.column(0))
                words, _, vocabulary = numbered(batch.column(1))
                seed = _seeds(names.dictionary.to_pylist())[names.indices.to_numpy()]
                hashes = rolled(word_hashes(_listed(vocabulary))[words], np.arange(len(batch)) * order, order, seed)
                at = hashes >> np.uint64(64 - bits)
                mark = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(mark)], ["at", "mark"])

        rows = phrases.select("lang", F.col("phrase").cast("binary")).mapInArrow(marks, "at int, mark long")
        found = rows.groupBy("at").agg(F.bit_or("mark").alias("mark")).toPandas()
        made = cls(bits)
        made.filled[found["at"].to_numpy()] = found["mark"].to_numpy().view(np.uint64)
        return made


def _distinct(columns: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``(place of one row of each kind, kind of every row)`` for rows of small non-negative integers."""
    key, span = columns[0], sizes[0]
    for column, size in zip(columns[1:], sizes[1:]):
        if span * size >= 1 << 62:
            _, key = np.unique(key, return_inverse=True)
            span = len(key) + 1
        key, span = key * size + column, span * size
    _, first, kind = np.unique(key, return_index=True, return_inverse=True)
    return first, kind


def _starts(block: Chunks, orders: list[int], window: int, known: Bitmap | None, known_order: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(order, places)``: where phrases of the given numbers of words start within pieces; each start belongs to one chunk.

    With ``known``, the filter of frequent phrases of ``known_order`` words, only those that hold no other ones.
    """
    plain = block.words != block.stop
    joint = np.append(plain[:-1] & plain[1:], False)
    joint[block.ends - 1] = False
    owned = np.ones(len(plain), bool)
    for k in range(window):
        owned[block.ends[~block.last] - 1 - k] = False

    def within(size: int) -> np.ndarray:
        inside = plain.copy()
        for k in range(size - 1):
            inside[: len(inside) - k] &= joint[k:]
        return inside

    likely = None
    if known is not None and known_order == 1:
        likely = known.holds(rolled(block.kinds, np.arange(len(block.kinds)), 1, block.seed))[block.words] & plain
    elif known is not None:
        at = np.flatnonzero(within(known_order))
        likely = np.zeros(len(plain), bool)
        likely[at] = known.holds(block.hashed(at, known_order))
    for order in orders:
        starts = within(order) & owned
        for k in range(order - known_order + 1) if likely is not None else ():
            starts[: len(starts) - k] &= likely[k:]
        yield order, np.flatnonzero(starts)


def common_cells(blocks: DataFrame, orders: list[int], max_words: int, known: Bitmap, known_order: int, min_count: int, bits: int) -> Bitmap:
    """Filter of the cells, of ``2 ** bits``, whose phrases of the given numbers of words occur ``min_count`` times in
    all. Every frequent phrase is in one; a rare one only beside others.

    Tasks hand on counts by cell as bytes, in ``SHARES`` parts; no count needs to go beyond the bound.
    """
    bound, shares = max(min(min_count, 1 << 30), 1), min(SHARES, 1 << (bits - 6))
    width = (1 << bits) // shares

    def summed(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.sort(np.concatenate(keys))
        cells = (keys >> np.uint64(32)).astype(np.int64)
        firsts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        totals = np.add.reduceat(keys & np.uint64((1 << 32) - 1), firsts)
        cells, totals = cells[firsts], np.minimum(totals, bound).astype(np.uint32)
        cuts = np.searchsorted(cells, np.arange(shares + 1) * width)
        full = [i for i in range(shares) if cuts[i] < cuts[i + 1]]
        parts = [slice(cuts[i], cuts[i + 1]) for i in full]
        steps = [_packed(np.diff(cells[x], prepend=i * width).astype(np.uint32)) for i, x in zip(full, parts)]
        columns = [pa.array(full, pa.int32()), pa.array(steps, pa.binary()), pa.array([_packed(totals[x]) for x in parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["share", "steps", "totals"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for block in _blocks(batches):
            for order, at in _starts(block, orders, max_words - 1, known, known_order):
                cells = block.hashed(at, order) >> np.uint64(64 - bits)
                held.append(cells << np.uint64(32) | np.minimum(block.times[at], bound).astype(np.uint64))
            if sum(map(len, held)) > HELD_HASHES:
                yield from summed(held)
                held = []
        if sum(map(len, held)):
            yield from summed(held)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, sums = None, None

        def filled() -> pa.RecordBatch:
            marks = np.packbits(sums >= bound, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([share], pa.int32()), pa.array([marks], pa.binary())], ["share", "marks"])

        for batch in batches:
            for i, own in enumerate(batch.column("share").to_pylist()):
                if own != share:
                    if share is not None:
                        yield filled()
                    share, sums = own, np.zeros(width, np.uint32)
                at = np.cumsum(_unpacked(batch.column("steps")[i].as_py(), np.uint32), dtype=np.int64)
                sums[at] = np.minimum(sums[at] + _unpacked(batch.column("totals")[i].as_py(), np.uint32), np.uint32(bound))
        if share is not None:
            yield filled()

    counts = blocks.mapInArrow(hashed, "share int, steps binary, totals binary")
    # Sorted, so that a task needs the sums of one share at a time.
    marks = counts.repartition("share").sortWithinPartitions("share").mapInArrow(gathered, "share int, marks binary")
    made = Bitmap(bits)
    for row in marks.collect():
        made.filled[row.share * width // 64 : (row.share + 1) * width // 64] = np.frombuffer(row.marks, np.uint64)
    return made


def _totals(block: Chunks, at: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The words, by number, of the phrases that start at ``at``, and how often each occurs."""
    columns, times, size = [block.words[at + k] for k in range(order)], block.times[at], len(block.vocabulary)
    if order == 1:
        totals = np.zeros(size, np.int64)
        np.add.at(totals, columns[0], times)
        kinds = np.flatnonzero(totals)
        return [kinds], totals[kinds]
    if size**order >= 1 << 62 or (times > 1).any():
        first, kind = _distinct(columns, [size] * order)
        totals = np.zeros(len(first), np.int64)
        np.add.at(totals, kind, times)
        return [x[first] for x in columns], totals
    kinds, totals = np.unique(reduce(lambda key, x: key * size + x, columns), return_counts=True)
    return [kinds // size ** (order - 1 - k) % size for k in range(order)], totals


def _counted(block: Chunks, orders: list[int], window: int, known: Bitmap | None, known_order: int, common: Bitmap | None) -> Iterator[pa.RecordBatch]:
    """Phrases of the given numbers of words in a block, weighted."""
    for order, at in _starts(block, orders, window, known, known_order):
        if common is not None:
            at = at[common.holds(block.hashed(at, order))]
        alone = block.times[at] == 1
        for some in (at,) if order == 1 else (at[alone], at[~alone]):
            if not len(some):
                continue
            columns, totals = _totals(block, some, order)
            parts = [block.vocabulary.take(pa.array(x)) for x in columns]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if order > 1 else parts[0]
            fixed = [pa.repeat(pa.scalar(x, kind), len(totals)) for x, kind in ((block.lang, pa.string()), (order, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*fixed, phrase, pa.array(totals)], ["lang", "size", "phrase", "f"])


def count_phrases(
    blocks: DataFrame, orders: list[int], max_words: int, known: Bitmap | None = None, known_order: int = 0, common: Bitmap | None = None
) -> DataFrame:
    """``(lang, size, phrase, f)``: how often each phrase of the given numbers of words occurs, from the blocks of chunks.

    ``known`` holds the phrases of ``known_order`` words that are frequent enough: a phrase with another one inside is
    not counted, since it cannot be frequent either. Nor is one outside of the ``common`` cells.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield from _counted(block, orders, max_words - 1, known, known_order, common)

    rows = blocks.mapInArrow(count, "lang string, size int, phrase binary, f long")
    counts = rows.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return counts.select("lang", "size", F.col("phrase").cast("string").alias("phrase"), "f")


def frequent_phrases(blocks: DataFrame, min_count: int, max_words: int, filter_bits: int, scratch: Scratch, cell_bits: int) -> list[DataFrame]:
    """``(lang, size, phrase, f)`` of all phrases of up to ``max_words`` words with ``f >= min_count``, a table a pass.

    One, two and three words in turn, then all longer ones: all parts of a frequent phrase are frequent, so words
    around rarer parts are not looked at again. What the tasks get of the shorter phrases is a bitmap of
    ``2 ** filter_bits`` bits, and of the cells with enough phrases one of ``2 ** cell_bits`` bits, whatever their number.
    """
    found, known = [], None
    for orders in [[1], [2], [3], list(range(4, max_words + 1))]:
        if not orders or orders[0] > max_words:
            break
        before = orders[0] - 1
        common = common_cells(blocks, orders, max_words, known, before, min_count, cell_bits) if known is not None else None
        counts = count_phrases(blocks, orders, max_words, known, before, common).filter(F.col("f") >= min_count)
        counts = scratch.stage(counts, f"phrases-{orders[0]}")
        found.append(counts)
        known = Bitmap.of(counts, orders[0], filter_bits) if orders[-1] < max_words else None
        if known is not None and not known.filled.any():
            break
    return found


def _part(phrase: str, start, length):
    return F.array_join(F.slice(F.split(phrase, " ", -1), start, length), " ")


def scored(frequent: DataFrame, totals: DataFrame, scale: int = 1_000) -> DataFrame:
    """Candidates of two words and more with ``a``, and of their lowest-scoring cut (ties: the shortest first part) the
    counts ``l`` and ``r`` and the ``score`` floor(scale * a * n / (l * r)), in decimals of 38 digits."""
    parts = frequent.select("lang", "phrase", "f")
    cuts = frequent.filter("size > 1").select(
        "lang", "size", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cuts = cuts.withColumns({"first": _part("phrase", 1, F.col("k")), "rest": _part("phrase", F.col("k") + 1, F.col("size"))})
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    wide = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"(CAST({scale} AS DECIMAL(10, 0)) * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    best = cuts.groupBy("lang", "size", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return best.select("lang", "size", "phrase", "a", "c.l", "c.r", "n", "c.score")


def undominated(candidates: DataFrame, percent: int = 100) -> DataFrame:
    """Candidates that no longer candidate holds with at least ``percent`` of their count.

    Counts fall with length, so a longer candidate that dominates has one of one word more inside it that does too.
    """
    longer = candidates.filter("size > 2").select(
        "lang",
        "a",
        F.explode(F.array(_part("phrase", 1, F.col("size") - 1), _part("phrase", 2, F.col("size")))).alias("phrase"),
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    joined = candidates.join(most, ["lang", "phrase"], "left")
    return joined.filter(F.coalesce(100 * F.col("most") < percent * F.col("a"), F.lit(True))).drop("most")


def best_of_each(candidates: DataFrame, top: int, slices: int = 64) -> DataFrame:
    """The first ``top`` of every lang by score, then count (both falling), then phrase, with ``rank`` from 1.

    Slices of a lang are cut to ``top`` first, so the task that ranks a lang reads a bounded number of rows.
    """
    order = "score DESC, a DESC, phrase"
    slice_ = f"PARTITION BY lang, pmod(xxhash64(phrase), {slices})"
    first = candidates.withColumn("rank", F.expr(f"row_number() OVER ({slice_} ORDER BY {order})")).filter(F.col("rank") <= top)
    last = first.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang ORDER BY {order})"))
    return last.filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    min_count: int = 100,
    max_words: int = 5,
    top: int = 2_000,
    percent: int = 100,
    modulus: int = 64,
    filter_bits: int = 25,
    text: str = "text",
    lang: str = "lang",
    cell_bits: int = 26,
) -> DataFrame:
    """The best collocations of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` (longs).

    Texts with A-Z lower-cased are split at ``[.,;:!?]``, line feeds, vertical tabs, form feeds and carriage returns into
    pieces, these at spaces and tabs into words. ``n`` counts the words of a language (null: ``und``). A phrase of 2 to
    ``max_words`` words that stands at least ``min_count`` times within pieces is a candidate; see ``scored``,
    ``undominated`` and ``best_of_each`` for its score, what drops it, and the order.

    ``modulus`` sets the mean length of a chunk, ``filter_bits`` and ``cell_bits`` (6 to 32) the size of the filters that
    save counting; none changes the result. Null and empty texts count nothing; repeated rows count each time; a text of any length is
    cut into chunks like all others (one without any trigger is one chunk); equal scores fall back on counts, then
    on the bytes of the phrase; ids and other columns, whatever their names, are not read. An empty table gives no rows.
    """
    if max_words < 2:
        raise ValueError("a phrase has two words or more")
    scratch = Scratch(docs.sparkSession)
    blocks = scratch.stage(encode(parse(docs, max_words, modulus, text, lang)), "chunks", compression="zstd")
    totals = scratch.stage(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    frequent = frequent_phrases(blocks, min_count, max_words, filter_bits, scratch, cell_bits)
    candidates = scratch.stage(scored(reduce(DataFrame.unionByName, frequent), totals), "candidates")
    scratch.drop(blocks, totals, *frequent)
    found = best_of_each(undominated(candidates, percent), top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
