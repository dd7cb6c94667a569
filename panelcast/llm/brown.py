"""Brown class language model: exchange clustering, class transitions, word emissions."""

import ctypes
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Scratch
from panelcast.llm.features import MIX, TURN
from panelcast.session import stage

END = b"\n"
END_HASH = np.uint64(xxhash.xxh3_64_intdigest(END))
END_ID = int(END_HASH.astype(np.int64))


@dataclass(frozen=True)
class BrownConfig:
    """Every training word is sorted by exchange into one of ``2 * classes`` classes.

    ``clustered``: the most frequent words, which are sorted first, among themselves and into ``classes``
    classes; with them the exchange over all words starts. ``sweeps``: at most as many in either exchange.
    The one over all words also ends with a sweep that gains less than ``least_gain`` (natural logarithm) a
    token, or that share of it for a share of the words. ``batch_bytes``: text that one row of the encoded corpus holds. ``shard_words``: words, counted
    once a batch, that one row of the vocabulary holds. ``prior``: weight of the class shares in a
    transition. ``rare``: words seen no more often show where unknown words stand and what follows them."""

    classes: int = 32
    clustered: int = 1_024
    sweeps: int = 10
    batch_bytes: int = 16_000_000
    prior: float = 5.0
    rare: int = 1
    shard_words: int = 250_000
    least_gain: float = 0.001

    @property
    def rest(self) -> int:
        """The state of unknown words, and of words before they have a class."""
        return 2 * self.classes

    @property
    def all_classes(self) -> int:
        return 2 * self.classes + 1

    @property
    def states(self) -> int:
        """Classes, the unknown, and the classes again for their rare words."""
        return 4 * self.classes + 1


def _release() -> None:
    """Gives freed memory back to the system, which a worker waiting for its next task would keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def _pack(values: np.ndarray, kind: str = "<i4") -> bytes:
    values = values.astype(kind)
    planes = np.empty((values.itemsize, len(values)), np.uint8)
    for k in range(values.itemsize):
        np.right_shift(values, 8 * k, out=planes[k], casting="unsafe")
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(packed: bytes, kind: str = "<i4") -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(size, -1)
    values = planes[0].astype(kind)
    for k in range(1, size):
        if planes[k].any():
            for at in range(0, len(values), 1 << 15):
                values[at : at + (1 << 15)] |= planes[k, at : at + (1 << 15)].astype(kind) << 8 * k
    return values


def _pack_counts(values: np.ndarray) -> bytes:
    wide = len(values) and values.max() >= 2**31
    return b"8" + _pack(values, "<i8") if wide else b"4" + _pack(values)


def _unpack_counts(packed: bytes) -> np.ndarray:
    return _unpack(packed[1:], "<i8" if packed[:1] == b"8" else "<i4").astype(np.int64)


BATCH = "batch long, doc_ids array<long>, train array<boolean>, lengths array<int>, words binary, codes binary, end_code int"
PIECE = 2_000_000


def _encoded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of some texts, with A-Z lower-cased and an end after each text; the places in them
    of all tokens; the number of tokens by text."""
    large = pa.types.is_large_binary(texts.type)
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.large_string() if large else pa.string())))
    coded = pc.dictionary_encode(split.flatten())
    many, codes = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False), coded.indices.to_numpy()
    names = coded.dictionary.view(texts.type)
    # White space at either end of a text leaves an empty string, which is no word.
    empty = pc.binary_length(names).to_numpy() == 0
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names.to_numpy(zero_copy_only=False)), np.uint64, len(names))
    hashes[empty] = END_HASH
    kept = ~empty[codes]
    lengths = np.diff(np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(many)])]) + 1
    tokens = np.full(lengths.sum(), len(names), np.int32)
    word = np.ones(len(tokens), bool)
    word[np.cumsum(lengths) - 1] = False
    tokens[word] = codes[kept]
    return np.append(hashes, END_HASH), tokens, lengths


def _encoder(limit: int):
    schema = pa.schema(
        [("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("words", pa.binary()), ("codes", pa.binary()), ("end_code", pa.int32())]
    )

    def encode(batches):
        batch, held, full = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            ids, train, hashes, codes, lengths = zip(*held)
            words, place = np.unique(np.concatenate(hashes), return_inverse=True)
            places = np.split(place.astype(np.int32), np.cumsum([len(h) for h in hashes])[:-1])
            codes = np.concatenate([to[c] for to, c in zip(places, codes)])
            row = [[batch], [sum(ids, [])], [sum(train, [])], [np.concatenate(lengths)], [words.tobytes()], [_pack(codes)], [place[-1]]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for rows in batches:
            sizes = 16 + pc.fill_null(pc.binary_length(rows.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            while len(rows):
                upto = np.cumsum(sizes)
                many = min(int(np.searchsorted(upto, min(limit - full, PIECE))) + 1, len(rows))
                held.append((rows.column(0)[:many].to_pylist(), rows.column(1)[:many].to_pylist(), *_encoded(rows.column(2)[:many])))
                full += upto[many - 1]
                rows, sizes = rows.slice(many), sizes[many:]
                if full >= limit:
                    yield flush()
                    batch, held, full = batch + 1, [], 0
        if held:
            yield flush()
            held = []
        _release()

    return encode


def _batches(frames):
    """The encoded batches of a task: train flag and length by document, sorted word hashes, codes."""
    for frame in frames:
        for row in frame.to_pylist():
            yield (
                row,
                np.array(row["train"], bool),
                np.array(row["lengths"], np.int64),
                np.frombuffer(row["words"], np.uint64),
                _unpack(row["codes"]),
            )


def _previous(codes: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The code before each token; a text begins after an end."""
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = end
    return before


def _cuts(words: np.ndarray, shards: int) -> np.ndarray:
    """Where sorted hashes pass from one shard, an equal range of all hashes, to the next."""
    edges = np.array([k * 2**64 // shards for k in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(words, edges), [len(words)]]).astype(np.int64)


def _rows(columns: dict, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[name], kinds[kind]) for name, kind in fields], [name for name, _ in fields])


SLICE = "shard int, batch long, words binary, n binary"


def _word_counts(shards: int):
    """The words of each batch and their training counts, cut into shards."""

    def count(frames):
        for row, train, lengths, words, codes in _batches(frames):
            counts = np.bincount(codes[np.repeat(train, lengths)], minlength=len(words))
            cuts = _cuts(words, shards)
            held = np.flatnonzero(np.diff(cuts))
            spans = [slice(cuts[k], cuts[k + 1]) for k in held]
            yield _rows(
                {"shard": held, "batch": [row["batch"]] * len(held), "words": [words[x].tobytes() for x in spans], "n": [_pack_counts(counts[x]) for x in spans]}, SLICE
            )

    return count


SHARD = "shard int, words binary, n binary, classes binary, batches array<long>, places array<binary>"


def _shard(cfg: BrownConfig):
    """One row for a shard: its training words, their counts, and where each batch's words are among them."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        found = [np.frombuffer(w, np.uint64) for w in rows["words"]]
        words, at = np.unique(np.concatenate(found), return_inverse=True)
        n = np.zeros(len(words), np.int64)
        np.add.at(n, at, np.concatenate([_unpack_counts(x) for x in rows["n"]]))
        known = n > 0
        place = np.where(known, np.cumsum(known) - 1, known.sum())[at]
        places = [_pack(x) for x in np.split(place, np.cumsum([len(f) for f in found])[:-1])]
        row = [rows["shard"].iloc[0], words[known].tobytes(), n[known].tobytes(), bytes([cfg.rest]) * int(known.sum()), rows["batch"].tolist(), places]
        return pd.DataFrame([row], columns=["shard", "words", "n", "classes", "batches", "places"])

    return merge


def _vocabulary(frames):
    """The shards of a task: row, sorted word hashes, counts and classes."""
    for frame in frames:
        for row in frame.to_pylist():
            yield row, np.frombuffer(row["words"], np.uint64), np.frombuffer(row["n"], np.int64), np.frombuffer(row["classes"], np.uint8)


def _most_frequent(limit: int):
    def top(frames):
        for _, words, n, _ in _vocabulary(frames):
            best = np.lexsort([words.astype(np.int64), -n, words != END_HASH])[:limit]
            yield _rows({"word": words[best].astype(np.int64), "n": n[best]}, "word long, n long")

    return top


def _sizes(frames):
    """By class: training tokens and words; and the class of the end."""
    for _, words, n, classes in _vocabulary(frames):
        tokens_, words_ = np.bincount(classes, n).astype(np.int64), np.bincount(classes)
        seen = np.flatnonzero(words_)
        ends = np.bincount(classes[words == END_HASH], minlength=len(words_))
        yield _rows({"class": seen, "n": tokens_[seen], "words": words_[seen], "ends": ends[seen]}, "class int, n long, words long, ends long")


def _places(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Positions of ``words`` in the sorted ``known``, ``len(known)`` for those that are not there."""
    at = np.searchsorted(known, words)
    at[at == len(known)] = 0
    return np.where(known[at] == words, at, len(known)) if len(known) else np.zeros(len(words), np.int64)


def _pair_counts(known: np.ndarray):
    def count(frames):
        size = len(known) + 1
        total = np.zeros(size * size, np.int64)
        for row, train, lengths, words, codes in _batches(frames):
            place = _places(words.astype(np.int64), known)
            learnt = np.repeat(train, lengths)
            pairs = place[_previous(codes, lengths, row["end_code"])[learnt]] * size + place[codes[learnt]]
            total += np.bincount(pairs, minlength=size * size)
        seen = np.flatnonzero(total)
        for k in range(0, len(seen), 100_000):
            part = seen[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["pair", "n"])

    return count


def _plog(x):
    return x * np.log(np.maximum(x, 1))


def likelihood(pairs: np.ndarray) -> float:
    """What exchange clustering raises: the class bigram log-likelihood but for a constant."""
    return float(_plog(pairs).sum() - _plog(pairs.sum(0)).sum() - _plog(pairs.sum(1)).sum())


def exchange(counts: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Classes of the words of a square count matrix whose last word stands for all others.

    Words start in turn over the classes and, most frequent first, move to the class that raises the
    likelihood of the class bigrams most, until a sweep moves none. The last word keeps a class of its own.
    """
    size = len(counts)
    order = np.argsort(-(counts.sum(0) + counts.sum(1))[:-1], kind="stable")
    where = np.empty(size, np.int64)
    where[order], where[-1] = np.arange(size - 1) % classes, classes
    member = np.zeros((size, classes + 1))
    member[np.arange(size), where] = 1
    right, left = counts @ member, counts.T @ member
    grid = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in order:
            a, own = where[w], counts[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[a] -= own
            l[a] -= own
            grid[a] -= r
            grid[:, a] -= l
            grid[a, a] -= own
            rows, cols = grid.sum(1), grid.sum(0)
            gain = (_plog(grid + r) - _plog(grid)).sum(1) + (_plog(grid.T + l) - _plog(grid.T)).sum(1)
            d = np.diagonal(grid)
            gain += _plog(d + r + l + own) + _plog(d) - _plog(d + r) - _plog(d + l)
            gain -= _plog(rows + r.sum() + own) - _plog(rows) + _plog(cols + l.sum() + own) - _plog(cols)
            b = int(np.argmax(gain[:classes]))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            grid[b] += r
            grid[:, b] += l
            grid[b, b] += own
            if b != a:
                moved += 1
                where[w] = b
                right[:, a] -= counts[:, w]
                right[:, b] += counts[:, w]
                left[:, a] -= counts[w]
                left[:, b] += counts[w]
        if not moved:
            break
    return where[:-1]


def _clusters(size: int, cfg: BrownConfig):
    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(size * size)
        counts[rows["pair"].to_numpy()] = rows["n"].to_numpy()
        found = exchange(counts.reshape(size, size), cfg.classes, cfg.sweeps)
        return pd.DataFrame({"at": np.arange(size - 1), "class": found})

    return cluster


def _first_classes(known: np.ndarray, classes: np.ndarray):
    """Gives the most frequent words their classes."""

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0].copy()
        now, at = np.frombuffer(row["classes"], np.uint8).copy(), _places(np.frombuffer(row["words"], np.uint64).astype(np.int64), known)
        now[at < len(known)] = classes[at[at < len(known)]]
        row["classes"] = now.tobytes()
        return pd.DataFrame([row])

    def placed(frames):
        for rows in frames:
            yield from (place(rows.iloc[k : k + 1]) for k in range(len(rows)))

    return placed


ANSWER = "batch long, shard int, classes binary"


def _answers(rest: int, counts: bool = False):
    """For every batch the classes of its words, shard by shard, and if wanted their counts; those of an
    unknown word are ``rest`` and 0."""

    def answer(frames):
        for row, _, n, classes in _vocabulary(frames):
            classes, n = np.append(classes, np.uint8(rest)), np.append(n, 0)
            places = [_unpack(p) for p in row["places"]]
            out = {"batch": row["batches"], "shard": [row["shard"]] * len(places), "classes": [classes[p].tobytes() for p in places]}
            if counts:
                out["n"] = [_pack_counts(n[p]) for p in places]
            yield _rows(out, ANSWER + ", n binary" * counts)

    return answer


CONTEXTS = "shard int, batch long, entries binary"


def _contexts(size: int):
    """How often each word of a batch follows each class, stands before it, and follows itself, in its shard's
    terms; under shard -1 the counts of class pairs. Training tokens only."""
    kinds = 2 * size + 1

    def count(key, batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = {"shard": [], "batch": [], "entries": []}
        if len(batch):
            row = batch.iloc[0]
            codes, lengths = _unpack(row["codes"]), np.asarray(row["lengths"], np.int64)
            use = np.repeat(np.asarray(row["train"], bool), lengths)
            before, here = _previous(codes, lengths, row["end_code"])[use], codes[use]
            del codes, use
            answers = answers.sort_values("shard")
            group = np.frombuffer(b"".join(answers["classes"]), np.uint8)
            kind = np.int32 if len(group) * kinds < 2**31 else np.int64
            itself, found = here[here == before], []
            for word, near, first, alone in ((here, before, 0, itself[:0]), (before, here, size, itself)):
                many = len(word)
                keys = np.empty(many + len(alone), kind)
                np.multiply(word, kinds, out=keys[:many], casting="unsafe", dtype=kind)
                keys[:many] += group[near]
                keys[:many] += first
                keys[many:] = alone.astype(kind) * kinds + 2 * size
                keys.sort()
                new = np.ones(len(keys), bool)
                np.not_equal(keys[1:], keys[:-1], out=new[1:])
                starts = np.flatnonzero(new)
                found.append((keys[starts], np.diff(starts, append=len(keys))))
                del keys, new, starts
            del before, here, word, near
            keys, n = found[0]
            grid = np.zeros(size * size)
            for k in range(0, len(keys), 100_000):
                word = keys[k : k + 100_000] // kinds
                grid += np.bincount(keys[k : k + 100_000] - word * kinds + group[word].astype(np.int64) * size, n[k : k + 100_000], size * size)
            grid = grid.reshape(size, size).T.ravel().astype(np.int64)
            # The words of a batch are sorted as the shards are.
            cuts = np.cumsum([0, *map(len, answers["classes"])])
            ends = [np.searchsorted(keys, cuts * kinds) for keys, _ in found]
            for k, shard in enumerate(answers["shard"]):
                parts = [(keys[e[k] : e[k + 1]], n[e[k] : e[k + 1]]) for (keys, n), e in zip(found, ends)]
                gaps = np.diff(np.concatenate([keys for keys, _ in parts]).astype(np.int64) - cuts[k] * kinds, prepend=0)
                out["shard"].append(shard)
                out["entries"].append(_pack_counts(np.concatenate([gaps, *(n for _, n in parts)])))
            out["shard"].append(-1)
            out["entries"].append(_pack_counts(grid))
            out["batch"] = [row["batch"]] * len(out["shard"])
        return pd.DataFrame(out)

    return count


def _grid(frames):
    total = 0
    for frame in frames:
        for packed in frame.column(0).to_pylist():
            total = total + _unpack_counts(packed)
    seen = np.flatnonzero(total)
    if len(seen):
        yield _rows({"pair": seen, "n": total[seen]}, "pair long, n long")


ENTRIES = 6_000


def gains(grid: np.ndarray, now: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For each word (row) and class: the likelihood with that word alone moved there, but for a constant a word.

    ``grid`` counts class pairs, ``left`` the classes before a word, ``right`` those after it, ``own`` the word
    after itself, all with the words in their classes ``now``.
    """
    at, width = np.arange(len(now)), len(grid)
    left, right = left.astype(float), right.astype(float)
    left[at, now] -= own
    right[at, now] -= own
    gain = np.zeros(left.shape)
    for grid_, mine, other in ((grid, right, left), (grid.T, left, right)):
        cells_ = grid_.T.astype(float)
        cell = np.flatnonzero(mine != 0)
        word, n = cell // width, mine.ravel()[cell]
        near = cell - word * width
        same = near == now[word]
        # What adds a count to cells that the word is not in is the same for all words.
        kinds, alike = np.unique(n * width + near, return_inverse=True)
        count, kind = np.divmod(kinds, width)
        kind = kind.astype(np.int64)
        steps = _plog(cells_[kind] + count[:, None]) - _plog(cells_)[kind]
        inside = np.flatnonzero(same)
        cells = cells_[near[inside]] - other[word[inside]]
        alike[inside] = len(kinds) + np.arange(len(inside))
        steps = np.vstack([steps, _plog(cells + n[inside, None]) - _plog(cells)])
        # The first entry of every word, then the second of those that have one, and so on.
        entries = np.bincount(word, minlength=len(now))
        order, first = np.argsort(-entries, kind="stable"), np.cumsum(entries) - entries
        total = np.zeros(gain.shape)
        for k, many in enumerate(len(now) - np.cumsum(np.bincount(entries))[:-1]):
            total[:many] += steps[alike[first[order[:many]] + k]]
        gain[order] += total
        cells = cells_[near, now[word]] - n - same * (own[word] + other[word, now[word]])
        gain[at, now] += np.bincount(word, _plog(cells + n) - _plog(cells) - steps[alike, now[word]], len(now))
        # What it adds to the sums depends on how often the word is there alone, but for its own class.
        many, of = np.unique(mine.sum(1) + own, return_inverse=True)
        sums = grid_.sum(1).astype(float)
        steps = _plog(sums + many[:, None]) - _plog(sums)
        gain -= steps[of]
        sums = sums[now]
        gain[at, now] += steps[of, now] - _plog(sums) + _plog(sums - many[of])
    # Cells of a class with itself count twice above where the word has that class on both sides, or follows itself.
    cell = np.flatnonzero(((left > 0) & (right > 0)) | (own > 0)[:, None])
    word = cell // width
    near = cell - word * width
    left, right, own = left.ravel()[cell], right.ravel()[cell], own[word]
    both = np.diagonal(grid).astype(float)[near] - (near == now[word]) * (left + right + own)
    gain.ravel()[cell] += _plog(both + right + left + own) + _plog(both) - _plog(both + right) - _plog(both + left)
    return gain


def _entries(rows: pd.DataFrame, places: dict, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The contexts of a shard's words over all batches: word, kind of context, count; sorted."""
    held = [np.zeros(0, np.int64)]
    for batch, packed in zip(rows["batch"], rows["entries"]):
        gaps, n = _unpack_counts(packed).reshape(2, -1)
        word, kind = np.divmod(np.cumsum(gaps), kinds)
        held.append((places[batch][word].astype(np.int64) * kinds + kind << 32) + n)
    held = np.sort(np.concatenate(held))
    keys, counts = held >> 32, held & 2**32 - 1
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    n = np.add.reduceat(counts, starts) if len(starts) else counts
    word, kind = np.divmod(keys[starts], kinds)
    return word, kind, n


def _start(words: np.ndarray, now: np.ndarray, word: np.ndarray, kind: np.ndarray, n: np.ndarray, cfg: BrownConfig) -> np.ndarray:
    """Words without a class begin in that of the frequent class they mostly follow, or in one by their hash."""
    new = np.where(now < cfg.rest, now, cfg.classes + (words % np.uint64(cfg.classes)).astype(np.int64))
    use = (kind < cfg.classes) & (now[word] == cfg.rest)
    word, kind, n = word[use], kind[use], n[use]
    order = np.lexsort([kind, -n, word])
    best = order[np.diff(word[order], prepend=-1) > 0]
    new[word[best]] = cfg.classes + kind[best]
    return new


def _moving(words: np.ndarray, share: float, turn: int) -> np.ndarray:
    """Positions of about that share of the words, others in each turn, whatever else is in the shard."""
    mixed = (words ^ (words >> np.uint64(29)) ^ (np.uint64(turn) * MIX)) * TURN
    return np.flatnonzero((mixed >> np.uint64(40)).astype(np.float64) < share * 2**24)


def _exchanged(now: np.ndarray, some: np.ndarray, word: np.ndarray, kind: np.ndarray, n: np.ndarray, grid: np.ndarray, cfg: BrownConfig) -> np.ndarray:
    """The words' classes after each of ``some`` moved to the one that raises the likelihood most while the others keep theirs."""
    size, many = cfg.all_classes, cfg.rest
    first = np.searchsorted(word, np.arange(len(now) + 1))
    # A word with one class before and one after it, once each, does what the others of its kind do.
    once = (np.diff(first) == 2) & (np.bincount(word, n, len(now)) == 2)
    pattern = np.arange(len(now)) + many**3
    pattern[once] = (now[once] * many + kind[first[:-1][once]]) * many + kind[first[:-1][once] + 1] - size
    _, one, alike = np.unique(pattern[some], return_index=True, return_inverse=True)
    one = some[one]
    best = now[one].copy()
    held = np.cumsum(first[one + 1] - first[one])
    ends = np.searchsorted(held, np.arange(ENTRIES, held[-1] if len(held) else 0, ENTRIES), side="right")
    for at in np.split(np.arange(len(one)), ends):
        part = one[at]
        lengths = first[part + 1] - first[part]
        row = np.repeat(np.arange(len(part)), lengths)
        entry = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(first[part], lengths)
        table = np.zeros((len(part), 2 * size + 1))
        table[row, kind[entry]] = n[entry]
        gain = gains(grid, now[part], table[:, :many], table[:, size : size + many], table[:, -1])
        to = gain.argmax(1)
        better = gain[np.arange(len(part)), to] > gain[np.arange(len(part)), now[part]] + 1e-9
        best[at] = np.where(better, to, now[part])
    new = now.copy()
    new[some] = best[alike]
    return new


def _decide(cfg: BrownConfig, grid: np.ndarray | None, share: float, turn: int):
    """The next class of every word of a shard."""

    def decide(key, shard: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        row = shard.iloc[0].copy()
        places = {b: _unpack(p) for b, p in zip(row["batches"], row["places"])}
        now = np.frombuffer(row["classes"], np.uint8).astype(np.int64)
        word, kind, n = _entries(rows, places, 2 * cfg.all_classes + 1)
        words = np.frombuffer(row["words"], np.uint64)
        if grid is None:
            now = _start(words, now, word, kind, n, cfg)
        else:
            now = _exchanged(now, _moving(words, share, turn), word, kind, n, grid, cfg)
        row["classes"] = now.astype(np.uint8).tobytes()
        del places, word, kind, n
        _release()
        return pd.DataFrame([row])

    return decide


SCORED = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, emission double, path binary"


def _emitter(total: float, vocabulary: float, mass: np.ndarray, cfg: BrownConfig):
    """Base score, emission score and path of states of every document of a batch."""
    scale = total + 0.1 * (vocabulary + 1)

    def emit(key, batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in SCORED.split(", ")]
        if not len(batch):
            return pd.DataFrame(columns=columns)
        row = batch.iloc[0]
        lengths, codes = np.asarray(row["lengths"], np.int64), _unpack(row["codes"])
        answers = answers.sort_values("shard")
        group = np.frombuffer(b"".join(answers["classes"]), np.uint8)
        count = np.concatenate([_unpack_counts(n) for n in answers["n"]])
        known = count > 0
        base = np.log10((count + 0.1) / scale)
        emission = np.where(known, np.log10((count + 0.1) / mass[group]), 0.0)
        state = np.where(known & (count <= cfg.rare), cfg.all_classes + group.astype(np.int64), group).astype(np.min_scalar_type(cfg.states - 1))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        path, wide = state[codes].tobytes(), state.itemsize
        return pd.DataFrame(
            {
                "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"),
                "train": np.asarray(row["train"], bool),
                "n_tokens": lengths,
                "n_known": np.add.reduceat(known[codes].astype(np.int64), starts),
                "base_score": np.add.reduceat(base[codes], starts),
                "emission": np.add.reduceat(emission[codes], starts),
                "path": [path[s * wide : (s + n) * wide] for s, n in zip(starts, lengths)],
            }
        )[columns]

    return emit


def _steps(path: bytes, end: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    here = np.frombuffer(path, np.min_scalar_type(size - 1)).astype(np.int64)
    return np.concatenate([[end], here[:-1]]), here


def _transition_counts(end: int, size: int):
    def count(frames):
        total = np.zeros(size * size, np.int64)
        for frame in frames:
            for path in frame.column(0).to_pylist():
                before, here = _steps(path, end, size)
                total += np.bincount(before * size + here, minlength=size * size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["pair", "n"])

    return count


def _path_score(path: Column, log_transition: np.ndarray, end: int) -> Column:
    @F.pandas_udf("double")
    def scored(paths: pd.Series) -> pd.Series:
        return pd.Series([log_transition[_steps(p, end, len(log_transition))].sum() for p in paths], dtype="float64")

    return scored(path)


def _log_transition(moves: np.ndarray, mass: np.ndarray, unknown: float, cfg: BrownConfig) -> np.ndarray:
    """log10 P(class or unknown | state before) between states, from the training moves between states."""
    rest, size = cfg.rest, cfg.all_classes
    folded = moves[:size] + np.vstack([moves[size:], np.zeros((1, cfg.states))])
    folded[rest] += moves[size:].sum(0)
    to, rare = folded[:, :rest] + folded[:, size:], folded[:, size:].sum(1)
    known = mass[:rest].sum()
    shares = mass[:rest] / known if known else mass[:rest]
    share = rare[:rest].sum() / max(to[:rest].sum(), 1)
    all_moves = to.sum(1)
    u = unknown * ((rare + cfg.prior * share) / ((all_moves + cfg.prior) * share) if share else np.ones(size))
    step = (to + cfg.prior * shares) / (all_moves + cfg.prior)[:, None] * (1 - u)[:, None]
    out = np.log10(np.maximum(np.column_stack([step, u, step]), 1e-300))
    return np.vstack([out, out[:rest]])


def score_documents(docs: DataFrame, train: Column, cfg: BrownConfig = BrownConfig(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    The model learns from the rows where ``train`` holds: words lower-cased from A to Z, then one end. The
    score is the log10 probability of the text: P(class | class before) * P(word | class). Transitions are
    smoothed towards the classes' shares, and a word's probability within its class is its share of the
    smoothed word counts. After each class the unknown word has its base probability, times how much more
    often rare words stand there than anywhere; after it comes what comes after rare words. So the
    probabilities of all words and the unknown one add up to 1.

    1. Texts are tokenized once into batches of bounded size: a dictionary of word hashes and packed codes.
       The vocabulary of all training words lies in shards, ranges of the hashes, that know where each
       batch's words are. It is never collected or broadcast.
    2. The ``clustered`` most frequent words are sorted into classes by exchange clustering on their bigram
       counts over all training tokens. From there all words of the vocabulary go through exchange: in each
       sweep the shards tell the batches the classes of their words, the batches tell the shards how often
       each word follows and precedes each class, and every word moves to the class that raises the
       likelihood of the class bigrams most. As all move at once, a sweep may lower it: it is taken back, and
       from then on a sweep moves half as many of the words, other ones each time.
    3. Documents become class paths, whose transitions are counted over all training tokens.

    A null, empty or blank text is one end token. Null ids are ids. Without training rows every word is
    unknown and both scores are those of a uniform model. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).cast("binary").alias("bytes"))
    corpus = scratch.stage(rows.mapInArrow(_encoder(cfg.batch_bytes), BATCH), "corpus")
    batches, held = corpus.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    batches, shards = max(batches, 1), held // 8 // cfg.shard_words + 1
    texts = corpus.select("batch", "train", "lengths", "words", "codes", "end_code")

    def by_batch(df):
        return df.repartition(batches, "batch").groupBy("batch")

    def by_shard(df):
        return df.repartition(shards, "shard").groupBy("shard")

    words = scratch.stage(by_shard(texts.mapInArrow(_word_counts(shards), SLICE)).applyInPandas(_shard(cfg), SHARD), "vocabulary")
    top = words.mapInArrow(_most_frequent(cfg.clustered), "word long, n long").orderBy(F.col("word") != END_ID, F.col("n").desc(), "word").limit(cfg.clustered)
    known = np.sort(top.toPandas()["word"].to_numpy(dtype="int64"))
    if len(known):
        pairs = texts.mapInArrow(_pair_counts(known), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        clusters = pairs.groupBy(F.lit(0).alias("one")).applyInPandas(_clusters(len(known) + 1, cfg), "at long, class long").toPandas()
        classes = clusters.sort_values("at")["class"].to_numpy()

        def contexts(vocabulary):
            told = vocabulary.mapInArrow(_answers(cfg.rest), ANSWER)
            found = by_batch(texts.drop("words")).cogroup(by_batch(told)).applyInPandas(_contexts(cfg.all_classes), CONTEXTS)
            found = scratch.stage(found, "contexts")
            grid = np.zeros(cfg.all_classes**2)
            for pair, n in found.filter("shard < 0").select("entries").mapInArrow(_grid, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
                grid[pair] = n
            return found, grid.reshape(cfg.all_classes, cfg.all_classes)[: cfg.rest, : cfg.rest]

        def moved(vocabulary, found, grid=None, share=1.0, turn=0):
            decided = by_shard(vocabulary).cogroup(by_shard(found.filter("shard >= 0"))).applyInPandas(_decide(cfg, grid, share, turn), SHARD)
            return scratch.stage(decided, "vocabulary")

        heads = words.mapInPandas(_first_classes(known, classes), SHARD)
        found, _ = contexts(heads)
        now = moved(heads, found)
        scratch.drop(found, words)
        found, grid = contexts(now)
        share = 1.0
        for turn in range(cfg.sweeps):
            tried = moved(now, found, grid, share, turn)
            tried_found, tried_grid = contexts(tried)
            gained = likelihood(tried_grid) - likelihood(grid)
            if gained < 0:
                scratch.drop(tried, tried_found)
                share /= 2
            else:
                scratch.drop(now, found)
                now, found, grid = tried, tried_found, tried_grid
                if gained < cfg.least_gain * share * grid.sum():
                    break
        scratch.drop(found)
        words = now

    mass, size, total, end = np.zeros(cfg.all_classes), 0, 0, cfg.rest
    sizes = words.mapInArrow(_sizes, "class int, n long, words long, ends long")
    for c, n, many, ends in sizes.groupBy("class").agg(F.sum("n"), F.sum("words"), F.sum("ends")).collect():
        mass[c], size, total, end = n + 0.1 * many, size + many, total + n, c if ends else end
    told = words.mapInArrow(_answers(cfg.rest, counts=True), ANSWER + ", n binary")
    emitted = by_batch(corpus.select("batch", "doc_ids", "train", "lengths", "codes")).cogroup(by_batch(told))
    emitted = stage(emitted.applyInPandas(_emitter(total, size, np.maximum(mass, 1e-300), cfg), SCORED), "class-paths")
    scratch.drop(corpus, words)

    moves = np.zeros(cfg.states**2)
    steps = emitted.filter("train").select("path").mapInArrow(_transition_counts(end, cfg.states), "pair long, n long")
    for pair, n in steps.groupBy("pair").agg(F.sum("n")).collect():
        moves[pair] = n
    transition = _log_transition(moves.reshape(cfg.states, cfg.states), mass, 0.1 / (total + 0.1 * (size + 1)), cfg)
    score = F.col("emission") + _path_score(F.col("path"), transition, end)
    return emitted.withColumn("score", score).select(
        "doc_id",
        "train",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
