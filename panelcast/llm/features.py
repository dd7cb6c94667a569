"""Hashed word n-gram features of whole texts, as numpy arrays inside tasks."""

import re

import numpy as np
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
TURN = np.uint64(0xC2B2AE3D27D4EB4F)
REPEATED = np.uint64(0x5851F42D4C957F2D)
MEMO_WORDS = 1 << 18

_LETTERS = re.compile(rb"[a-z\x80-\xff]+")
_DIGITS = re.compile(rb"[0-9]+")
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased: what lies between ASCII white space."""
    return text.lower().split() if text else []


class Words(dict):
    """Numbers for words, and by number the hashes of the word and of its shape.

    Call ``trim`` between texts: it forgets everything once there are too many, so memory stays bounded.
    """

    def __init__(self):
        self._room(1 << 12)

    def _room(self, n: int) -> None:
        self.word, self.shape = np.zeros(n, np.uint64), np.zeros(n, np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at == len(self.word):
            self.word, self.shape = (np.concatenate([x, np.zeros(at, np.uint64)]) for x in (self.word, self.shape))
        shape = _RUNS.sub(rb"\1", _DIGITS.sub(b"0", _LETTERS.sub(b"a", word)))
        self.word[at], self.shape[at] = xxhash.xxh3_64_intdigest(word), xxhash.xxh3_64_intdigest(shape, 1)
        self[word] = at
        return at

    def trim(self) -> None:
        if len(self) >= MEMO_WORDS:
            self.clear()
            self._room(1 << 12)

    def numbers(self, text: bytes | None) -> np.ndarray:
        found = tokens(text)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def _bits(mixed: np.ndarray, bits: int) -> np.ndarray:
    return (((mixed ^ (mixed >> np.uint64(31))) * TURN) >> np.uint64(64 - bits)).astype(np.int64)


def _pairs(values: np.ndarray, salt: int) -> np.ndarray:
    return (values[:-1] * MIX + values[1:]) * TURN + np.uint64(salt)


def ngram_indexes(text: bytes | None, memo: Words, bits: int) -> np.ndarray:
    """Hashed features of a text, repeats included: words, word pairs, word shapes and pairs of shapes.

    A word equal to the one before has a shape of its own, so repetition is visible whatever the word.
    """
    memo.trim()
    at = memo.numbers(text)
    if not len(at):
        return at
    word, shape = memo.word[at], memo.shape[at]
    shape[1:][at[1:] == at[:-1]] = REPEATED
    return _bits(np.concatenate([word * MIX, _pairs(word, 1), shape * MIX, _pairs(shape, 2)]), bits)


def word_indexes(text: bytes | None, memo: Words, bits: int) -> np.ndarray:
    """Hashed words of a text, repeats included."""
    memo.trim()
    at = memo.numbers(text)
    return _bits(memo.word[at] * MIX, bits)
