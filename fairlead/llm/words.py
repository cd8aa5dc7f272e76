"""Words of many texts at once: positions, byte-span hashes, ragged ranges."""

from __future__ import annotations

import numpy as np

from fairlead.llm.common import SPACE_BYTES

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACE_BYTES)] = True
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    held = _powers.get(str(base))
    if held is None or len(held) < n:
        each = np.full(n, base & (2**64 - 1), dtype=np.uint64)
        each[0] = 1
        held = _powers[str(base)] = np.multiply.accumulate(each)
    return held[:n]


class Spans:
    """Words of a buffer and 64-bit hashes of byte spans in it, equal for equal bytes anywhere.

    The buffer holds words that each end with one space. Hashes only sort; every match is
    verified on the bytes.
    """

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.text = text
        self.ends = np.flatnonzero(text == 0x20)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_TABLE[text] * _power(_BASE, max(n, 1))[:n], out=self._sums[1:])
        self._back = _power(pow(_BASE, -1, 2**64), n + 1)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words first..last, both included."""
        a, b = self.starts[first], self.ends[last]
        h = (self._sums[b] - self._sums[a]) * self._back[a]
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(32)
        return h


def normalised(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all words, each followed by one space, and the number of words of each text."""
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = IS_SPACE[joined]
    ends = np.empty(len(space), dtype=bool)  # the first space after a word
    ends[0] = False
    ends[1:] = space[1:] & ~space[:-1]
    counts = np.diff(np.concatenate([[0], np.cumsum(ends)[np.cumsum([len(x) + 1 for x in texts]) - 1]]))
    kept = joined[~space | ends].copy()
    kept[np.flatnonzero(space[~space | ends])] = 0x20
    return kept, counts


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    offsets = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - offsets, lengths)


def same_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether text[a : a + length] equals text[b : b + length]; lengths above zero."""
    same = np.ones(len(a), dtype=bool)
    step = max(1, (8 << 20) // max(1, int(lengths.max(initial=1))))
    for k in range(0, len(a), step):
        n = lengths[k : k + step]
        differ = text[ragged(a[k : k + step], n)] != text[ragged(b[k : k + step], n)]
        same[k : k + step] = np.add.reduceat(differ, np.cumsum(n) - n) == 0
    return same


def distinct_words(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word of each distinct one, distinct number of each word), exact.

    Words of up to eight bytes are their own key; longer ones sort by hash and are compared.
    """
    spans = Spans(text)
    n = len(spans.ends)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    length = spans.ends - spans.starts
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(text) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    which = np.empty(n, dtype=np.int64)
    short = np.flatnonzero(length <= 8)
    drop = (_U(64) - _U(8) * length[short].astype(np.uint64)) % _U(64)
    keys = (eight[spans.starts[short]] << drop) >> drop
    _, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
    first = [short[at]]
    which[short] = inverse
    long = np.flatnonzero(length > 8)
    if len(long):
        _, at, inverse = np.unique(spans.hashes(long, long), return_index=True, return_inverse=True)
        origin = long[at][inverse]
        same = length[origin] == length[long]
        same[same] = same_bytes(text, spans.starts[long[same]], spans.starts[origin[same]], length[long[same]])
        odd = np.flatnonzero(~same)  # another word with an equal hash: a class of its own
        inverse[odd] = len(at) + np.arange(len(odd))
        which[long] = len(first[0]) + inverse
        first += [long[at], long[odd]]
    return np.concatenate(first), which
