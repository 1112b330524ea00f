"""Vectorised word, line and n-gram hashing over Arrow string columns.

Words are runs of bytes outside ``\\x20 \\x09-\\x0D``. All hashes are 64-bit, the same on every machine and in
every process. Blocks of about one megabyte bound the working memory, apart from single longer texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

_U = np.uint64
BLOCK_BYTES = 1 << 20
WS = np.zeros(256, bool)
WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BYTES = stream(11, 256)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_R = _U(0x9E3779B97F4A7C15)
_GRAM = stream(23, 64) | _U(1)
_powers = np.ones(1, _U)
PREFIX_BYTES = 2 << 20  #: blocks up to here are hashed by prefix sums, which take 24 bytes a byte
_inverse = np.ones(1, _U)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        full = np.full(max(n, 4096), _R, _U)
        full[0] = 1
        _powers = np.cumprod(full)
    return _powers[:n]


def inverse_powers(n: int) -> np.ndarray:
    """The same powers' inverses modulo 2^64."""
    global _inverse
    if len(_inverse) < n:
        full = np.full(max(n, 4096), _U(pow(int(_R), -1, 1 << 64)), _U)
        full[0] = 1
        _inverse = np.cumprod(full)
    return _inverse[:n]


def _finish(sums: np.ndarray, lens: np.ndarray) -> np.ndarray:
    return mix(sums + lens.astype(_U) * _U(0xD6E8FEB86659FD93))


def _run_hash(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """A hash of each run of consecutive table values; all lens > 0."""
    if not len(lens):
        return np.zeros(0, _U)
    first = np.cumsum(lens) - lens
    pos = np.arange(len(values)) - np.repeat(first, lens)
    return _finish(np.add.reduceat(values * powers(int(lens.max()))[pos], first), lens)


class Block:
    """Some consecutive texts of an Arrow column, as bytes."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = (texts.fill_null("") if texts.null_count else texts).cast(pa.large_string())
        self.n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if self.n else None
        self.data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.off = off - off[0]
        self.lower = lower

    @cached_property
    def _spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ws = WS[self.data]
        before = np.ones(len(ws) + 1, bool)
        before[1:] = ws
        before[self.off] = True
        word = ~ws
        starts = np.flatnonzero(word & before[:-1])
        after = np.ones(len(ws) + 1, bool)
        after[:-1] = ws
        after[self.off] = True
        return starts, np.flatnonzero(word & after[1:]) + 1, word

    @property
    def starts(self) -> np.ndarray:
        return self._spans[0]

    @property
    def ends(self) -> np.ndarray:
        return self._spans[1]

    @cached_property
    def bounds(self) -> np.ndarray:
        """Where each text's words begin in ``words``, and the end."""
        return np.searchsorted(self.starts, self.off)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.bounds)

    @cached_property
    def _sums(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, _U)
        np.cumsum((_LOWER if self.lower else _BYTES)[self.data] * powers(len(self.data)), out=out[1:])
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from starts to ends, all runs of one byte or more."""
        lens = ends - starts
        if len(self.data) <= PREFIX_BYTES:  # differences of one prefix sum, taken to the power 0
            return _finish((self._sums[ends] - self._sums[starts]) * inverse_powers(len(self.data))[starts], lens)
        at = np.repeat(starts - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
        return _run_hash((_LOWER if self.lower else _BYTES)[self.data[at]], lens)

    @cached_property
    def words(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    @cached_property
    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def grams(self, k: int) -> np.ndarray:
        """Hashes of the k words from each word on; those that leave their text mean nothing."""
        w = self.words
        out = np.zeros(len(w), _U)
        for j in range(min(k, len(w))):
            out[: len(w) - j] += w[j:] * _GRAM[j]
        return mix(out + _U(k))

    def gram_starts(self, k: int) -> np.ndarray:
        """Which words begin k words of one text."""
        left = np.repeat(self.bounds[1:], self.n_words) - np.arange(len(self.starts))
        return left >= k

    def per_text(self, at_word: np.ndarray) -> np.ndarray:
        """Sums over each text's words."""
        total = np.concatenate([[0], np.cumsum(at_word)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def per_byte(self, at_byte: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(at_byte)])
        return total[self.off[1:]] - total[self.off[:-1]]

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, hash and order of every line that has a word."""
        nl = np.flatnonzero(self.data == 10)
        starts = np.union1d(self.off[:-1], nl + 1)
        starts = starts[starts < len(self.data)]
        doc = np.searchsorted(self.off, starts, side="right") - 1
        ends = np.minimum(np.append(nl, len(self.data))[np.searchsorted(nl, starts)], self.off[doc + 1])
        worded = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        starts, ends, doc = starts[worded], ends[worded], doc[worded]
        lens = ends - starts
        keep = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(keep, starts, 1)
        np.add.at(keep, ends, -1)
        inside = np.cumsum(keep[:-1]) > 0
        return doc, _run_hash(_BYTES[self.data[inside]], lens), np.arange(len(doc))


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES, lower: bool = False) -> Iterator[tuple[int, int, Block]]:
    """(first, end, Block) over the rows of a column, about ``limit`` bytes each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, hi, Block(texts.slice(lo, hi - lo), lower)
        lo = hi


def repeated(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values h of texts doc: whether each occurs twice or more in its text, and whether it isn't the first one there."""
    if not len(h):
        return np.zeros(0, bool), np.zeros(0, bool)
    key = mix(h + doc.astype(_U) * _U(0xA24BAED4963EE407))
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    later, twice = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, later
