"""Words and rolling hashes over the byte buffers of Arrow batches, vectorised with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text whose arrays are held at once (one text may be longer).
CHUNK_BYTES = 1 << 18

#: Bytes of words: all but white space.
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_TABLE = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        pair = np.array([[base], [pow(base, -1, 1 << 64)]], np.uint64)
        steps = np.repeat(pair, size, axis=1)
        steps[:, 0] = 1
        have = tuple(np.cumprod(steps, axis=1))
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = have
    return have


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every `width` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, len(values))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
    return mix((sums[width:] - sums[:n]) * down[:n])


def ranges(values: np.ndarray, first: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[first:stop] for each pair."""
    up, down = _powers(base, len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
    length = (stop - first).astype(np.uint64)
    return mix((sums[stop] - sums[first]) * down[first] + mix(length))


class Chunk:
    """Some texts of a batch: rows first..last, their bytes, and the words in them.

    starts, ends: byte places of every word; first_word: index of each row's first word, and
    at the end the number of words.
    """

    def __init__(self, first: int, offsets: np.ndarray, data: np.ndarray, letters: np.ndarray):
        self.first, self.last = first, first + len(offsets) - 1
        self.data = data[offsets[0] : offsets[-1]]
        at = self.offsets = offsets - offsets[0]
        word = letters[self.data]
        before = np.concatenate([[False], word[:-1]]) if len(word) else word
        begins = at[:-1][at[:-1] < len(word)]
        before[begins] = False
        self.starts = np.flatnonzero(word & ~before)
        after = np.concatenate([word[1:], [False]]) if len(word) else word
        stops = at[1:][at[1:] > 0] - 1
        after[stops] = False
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first_word = np.searchsorted(self.starts, at)

    def text(self, k: int) -> str:
        return self.data[self.offsets[k] : self.offsets[k + 1]].tobytes().decode()

    def _hashed(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each range, made for CHUNK_BYTES at a time."""
        out = [np.zeros(0, np.uint64)]
        k = 0
        while k < len(starts):
            base = starts[k]
            stop = max(k + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
            s, e = starts[k:stop] - base, ends[k:stop] - base
            up, down = _powers(0x9E3779B97F4A7C15, int(e[-1]) + 1)
            terms = _TABLE[self.data[base : base + e[-1]]] * up[: e[-1]]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
            h = (sums[e] - sums[s]) * down[s]
            out.append(mix(h + (e - s).astype(np.uint64)))
            k = stop
        return np.concatenate(out)

    def word_hashes(self) -> np.ndarray:
        return self._hashed(self.starts, self.ends)

    def prefix_hashes(self, lengths: list[int]) -> dict[int, np.ndarray]:
        """By length: a hash of the first bytes of each word that has so many."""
        out = {}
        for n in lengths:
            starts = self.starts[self.ends - self.starts >= n]
            out[n] = mix(self._hashed(starts, starts + n) + np.uint64(1))
        return out


def chunks(texts: pa.Array, letters: np.ndarray = _NOT_SPACE) -> Iterator[Chunk]:
    """The texts of a batch (nulls as empty), about CHUNK_BYTES at a time; letters: bytes of words."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1)
        yield Chunk(first, at[first : last + 1], data, letters)
        first = last
