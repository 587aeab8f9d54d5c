"""Word and shingle hashes of whole Arrow batches of texts, in numpy.

A word is a longest run of bytes other than ASCII white space (tab to carriage return,
and space). A word's hash adds up a mixed number for every eight bytes of it and their
place, so no Python object is made for a word, and words of any pattern collide by chance
only (a polynomial modulo 2^64 gives whole families of words one value). Texts are cut into slices of whole
texts, so memory follows ``SLICE`` or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5  # words
SLICE = 1_000_000  # bytes of text handled at once, unless one text is longer

_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # of two independent hashes
_PLACE = np.uint64(0xD1B54A32D192ED03)  # odd
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes
_WEIGHTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) and where each begins, plus the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most ``size`` bytes each, or of one text."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, side="right")) - 1)
        yield i, j
        i = j


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word, which never goes past its text's end."""
    n = len(data)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of the bytes of spans that are not empty."""
    size = ends - starts
    number = (size + 7) >> 3
    first = np.cumsum(number) - number
    place = np.arange(number.sum()) - np.repeat(first, number)
    at = np.repeat(starts, number) + 8 * place
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each byte on
    value = eights[at] & _MASKS[np.minimum(np.repeat(ends, number) - at, 8)]
    value = mixed(value ^ (np.uint64(_SALTS[which]) + place.astype(np.uint64) * _PLACE))
    if len(value) > len(size):
        value = np.add.reduceat(value, first)
    return mixed(value + size.astype(np.uint64) * _PLACE)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and where each text's words begin, plus the end."""
    starts, ends = word_spans(data, bounds)
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside each text (repeats included), and
    where each text's begin. A text of fewer words, but some, has one shingle of all."""
    count = np.diff(bounds)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    own = np.repeat(np.arange(len(count)), count)  # text of each word
    left = bounds[1:][own] - np.arange(n)  # words from here to the end of the text
    total = words * _WEIGHTS[0]
    for k in range(1, min(size, n)):
        weight = _WEIGHTS[k % len(_WEIGHTS)] + np.uint64(2 * (k // len(_WEIGHTS)))
        total[: n - k] += np.where(left[: n - k] > k, words[k:] * weight, np.uint64(0))
    begins = np.zeros(n, bool)
    begins[bounds[:-1][count > 0]] = True
    valid = (left >= size) | (begins & (left < size))
    kept = np.where(left < size, left, size)[valid].astype(np.uint64)
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    return mixed(total[valid] + kept), np.concatenate([[0], np.cumsum(number)])


def permutations(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends of ``count`` universal hash functions."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def signatures(shingles: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash signatures, one row for each text; a text without shingles has the
    largest value everywhere."""
    out = np.full((len(bounds) - 1, len(a)), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        work = np.empty_like(shingles)
        for k in range(len(a)):
            np.multiply(shingles, a[k], out=work)
            work += b[k]
            out[some, k] = np.minimum.reduceat(work, bounds[some]) >> np.uint64(32)
    return out


def text_shingles(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, after, shingles, bounds)`` for consecutive slices of the texts."""
    data, bounds = text_bytes(texts)
    for i, j in slices(bounds):
        part = bounds[i : j + 1]
        words, at = word_hashes(data[part[0] : part[-1]], part - part[0])
        yield i, j, *shingle_hashes(words, at, size)
