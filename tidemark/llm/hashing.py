"""Hashes of the words and word shingles of an Arrow column of texts, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Multipliers of the words of a shingle by their place.
_PLACE = np.array(
    [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]
    + [(0x589965CC75374CC3 + 2 * k * 0x1D8E4E27C47D124F) % 2**64 for k in range(27)],
    dtype=np.uint64,
)
#: Bytes of text handled at once, unless one text alone is longer.
CHUNK = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def white_space() -> np.ndarray:
    """Bytes that part words: the ASCII white space."""
    parts = np.zeros(256, dtype=bool)
    parts[[9, 10, 11, 12, 13, 32]] = True
    return parts


def not_letters() -> np.ndarray:
    """Bytes that part words: every ASCII character but letters and digits."""
    parts = np.ones(256, dtype=bool)
    parts[128:] = False
    for first, last in ("09", "AZ", "az"):
        parts[ord(first) : ord(last) + 1] = False
    return parts


def ascii_lower() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with the end as last; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, parts: np.ndarray, fold: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the place in it of each text's first word (with the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~parts[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    size = np.flatnonzero(inside & (~after | edge[1:])) + 1 - start
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data if fold is None else fold[data]
    eights = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    hashes = size.astype(np.uint64) * _PLACE[0]
    live, at = np.arange(len(start)), 0
    while len(live):
        rest = size[live] - at
        piece = eights[start[live] + at]
        short = rest < 8
        piece[short] &= (np.uint64(1) << (np.uint64(8) * rest[short].astype(np.uint64))) - np.uint64(1)
        hashes[live] = mix((hashes[live] ^ piece) + _PLACE[1])
        live, at = live[rest > 8], at + 8
    return hashes, np.searchsorted(start, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``k`` words of each text, and where each text's begin.

    A text of fewer words has one shingle, all of its words; a text without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begins = np.concatenate(([0], np.cumsum(count)))
    total = int(begins[-1])
    text = np.repeat(np.arange(len(n)), count)
    at = np.arange(total) - begins[text] + first[text]
    out = np.zeros(total, dtype=np.uint64)
    for j in range(k):
        has = n[text] > j
        out[has] += words[at[has] + j] * _PLACE[j]
    return mix(out + np.minimum(n, k)[text].astype(np.uint64)), begins


def shingle_sets(
    column: pa.Array, k: int, parts: np.ndarray, fold: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts: the sorted distinct shingle hashes, text after text, and where each text's begin."""
    data, offsets = utf8(column)
    for a, b in chunks(offsets):
        words, first = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], parts, fold)
        hashes, begins = shingle_hashes(words, first, k)
        for i in range(b - a):
            hashes[begins[i] : begins[i + 1]].sort()
        fresh = np.ones(len(hashes), dtype=bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        fresh[begins[:-1][np.diff(begins) > 0]] = True
        yield hashes[fresh], np.concatenate(([0], np.cumsum(fresh)))[begins]
