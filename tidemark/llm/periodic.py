"""Runs of words that repeat with a period, and texts with each run cut to its first period.

A grid of step p is laid over the words for every period p, so there are n/p points for
it and n log n in all. A run of three periods covers three points in a row of its grid;
where these agree, the longest common extensions (LCE) to both sides of two points give
the whole run. LCEs are answered by a difference cover: only suffixes that begin in the
cover are sorted, any two places reach two such suffixes after the same few words, which
are compared one by one, and a range minimum over the sorted suffixes gives the rest.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.columns import named, text_of
from tidemark.llm.hashing import chunks

#: Each difference modulo 31 is one of two members of the cover (fixed values).
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
#: A run is as long as so many words and so many periods at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words that must agree behind the first grid point of a run: LEAST_WORDS - 2 * 7 or, from period 8 on, 8.
AGREE = 8
#: Pairs of grid points extended at once.
PAIRS = 1 << 17


class Extensions:
    """Longest common extensions of the suffixes of a sequence of words' numbers."""

    def __init__(self, words: np.ndarray):
        """``words``: numbers from 0 on, or negative ones that occur once. Takes some
        hundred bytes a word at most; sorting is of some fifth of all suffixes."""
        v, cover = MODULUS, np.array(COVER)
        blocks = len(words) // v + 2
        # Behind the end stand numbers that occur nowhere else, so all suffixes differ.
        least = min(0, int(words.min(initial=0)))
        pad = least - 1 - np.arange((blocks + 2) * v - len(words))
        self.words = np.concatenate((words, pad)).astype(np.int32)
        self._classes = np.full(v, -1)
        self._classes[cover] = np.arange(len(cover))
        self._shift = np.zeros(v, dtype=np.int64)
        for a in cover[::-1]:
            for b in cover:
                self._shift[(b - a) % v] = a
        places = (cover[:, None] + v * np.arange(blocks)[None, :]).ravel()
        self._row = blocks + 1
        self._sort(places, blocks)

    def _sort(self, places: np.ndarray, blocks: int) -> None:
        """Rank the sampled suffixes by doubling: a suffix is its first block and the suffix behind it."""
        v, m = MODULUS, len(places)
        first = np.lib.stride_tricks.sliding_window_view(self.words, v)[places]
        names = np.unique(np.ascontiguousarray(first).view(f"S{4 * v}").ravel(), return_inverse=True)[1]
        levels = [self._table(names.astype(np.int32), blocks)]
        while int(names.max()) < m - 1:
            step = 1 << (len(levels) - 1)
            behind = np.full((len(COVER), blocks), -1, dtype=np.int64)
            behind[:, : max(0, blocks - step)] = names.reshape(len(COVER), blocks)[:, step:]
            names = np.unique(names.astype(np.int64) * (m + 1) + behind.ravel() + 1, return_inverse=True)[1]
            levels.append(self._table(names.astype(np.int32), blocks))
        self._rank = levels[-1]
        order = np.empty(m, dtype=np.int64)
        order[names] = np.arange(m)
        flat = (order // blocks) * self._row + order % blocks
        common = self._common(levels[:-1], flat[:-1], flat[1:], places[order[:-1]], places[order[1:]])
        table = [common.astype(np.int32)]
        while 2 << (len(table) - 1) <= len(common):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self._least = table

    def _table(self, names: np.ndarray, blocks: int) -> np.ndarray:
        """The names by class and block, with a last column for what lies behind the end."""
        out = np.full((len(COVER), blocks + 1), -1, dtype=np.int32)
        out[:, :blocks] = names.reshape(len(COVER), blocks)
        return out.ravel()

    def _common(self, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common prefixes of suffixes that follow each other: by whole levels, then by words."""
        out, last = np.zeros(len(a), dtype=np.int64), self._row - 1
        a, b = a.copy(), b.copy()
        for k in reversed(range(len(levels))):
            same = (levels[k][a] == levels[k][b]) & (levels[k][a] >= 0)
            step = 1 << k
            for x in (a, b):
                x[same] += np.minimum(step, last - x[same] % self._row)
            out[same] += step * MODULUS
        return out + self._walk(i + out, j + out, np.full(len(a), MODULUS))

    def _walk(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from i and j on agree, up to ``most``."""
        out, live = np.zeros(len(i), dtype=np.int64), np.arange(len(i))
        t = 0
        while len(live):
            live = live[most[live] > t]
            live = live[self.words[i[live] + t] == self.words[j[live] + t]]
            t += 1
            out[live] = t
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of different places: how many words from them on agree."""
        few = (self._shift[(j - i) % MODULUS] - i) % MODULUS
        out = self._walk(i, j, few)
        met = np.flatnonzero(out == few)
        if not len(met):
            return out
        a, b = (self._rank[self._classes[x % MODULUS] * self._row + x // MODULUS] for x in (i[met] + few[met], j[met] + few[met]))
        low, high = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        rest = np.empty(len(met), dtype=np.int64)
        for level in np.unique(k):
            at, row = k == level, self._least[level]
            rest[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(level))])
        out[met] += rest
        return out


def grid_pairs(words: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(places, p): points i of the grid of step p where i, i + p and i + 2p, and the words behind i and i + p, agree.

    The first point of each run of three periods is among them. ``words`` holds texts by
    descending ``lengths``, each with a number of its own behind it; ``ends`` says where.
    """
    padded = np.concatenate((words, int(words.min()) - 1 - np.arange(AGREE)))
    for p in range(1, int(lengths[0]) // LEAST_PERIODS + 1):
        texts = int(np.searchsorted(-lengths, -max(LEAST_WORDS, LEAST_PERIODS * p), side="right"))
        if not texts:
            return
        grid = words[: ends[texts - 1] : p]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[1:] & same[:-1])
        if len(at):
            at *= p
            for t in range(1, AGREE):
                # Where a comparison would leave the sequence, a number before it has differed.
                at = at[padded[at + t] == padded[at + p + t]]
            if len(at):
                yield at, p


def _laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts by descending length one after another, each with a number of its own behind it: words, lengths, ends."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    parts = [x for k, t in enumerate(texts) for x in (t, np.array([-1 - k], dtype=np.int32))]
    return np.concatenate(parts), lengths, np.cumsum(lengths + 1) - 1


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text of words' numbers, by start, then period.

    A run is a stretch of ``LEAST_WORDS`` words and ``LEAST_PERIODS`` of its smallest
    period at least that no neighbouring word extends.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    by_length = sorted((k for k, t in enumerate(texts) if len(t) >= LEAST_WORDS), key=lambda k: -len(texts[k]))
    if not by_length:
        return found
    words, lengths, ends = _laid_out([texts[k] for k in by_length])
    hit = np.zeros(len(by_length), dtype=bool)
    for at, _ in grid_pairs(words, lengths, ends):
        hit[np.searchsorted(ends, at)] = True
    by_length = [k for k, h in zip(by_length, hit, strict=True) if h]
    if not by_length:
        return found

    words, lengths, ends = _laid_out([texts[k] for k in by_length])
    ahead, back = Extensions(words), Extensions(words[::-1])
    n = len(words)

    def extended(pairs: list[tuple[np.ndarray, int]]) -> np.ndarray:
        i = np.concatenate([a for a, _ in pairs])
        p = np.repeat([p for _, p in pairs], [len(a) for a, _ in pairs])
        before = back.lce(n - i, n - i - p)
        length = before + p + ahead.lce(i, i + p)
        keep = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        return np.unique(np.stack((i - before, length, p))[:, keep], axis=1)

    runs, pairs, held = np.zeros((3, 0), dtype=np.int64), [], 0
    for at, p in grid_pairs(words, lengths, ends):
        for a in range(0, len(at), PAIRS):
            pairs.append((at[a : a + PAIRS], p))
            held += len(pairs[-1][0])
            if held >= PAIRS:
                runs, pairs, held = _smallest(np.concatenate((runs, extended(pairs)), axis=1)), [], 0
    if pairs:
        runs = _smallest(np.concatenate((runs, extended(pairs)), axis=1))
    begins = ends - lengths
    for start, length, period in runs.T.tolist():
        k = int(np.searchsorted(ends, start))
        found[by_length[k]].append((start - int(begins[k]), length, period))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of runs over the same stretch the one with the smallest period: the others' periods are its multiples."""
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    fresh = np.ones(runs.shape[1], dtype=bool)
    fresh[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
    return runs[:, fresh]


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains behind its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~drop)]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column(1).cast(pa.large_binary())).to_numpy(zero_copy_only=False)
        for a, b in chunks(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))):
            ids, texts = (c.slice(a, b - a) for c in batch.columns)
            # bytes.split() parts words at ASCII white space.
            words = [t.split() for t in texts.cast(pa.large_binary()).to_pylist()]
            numbers: defaultdict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            runs = runs_of([np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in words])
            rest = [b" ".join(without_repeats(w, r)) for w, r in zip(words, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs], _RUNS),
                    pa.array(rest, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs, collapsed.

    ``runs`` lists (start, length, period) of every run of the whole text by start, then
    period, in words (parted by ASCII white space). ``collapsed`` is the text's words
    without those that some run repeats, joined by one space. A null, empty or blank text
    has no words; null ids stay null; repeated rows get equal answers. A task holds some
    two megabytes of text, or one longer text; of a text that repeats itself, indexes of
    some two hundred bytes a word come on top. Other columns are not read.
    """
    source = docs.select(named(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return source.mapInArrow(_collapsed, schema)


def strongest(runs: Column) -> Column:
    """The run of the greatest length in periods, the first by start, then period, of equals; null without a run."""

    def before(x: Column, y: Column) -> Column:
        more = y["length"] * x["period"] - x["length"] * y["period"]
        return F.when(more != 0, F.signum(more).cast("int")).when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int")).otherwise(
            F.signum(x["period"] - y["period"]).cast("int")
        )

    return F.get(F.array_sort(runs, before), F.lit(0))
