"""Fill-in-middle: documents cut in three and put together so that the middle comes last.

The cuts are ranks of units (a run of ASCII letters, or any other single character).
An indexable skip list leads from a rank to the code point it ends at: each link of a
lane carries how many units and how many code points it spans, so a descent by
accumulated widths reaches a rank exactly without a table of all prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import named, text_of
from tidemark.llm.hashing import chunks, mix, utf8

#: Marks before the prefix, the suffix and the middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, those that are transformed, and of these those whose suffix comes first.
RATE, SUFFIX_FIRST = 90, 20


class SkipList:
    """The units of a text in express lanes.

    Node 0 of each lane is the head; node k of the lowest lane stands behind unit k. A
    node of a lane is in the lane above it with a chance of one in four, by a hash of its
    place. ``units[l][k]`` and ``points[l][k]`` are the widths of the link behind node k of
    lane l, ``down[l][k]`` is that node's place in the lane below. Building takes room in
    proportion to the units, a descent some four steps a lane.
    """

    def __init__(self, points: np.ndarray):
        """``points``: the code points of each unit."""
        nodes = np.arange(len(points) + 1)
        self.units = [np.ones(len(points), dtype=np.int64)]
        self.points = [points.astype(np.int64)]
        self.down: list[np.ndarray] = [nodes]
        coins = mix(nodes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        while len(nodes) > 8:
            lane = len(self.units)
            rises = (coins[nodes] >> np.uint64(2 * lane % 64)) & np.uint64(3) == 0
            rises[0] = True
            places = np.flatnonzero(rises)
            if len(places) == 1:
                break
            # The widths of a link are the sums of those it passes over; the last node has no link.
            last = places[-1]
            self.units.append(np.add.reduceat(self.units[-1][:last], places[:-1]))
            self.points.append(np.add.reduceat(self.points[-1][:last], places[:-1]))
            self.down.append(places)
            nodes = nodes[places]

    def seek(self, ranks: np.ndarray) -> np.ndarray:
        """The code points before the end of the first ``ranks`` units, for all ranks at once."""
        at = np.zeros(len(ranks), dtype=np.int64)
        left, point = np.array(ranks, dtype=np.int64), np.zeros(len(ranks), dtype=np.int64)
        for lane in reversed(range(len(self.units))):
            units, points = self.units[lane], self.points[lane]
            go = np.arange(len(ranks))
            while len(go):
                go = go[at[go] < len(units)]
                go = go[units[at[go]] <= left[go]]
                left[go] -= units[at[go]]
                point[go] += points[at[go]]
                at[go] += 1
            at = self.down[lane][at]
        return point


def _letters() -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for first, last in ("AZ", "az"):
        out[ord(first) : ord(last) + 1] = True
    return out


def units_of(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of every unit of UTF-8 texts, and the place in it of each text's first unit (with the end)."""
    lead = (data & 0xC0) != 0x80
    letter = letters[data]
    begins = lead & ~letter
    begins[1:] |= letter[1:] & ~letter[:-1]
    if len(data):
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    points = np.cumsum(lead)
    widths = np.diff(np.append(points[starts] - 1, points[-1] if len(points) else 0))
    return widths, np.searchsorted(starts, offsets)


def _draws(id: int | None) -> list[int]:
    digest = hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _cut(rate: int, suffix_first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in chunks(offsets):
                ids, texts = (c.slice(a, b - a).to_pylist() for c in batch.columns)
                widths, first = units_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], letters)
                counts = np.diff(first)
                draws = [_draws(i) for i in ids]
                ranks = np.array([sorted((h[0] % (n + 1), h[1] % (n + 1))) for h, n in zip(draws, counts.tolist(), strict=True)])
                # One list holds the units of all texts; a text's own ranks begin at its first unit.
                sought = (ranks + first[:-1, None]).ravel()
                points = SkipList(widths).seek(np.concatenate((sought, first[:-1])))
                ends = points[: len(sought)].reshape(-1, 2) - points[len(sought) :, None]
                rows = []
                for i, text, h, n, (p, m) in zip(ids, texts, draws, counts.tolist(), ends.tolist(), strict=True):
                    if not text or h[2] % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append((i, n, "plain", None, None, text))
                        continue
                    prefix, middle, suffix = text[:p], text[p:m], text[m:]
                    if h[3] % 100 < suffix_first:
                        out = ("spm", p, m - p, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
                    else:
                        out = ("psm", p, m - p, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")
                    rows.append((i, n, *out))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def middle_last(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """Per row of ``docs``: doc_id, n (units), form, prefix_chars, middle_chars, output.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or
    ``plain``, the text unchanged: some ``100 - rate`` of a hundred, empty texts, and texts
    that hold a mark themselves. Cuts and form depend on the id alone, so repeated rows
    get equal answers; a null id is drawn for as an empty one and stays null. A null text
    is empty. Texts are whole, however long: a task holds some two megabytes of text, or
    one longer text, with its list. Other columns are not read.
    """
    source = docs.select(named(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return source.mapInArrow(
        _cut(rate, suffix_first), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(form: Column, output: Column) -> Column:
    """The text from which an output was made. No piece holds a mark, so the first one found is it."""

    def pieces(first: str, second: str) -> list[Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        return [
            F.substring_index(body, second, 1),
            F.substring_index(F.substring_index(body, second, -1), MIDDLE, 1),
            F.substring_index(body, MIDDLE, -1),
        ]

    prefix, suffix, middle = pieces(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = pieces(SUFFIX, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
