"""Documents that hold benchmark items, found by greedy string tiling.

Seeds, runs of five words, of documents and items are joined by their hash. What a
document shares with the benchmark is reduced to a pattern of seeds, which documents with
the same passages have in common. Where a pattern has enough seeds of an item, the longest
match that overlaps no earlier one is marked again and again, found by running Karp-Rabin
hashes over both, so passages are found in any order. An item counts as leaked when the
marked tiles cover enough of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.columns import hidden, named, text_of
from tidemark.llm.hashing import chunks, not_letters, shingle_hashes, utf8, word_hashes
from tidemark.session import stage_in

#: Words of the shortest tile, and the share of an item's words that tiles must cover, in percent.
TILE, PERCENT = 5, 60
#: Bits of the filter that keeps most seeds no item has from being joined, and the slices
#: it is put together from. Its size is the same for any benchmark; a larger one lets more pass.
FILTER_BITS, SLICES = 1 << 24, 64
_BASE = np.uint64(0x9E3779B97F4A7C15)
LEAKS = "array<struct<item_id:bigint,covered:bigint,words:bigint>>"


def _hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts; letter case and punctuation do not count."""
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    words, first, base = [], [np.zeros(1, np.int64)], 0
    for a, b in chunks(offsets):
        w, f = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], not_letters())
        words.append(w)
        first.append(f[1:] + base)
        base += len(w)
    return np.concatenate(words) if words else np.zeros(0, np.uint64), np.concatenate(first)


def _powers(n: int) -> np.ndarray:
    """The powers of the hash base, from the zeroth to the ``n``-th."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE, np.uint64))), dtype=np.uint64)


def _runs(usable: np.ndarray) -> np.ndarray:
    """For each place how many usable ones follow it without a break, itself included."""
    n = len(usable)
    broken = np.append(np.flatnonzero(~usable), n)
    return broken[np.searchsorted(broken, np.arange(n))] - np.arange(n)


class _Windows:
    """The windows of a sequence of seeds, of any length, by hash, as far as they are unmarked."""

    def __init__(self, at: np.ndarray, seeds: np.ndarray, powers: np.ndarray):
        """``seeds`` begin at the words ``at`` (ascending); places between have no seed.
        ``powers`` are as many as the longest sequence to be compared needs."""
        self.at = at
        with np.errstate(over="ignore"):
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(seeds * powers[: len(seeds)], dtype=np.uint64)))
        self.lift = powers[::-1][: len(seeds) + 1]
        self.next = np.append(np.diff(at) == 1, False) if len(at) else np.zeros(0, dtype=bool)
        self.free = np.ones(len(at), dtype=bool)

    def lengths(self) -> np.ndarray:
        """For each seed how many in a row, from it on, are free and one word apart."""
        if not len(self.at):
            return np.zeros(0, np.int64)
        linked = self.next & self.free & np.append(self.free[1:], False)
        steps = _runs(linked)
        return np.where(self.free, steps + 1, 0)

    def hashes(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Karp-Rabin hashes of the ``n`` seeds from each start on."""
        with np.errstate(over="ignore"):
            return (self.sums[starts + n] - self.sums[starts]) * self.lift[starts]

    def mark(self, start: int, words: int, width: int) -> None:
        """The words of a tile are marked: seeds that touch one of them go."""
        first = self.at[start]
        a, b = np.searchsorted(self.at, [first - width + 1, first + words])
        self.free[a:b] = False


def tiles(at: np.ndarray, seeds: np.ndarray, item: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (start in the text, start in the item, words) of every tile.

    ``seeds`` of ``width`` words begin at the words ``at`` of the text, those of the item
    at each of its words. The longest match, of equal ones the first in the text, then in
    the item, is marked, then the next among what is left. Its length is found by halving:
    windows of a length are compared by their hashes. Memory follows the two lengths, not
    their product, however often a word repeats.
    """
    powers = _powers(max(len(at), len(item)))
    text, other = _Windows(at, seeds, powers), _Windows(np.arange(len(item)), item, powers)
    out: list[tuple[int, int, int]] = []
    upper = min(len(at), len(item))
    while upper:
        mine, its = text.lengths(), other.lengths()

        def common(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            a, b = np.flatnonzero(mine >= n), np.flatnonzero(its >= n)  # noqa: B023
            x, y = text.hashes(a, n), other.hashes(b, n)
            return a, x, b, y

        low, high = 0, int(min(upper, mine.max(initial=0), its.max(initial=0)))
        while low < high:
            middle = (low + high + 1) // 2
            _, x, _, y = common(middle)
            if np.isin(x, y).any():
                low = middle
            else:
                high = middle - 1
        if not low:
            break
        a, x, b, y = common(low)
        places: dict[int, list[int]] = {}
        for start, h in zip(b[::-1].tolist(), y[::-1].tolist(), strict=True):
            places.setdefault(h, []).append(start)
        hit = np.isin(x, y)
        words = low + width - 1
        for start, h in zip(a[hit].tolist(), x[hit].tolist(), strict=True):
            if not text.free[start : start + low].all():
                continue
            left = places[h]
            while left and not other.free[left[-1] : left[-1] + low].all():
                left.pop()
            if left:
                out.append((int(at[start]), left[-1], words))
                text.mark(start, words, width)
                other.mark(left[-1], words, width)
        upper = low - 1
    return out


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, size, width, seeds) of items with a word."""
    for batch in batches:
        words, first = _hashed(batch.column(1))
        rows = []
        for i, item_id in enumerate(batch.column(0).to_pylist()):
            own = words[first[i] : first[i + 1]]
            if len(own):
                seeds, _ = shingle_hashes(own, np.array([0, len(own)]), TILE)
                rows.append((item_id, len(own), min(len(own), TILE), seeds.astype("<u8").tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item_id", "size", "width", "seeds"]
        )


def _seeds_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, width, size, seed, n): the distinct seeds of each row, and how many places have them."""
    for batch in batches:
        for i in range(batch.num_rows):
            node, width, size, raw = (c[i].as_py() for c in batch.columns)
            seeds, n = np.unique(np.frombuffer(raw, "<u8"), return_counts=True)
            k = len(seeds)
            kind = batch.schema.field(0).type
            columns = [pa.array([node] * k, kind), pa.array([width] * k, pa.int32()), pa.array([size] * k, pa.int64())]
            columns += [pa.array(seeds.view(np.int64)), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "width", "size", "seed", "n"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices of a task's filter that have a bit set."""
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for batch in batches:
        places = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(FILTER_BITS)
        np.bitwise_or.at(bits, (places >> np.uint64(3)).astype(np.int64), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
    parts = bits.reshape(SLICES, -1)
    there = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(there, pa.int32()), pa.array([parts[i].tobytes() for i in there], pa.binary())], names=["slice", "bits"]
    )


def _united(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint8) for x in table["bits"].to_pylist()]
    return pa.table({"slice": table["slice"].slice(0, 1), "bits": pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())})


def _filter(seeds: DataFrame) -> np.ndarray:
    """Bits by seed, of a fixed size."""
    slices = seeds.select("seed").mapInArrow(_slices, "slice int, bits binary").groupBy("slice").applyInArrow(_united, "slice int, bits binary")
    bits = np.zeros((SLICES, FILTER_BITS // 8 // SLICES), dtype=np.uint8)
    for row in slices.collect():
        bits[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


def _patterns(bits, widths: list[int]):
    """(mark, width, pattern, at, seeds) of texts with seeds that the filter lets pass, a row a width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in batches:
            words, first = _hashed(batch.column(1))
            marks = batch.column(0).to_pylist()
            rows = []
            for a in range(0, len(marks), 256):
                b = min(a + 256, len(marks))
                for width in widths:
                    seeds, begins = shingle_hashes(words[first[a] : first[b]], first[a : b + 1] - first[a], width)
                    place = seeds % np.uint64(FILTER_BITS)
                    hit = np.flatnonzero(held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    cut = np.searchsorted(hit, begins)
                    for i in np.flatnonzero(np.diff(cut)):
                        own = hit[cut[i] : cut[i + 1]]
                        if first[a + i + 1] - first[a + i] < width:
                            continue  # the only seed of a shorter text
                        # Only whether places touch matters: wider gaps are drawn together.
                        gaps = np.minimum(np.diff(own, prepend=own[0]), width + 1)
                        at, mine = np.cumsum(gaps).astype("<u4"), seeds[own].astype("<u8").tobytes()
                        raw = at.tobytes()
                        digest = hashlib.blake2b(bytes([width]) + raw + mine, digest_size=16).digest()
                        rows.append((marks[a + i], width, digest, raw, mine))
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["mark", "width", "pattern", "at", "seeds"]
            )

    return run


def _tiled(percent: int):
    """(pattern, item_id, covered, words) of the pairs that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pattern, width, at, seeds, item_id, size, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = tiles(np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(seeds, "<u8"), np.frombuffer(item, "<u8"), width)
                covered = sum(n for _, _, n in found)
                if covered * 100 >= percent * size:
                    rows.append((pattern, item_id, covered, size))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["pattern", "item_id", "covered", "words"]
            )

    return run


def leaks(
    spark: SparkSession, texts: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(mark, leaks) of the texts that leak an item. ``texts``: (mark, text)."""
    stage = stage_in(spark, "leaks")
    source = benchmark.select(named(item_id).cast("long").alias("item_id"), text_of(item_text).alias("text")).distinct()
    items = stage(
        source.mapInArrow(_items, "item_id long, size long, width int, seeds binary").withColumn("node", F.monotonically_increasing_id())
    )
    seed_row = "node {}, width int, size long, seed long, n long"
    of_items = stage(items.select("node", "width", "size", "seeds").mapInArrow(_seeds_of, seed_row.format("long")))
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most TILE of them
    bits = spark.sparkContext.broadcast(_filter(of_items))
    shared = stage(texts.mapInArrow(_patterns(bits, widths), "mark long, width int, pattern binary, at binary, seeds binary"))

    by_pattern = shared.groupBy("pattern").agg(F.first("width").alias("width"), F.first("at").alias("at"), F.first("seeds").alias("seeds"))
    patterns = stage(by_pattern)
    of_patterns = patterns.select("pattern", "width", F.lit(0).cast("long").alias("size"), "seeds").mapInArrow(_seeds_of, seed_row.format("binary"))
    of_patterns = of_patterns.select(F.col("node").alias("pattern"), "width", "seed")
    met = of_patterns.join(of_items, ["seed", "width"]).groupBy("pattern", "node").agg(
        F.sum("n").alias("n"), F.first("size").alias("size"), F.first("width").alias("width")
    )
    # Each place of a seed covers at most its own words.
    near = stage(met.where(F.col("n") * F.col("width") * 100 >= F.col("size") * percent).select("pattern", "node"))
    pairs = near.join(patterns, "pattern").join(items.select("node", "item_id", "size", F.col("seeds").alias("item")), "node")
    tiled = pairs.select("pattern", "width", "at", "seeds", "item_id", "size", "item").mapInArrow(
        _tiled(percent), "pattern binary, item_id long, covered long, words long"
    )
    found = stage(tiled)
    marked = shared.select("mark", "pattern").distinct().join(found, "pattern").select("mark", F.struct("item_id", "covered", "words").alias("leak"))
    return stage(marked.groupBy("mark").agg(F.array_sort(F.collect_list("leak")).cast(LEAKS).alias("leaks")))


def mark_leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    to: str = "leaks",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """``docs`` with the column ``to``: the items each text leaks, as (item_id, covered, words).

    Null and empty texts leak nothing; items without a word are passed over; a null item
    id stays null; equal items count once. An item of fewer than five words is matched as
    a whole. Repeated rows get equal answers, and a column of ``docs`` named ``to`` is
    replaced. Texts and items are read whole, in chunks of some two megabytes or one
    longer text; of a text only the seeds it shares with the benchmark go on.
    """
    key = next((c for c in docs.columns if c.lower() == to.lower()), None)
    plain = docs if key is None else docs.drop(key)
    mark = hidden(plain, "mark")
    marked = plain.withColumn(mark, F.xxhash64(text_of(text)))
    found = leaks(spark, marked.select(F.col(mark).alias("mark"), text_of(text).alias("text")), benchmark, item_id, item_text, percent)
    found = found.toDF(mark, to)
    out = marked.join(found, mark, "left")
    return out.select(*[named(c) for c in plain.columns], F.coalesce(named(to), F.array().cast(LEAKS)).alias(to))


def decontaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that leak no item of ``benchmark``, all of their columns.

    Rows with null or empty texts stay, repeated rows go or stay together, an empty table
    or benchmark changes nothing.
    """
    mark = hidden(docs, "mark")
    marked = docs.withColumn(mark, F.xxhash64(text_of(text)))
    found = leaks(spark, marked.select(F.col(mark).alias("mark"), text_of(text).alias("text")), benchmark, percent=percent)
    return marked.join(found.select(F.col("mark").alias(mark)), mark, "left_anti").select(*[named(c) for c in docs.columns])
