"""Benchmark decontamination: an FM-index for each shard of the corpus, searched backwards for the benchmark's windows.

A worker gathers documents to a shard of bounded size, maps words to ids of the
benchmark's vocabulary, keeps the stretches of known words that are long enough
to hold a window, and builds one index over them: suffixes sorted, their
Burrows-Wheeler transform in a wavelet matrix with popcount ranks, and sampled
suffix positions.  All windows are searched at once; the rows of the matrix that
match are walked back to a sampled position, and overlapping occurrences merge
into removal spans.  No document is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import ALNUM, SPANS, offsets, quoted, runs, spans_column, table, text_bytes

#: Words in a window.
WINDOW = 13
#: A shard closes at this many words.
SHARD_WORDS = 2_000_000
#: Benchmark text held by a worker at once; a larger benchmark is searched in blocks of this size, one after another.
BLOCK_BYTES = 16 << 20
#: Words in one indexed chunk, besides the overlap of a window less one.
CHUNK = 128
#: One suffix position in so many is stored.
SAMPLE = 8


class WaveletMatrix:
    """Ranks over a sequence of small integers; one packed bit vector for each bit of a symbol."""

    def __init__(self, sequence: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.bits, now = bits, sequence
        for level in range(bits - 1, -1, -1):
            bit = (now >> level & 1).astype(bool)
            padded = np.zeros((len(now) // 64 + 1) * 64, bool)
            padded[: len(now)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = offsets(np.bitwise_count(packed))[:-1]
            self.levels.append((packed, before, len(now) - int(bit.sum())))
            now = np.concatenate((now[~bit], now[bit]))

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(packed[at >> 6] & below)

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position `at` of the sequence lands below, as far as `symbol` is concerned."""
        for depth, (packed, before, zeros) in enumerate(self.levels):
            ones = self._ones(packed, before, at)
            at = np.where(symbol >> (self.bits - 1 - depth) & 1, zeros + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at these positions, and where the positions land."""
        symbol = np.zeros(len(at), np.int64)
        for packed, before, zeros in self.levels:
            bit = (packed[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            ones = self._ones(packed, before, at)
            at = np.where(bit, zeros + ones, at - ones)
            symbol = symbol << 1 | bit
        return symbol, at


def sort_suffixes(text: np.ndarray, left: np.ndarray, bits: int) -> np.ndarray:
    """Positions of `text` in the order of what follows up to the next 0, then of position.

    left: symbols from each position to the next 0.  Packed prefixes are sorted
    first; then prefixes double in length among those that still tie.
    """
    n, step = len(text), max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(step):
        key <<= bits
        key[: max(0, n - k)] |= np.where(left[: max(0, n - k)] > k, text[k:], 0)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def group_starts(sorted_keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
        return np.maximum.accumulate(np.where(new, at, 0))

    rank[order] = group_starts(key[order], np.arange(n))
    while True:
        sizes = np.bincount(rank, minlength=n)
        slots = np.flatnonzero(sizes[rank[order]] > 1)
        if slots.size == 0 or step > left.max():
            return order
        tied = order[slots]
        second = np.where(left[tied] > step, rank[np.minimum(tied + step, n - 1)] + 1, 0)
        again = np.lexsort((tied, second, rank[tied]))
        tied, second = tied[again], second[again]
        order[slots] = tied
        old = rank[tied]
        new = np.concatenate(([True], (old[1:] != old[:-1]) | (second[1:] != second[:-1])))
        rank[tied] = np.maximum.accumulate(np.where(new, slots, 0))
        step *= 2


class FMIndex:
    """Over chunks of symbols 1.., each followed by a 0."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.n = len(text)
        bits = max(1, int(symbols).bit_length())
        ends = np.flatnonzero(text == 0)
        left = ends[np.searchsorted(ends, np.arange(self.n))] - np.arange(self.n)
        order = sort_suffixes(text, left, bits)
        self.tree = WaveletMatrix(text[order - 1], bits)
        self.first = offsets(np.bincount(text, minlength=symbols + 1))
        self.origin = self.tree.descend(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))
        begins = np.zeros(self.n, bool)
        begins[0] = True
        begins[ends[:-1] + 1] = True
        kept = (order % SAMPLE == 0) | begins[order]
        self.sampled_rows, self.sampled = np.flatnonzero(kept), order[kept]

    def _step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.tree.descend(symbol, row) - self.origin[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of patterns of one length (a row each): which occur, and their first and last-but-one rows."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[which, column].astype(np.int64)
            low, high = self._step(symbol, low), self._step(symbol, high)
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
            if which.size == 0:
                break
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of these rows, each walked back to a sampled one."""
        out, todo, row, walked = np.empty(len(rows), np.int64), np.arange(len(rows)), rows, 0
        while todo.size:
            near = np.minimum(np.searchsorted(self.sampled_rows, row), len(self.sampled_rows) - 1)
            known = self.sampled_rows[near] == row
            out[todo[known]] = self.sampled[near[known]] + walked
            todo, row = todo[~known], row[~known]
            symbol, landed = self.tree.access(row)
            row = self.first[symbol] + landed - self.origin[symbol]
            walked += 1
        return out


class Windows:
    """Distinct windows of a block of benchmark items, by length, with the items that hold each."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        number: dict[str, int] = {}
        holders: dict[bytes, set[int]] = {}
        for name, text in items:
            words = text.translate(ALNUM).split()
            if not words:
                continue
            item = number.setdefault(name, len(number))
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32)
            for at in range(max(1, len(ids) - window + 1)):
                holders.setdefault(ids[at : at + window].tobytes(), set()).add(item)
        self.names = list(number)
        by_length: dict[int, list[bytes]] = {}
        for key in holders:
            by_length.setdefault(len(key) // 4, []).append(key)
        #: (patterns, a row each; offsets and item numbers of their holders)
        self.groups = []
        for keys in by_length.values():
            patterns = np.frombuffer(b"".join(keys), np.int32).reshape(len(keys), -1)
            held = [sorted(holders[k]) for k in keys]
            self.groups.append((patterns, offsets(np.array([len(h) for h in held])), np.array([i for h in held for i in h], np.int64)))
        self.shortest, self.longest = min(by_length, default=0), max(by_length, default=0)

    def hits(self, ids: np.ndarray, doc_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mask of the words hit, and distinct pairs of document and item.  ids: 0 for other words and between documents."""
        covered = np.zeros(len(ids) + 1, np.int64)
        pairs = [np.empty((0, 2), np.int64)]
        starts, ends = runs(ids > 0)
        long = ends - starts >= self.shortest
        starts, ends = starts[long], ends[long]
        if starts.size and self.groups:
            pieces = np.maximum(1, -(-(ends - starts - self.longest + 1) // CHUNK))
            at = np.repeat(starts, pieces) + CHUNK * (np.arange(pieces.sum()) - np.repeat(offsets(pieces)[:-1], pieces))
            size = np.minimum(CHUNK + self.longest - 1, np.repeat(ends, pieces) - at)
            base = offsets(size + 1)
            source = np.arange(base[-1]) - np.repeat(base[:-1], size + 1) + np.repeat(at, size + 1)
            text = ids[np.minimum(source, len(ids) - 1)].astype(np.int64)
            text[base[1:] - 1] = 0
            index = FMIndex(text, len(self.vocabulary))
            for patterns, first, items in self.groups:
                which, low, high = index.search(patterns)
                if which.size == 0:
                    continue
                count = high - low
                rows = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(offsets(count)[:-1], count)
                found, window = source[index.locate(rows)], np.repeat(which, count)
                np.add.at(covered, found, 1)
                np.add.at(covered, found + patterns.shape[1], -1)
                both = np.unique(np.stack((doc_of[found], window), 1), axis=0)
                each = first[both[:, 1] + 1] - first[both[:, 1]]
                item = items[np.repeat(first[both[:, 1]], each) + np.arange(each.sum()) - np.repeat(offsets(each)[:-1], each)]
                pairs.append(np.stack((np.repeat(both[:, 0], each), item), 1))
        return np.cumsum(covered[:-1]) > 0, *np.unique(np.concatenate(pairs), axis=0).T


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items, streamed through the driver in blocks of at most `limit` bytes (one item at least)."""
    held, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    for name, text in rows.toLocalIterator():
        data = text.encode()
        if held and size + len(data) > limit:
            yield held
            held, size = [], 0
        held.append((name, data))
        size += len(data)
    yield held


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """docs with n_words, n_hit (bigint), items (array<string>, sorted), spans (word ranges to remove) and contaminated.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.
    A null or empty text has no words and is not contaminated; an item without
    words has no window; a null item id counts as ''.  Items that repeat an id
    count as one.  Repeated rows each get the same answer.  An empty benchmark
    hits nothing; no documents give no rows.  Texts of any length are searched whole.
    Columns of docs with one of the new names are replaced.
    keep: the columns of docs to return, all if None.
    Memory: a shard, or one document if that is larger, and a block of the benchmark.
    The benchmark passes through the driver block by block.  A worker process makes a
    block's windows once, whatever the number of its tasks.
    """
    spark, added = docs.sparkSession, ["n_words", "n_hit", "items", "spans", "contaminated"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    row = [quoted(c) for c in kept if c != text_col]
    frame = docs.select(F.struct(F.lit(True).alias("__sparkloom_row"), *row).alias("row"), quoted(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<string>").alias("items"), F.array().cast(SPANS).alias("spans"))
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    now = next(blocks)
    while now is not None:
        later = next(blocks, None)
        with_text = later is not None or text_col in kept
        schema = T.StructType([f for f in frame.schema.fields if with_text or f.name != "text"])
        frame = frame.mapInArrow(_searcher(spark.sparkContext.broadcast(now), uuid.uuid4().hex, window, shard_words, with_text), schema)
        now = later
    width = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    columns = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in kept]
    out = frame.select(*columns, "n_words", width.alias("n_hit"), "items", "spans")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


#: The last block's windows a worker process has made, by broadcast and window.
_MADE: dict[tuple, Windows] = {}


def _windows(name: str, items: list[tuple[str, bytes]], window: int) -> Windows:
    if (name, window) not in _MADE:
        _MADE.clear()
        _MADE[name, window] = Windows(items, window)
    return _MADE[name, window]


def _searcher(broadcast, name: str, window: int, shard_words: int, with_text: bool):
    """name: one no other broadcast has."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(name, broadcast.value, window)
        find, unknown = windows.vocabulary.get, repeat(0)

        def close(batch: pa.RecordBatch, ids: list[np.ndarray]) -> pa.RecordBatch:
            lengths = np.array([len(x) for x in ids], np.int64)
            base = offsets(lengths + 1)
            flat = np.zeros(base[-1], np.int32)
            doc_of = np.repeat(np.arange(len(ids)), lengths + 1)
            for at, x in zip(base, ids):
                flat[at : at + len(x)] = x
            mask, doc, item = windows.hits(flat, doc_of)
            names = [set(x) for x in batch.column("items").to_pylist()]
            for d, i in zip(doc.tolist(), item.tolist()):
                names[d].add(windows.names[i])
            for d, spans in enumerate(batch.column("spans").to_pylist()):  # what earlier blocks found
                for s in spans:
                    mask[base[d] + s["start"] : base[d] + s["end"]] = True
            starts, ends = runs(mask)
            owner = doc_of[starts] if starts.size else np.empty(0, np.int64)
            spans = spans_column(starts - base[owner], ends - base[owner], np.bincount(owner, minlength=len(ids)))
            columns = {"row": batch.column("row")} | ({"text": batch.column("text")} if with_text else {})
            columns |= {"n_words": pa.array(lengths), "items": pa.array([sorted(x, key=str.encode) for x in names], pa.list_(pa.string())), "spans": spans}
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            begin, size, ids = 0, 0, []
            for text in text_bytes(batch.column("text")):
                words = text.translate(ALNUM).split()
                ids.append(np.fromiter(map(find, words, unknown), np.int32, len(words)))
                size += len(words)
                if size >= shard_words:
                    yield close(batch.slice(begin, len(ids)), ids)
                    begin, size, ids = begin + len(ids), 0, []
            if ids:
                yield close(batch.slice(begin, len(ids)), ids)

    return search


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
