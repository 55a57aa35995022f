"""Substring dedup: Rabin-Karp hashes of every window of consecutive words, counted across the corpus.

1. A worker gathers documents to a batch, rolls two polynomial hashes over the
   words of each window and deals the windows to buckets by bits of the second
   hash.  A window that a batch holds more than once is known to be repeated there and
   then; of its copies the bucket gets one hash.  Any other costs 8 bytes of hash and
   about one byte of position.
2. The task of a bucket counts its hashes and replies to each batch with the
   positions whose hash occurs again, in whatever document.
3. The task of a batch marks the words that repeated windows cover, merges them into
   maximal intervals and names each document by the MD5 of its text.
4. Documents join their intervals on that digest and drop the words.

Words are hashed once, whatever the size of the corpus.  Hot windows are no hot
keys: a batch sends a bucket one row, with one hash of a window that repeats in it.
A bucket that is too large for memory is kept in a scratch file of its task, which
is counted range by range of the hash.  Two windows are taken to be equal if 64 bits
of one hash and the bucket (bits of an independent hash) agree; with w windows
in b buckets a window has a false match with probability w / (2^64 b): 3 * 10^-11 for
100 TB in MOST_BUCKETS.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, repeatable
from ._util import SPANS, offsets, quoted, runs, spans_column, table, text_bytes, total_bytes

WINDOW = 35
#: Text in a batch and text for each bucket, in bytes.
BATCH_BYTES, BUCKET_BYTES = 12 << 20, 16 << 20
#: Most buckets, and hashes that a task holds in memory at once.
MOST_BUCKETS, STEP_HASHES = 1 << 15, 8 << 20
#: A text with more than one in so many of all copies is dealt to several tasks when it meets its intervals; hence there are at most so many.
SHARE = 1_000
#: The two bases (odd, 3 mod 8, so that their powers have the longest period) and the seed of word hashes.
BASES, SEED = (0x9E3779B97F4A7C13, 0xC2B2AE3D27D4EB4B), 35

_DEALT = "bucket int, batch long, kind int, hashes binary, places binary"


class WordHashes(dict):
    """XXH64 of words, remembered; forgets all when it holds too many."""

    def __init__(self, seed: int, most: int = 500_000) -> None:
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def window_hashes(words: np.ndarray, window: int, base: int) -> np.ndarray:
    """Rabin-Karp: sum of words[i + j] * base^(window - 1 - j) modulo 2^64 for each window, by differences of prefix sums."""
    n = len(words)
    if n < window:
        return np.empty(0, np.uint64)

    def powers(of: int, count: int) -> np.ndarray:
        factors = np.full(count, of, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(_inverse(base), n), out=sums[1:])
    back = powers(base, n) if n > window - 1 else None
    return (sums[window:] - sums[:-window]) * back[window - 1 :]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash: every bit of x counts in every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pack_places(places: np.ndarray) -> bytes:
    """Ascending numbers as gaps: a byte each, or after a 255 four bytes."""
    gaps = np.diff(places, prepend=-1) - 1
    wide = gaps >= 255
    head = np.minimum(gaps, 255).astype(np.uint8)
    return np.uint32(wide.sum()).tobytes() + gaps[wide].astype(np.uint32).tobytes() + head.tobytes()


def unpack_places(packed: bytes) -> np.ndarray:
    wide = int(np.frombuffer(packed, np.uint32, 1)[0])
    gaps = np.frombuffer(packed, np.uint8, offset=4 + 4 * wide).astype(np.int64)
    gaps[gaps == 255] = np.frombuffer(packed, np.uint32, wide, 4)
    return np.cumsum(gaps + 1) - 1


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "batch", "kind", "hashes", "places"])


def _deal(window: int, buckets: int, batch_bytes: int):
    """Batches of text to rows of windows (kind 1) for the buckets, one of document digests (kind 0) and one of the windows repeated in the batch (kind 2)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, number, memo = TaskContext.get().partitionId(), 0, WordHashes(SEED)

        def close(digests: list[bytes], hashed: list[np.ndarray]) -> pa.RecordBatch:
            name = partition << 32 | number
            lengths = np.array([len(x) for x in hashed], np.int64)
            base, words = offsets(lengths), np.concatenate(hashed)
            starts = np.ones(max(0, len(words) - window + 1), bool)
            for last in base[1:-1]:  # windows that reach into the next document
                starts[max(0, last - window + 1) : last] = False
            at = np.flatnonzero(starts)
            value, other = (window_hashes(words, window, b)[at] for b in BASES)
            bucket = ((mix(other) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16)
            value = mix(value)
            order = np.argsort(value)
            order = order[np.argsort(bucket[order], kind="stable")]
            same = (value[order[1:]] == value[order[:-1]]) & (bucket[order[1:]] == bucket[order[:-1]])
            again = np.zeros(len(at), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            first = np.concatenate(([True], ~same))[: len(order)]
            known = order[first & again[order]]  # one of each window that repeats here
            alone = np.flatnonzero(~again)
            alone = alone[np.argsort(bucket[alone], kind="stable")]
            of_alone, of_known = (offsets(np.bincount(bucket[x], minlength=buckets)) for x in (alone, known))
            rows = [(int(name % buckets), name, 0, b"".join(digests), base.tobytes()), (int(name % buckets), name, 2, b"", pack_places(at[again]))]
            for b in np.flatnonzero(np.diff(of_alone) + np.diff(of_known)).tolist():
                mine, shared = alone[of_alone[b] : of_alone[b + 1]], known[of_known[b] : of_known[b + 1]]
                rows.append((b, name, 1, value[mine].tobytes() + value[shared].tobytes(), pack_places(at[mine])))
            return _rows(rows)

        digests, hashed, size = [], [], 0
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                words = text.split()
                if len(words) < window:
                    continue
                digests.append(hashlib.md5(text).digest())
                hashed.append(memo.of(words))
                size += len(text)
                if size >= batch_bytes:
                    yield close(digests, hashed)
                    digests, hashed, size, number = [], [], 0, number + 1
        if digests:
            yield close(digests, hashed)

    return deal


class _Bucket:
    """Rows (batch, hashes, places) of a bucket: in memory while they are few, else in a scratch file."""

    def __init__(self, step: int) -> None:
        self.step, self.rows, self.file, self.sizes, self.held = step, [], None, [], 0

    def add(self, row: tuple[int, bytes, bytes]) -> None:
        self.sizes.append(len(row[1]) // 8)
        self.rows.append(row)
        self.held += self.sizes[-1]
        if self.held > self.step:
            self.file = self.file or tempfile.TemporaryFile()
            for held in self.rows:
                pickle.dump(held, self.file)
            self.rows, self.held = [], 0

    def __iter__(self) -> Iterator[tuple[int, bytes, bytes]]:
        if self.file:
            self.file.seek(0)
            for _ in range(len(self.sizes) - len(self.rows)):
                yield pickle.load(self.file)
        yield from self.rows

    def again(self) -> list[np.ndarray]:
        """For each row, which of its hashes the bucket holds more than once; packed."""
        steps = -(-sum(self.sizes) // self.step)
        cuts = [(k << 64) // steps for k in range(steps)] + [(1 << 64) - 1]
        out = [np.zeros(n, bool) if steps == 1 else np.zeros(-(-n // 8), np.uint8) for n in self.sizes]
        for k in range(steps):
            values, places = [], []
            for _, hashes, _ in self:
                x = np.frombuffer(hashes, np.uint64)
                inside = np.ones(len(x), bool) if steps == 1 else (x >= np.uint64(cuts[k])) & ((x < np.uint64(cuts[k + 1])) | (k == steps - 1))
                places.append(np.flatnonzero(inside))
                values.append(x[inside])
            flat = np.concatenate(values)
            order = np.argsort(flat)
            ranked = flat[order]
            same = ranked[1:] == ranked[:-1]
            found = np.zeros(len(flat), bool)
            found[order[1:][same]] = True
            found[order[:-1][same]] = True
            at = 0
            for i, (place, n) in enumerate(zip(places, self.sizes)):
                mine = np.zeros(n, bool)
                mine[place] = found[at : at + len(place)]
                out[i] = mine if steps == 1 else out[i] | np.packbits(mine)
                at += len(place)
        return out if steps == 1 else [np.unpackbits(bits, count=n).astype(bool) for bits, n in zip(out, self.sizes)]


def _count(step: int):
    """Of one partition: for each bucket, tells each batch the places of its windows that occur again."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Bucket] = {}
        for batch in batches:
            for bucket, name, kind, hashes, places in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 1:
                    held.setdefault(bucket, _Bucket(step)).add((name, hashes, places))
                else:
                    yield _rows([(bucket, name, kind, hashes, places)])
        for number in list(held):
            bucket = held.pop(number)
            told = []
            for (name, _, places), again in zip(bucket, bucket.again()):
                at = unpack_places(places)
                mine = at[again[: len(at)]]
                if len(mine):
                    told.append((number, name, 1, b"", pack_places(mine)))
                if len(told) >= 256:
                    yield _rows(told)
                    told = []
            yield _rows(told)

    return count


def _merge(window: int):
    """All rows of one batch to the removal intervals of its documents."""

    def merge(group: pa.Table) -> pa.Table:
        kinds, hashes, places = (group.column(c).to_pylist() for c in ("kind", "hashes", "places"))
        digests, base = next(((hashes[i], np.frombuffer(places[i], np.int64)) for i, k in enumerate(kinds) if k == 0))
        change = np.zeros(base[-1] + 1, np.int32)
        for kind, packed in zip(kinds, places):
            if kind:
                at = unpack_places(packed)
                change[at] += 1
                change[at + window] -= 1
        covered = np.cumsum(change[:-1]) > 0
        begins, ends, owners, copies = [], [], [], {}
        for d in range(len(base) - 1):
            name = digests[16 * d : 16 * d + 16]
            if name not in copies:
                s, e = runs(covered[base[d] : base[d + 1]])
                begins.append(s)
                ends.append(e)
                owners.append(len(s))
            copies[name] = copies.get(name, 0) + 1
        counts = np.array(owners)
        spans = spans_column(np.concatenate(begins), np.concatenate(ends), counts)
        out = pa.table({"digest": pa.array([name.hex() for name in copies]), "copies": pa.array(list(copies.values()), pa.int64()), "removed_spans": spans})
        return out.filter(pa.array(counts > 0))

    return merge


def repeated_spans(docs: DataFrame, text_col: str = "text", window: int = WINDOW, batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES, step_hashes: int = STEP_HASHES) -> DataFrame:
    """digest (MD5 of the text, hex), copies and removed_spans of each distinct text that holds a repeated window.

    docs must be repeatable().
    """
    buckets = min(MOST_BUCKETS, max(1, -(-total_bytes(docs, text_col) // bucket_bytes)))
    dealt = docs.select(quoted(text_col).cast("binary").alias("text")).mapInArrow(_deal(window, buckets, batch_bytes), _DEALT)
    told = dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(_count(step_hashes), _DEALT)
    spans = told.groupBy("batch").applyInArrow(_merge(window), f"digest string, copies bigint, removed_spans {SPANS}")
    return spans.groupBy("digest").agg(F.sum("copies").alias("copies"), F.first("removed_spans").alias("removed_spans"))


def dedup_substrings(docs: DataFrame, text_col: str = "text", window: int = WINDOW, keep: list[str] | None = None, share: int = SHARE, **sizes: int) -> DataFrame:
    """docs with n_words, n_removed (bigint), removed_spans (word intervals, maximal) and kept_text (words left, joined by a space).

    Words are runs of characters other than the six ASCII spaces.  A word goes
    if a window of `window` words that covers it starts anywhere else as well, in
    another document or the same; windows are judged on the input, so no copy
    is spared.  Null, empty and shorter texts lose nothing; texts of any length are
    taken whole; a repeated row is a copy like any other.  An empty table gives no
    rows.  Columns of docs with one of the new names are replaced.  keep: the columns
    of docs to return, all if None.  docs that are not repeatable() are written once.
    """
    added = ("n_words", "n_removed", "removed_spans", "kept_text")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    docs = repeatable(docs.select(*(quoted(c) for c in dict.fromkeys([*kept, text_col]))))
    spans = materialize(repeated_spans(docs, text_col, window, **sizes))
    part = max(1, (spans.agg(F.sum("copies")).first()[0] or 0) // share)
    parts = F.ceil(F.col("copies") / part).cast("int").alias("parts")
    hot = spans.where(F.col("copies") > part).select(F.col("digest").alias("hot"), parts)  # at most `share` of them
    text = F.coalesce(quoted(text_col), F.lit(""))
    left = docs.select(F.struct(F.lit(True).alias("__sparkloom_row"), *(quoted(c) for c in kept)).alias("row"), text.alias("text"), F.md5(text.cast("binary")).alias("digest")).join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left")
    # a text with too few spaces for a window has no intervals, so its copies may go anywhere
    short = F.length("text") - F.length(F.translate("text", " \t\n\x0b\x0c\r", "")) + 1 < window
    spread = F.when(short, F.lit(share)).otherwise(F.coalesce("parts", F.lit(1)))
    left = left.withColumn("part", F.pmod(F.monotonically_increasing_id(), spread).cast("int")).select("row", F.col("text").cast("binary").alias("data"), "digest", "part")
    dealt = spans.select("digest", "removed_spans", F.explode(F.sequence(F.lit(0), F.when(F.col("copies") > part, parts).otherwise(F.lit(1)) - 1)).alias("part"))
    joined = left.join(dealt.hint("shuffle_hash"), ["digest", "part"], "left").select("row", "data", "removed_spans")
    out = joined.mapInArrow(_cut, joined.select("row").schema.add("n_words", "long").add("n_removed", "long").add("removed_spans", joined.schema["removed_spans"].dataType).add("kept_text", "string"))
    return out.select(*(F.col("row")[c].alias(c) for c in kept), *added)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, texts, begin, size = [], [], [], 0, 0
        spans = batch.column("removed_spans")

        def close() -> pa.RecordBatch:
            part = batch.slice(begin, len(counts))
            filled = pa.array([x or [] for x in part.column("removed_spans").to_pylist()], spans.type)
            return pa.RecordBatch.from_arrays([part.column("row"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), filled, pa.array(texts, pa.binary()).cast(pa.string())], ["row", "n_words", "n_removed", "removed_spans", "kept_text"])

        for i, text in enumerate(text_bytes(batch.column("data"))):
            words = text.split()
            counts.append(len(words))
            gone, left, last = 0, [], 0
            for s in spans[i].as_py() or ():
                left += words[last : s["start"]]
                gone, last = gone + s["end"] - s["start"], s["end"]
            removed.append(gone)
            texts.append(b" ".join(left + words[last:] if last else words))
            size += len(text)
            if size >= 16 << 20:
                yield close()
                begin, counts, removed, texts, size = begin + len(counts), [], [], [], 0
        if counts:
            yield close()


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_substrings(docs, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
