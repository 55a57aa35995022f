"""LM scoring by Brown class n-grams.

Words are clustered by exchange: each moves to the class where the likelihood of
the class bigrams gains most.  The classes are seeded on the driver, where the CORE
commonest words and the others by their last three characters (hashed to a fixed
number of endings) are exchanged one by one until nothing moves.  Then the whole
vocabulary is exchanged in distributed passes: in each, every word of `least` training
tokens or more is moved by the pairs it occurs in, whatever its ending.  Rarer and
unseen words keep the class of their ending.
p(word | history) = p(class | two classes before) * p(word | class), class
trigrams smoothed by bigrams and those by single classes, words by one more count
each and one unseen word in each class.  All counts cover all training documents.

The vocabulary is as large as the corpus makes it and no worker ever holds it:

1. Documents are encoded in batches, each with its distinct words in the order of
   their 64-bit hashes, and written to the shared checkpoint folder.
2. Batches send hashes and counts to buckets of the vocabulary, which are ranges of the
   hash; a bucket adds them up and answers each batch, in the order of its words,
   with the corpus's counts and the numbers of the words that passes move.
3. Pairs of units are counted over the batches, and the classes are seeded.
4. In a pass, batches send their words' classes and how often classes stand before and
   after them; a bucket adds that up, moves its words and answers with their classes.
5. Triples of classes are counted; batches score their documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release
from ._util import LOWER, arrow_rows, held_out, offsets, quoted, table, text_bytes, total_bytes

#: Words seeded one by one; endings; classes, the first for the end of a document; most rounds of seeding.
CORE, ENDINGS, CLASSES, SEED_ROUNDS = 1024, 512, 64, 50
#: Distributed passes over the vocabulary; tokens of a word that passes move.
PASSES, LEAST = 2, 3
#: Weight of the shorter history, in counts.
BACK_OFF = 30.0
#: Text in a batch, text for each vocabulary bucket, in bytes; most buckets.
BATCH_BYTES, BUCKET_BYTES, MOST_BUCKETS = 8 << 20, 24 << 20, 1 << 15
#: Hashes of a bucket looked at in one step; words of a bucket moved in one step.
STEP_HASHES, STEP_WORDS = 4 << 20, 1 << 15
UNITS = CORE + ENDINGS + 1
END = UNITS - 1
#: What a pass counts for a word: classes after it, classes before it, itself after itself.
WIDTH = 2 * CLASSES + 1


class _Local(dict):
    """Numbers words in the order they first occur."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0, byte planes apart (as many as the largest needs), compressed."""
    wide = values.astype("<u8")
    width = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + len(wide).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = pa.decompress(data[9:], decompressed_size=width * n, codec="zstd", asbytes=True)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


def ending(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word.decode(errors="replace")[-3:].encode(), 3) % ENDINGS


def _encode(batch_bytes: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, number = TaskContext.get().partitionId(), 0
        local, tokens, ids, held, size, id_type = _Local(), [], [], [], 0, None

        def close() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in tokens], np.int32)
            words = list(local)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
            order = np.argsort(hashes, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            flat = rank[np.concatenate(tokens)]
            counts = np.bincount(flat[np.repeat(~np.array(held), lengths)], minlength=len(words))
            endings = np.fromiter(map(ending, words), np.uint32, len(words))[order]
            row = pa.StructArray.from_arrays([pa.array(ids, id_type), pa.array(held), pa.array(lengths)], ["id", "held_out", "n"])
            docs = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), row)
            columns = [pa.array([partition << 32 | number]), docs, *(pa.array([x], pa.binary()) for x in (pack(flat), hashes[order].tobytes(), pack(endings), pack(counts)))]
            return pa.RecordBatch.from_arrays(columns, ["batch", "docs", "tokens", "hashes", "endings", "counts"])

        for batch in batches:
            id_type = batch.schema.field("id").type
            texts = text_bytes(batch.column("text"))
            for key, out, text in zip(batch.column("id").to_pylist(), batch.column("held_out").to_pylist(), texts):
                words = text.translate(LOWER).split()
                tokens.append(np.fromiter(map(local.__getitem__, words), np.uint32, len(words)))
                ids.append(key)
                held.append(bool(out))
                size += len(text) + 64
                if size >= batch_bytes:
                    yield close()
                    local, tokens, ids, held, size, number = _Local(), [], [], [], 0, number + 1
        if ids:
            yield close()

    return encode


_DEALT = "bucket int, batch long, hashes binary, endings binary, counts binary"
_REPLY = "kind int, batch long, bucket int, counts binary, vids binary, hash long, ending int, n long, tokens long"
_REPLY_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64())


def _table(rows: list[tuple], schema: str, types: tuple) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(names), types)], names)


def _deal(buckets: int):
    """A batch's words, which are in the order of their hashes, to the buckets: ranges of the hash."""
    begins = np.array([-(-(b << 32) // buckets) << 32 for b in range(buckets)], np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, hashes, endings, counts in zip(*(batch.column(c).to_pylist() for c in ("batch", "hashes", "endings", "counts"))):
                hashed, tails, n = np.frombuffer(hashes, np.uint64), unpack(endings), unpack(counts)
                bound = np.append(np.searchsorted(hashed, begins), len(hashed))
                rows = [(b, name, hashed[i:j].tobytes(), pack(tails[i:j]), pack(n[i:j])) for b in np.flatnonzero(np.diff(bound)).tolist() for i, j in [bound[b : b + 2].tolist()]]
                yield _table(rows, _DEALT, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))

    return deal


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault(bucket, []).append(row)
    for bucket in list(held):
        yield bucket, held.pop(bucket)


def _vocabulary(core: int, least: int):
    """Per bucket: the answers to batches (kind 1), words and tokens by ending (kind 0), words by ending that passes do not move (kind 3), the commonest words (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            lists = [np.frombuffer(r[1], np.uint64) for r in rows]
            answers = [(np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)) for x in lists]
            types, tokens, fixed = (np.zeros(ENDINGS, np.int64) for _ in range(3))
            best, moved = np.empty((0, 3), np.uint64), 0
            # ranges of the hash, so that a bucket of any size is counted step by step
            steps = max(1, -(-sum(map(len, lists)) // STEP_HASHES))
            low, high = min(int(x[0]) for x in lists), max(int(x[-1]) for x in lists) + 1
            cuts = [np.searchsorted(x, np.array([low + (high - low) * k // steps for k in range(steps)], np.uint64)).tolist() + [len(x)] for x in lists]
            tails_of, counts_of = [unpack(r[2]) for r in rows], [unpack(r[3]) for r in rows]
            for k in range(steps):
                part = [slice(c[k], c[k + 1]) for c in cuts]
                distinct, first, number = np.unique(np.concatenate([x[p] for x, p in zip(lists, part)]), return_index=True, return_inverse=True)
                total = np.zeros(len(distinct), np.int64)
                np.add.at(total, number, np.concatenate([n[p] for n, p in zip(counts_of, part)]))
                tails = np.concatenate([t[p] for t, p in zip(tails_of, part)])[first]
                moves = total >= least
                vid = np.where(moves, moved + np.cumsum(moves), 0)
                moved += int(moves.sum())
                known = total > 0
                types += np.bincount(tails[known], minlength=ENDINGS)
                np.add.at(tokens, tails, total)
                fixed += np.bincount(tails[known & ~moves], minlength=ENDINGS)
                top = np.column_stack((total[known].astype(np.uint64), distinct[known], tails[known].astype(np.uint64)))
                best = np.concatenate((best, top))
                best = best[np.lexsort((best[:, 1], ~best[:, 0]))[:core]]
                at = 0
                for (count, number_of), p in zip(answers, part):
                    mine = number[at : at + p.stop - p.start]
                    count[p], number_of[p] = total[mine], vid[mine]
                    at += len(mine)
            for (name, *_), (count, number_of) in zip(rows, answers):
                yield _table([(1, name, bucket, pack(count), pack(number_of), None, None, None, None)], _REPLY, _REPLY_TYPES)
            yield _table([(0, None, bucket, None, None, None, e, int(types[e]), int(tokens[e])) for e in np.flatnonzero(types).tolist()], _REPLY, _REPLY_TYPES)
            yield _table([(3, None, bucket, None, None, None, e, int(fixed[e]), None) for e in np.flatnonzero(fixed).tolist()], _REPLY, _REPLY_TYPES)
            yield _table([(2, None, bucket, None, None, int(h.astype(np.int64)), int(e), int(n), None) for n, h, e in best], _REPLY, _REPLY_TYPES)

    return run


def exchange(rows: np.ndarray, cols: np.ndarray, n: np.ndarray, units: int, classes: int, rounds: int = SEED_ROUNDS, end: int | None = None) -> np.ndarray:
    """Class of each unit from counts n of pairs (rows, cols), by exchange; the unit `end` alone has class 0."""
    n = n.astype(float)
    size = np.bincount(rows, n, units) + np.bincount(cols, n, units)
    order = np.argsort(-size, kind="stable")
    order = order[order != end]
    low = 0 if end is None else 1
    of = np.zeros(units, np.int64)
    of[order] = low + np.arange(len(order)) % (classes - low)
    by_row, by_col = np.argsort(rows, kind="stable"), np.argsort(cols, kind="stable")
    row_at, col_at = offsets(np.bincount(rows, minlength=units)), offsets(np.bincount(cols, minlength=units))
    pairs = np.zeros((classes, classes))
    np.add.at(pairs, (of[rows], of[cols]), n)
    left, right = pairs.sum(1), pairs.sum(0)

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    diagonal = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for u in order.tolist():
            if not size[u]:
                continue
            a, b = by_row[row_at[u] : row_at[u + 1]], by_col[col_at[u] : col_at[u + 1]]
            own = n[a][cols[a] == u].sum()
            after = np.bincount(of[cols[a]], n[a] * (cols[a] != u), classes)
            before = np.bincount(of[rows[b]], n[b] * (rows[b] != u), classes)
            k = of[u]
            for sign in (-1, 1):
                pairs[k] += sign * after
                pairs[:, k] += sign * before
                pairs[k, k] += sign * own
                left[k] += sign * (after.sum() + own)
                right[k] += sign * (before.sum() + own)
                if sign < 0:  # without u: what does each class gain by it?
                    in_row, in_col = f(pairs + after) - f(pairs), (f(pairs.T + before) - f(pairs.T))
                    in_row[diagonal, diagonal] = in_col[diagonal, diagonal] = 0
                    d = pairs[diagonal, diagonal]
                    gain = in_row.sum(1) + in_col.sum(1) + f(d + after + before + own) - f(d)
                    gain -= f(left + after.sum() + own) - f(left) + f(right + before.sum() + own) - f(right)
                    best = low + int(np.argmax(gain[low:]))
                    moved += best != k and gain[best] > gain[k] + 1e-9
                    k = best if gain[best] > gain[k] + 1e-9 else k
                    of[u] = k
        if not moved:
            break
    return of


@dataclass
class Model:
    """All that scoring needs besides the counts and classes of a document's own words; of fixed size."""

    log_next: np.ndarray  # log10 p(class | two classes before)
    room: np.ndarray  # tokens + words + 1 of each class
    tokens: int
    words: int
    ends: int


@dataclass
class Seed:
    """The classes before the first pass, by core word and ending; of fixed size."""

    core: np.ndarray  # hashes, sorted
    core_unit: np.ndarray
    class_of: np.ndarray  # of units

    def units(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        unit = CORE + endings.astype(np.int64)
        if len(self.core):
            at = np.minimum(np.searchsorted(self.core, hashes), len(self.core) - 1)
            unit = np.where(self.core[at] == hashes, self.core_unit[at], unit)
        return unit

    def classes(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        return self.class_of[self.units(hashes, endings)]


def _sequences(docs: list[dict], flat: np.ndarray, end: int, training_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """A batch's documents, an `end` after each, and their lengths."""
    lengths = np.array([d["n"] for d in docs], np.int64)
    use = ~np.array([d["held_out"] for d in docs]) if training_only else np.ones(len(lengths), bool)
    flat = flat[np.repeat(use, lengths)]
    lengths = lengths[use]
    out = np.full(len(flat) + len(lengths), end)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)] = flat
    return out, lengths


def _shifted(now: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """One and two before each of a batch's sequence; a document's first word has only ends before it."""
    before = np.concatenate(([end], now[:-1]))[: len(now)]
    two = np.where(before == end, end, np.concatenate(([end], before[:-1]))[: len(now)])
    return before, two


def _count_units(seed: Seed):
    """Counts of pairs of units in training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS**2, np.int64)
        for batch in batches:
            for docs, tokens, hashes, endings in zip(*(batch.column(c).to_pylist() for c in ("docs", "tokens", "hashes", "endings"))):
                unit = seed.units(np.frombuffer(hashes, np.uint64), unpack(endings))
                now, _ = _sequences(docs, unit[unpack(tokens)], END, True)
                total += np.bincount(_shifted(now, END)[0] * UNITS + now, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["key", "n"])

    return count


def _smooth(triples: np.ndarray) -> np.ndarray:
    """log10 p(class | two before) by Dirichlet back-off to shorter histories and, last, to evenness."""
    pairs, single = triples.sum(0), triples.sum((0, 1))
    one = (single + 1) / (single.sum() + CLASSES)
    two = (pairs + BACK_OFF * one) / (pairs.sum(1, keepdims=True) + BACK_OFF)
    three = (triples + BACK_OFF * two[None]) / (triples.sum(2, keepdims=True) + BACK_OFF)
    return np.log10(three)


class _Answers:
    """What the buckets told a batch, put together in the order of its words."""

    def __init__(self, batch: pa.Table, replies: pa.Table, seed: Seed) -> None:
        self.batch, self.docs = batch.column("batch")[0].as_py(), batch.column("docs")[0].as_py()
        self.tokens = unpack(batch.column("tokens")[0].as_py())
        rows = sorted(zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "counts", "vids"))), key=lambda r: r[:2])
        told = [r for r in rows if r[0] == 1]
        none = [np.empty(0, np.int64)]
        counts = [unpack(r[2]) for r in told]
        self.buckets, self.bound = [r[1] for r in told], offsets(np.array([len(c) for c in counts], np.int64))
        self.counts, self.vids = np.concatenate(counts + none), np.concatenate([unpack(r[3]) for r in told] + none)
        moved = [np.frombuffer(r[2], np.uint8) for r in rows if r[0] == 4]
        if moved:
            self.classes = np.concatenate(moved).astype(np.int64)
        elif not len(self.counts):  # a batch without words, which no bucket knows
            self.classes = none[0]
        else:
            self.classes = seed.classes(np.frombuffer(batch.column("hashes")[0].as_py(), np.uint64), unpack(batch.column("endings")[0].as_py()))


_SENT = "bucket int, batch long, classes binary, vids binary, sizes binary, keys binary, counts binary"
_SENT_TYPES = (pa.int32(), pa.int64(), *[pa.binary()] * 5)


def _send(seed: Seed):
    """A batch's part in a pass, bucket by bucket; to bucket -1 its pairs of classes."""

    def send(batch: pa.Table, replies: pa.Table) -> pa.Table:
        a = _Answers(batch, replies, seed)
        end = len(a.counts)
        now, _ = _sequences(a.docs, a.tokens, end, True)
        before, _ = _shifted(now, end)
        kind = np.append(a.classes, 0)
        pairs = np.bincount(kind[before] * CLASSES + kind[now], minlength=CLASSES**2)
        mine = np.flatnonzero(a.vids)
        number = np.full(end + 1, -1)
        number[mine] = np.arange(len(mine))
        same = (before == now) & (now != end)
        after = (number[before] >= 0) & ~same
        ahead = (number[now] >= 0) & ~same
        itself = (number[now] >= 0) & same
        keys = np.concatenate((number[before[after]] * WIDTH + kind[now[after]], number[now[ahead]] * WIDTH + CLASSES + kind[before[ahead]], number[now[itself]] * WIDTH + 2 * CLASSES))
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
        n, keys = np.diff(np.append(first, len(keys))), keys[first]
        word_at = np.searchsorted(mine, a.bound)
        key_at = np.searchsorted(keys, word_at * WIDTH)
        sizes = np.bincount(keys // WIDTH, minlength=len(mine))
        rows = [(-1, a.batch, None, None, None, None, pack(pairs))]
        for i, bucket in enumerate(a.buckets):
            words, those, held = slice(*a.bound[i : i + 2]), slice(*key_at[i : i + 2]), slice(*word_at[i : i + 2])
            rows.append((bucket, a.batch, a.classes[words].astype(np.uint8).tobytes(), pack(a.vids[words]), pack(sizes[held]), (keys[those] % WIDTH).astype(np.uint8).tobytes(), pack(n[those])))
        return pa.Table.from_batches([_table(rows, _SENT, _SENT_TYPES)])

    return send


def gains(pairs: np.ndarray) -> np.ndarray:
    """What each class gives a word for each count of a pass, by the class bigrams: whole numbers, so that sums do not depend on their order."""
    p = pairs + 0.5
    log_p, left, right = np.log(p), np.log(p.sum(1)), np.log(p.sum(0))
    table_of = np.vstack((log_p.T - left[None, :], log_p - right[None, :], (np.diag(log_p) - left - right)[None, :]))
    return np.round(table_of * 4096).astype(np.int64)


def _move(pairs: np.ndarray):
    """Per bucket: moves its words, and answers each batch with its words' classes (kind 4); words moved by class (kind 5)."""
    worth = gains(pairs)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            vids = [unpack(r[2]) for r in rows]
            words = max((int(v.max(initial=0)) for v in vids), default=0)
            was, now = np.zeros(words + 1, np.int64), np.zeros(words + 1, np.int64)
            entries = []
            for (_, classes, _, sizes, keys, counts), v in zip(rows, vids):
                was[v] = np.frombuffer(classes, np.uint8)
                entries.append((v[v > 0], offsets(unpack(sizes)), np.frombuffer(keys, np.uint8).astype(np.int64), unpack(counts)))
            for begin in range(1, words + 1, STEP_WORDS):
                end = min(words + 1, begin + STEP_WORDS)
                total = np.zeros((end - begin, WIDTH), np.int64)
                for v, at, keys, counts in entries:
                    i, j = np.searchsorted(v, (begin, end))
                    owner = np.repeat(v[i:j] - begin, np.diff(at[i : j + 1]))
                    np.add.at(total, (owner, keys[at[i] : at[j]]), counts[at[i] : at[j]])
                score = total @ worth
                score[:, 0] = np.iinfo(np.int64).min
                best, own = score.argmax(axis=1), was[begin:end]
                rows_of = np.arange(end - begin)
                now[begin:end] = np.where(score[rows_of, best] > score[rows_of, own], best, own)
            for (name, classes, *_), v in zip(rows, vids):
                answer = np.where(v > 0, now[v], np.frombuffer(classes, np.uint8)).astype(np.uint8)
                yield _table([(4, name, bucket, answer.tobytes(), None, None, None, None, None)], _REPLY, _REPLY_TYPES)
            held = np.bincount(now[1:], minlength=CLASSES)
            yield _table([(5, None, bucket, None, None, None, k, int(held[k]), None) for k in np.flatnonzero(held).tolist()], _REPLY, _REPLY_TYPES)

    return move


def _count_triples(seed: Seed):
    def count(batch: pa.Table, replies: pa.Table) -> pa.Table:
        a = _Answers(batch, replies, seed)
        now, _ = _sequences(a.docs, a.classes[a.tokens], 0, True)
        before, two = _shifted(now, 0)
        total = np.bincount((two * CLASSES + before) * CLASSES + now, minlength=CLASSES**3)
        at = np.flatnonzero(total)
        return pa.table({"key": pa.array(at), "n": pa.array(total[at])})

    return count


def _scorer(seed: Seed, model: Model, id_type: pa.DataType):
    def score(batch: pa.Table, replies: pa.Table) -> pa.Table:
        a = _Answers(batch, replies, seed)
        end = len(a.counts)
        now, lengths = _sequences(a.docs, a.tokens, end, False)
        count_of = np.append(a.counts, model.ends)[now]
        kind = np.append(a.classes, 0)[now]
        before, two = _shifted(kind, 0)
        emit = np.where(now == end, 1.0, (count_of + 1) / model.room[kind])
        each = model.log_next[two, before, kind] + np.log10(emit)
        base = np.log10((count_of + 1) / (model.tokens + model.words + 1))
        first = offsets(lengths + 1)[:-1]
        return pa.table(
            {
                "id": pa.array([d["id"] for d in a.docs], id_type),
                "held_out": pa.array([d["held_out"] for d in a.docs]),
                "n_tokens": pa.array(lengths + 1),
                "n_known": pa.array(np.add.reduceat((count_of > 0).astype(np.int64), first)),
                "train_tokens": pa.array(np.full(len(a.docs), model.tokens)),
                "base_score": pa.array(np.add.reduceat(base, first)),
                "score": pa.array(np.add.reduceat(each, first)),
            }
        )

    return score


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held: Column | None = None,
    batch_bytes: int = BATCH_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    core: int = CORE,
    passes: int = PASSES,
    least: int = LEAST,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Tokens are A-Z lower-cased words between ASCII spaces and one end a document;
    a null or empty text is the end alone, and texts of any length are scored whole.
    held: which rows are not learned from (default: none).  base_score is the unigram model
    with one count more; both scores are log10 probabilities of the whole text.  A null id is
    kept; repeated rows are learned from and scored each.  Without training rows all words
    are unseen.  An empty table gives no rows.  Other columns of docs play no part, whatever
    their names.  Of words of one count those of smaller hash (unsigned) are in the core, so
    scores depend neither on the sizes of batches and buckets nor on the order of rows.
    core: at most CORE words are seeded one by one.  least: 1 moves every training word.
    """
    spark = docs.sparkSession
    source = docs.select(quoted(id_col).alias("id"), (F.lit(False) if held is None else F.coalesce(held, F.lit(False))).alias("held_out"), quoted(text_col).alias("text"))
    kind = dict(source.dtypes)["id"]
    with arrow_rows(spark, 500):
        encoded = materialize(source.mapInArrow(_encode(batch_bytes), f"batch long, docs array<struct<id:{kind},held_out:boolean,n:int>>, tokens binary, hashes binary, endings binary, counts binary"))
    buckets = min(MOST_BUCKETS, max(1, -(-total_bytes(docs, text_col) // bucket_bytes)))
    dealt = encoded.select("batch", "hashes", "endings", "counts").mapInArrow(_deal(buckets), _DEALT)
    replies = materialize(dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(_vocabulary(min(core, CORE), least), _REPLY))
    seed, pairs, types, model = _seed(encoded, replies, min(core, CORE), least)
    told, full = replies.where("kind = 1"), encoded.select("batch", "docs", "tokens", "hashes", "endings")
    classes: DataFrame | None = None
    for _ in range(passes):
        sent = materialize(_met(full, told, classes).applyInArrow(_called(_send, spark.sparkContext.broadcast(seed)), _SENT))
        if classes is not None:
            pairs = _pairs(sent)
        after = materialize(sent.where("bucket >= 0").repartitionById(buckets, F.col("bucket")).mapInArrow(_move(pairs), _REPLY))
        release(sent)
        release(classes)
        classes = after.where("kind = 4")
        classes._sparkloom_path = after._sparkloom_path
        full = encoded.select("batch", "docs", "tokens")
        types = _tally(after.where("kind = 5"), "n", CLASSES) + model.fixed
    shared = spark.sparkContext.broadcast(seed)
    triples = np.zeros(CLASSES**3)
    got = _met(full, told, classes).applyInArrow(_called(_count_triples, shared), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    triples[got.column("key").to_numpy()] = got.column("n").to_numpy()
    triples = triples.reshape((CLASSES,) * 3)
    room = triples.sum((0, 1)) + types + 1
    final = spark.sparkContext.broadcast(Model(_smooth(triples), room, model.tokens, model.words, model.ends))  # of fixed size, whatever the corpus
    id_type = pa.array([], encoded.select("docs").limit(0).toArrow().schema.field("docs").type.value_type.field("id").type).type
    run = lambda a, b: _scorer(shared.value, final.value, id_type)(a, b)
    out = _met(full, told, classes).applyInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def _met(batches: DataFrame, told: DataFrame, classes: DataFrame | None):
    """Each batch with the answers to it."""
    columns = ["kind", "batch", "bucket", "counts", "vids"]
    answers = told.select(*columns) if classes is None else told.select(*columns).unionByName(classes.select(*columns))
    return batches.groupBy("batch").cogroup(answers.groupBy("batch"))


def _called(make, shared):
    return lambda a, b: make(shared.value)(a, b)


def _tally(rows: DataFrame, what: str, size: int) -> np.ndarray:
    """Sums by the column `ending`, of fixed number."""
    out = np.zeros(size, np.int64)
    for r in rows.groupBy("ending").agg(F.sum(what).alias("n")).collect():
        out[r.ending] = r.n
    return out


def _pairs(sent: DataFrame) -> np.ndarray:
    """Pairs of classes over all batches."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**2, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += unpack(packed)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["key", "n"])

    got = sent.where("bucket = -1").select("counts").mapInArrow(add, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES**2, np.int64)
    out[got.column("key").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(CLASSES, CLASSES)


@dataclass
class _Totals:
    tokens: int
    words: int
    ends: int
    fixed: np.ndarray  # words that passes do not move, by class


def _seed(encoded: DataFrame, replies: DataFrame, core: int, least: int) -> tuple[Seed, np.ndarray, np.ndarray, _Totals]:
    """The seeded classes, their pairs, the words of each, and totals of the training documents."""
    types, tokens = (_tally(replies.where("kind = 0"), c, ENDINGS) for c in ("n", "tokens"))
    fixed = _tally(replies.where("kind = 3"), "n", ENDINGS)
    unsigned = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
    best = replies.where("kind = 2").orderBy(F.desc("n"), unsigned).select("hash", "ending", "n").limit(core).collect()
    ends = encoded.select(F.sum(F.size(F.filter("docs", lambda d: ~d["held_out"])))).first()[0] or 0
    hashes = np.array([r.hash for r in best], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    kinds, rare = np.zeros(UNITS, np.int64), np.zeros(UNITS, np.int64)  # words of each unit, and those that passes do not move
    kinds[CORE:END], rare[CORE:END] = types, fixed
    for i, r in enumerate(best):
        kinds[i], rare[i] = 1, r.n < least
        kinds[CORE + r.ending] -= 1
        rare[CORE + r.ending] -= r.n < least
    seed = Seed(hashes[order], order, np.zeros(UNITS, np.int64))
    got = encoded.select("docs", "tokens", "hashes", "endings").mapInArrow(_count_units(seed), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = got.column("key").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(key)
    key, n = key[order], n[order]
    seed.class_of = exchange(key // UNITS, key % UNITS, n, UNITS, CLASSES, end=END)
    pairs = np.zeros((CLASSES, CLASSES), np.int64)
    np.add.at(pairs, (seed.class_of[key // UNITS], seed.class_of[key % UNITS]), n)
    of_class = lambda x: np.bincount(seed.class_of, x, CLASSES).astype(np.int64)
    return seed, pairs, of_class(kinds), _Totals(int(tokens.sum() + ends), int(types.sum() + (ends > 0)), int(ends), of_class(rare))


def op5_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, held=held_out(F.col("doc_id"), 7, 2))
