import collections
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import class_lm as op
from sparkloom.llm._util import table


def brute(docs):
    """docs: (id, held out, text); all but the model's score."""
    split = [bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()).split() + [None] for _, _, t in docs]
    count = collections.Counter(w for (_, h, _), words in zip(docs, split) if not h for w in words)
    total = sum(count.values())
    return [(d, h, len(w), sum(count[x] > 0 for x in w), total, sum(math.log10((count[x] + 1) / (total + len(count) + 1)) for x in w)) for (d, h, _), w in zip(docs, split)]


def compare(got, want):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    want = sorted(want, key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(want, key=lambda r: (str(r[0]), r[2]))):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


def test_packing():
    for values in ([], [0], [1, 255, 256, 2**32 - 1], [5 * 10**11, 2**62]):
        assert op.unpack(op.pack(np.array(values, np.int64))).tolist() == values


def brute_scores(docs, core=op.CORE, passes=op.PASSES, least=op.LEAST):
    """The model word by word; only exchange() is the module's, which has a test of its own."""
    split = [(h, bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()).split()) for _, h, t in docs]
    count = collections.Counter(w for h, words in split if not h for w in words)
    ends = sum(not h for h, _ in split)
    digest = lambda w: xxhash.xxh64_intdigest(w)
    common = {w: i for i, w in enumerate(sorted(count, key=lambda w: (-count[w], digest(w)))[:core])}
    unit = lambda w: 1536 if w is None else common.get(w, 1024 + xxhash.xxh64_intdigest(w.decode()[-3:].encode(), 3) % 512)
    training = [w for h, words in split if not h for w in [*words, None]]
    pairs = list(zip([None, *training], training))
    tally = collections.Counter((unit(a), unit(b)) for a, b in pairs)
    rows, cols = (np.array([k[i] for k in sorted(tally)], np.int64).reshape(-1) for i in (0, 1))
    of = op.exchange(rows, cols, np.array([tally[k] for k in sorted(tally)], np.int64), 1537, 64, end=1536)
    kind = {w: int(of[unit(w)]) for w in {w for _, words in split for w in words}} | {None: 0}
    for _ in range(passes):
        table_of = np.full((64, 64), 0.5)
        for a, b in pairs:
            table_of[kind[a], kind[b]] += 1
        log_of = lambda x: math.log(x)
        left, right = table_of.sum(1), table_of.sum(0)
        whole = lambda x: round(4096 * x)
        after, before, itself = (collections.defaultdict(collections.Counter) for _ in range(3))
        for a, b in pairs:
            if a == b and a is not None:
                itself[a][0] += 1
            else:
                after[a][kind[b]] += 1
                before[b][kind[a]] += 1
        new = dict(kind)
        for w in count:
            if count[w] >= least:
                def worth(k):
                    x = sum(n * whole(log_of(table_of[k, c]) - log_of(left[k])) for c, n in after[w].items())
                    x += sum(n * whole(log_of(table_of[c, k]) - log_of(right[k])) for c, n in before[w].items())
                    return x + itself[w][0] * whole(log_of(table_of[k, k]) - log_of(left[k]) - log_of(right[k]))

                best = max(range(1, 64), key=lambda k: (worth(k), -k))
                new[w] = best if worth(best) > worth(kind[w]) else kind[w]
        kind = new
    triples = np.zeros((64, 64, 64))
    two, one = 0, 0
    for w in training:
        triples[two, one, kind[w]] += 1
        two, one = (0, 0) if w is None else (one, kind[w])
    single, double = triples.sum((0, 1)), triples.sum(0)
    p1 = (single + 1) / (single.sum() + 64)
    p2 = (double + 30 * p1) / (double.sum(1, keepdims=True) + 30)
    p3 = (triples + 30 * p2[None]) / (triples.sum(2, keepdims=True) + 30)
    room = single + np.bincount([kind[w] for w in count], minlength=64) + 1
    out = []
    for h, words in split:
        total, two, one = 0.0, 0, 0
        for w in [*words, None]:
            total += math.log10(p3[two, one, kind[w]]) + (math.log10((count[w] + 1) / room[kind[w]]) if w is not None else 0.0)
            two, one = one, kind[w]
        out.append(total)
    return out, (p3, kind, room, count, ends)


def language(n=120, seed=5):
    """Texts with some structure: words of a few kinds follow one another."""
    rng = random.Random(seed)
    kinds = [[f"{a}{i}{z}" for i in range(9)] for a, z in (("N", "on"), ("v", "es"), ("d", "e"), ("p", "on"))]
    return [(k if k % 11 else None, k % 4 == 0, " ".join(rng.choice(kinds[(j + rng.randrange(2)) % 4]) for j in range(rng.choice([0, 3, 25, 60])))) for k in range(n)]


@pytest.mark.parametrize("how", [{}, {"core": 6}, {"core": 6, "passes": 0}, {"core": 3, "passes": 3, "least": 1}])
def test_scores_of_the_model(spark, how):
    docs = language()
    frame = spark.createDataFrame(docs, "doc_id long, h boolean, text string")
    want = collections.Counter((d, h, round(s, 7)) for (d, h, _), s in zip(docs, brute_scores(docs, **how)[0]))
    for sizes in ({}, {"batch_bytes": 900, "bucket_bytes": 700}):
        got = op.score_texts(frame, held=F.col("h"), **sizes, **how).collect()
        assert collections.Counter((r.doc_id, r.held_out, round(r.score, 7)) for r in got) == want


def test_scores_are_a_distribution():
    """Over all words the model knows, one unseen word of each class and the end, probabilities after any history add up to one at most, and to one where every class has its unseen word."""
    p3, kind, room, count, _ = brute_scores(language())[1]
    known = {k: sum(count[w] + 1 for w in count if kind[w] == k) + 1 for k in range(1, 64)}
    for two, one in ((0, 0), (0, 5), (7, 9), (63, 1)):
        total = p3[two, one, 0] + sum(p3[two, one, k] * known[k] / room[k] for k in range(1, 64))
        assert total == pytest.approx(1.0)


def test_counts_beyond_32_bits():
    """A bucket's totals and a pass's choice with counts that no 32-bit number holds."""
    hashes, endings, counts = np.array([5, 9], np.uint64), np.array([1, 2]), np.array([3 * 10**11, 2])
    rows = [(0, name, hashes.tobytes(), op.pack(endings), op.pack(counts)) for name in (1, 2)]
    batch = op._table(rows, op._DEALT, (op.pa.int32(), op.pa.int64(), op.pa.binary(), op.pa.binary(), op.pa.binary()))
    out = [r for b in op._vocabulary(10, 3)(iter([batch])) for r in b.to_pylist()]
    assert [op.unpack(r["counts"]).tolist() for r in out if r["kind"] == 1] == [[6 * 10**11, 4]] * 2
    assert {(r["hash"], r["n"]) for r in out if r["kind"] == 2} == {(5, 6 * 10**11), (9, 4)}
    pairs = np.full((64, 64), 10**13)
    assert int(np.abs(op.gains(pairs)).max()) * 2 * 10**13 < 2**63  # a word's pairs on either side


def likelihood(rows, cols, n, of, classes):
    m = np.zeros((classes, classes))
    np.add.at(m, (of[rows], of[cols]), n)
    f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return f(m) - f(m.sum(1)) - f(m.sum(0))


def test_exchange_reaches_a_local_optimum():
    rng = np.random.default_rng(7)
    pairs = np.unique(rng.integers(0, 20, (150, 2)), axis=0)
    n = rng.integers(1, 9, len(pairs))
    of = op.exchange(pairs[:, 0], pairs[:, 1], n, 20, 4, rounds=50, end=19)
    assert of[19] == 0 and (of[:19] > 0).all()
    best = likelihood(pairs[:, 0], pairs[:, 1], n, of, 4)
    for u in range(19):
        for k in (1, 2, 3):
            other = of.copy()
            other[u] = k
            assert likelihood(pairs[:, 0], pairs[:, 1], n, other, 4) <= best + 1e-6


@pytest.mark.parametrize("sizes", [{}, {"batch_bytes": 300, "bucket_bytes": 500}])
def test_small_tables(spark, sizes):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "B", "b.", "é", "ccc", "dddd", f"w{k}"]) for _ in range(rng.choice([0, 1, 2, 30]))) for k in range(50)]
    docs = [(k, k % 3 == 0, t) for k, t in enumerate(texts)] + [(None, False, None), (51, True, ""), (52, False, "x " * 50_000), (4, False, texts[4])]
    frame = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, h boolean, text string, id int, batch string")
    got = op.score_texts(frame, held=F.col("h"), **sizes).collect()
    compare(got, brute(docs))
    assert sorted(round(r.score, 6) for r in got) == sorted(round(x, 6) for x in brute_scores(docs)[0])
    none = op.score_texts(frame, held=F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in none} == {(0, 0, 0.0)}
    assert op.score_texts(frame.limit(0)).count() == 0


def test_passes_raise_the_likelihood(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    total = [op.score_texts(docs, passes=n, least=1).agg(F.sum("score")).first()[0] for n in (0, 1, 2)]
    print("log10 likelihood by passes", total)
    assert total[0] < total[1] < total[2]


def test_query(spark, sf):
    docs = [(d.doc_id, zlib.crc32(str(d.doc_id).encode()) % 7 == 2, d.text) for d in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = op.op5_brown_class_lm(spark, sf).collect()
    compare(got, brute(docs))
    held = [r for r in got if r.held_out]
    gain = (sum(r.score for r in held) - sum(r.base_score for r in held)) / sum(r.n_tokens for r in held)
    print("log10 gained a token", gain)
    assert gain > 0.05
