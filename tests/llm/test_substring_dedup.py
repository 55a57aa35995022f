import collections
import hashlib
import random

import numpy as np
import pytest

from sparkloom.llm import substring_dedup as op
from sparkloom.llm._util import table


def brute(texts, window):
    split = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def test_window_hashes():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 2**63, 50).astype(np.uint64)
    got = op.window_hashes(words, 7, op.BASES[0])
    for i in range(44):
        want = 0
        for w in words[i : i + 7].tolist():
            want = (want * op.BASES[0] + w) % 2**64
        assert int(got[i]) == want
    assert op.window_hashes(words[:6], 7, op.BASES[0]).size == 0
    assert op.window_hashes(words[:7], 7, op.BASES[0]).size == 1


def test_places_round_trip():
    for places in ([], [0], [0, 1, 255, 256, 511, 512, 70_000], list(range(0, 3000, 254)), [254, 510, 767]):
        assert op.unpack_places(op.pack_places(np.array(places, np.int64))).tolist() == places


@pytest.mark.parametrize("sizes", [{}, {"batch_bytes": 50, "bucket_bytes": 100}, {"batch_bytes": 400, "bucket_bytes": 300, "step_hashes": 20}, {"batch_bytes": 1, "step_hashes": 7, "share": 3}])
def test_against_brute_force(spark, sizes):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "b", "é", "cc", "x.", " z"])
    texts = [rng.choice([" ", "\t", "\n\n", "\x0b", "\x1c"]).join(word() for _ in range(rng.choice([0, 1, 5, 6, 30, 200]))) for _ in range(60)]
    texts += [texts[4], texts[5], texts[5], None, None, "", " " * 50, "w " * 4000, "q r s t u v w x"]
    docs = spark.createDataFrame([(k if k % 7 else None, t, "old") for k, t in enumerate(texts)], "doc_id long, text string, n_words string")
    if "share" in sizes:  # in an order of its own
        docs = docs.repartition(5)
    got = op.dedup_substrings(docs, window=6, **sizes)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed", "removed_spans", "kept_text"]
    rows = sorted((r.text or "", r.n_words, r.n_removed, r.kept_text) for r in got.collect())
    assert rows == sorted((t or "", *b) for t, b in zip(texts, brute(texts, 6)))
    for r in got.collect():
        ends = [s["end"] for s in r.removed_spans]
        assert all(s["start"] > e for s, e in zip(r.removed_spans[1:], ends))  # maximal: no two touch
        assert sum(s["end"] - s["start"] for s in r.removed_spans) == r.n_removed


def test_empty_table(spark):
    assert op.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    want = [(d.doc_id, n, r, hashlib.sha256(t.encode()).hexdigest()) for d, (n, r, t) in zip(docs, brute([d.text for d in docs], 35))]
    assert sorted(map(tuple, op.op2_substring_dedup(spark, sf).collect())) == sorted(want)
    assert sum(x[2] for x in want) > 0
