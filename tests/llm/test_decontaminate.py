import hashlib
import random
import re

import numpy as np
import pytest

from sparkloom.llm import decontaminate as op
from sparkloom.llm._util import table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def brute(docs, items, window=13):
    windows = {}
    for name, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + window]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, names = WORD.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (found := windows.get(tuple(words[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((doc_id, len(words), len(hit), sorted(names, key=str.encode), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def key(row):
    return tuple((x is None, x) if not isinstance(x, list) else x for x in row)


def answer(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect()), key=key)


def test_index_against_search():
    rng = np.random.default_rng(1)
    for trial in range(30):
        chunks = [rng.integers(1, rng.integers(2, 5), rng.integers(1, 40)) for _ in range(rng.integers(1, 30))]
        text = np.concatenate([np.append(c, 0) for c in chunks]).astype(np.int64)
        index = op.FMIndex(text, 4)
        for m in (1, 3, 6):
            patterns = rng.integers(1, 4, (20, m))
            found = {}
            for which, low, high in zip(*index.search(patterns)):
                found[which] = sorted(index.locate(np.arange(low, high)).tolist())
            for k, p in enumerate(patterns):
                want = [i for i in range(len(text) - m + 1) if (text[i : i + m] == p).all()]
                assert found.get(k, []) == want, trial


@pytest.mark.parametrize("shard_words,block_bytes", [(2_000_000, 1 << 20), (40, 30)])
def test_against_brute_force(spark, shard_words, block_bytes):
    rng = random.Random(3)
    word = lambda: rng.choice(["Aa", "b1", "c", "é", "dd", "E"])
    items = [(f"i{k % 9}", " ".join(word() for _ in range(rng.choice([0, 1, 4, 5, 6, 9])))) for k in range(12)] + [(None, "q q q q q q"), ("z", None)]
    docs = [(k, rng.choice([" ", "-", "\n"]).join(word() for _ in range(rng.choice([0, 3, 60, 900])))) for k in range(40)]
    docs += [(5, docs[5][1]), (None, "q q q q q q q"), (99, None), (100, ""), (101, "Aa " * 3000)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    got = op.decontaminate(d, b, window=5, shard_words=shard_words, block_bytes=block_bytes)
    assert answer(got) == sorted(brute(docs, items, 5), key=key)


def test_clashing_columns_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n_words int, spans string")
    none = spark.createDataFrame([], "item_id string, text string")
    row = op.decontaminate(d, none).collect()[0]
    assert (row.doc_id, row.text, row.n_words, row.n_hit, row.spans, row.contaminated) == (1, "a b", 2, 0, [], False)
    assert op.decontaminate(d.limit(0), none).count() == 0


def test_query(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    want = [(d, w, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c) for d, w, h, i, c in brute(docs, items)]
    assert sorted(map(tuple, op.op1_decontaminate(spark, sf).collect())) == sorted(want)
    assert any(x[-1] for x in want) and any(x[2] and not x[-1] for x in want)
