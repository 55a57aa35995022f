import random

import numpy as np
import pytest
import xxhash

from sparkloom.llm import simhash as op
from sparkloom.llm._util import table


def brute_code(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    pieces = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(codes, radius=4):
    """Union-find over all pairs; the smallest id (not None) of each class."""
    up = list(range(len(codes)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    values = np.array([c for _, c in codes], np.uint64)
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius):
            a, b = top(i), top(int(j))
            up[max(a, b)] = min(a, b)
    ids = {}
    for i, (k, _) in enumerate(codes):
        if k is not None:
            ids[top(i)] = min(k, ids.get(top(i), k))
    return [ids.get(top(i)) for i in range(len(codes))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "a b c d", "É é A a É é A a x", "w " * 70_000])
def test_code(text):
    assert op.simhash((text or "").encode().translate(op.LOWER).split()) == brute_code(text)


def test_forest_finds_all():
    rng = np.random.default_rng(2)
    for radius in (0, 2, 4):
        codes = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64))
        shard = np.sort(rng.integers(0, 3, len(codes)))
        forest = op.Forest(codes, shard)
        found = {(q, n) for qs, ns in forest.search(codes, forest.root, radius) for q, n in zip(qs.tolist(), ns.tolist())}
        near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
        want = {(int(a), int(b)) for a, b in np.argwhere(near & (shard[:, None] == shard[None, :]))}
        assert found == want


@pytest.mark.parametrize("sizes", [{}, {"shard_codes": 1, "tree_codes": 7}, {"shard_codes": 4000, "tree_codes": 30}])
def test_links(spark, sizes):
    rng = random.Random(9)
    codes = set()
    for _ in range(60):
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 9])):
            codes.add(c)
            for _ in range(rng.choice([1, 3, 4, 5])):
                c ^= 1 << rng.randrange(64)
    hub = rng.getrandbits(64)
    codes |= {hub ^ 1 << i for i in range(50)}
    codes = sorted(codes)
    frame = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "code long")
    links = op.near_links(frame, **sizes)
    got = {r.node: r.component for r in op.connected_components(links).collect()}
    want = brute_classes(list(enumerate(codes)))
    signed = [int(np.uint64(c).astype(np.int64)) for c in codes]
    classes = {}
    for s, w in zip(signed, want):
        classes.setdefault(w, set()).add(got.get(s, s))
    assert all(len(v) == 1 for v in classes.values())
    assert len({next(iter(v)) for v in classes.values()}) == len(classes)


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base, base + " x", base.upper(), None, "", "  ", "lonely words here", "q " * 50_000, base, "other " + base]
    rows = [(k if k != 2 else None, t, "c", 1) for k, t in enumerate(texts)] + [(0, base, "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, code string, id int")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in op.near_duplicates(docs).collect()), key=str)
    codes = [(k, brute_code(t)) for k, t, *_ in rows]
    want = sorted(((k, f"{c:016x}", m) for (k, c), m in zip(codes, brute_classes(codes))), key=str)
    assert got == want
    assert op.near_duplicates(docs.limit(0)).count() == 0


def test_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    codes = [(d.doc_id, brute_code(d.text)) for d in docs]
    want = sorted((k, f"{c:016x}", m) for (k, c), m in zip(codes, brute_classes(codes)))
    assert sorted(map(tuple, op.op9_simhash_bktree(spark, sf).collect())) == want
    assert len({w[2] for w in want}) < len(want)
