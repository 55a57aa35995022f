"""Near-dedup by Jaccard similarity against all pairs of sets."""

import collections
import random

import pytest

import corpus_pipeline as pipeline
from sparkloom.llm import shingle_dedup as op
from sparkloom.llm._util import table


def brute_set(text, size=5):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_pairs(texts, similarity=0.8):
    """(i, j, similarity) of all pairs that reach it."""
    sets = [brute_set(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                both = len(a & b)
                if both / (len(a) + len(b) - both) >= similarity:
                    yield j, i, both / (len(a) + len(b) - both)


def brute_classes(texts):
    """The smallest place of each text's class."""
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j, _ in brute_pairs(texts):
        a, b = top(i), top(j)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def edited(rng, words, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in words]


def test_stage_takes_similarity_from_four_fifths(spark, sf):
    """Before, the stage let nearly all near copies below 0.95 stay."""
    docs = table(spark, sf, "documents").select(*pipeline.COLUMNS)
    rows = sorted(map(tuple, docs.collect()))
    classes = brute_classes([r[1] for r in rows])
    after = collections.Counter(map(tuple, pipeline.near_dedup(spark, docs, sf).collect()))
    assert after == collections.Counter(rows[i] for i in set(classes))


def test_crowds_and_edges(spark):
    rng = random.Random(4)
    texts = [None, "", " \n", "one two", "ONE  two", "one two three", "a b c d e", "a b c d f"]
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([40, 200, 900]))]
        for share in (0, 0.002, 0.01, 0.02, 0.03, 0.05):
            texts.append(" ".join(edited(rng, base, share)))
            texts.append(" ".join(base[rng.randrange(len(base) // 4) :]))
    chain = [f"c{i}" for i in range(300)]
    texts += [" ".join(chain[i : i + 200]) for i in range(0, 100, 10)]
    crowd = [f"h{i}" for i in range(60)]
    texts += [" ".join(edited(rng, crowd, 0.02)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(map(tuple, op.jaccard_duplicates(docs).collect()))
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)
    assert op.jaccard_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("similarity, least", [(0.8, 0.995), (0.9, 0.999)])
def test_bands_reach(similarity, least):
    rng = random.Random(1)
    met = 0
    for _ in range(2000):
        words = [rng.getrandbits(64) for _ in range(1000)]
        cut = round(1000 * (1 - similarity) / 2)  # of 1,000 hashes in all, either side lacks these
        a, b = (op.np.array(sorted(s), op.np.uint64) for s in (words[cut:], words[: 1000 - cut]))
        met += bool((op.bands(a) == op.bands(b)).any())
    assert met >= least * 2000


def test_trees_search_by_code_and_do_not_make_pairs(spark, monkeypatch):
    """Before, there were no codes or trees, and every pair of different classes in a bucket was a row of a join."""
    rng = random.Random(8)
    base = [f"k{i}" for i in range(120)]
    texts = list({" ".join(edited(rng, base, rng.choice([0.005, 0.03]))) for _ in range(400)})
    assert len(set(map(int, (op.code_of(op.shingles(t.encode().split())) for t in texts)))) > 100
    made = {}
    search = op._between
    monkeypatch.setattr(op, "TREE_TEXTS", 64)
    monkeypatch.setattr(op, "_between", lambda *a: made.setdefault("links", op.materialize(search(*a))))
    monkeypatch.setattr(op, "release", lambda df: None)
    got = dict(map(tuple, op.jaccard_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()))
    want = brute_classes(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert 300 > len(set(want)) > 10 and made["links"].distinct().count() < 20 * len(texts)


@pytest.mark.parametrize("n", [5, 20, 100, 1000])
def test_radius_reaches(n):
    """Codes of two sets of Jaccard 0.8 differ in at most RADIUS bits."""
    rng = op.np.random.default_rng(n)
    far = 0
    for _ in range(1000):
        words = rng.integers(0, 1 << 64, n, op.np.uint64)
        cut = n // 10 or 1
        a, b = (words[:-cut], words[cut:]) if n > 5 else (words, words[:-cut])
        far += int(op.np.bitwise_count(op.code_of(a) ^ op.code_of(b))) > op.RADIUS
    assert far <= 2
