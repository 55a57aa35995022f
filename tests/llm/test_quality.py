import collections
import math
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import quality as op
from sparkloom.llm._util import table


def brute(text):
    words = [w.decode() for w in (text or "").encode().split()]
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def base(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def test_base_rules(spark):
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "B", "é#", "<x>", "\x1cq", " "])
    texts = [rng.choice([" ", "\n", "\t \n", "\x0b"]).join(word() for _ in range(rng.choice([0, 7, 8, 9, 60, 400]))) for _ in range(80)]
    texts += [None, "", " \n\n ", "same line\n" * 30, "a b c d e f g h " * 2, " ".join(f"w{i}" for i in range(20)), "z " * 150_000]
    docs = spark.createDataFrame([(k if k % 9 else None, t, "x", 2) for k, t in enumerate(texts)] + [(1, texts[1], "x", 2)], "doc_id long, text string, kept string, h int")
    trusted = spark.createDataFrame([(1,), (2,)], "id long")
    out = op.judge_quality(docs, trusted)
    assert out.columns == ["doc_id", "text", "h", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    rows = out.collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert base(r) == brute(r.text), r.text
        assert not (r.base_failed and r.kept)
    none = op.judge_quality(docs, trusted.limit(0)).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in none)
    assert op.judge_quality(docs.limit(0), trusted).count() == 0


def grams(text):
    """64-bit hashes of all n-grams: words, pairs of words, last three characters."""
    hashed = xxhash.xxh64_intdigest
    words = (text or "").encode().split()
    ids = [hashed(w, 42) for w in words]
    pairs = [hashed(b.to_bytes(8, "little"), hashed(a.to_bytes(8, "little"), 42)) for a, b in zip(ids, ids[1:])]
    return ids + pairs + [hashed((3).to_bytes(4, "little"), hashed(w.decode()[-3:].encode(), 42)) for w in words]


def brute_scores(rows, trusted, buckets=8192, smoothing=32768):
    """Mean log ratio of each (id, text): target over raw, both multinomials over hash buckets, the target's smoothed towards the raw one."""
    raw, target, each = collections.Counter(), collections.Counter(), []
    for k, text in rows:
        held = collections.Counter(g % buckets for g in grams(text))
        each.append(held)
        raw.update(held)
        if k in trusted:
            target.update(held)
    n, m = sum(raw.values()), sum(target.values())
    weight = {b: round(math.log((target[b] + smoothing * raw[b] / n) / (m + smoothing)) - math.log(raw[b] / n), 4) for b in raw}
    return [sum(weight[b] * c for b, c in held.items()) / max(1, sum(held.values())) for held in each]


def trusted_of(labels):
    least = {}
    for r in labels:
        if r.doc_id is not None and r.quality is not None:
            least[r.doc_id] = min(r.quality, least.get(r.doc_id, 1))
    return {k for k, q in least.items() if q == 1}


def test_scores_of_small_tables(spark):
    rng = random.Random(3)
    rows = [(k if k % 8 else None, " ".join(rng.choice(["good", "bad", "junk", "é", "words", f"w{k % 5}"]) for _ in range(rng.choice([0, 1, 2, 30, 90])))) for k in range(60)]
    rows += [(61, None), (1, rows[1][1]), (62, "very " * 20_000)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, score int")
    trusted = {k for k in range(0, 60, 3) if k % 8}
    want = collections.Counter((k, t, round(x, 8)) for (k, t), x in zip(rows, brute_scores(rows, trusted)))
    got = op.judge_quality(docs, spark.createDataFrame([(k,) for k in trusted], "id long"))
    assert collections.Counter((r.doc_id, r.text, round(r.score, 8)) for r in got.collect()) == want


def test_query(spark, sf):
    rows = {r.doc_id: r for r in op.op6_quality_llr(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    assert rows.keys() == texts.keys()
    assert all(base(rows[k]) == brute(t) for k, t in texts.items())
    known = table(spark, sf, "labels").collect()
    for (k, _), score in zip(texts.items(), brute_scores(list(texts.items()), trusted_of(known))):
        assert rows[k].score == pytest.approx(score, abs=1e-9)
        assert abs(score + 0.1) < 1e-9 or rows[k].kept == (not rows[k].base_failed and score >= -0.1)
    labels = [r for r in known if not rows[r.doc_id].base_failed]
    good, bad = ([rows[r.doc_id].kept for r in labels if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.2
