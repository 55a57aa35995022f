import math
import random
import re
import zlib

import pytest

from sparkloom.llm import toxicity as op
from sparkloom.llm._util import table


def clause(text, words=None):
    return op.Scorer(words or {}).clause(text.encode().split())


def test_grammar_scores_clauses():
    plain, aimed = clause("what an idiot"), clause("you are an idiot")
    assert plain == op.LISTED_WEIGHT and aimed == 1.5 * plain
    assert clause("not an idiot") == pytest.approx(0.3 * plain) == clause("you are not an idiot")
    assert clause("not that it matters at all idiot") == plain  # out of the negation's reach
    assert clause("he said some words idiot") == pytest.approx(0.5 * plain)
    assert clause("i will kill you") > clause("i will kill time") > 0
    assert clause("never kill you") < clause("kill you")
    assert clause("nothing to see") == 0
    assert clause("you zork", {"zork": 4.0}) == 6.0


def test_composition_equals_cascade():
    a = op._scope("negation", {"insult": ("denied", 0.5)}, 2)
    b = op._scope("report", {"denied": ("quoted", 0.5), "insult": ("quoted", 1.0)}, None)
    both = op.compose(a, b)
    for text in ("negation insult report negation insult insult", "report negation other insult insult insult", "insult report insult"):
        s = t = u = 0
        for symbol in text.split():
            s, middle, x = a.step(s, symbol)
            t, last, y = b.step(t, middle)
            u, out, z = both.step(u, symbol)
            assert (out, z) == (last, x * y)


def test_small_tables(spark):
    docs = [(k, ("fine words here " if k % 3 else "you zork here ") * (k % 4 + 1) + f"{k} a{k} b{k}", "x") for k in range(60)] + [(None, None, "x"), (61, "", "x"), (62, "ZORK!! " + "a " * 200_000, "x"), (62, "zork", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)] + [(None, 1), (1, None), (2, 0)], "doc_id long, toxic int")
    model = op.train(frame, labels)
    assert "zork" in model.words and "here" not in model.words
    got = op.score_toxicity(frame, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == ("zork" in (r.text or "").lower()) for r in got)
    for few in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        assert op.score_toxicity(frame, op.train(frame, few)).count() == len(docs)
    assert op.score_toxicity(frame.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = op.op10_toxicity_grammar(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    ones, zeros = [s for y, s, _ in judged if y], [s for y, s, _ in judged if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / len(ones) / len(zeros)
    caught = sum(p for y, _, p in judged if y) / len(ones)
    wrong = sum(p for y, _, p in judged if not y) / len(zeros)
    print(auc, caught, wrong, len(ones))
    assert auc > 0.95 and caught > 0.9 and wrong < 0.02  # labels of junk are noise here: some of it is marked toxic at random


# ---- the whole scorer against rules run one after another over a clause

def brute_symbols(words, weights):
    listed = {w: k for k, text in op.WORDS.items() for w in text.split()}
    out = []
    for word in words:
        found = ("other", 1.0)
        for key in [word] + [word[:k] + "*" for k in (6, 5, 4) if len(word) >= k]:
            if key in listed or key in weights:
                found = (listed.get(key, "insult"), min(weights[key], 6.0) if key in weights else 3.0)
                break
        out.append(found)
    return out


def brute_clause(pairs, gains):
    symbols = [s for s, _ in pairs]
    passes = [(("negation",), {"insult": "denied", "threat": "denied"}, 3), (("report",), {"insult": "quoted", "threat": "quoted"}, 10**9), (("threat",), {"target": "menace"}, 3), (("target", "menace"), {"insult": "aimed"}, 4)]
    for openers, changes, reach in passes:
        last, new = None, []
        for i, s in enumerate(symbols):
            new.append(changes[s] if s in changes and last is not None and i - last <= reach else s)
            last = i if s in openers else last
        symbols = new
    total, held = 0.0, 3.0
    for (before, weight), after in zip(pairs, symbols):
        held = weight if before == "threat" else held
        total += gains.get(after, 0.0) * (held if after == "menace" else weight)
    return total


def brute_score(text, model):
    gains = dict(zip(op.GAIN, model.gains))
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    scores = []
    for clause in re.split(r"[.!?;:\n]+", lower):
        pairs = brute_symbols(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", clause), model.words)
        if any(s in ("insult", "threat") for s, _ in pairs):
            scores.append(brute_clause(pairs, gains))
    x = [max(scores), math.log1p(sum(scores)), math.log1p(len(scores))] if scores else [0.0] * 3
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.coefficients[0] + sum(a * b for a, b in zip(model.coefficients[1:], x))))))


def test_scores_of_a_whole_table(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = op.train(docs, table(spark, sf, "labels"))
    got = op.score_toxicity(docs, model).collect()
    assert len(got) == docs.count() and sum(r.score > 0.3 for r in got) > 10
    for r in got:
        assert r.score == pytest.approx(brute_score(r.text, model), abs=1e-9)


def sentences(seed, n=500):
    """Clauses whose label their structure decides: the same words, aimed or denied or quoted."""
    rng = random.Random(seed)
    some = lambda: [rng.choice(["table", "house", "green", "river", "paper", "walks"]) for _ in range(rng.randrange(5))]
    out = []
    for k in range(n):
        insult, kind = rng.choice(["idiot", "moron", "loser", "scum"]), rng.choice(["aimed", "denied", "quoted", "menace", "threat", "none"])
        core = {"aimed": ["you", insult], "denied": ["not", insult], "quoted": ["said", *some(), insult], "menace": ["kill", "you"], "threat": ["kill", "time", "on", "some", "evenings"], "none": ["you", "said", "not"]}[kind]
        out.append((k, " ".join(some() + core + (some() if kind != "threat" else [])) + ".", int(kind in ("aimed", "menace"))))
    return out


def accuracy(spark, machine):
    rows = spark.createDataFrame(sentences(1), "doc_id long, text string, toxic int")
    model = op.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), machine=machine)
    other = sentences(2)
    scored = op.score_toxicity(spark.createDataFrame(other, "doc_id long, text string, y int"), model, threshold=0.5, machine=machine)
    return model, sum(r.predicted == r.y for r in scored.collect()) / len(other)


def test_arcs_decide_where_structure_does(spark):
    """Without its arcs the grammar sees the same words in both labels; with them it tells them apart."""
    whole, with_arcs = accuracy(spark, None)
    _, without = accuracy(spark, op.Transducer())
    print("held-out accuracy with and without arcs", with_arcs, without, whole.gains)
    assert with_arcs > 0.97 and without < 0.9
    gains = dict(zip(op.GAIN, whole.gains))
    assert gains["denied"] < op.GAIN["denied"] and gains["quoted"] < op.GAIN["quoted"] and gains["aimed"] > gains["insult"] * 0.9


def test_rows_of_one_id_are_bounded(spark):
    docs = spark.createDataFrame([(1, f"you idiot {k}") for k in range(300)] + [(2, "fine words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    model = op.train(docs, labels)
    assert op.score_toxicity(docs, model).count() == 301
