"""Each stage of the pipeline against brute force on what the stage before it kept."""

import collections

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from sparkloom.llm._util import table

from .test_decontaminate import brute as brute_decontaminate
from .test_native_ops import targets
from .test_quality import brute as brute_quality
from .test_quality import brute_scores, trusted_of
from .test_shingle_dedup import brute_classes


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = table(spark, sf, "documents").select(*pipeline.COLUMNS)
    extra = docs.where("doc_id in (5, 6)")
    docs = docs.unionByName(extra).unionByName(extra.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")))
    out = [("input", pipeline.materialize(docs))]
    for name, stage in pipeline.STAGES:
        out.append((name, pipeline.materialize(stage(spark, out[-1][1], sf))))
    return {name: frame.collect() for name, frame in out}


def rows(stages, name):
    return collections.Counter(tuple(r)[:5] for r in stages[name])


def quality(before, spark, sf):
    """What the quality stage keeps of these rows, and the rows whose score is at the threshold to the last digits."""
    scores = brute_scores([r[:2] for r in before], trusted_of(table(spark, sf, "labels").collect()))
    near = [r for r, x in zip(before, scores) if abs(x + 0.1) < 1e-9]
    return collections.Counter(r for r, x in zip(before, scores) if not brute_quality(r[1])[5] and x >= -0.1), near


def dedup(before):
    """What the near-dedup stage keeps."""
    def name(r):
        h = xxhash.xxh64_intdigest((r[1] or "").encode(), 42)
        return r[0] is None, r[0] or 0, h - (h >> 63 << 64)

    rows = {}
    for r in before:
        order = tuple((x is not None, x if x is not None else 0) for x in (r[2], r[3], r[4]))
        if name(r) not in rows or order < rows[name(r)][0]:
            rows[name(r)] = (order, r)
    names = sorted(rows)
    classes = brute_classes([rows[k][1][1] for k in names])
    return collections.Counter(rows[names[i]][1] for i in set(classes))


def test_quality(stages, spark, sf):
    before, after = rows(stages, "input"), rows(stages, "quality_rules")
    want, near = quality(list(before.elements()), spark, sf)
    assert not near and after == want and sum(after.values()) < sum(before.values())


def test_near_dedup(stages):
    before, after = rows(stages, "quality_rules"), rows(stages, "near_dedup")
    assert after == dedup(before.elements()) and sum(after.values()) < sum(before.values())


def test_decontamination(stages, spark, sf):
    before, after = rows(stages, "near_dedup"), rows(stages, "decontamination")
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    clean = {d for d, *_, hit in brute_decontaminate([r[:2] for r in before], items) if not hit}
    assert after == collections.Counter({r: n for r, n in before.items() if r[0] in clean})


def test_mixing(stages):
    before, after = rows(stages, "decontamination"), rows(stages, "source_mixing")
    size, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for r, n in before.items():
        words = len(r[1].encode().split())
        size[r[3]] += n * words
        taken[r[3]] += after[r] * words
        most[r[3]] = max(most[r[3]], words)
        assert after[r] <= 2 * n
    assert not set(after) - set(before)
    for source, target in targets(size).items():
        assert abs(taken[source] - target) <= most[source]


def test_sharding(stages):
    assert rows(stages, "sharding") == rows(stages, "source_mixing")
    held = collections.Counter()
    for r in stages["sharding"]:
        held[r.shard] += len(r.text.encode())
    assert all(n <= 16 << 20 for n in held.values())


def test_run(stages, spark, sf):
    out = pipeline.run(spark, sf)
    assert out.columns[:5] == pipeline.COLUMNS and out.count() > 0


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and columns with names the stages use."""
    text = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    rows = [
        (1, text, "en", "a", 5), (1, text, "de", "a", 5), (1, text, "de", None, None), (1, other, "en", "a", 5), (2, text + " x", None, "a", None),
        (None, text, None, None, None), (None, text, None, None, None), (None, None, None, None, None), (3, None, "en", "b", 0), (4, "", "en", "b", 0),
        (5, "a b", "fr", "b", 3), (6, "a b", "fr", "b", 3), (7, "long " * 60_000, "en", "a", 1), (8, " ".join(f"l{i}" for i in range(70_000)), "en", "c", 1), (9, text.upper(), "en", "c", 5),
    ] + [(10, " ".join(f"t{i}" for i in range(40)), "en", "c", 9)] * 5
    frame = spark.createDataFrame([(*r, "row", 1, "h", True, 2.0, 3, "s") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, size int, hash string, kept boolean, score double, copies int, shard string")
    return rows, pipeline.materialize(frame)


def test_stages_on_odd_rows(spark, sf, odd):
    rows, frame = odd
    got = {name: collections.Counter(tuple(r)[:5] for r in stage(spark, frame, sf).collect()) for name, stage in pipeline.STAGES}
    assert got["quality_rules"] == quality(rows, spark, sf)[0]
    assert got["near_dedup"] == dedup(rows)
    assert got["decontamination"] == got["sharding"] == collections.Counter(rows)
    size, taken = collections.Counter(), collections.Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").split())
    for r, n in got["source_mixing"].items():
        taken[r[3]] += n * len((r[1] or "").split())
        assert n <= 2 * rows.count(r)
    for source, target in targets(size).items():
        assert abs(taken[source] - target) <= max(len((r[1] or "").split()) for r in rows if r[3] == source)
    for name, stage in pipeline.STAGES:
        columns = stage(spark, frame, sf).columns
        assert columns[:5] == pipeline.COLUMNS and (name == "sharding") == (len(columns) > 5)


def test_stages_on_nothing(spark, sf, odd):
    for _, stage in pipeline.STAGES:
        assert stage(spark, odd[1].limit(0), sf).count() == 0
