"""Mixing, sharding and url filters against brute force on small tables with nulls, ties, hot keys and clashing names."""

import collections
import hashlib
import random

import pytest

from sparkloom.llm import mixing, sharding, url_filters


# ---- mixing

def targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        unit = budget / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit > epochs * sizes[s]]
        if not over:
            return out | {s: weight[s] * unit for s in free}
        for s in over:
            out[s] = float(epochs * sizes[s])
            budget -= out[s]
            free.discard(s)
    return out


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target long")
    return docs, mixing.mix_sources(docs, **kw)


@pytest.mark.parametrize("how", [{}, {"range_rows": 1, "block_rows": 30}])
def test_mixing(spark, how):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(0, 60), rng.choice(["a", "b", "c", "é", None, "hot", "hot", "hot"]), "s", 1) for k in range(400)]
    rows += [(7, "x y z", "a", "s", 1)] * 9 + [(None, "q r", "b", "s", 1), (1000, None, "a", "s", 1), (1001, "", "empty", "s", 1)]
    rows += [(None, f"n{k}", "b", "s", 1) for k in range(60)] + [(8, "alike in all", "hot", "s", 1)] * 150
    room = max(how.get("block_rows", 1000), len(rows) // how.get("block_rows", 1000))
    _, out = mixed(spark, rows, finish=True, **how)
    got = out.collect()
    assert len(got) == len(rows) and out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "finish", "copies", "taken"]
    sizes = collections.Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    want, taken, largest = targets(sizes), collections.Counter(), collections.Counter()
    for r in got:
        assert r["size"] == len((r.text or "").split()) and r.taken == r["size"] * r.copies and 0 <= r.copies <= 2
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    counted = lambda out: collections.Counter((r.doc_id, r.text, r["size"], r.source, r.taken) for r in out)
    how = {k: v for k, v in how.items() if k != "range_rows"}
    assert counted(mixed(spark, rows[::-1], range_rows=3, **how)[1].collect()) == counted(got)
    again = mixing.mix_sources(mixed(spark, rows)[0].repartition(5, "text"), **how)
    assert "finish" not in again.columns and counted(again.collect()) == counted(got)
    assert counted(got) == brute_mix(rows, room)


def brute_mix(rows, room):
    """The queues one document after another; rows alike in blocks of `room`."""
    alike = collections.Counter((r[0], r[1], r[2]) for r in rows)
    sizes, entries = collections.Counter(), collections.defaultdict(list)
    for (k, text, source), n in alike.items():
        digest = lambda x: hashlib.md5(x.encode()).hexdigest()
        key = digest(f"8:{'' if k is None else k}:{source or ''}:{digest(text or '')}")
        for i in range(n):
            entries[source].append((digest(f"{key}:{i // room}") if n > room else key, i, k, text, len((text or "").split())))
        sizes[source] += n * len((text or "").split())
    target, queue = targets(sizes), []
    for source, held in entries.items():
        done = 0
        for _, i, k, text, size in sorted(held, key=lambda e: e[:2]):
            done += size
            queue += [((done + epoch * sizes[source]) / target[source], size, (k, text, source, i)) for epoch in range(2) if target[source]]
    queue.sort(key=lambda e: e[0])
    taken, used, at = collections.Counter(), 0, 0
    while at < len(queue):
        same = [e for e in queue[at:] if e[0] == queue[at][0]]
        used += sum(e[1] for e in same)
        if used > 1.5 * sum(sizes.values()):
            break
        taken.update(e[2] for e in same)
        at += len(same)
    return collections.Counter((k, text, size, source, size * taken[k, text, source, i]) for source, held in entries.items() for _, i, k, text, size in held)


def test_mixing_spreads_null_ids(spark):
    rows = [(None, f"t{k}", "a", "s", 1) for k in range(3_000)]
    docs, _ = mixed(spark, rows)
    alike = docs.select(docs.source.alias("__mix_source"), mixing.F.md5(docs.text.cast("binary")).alias("__mix_key"), mixing.F.lit(1).cast("long").alias("size"), mixing.F.lit(1).cast("long").alias("n"))
    sources = mixing.source_targets(alike.groupBy(mixing.F.col("__mix_source").alias("source")).agg(mixing.F.sum("size").alias("source_size")), (5, 2, 1), 1.5, 2).withColumn("bits", mixing.F.lit(5))
    queue = mixing._queue(alike, sources, 1000)
    assert sorted(r.before for r in queue.collect()) == list(range(3_000))
    held = mixing.mix_sources(docs)
    assert {r.copies for r in held.collect()} == {1, 2}


def test_mixing_nothing(spark):
    assert mixed(spark, [(1, "a", "b", "", 1)])[0].limit(0).count() == 0
    docs, _ = mixed(spark, [(1, "a", "b", "", 1)])
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    _, out = mixed(spark, [(1, "", "b", "", 1), (2, None, None, "", 1)])
    assert [(r.target, r.taken) for r in out.collect()] == [(0.0, 0), (0.0, 0)]


# ---- sharding

@pytest.mark.parametrize("limit", [10**9, 3000, 100])
def test_sharding(spark, limit):
    rng = random.Random(2)
    rows = [(k, "é" * rng.randrange(0, 40), "s", 3) for k in range(300)]
    rows += [(5, "same text", "s", 3)] * 200 + [(None, None, "s", 3), (None, "", "s", 3), (400, "long" * 1000, "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, bytes int").repartition(7)
    out = sharding.shard(docs, limit=limit)
    assert out.columns == ["doc_id", "text", "bytes", "shard", "shard_depth", "shard_bytes", "shard_rows"]
    got = out.collect()
    assert len(got) == len(rows)
    held = collections.defaultdict(list)
    for r in got:
        held[r.shard].append(r)
    plain = {s.partition("+")[0] for s in held}
    for s, members in held.items():
        size = sum(len((r.text or "").encode()) for r in members)
        assert {r.shard_bytes for r in members} == {size} and {r.shard_rows for r in members} == {len(members)}
        assert size <= limit or len(members) == 1
        for r in members:
            bits = bin(int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:{r.text or ''}".encode()).hexdigest()[:15], 16))[2:].zfill(60)
            assert bits.startswith(s.partition("+")[0]) and r.shard_depth == len(s.partition("+")[0])
    assert not any(a != b and b.startswith(a) for a in plain for b in plain)
    for s in plain - {""}:  # a split was needed: the parent is over the limit
        assert sum(len((r.text or "").encode()) for r in got if r.shard.startswith(s[:-1])) > limit


def test_sharding_empty(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- url filters

def test_urls(spark):
    canonical = '<html><LINK data-x="1" rel="canonical" href="{}"></html>'
    refresh = "<meta http-equiv='refresh' content='0; URL={}'>"
    pages = [
        (1, "http://a.com/en/1", None),
        (2, "http://x.org/en/1", canonical.format("http://a.com/en/1")),
        (3, "http://y.org/p/q", refresh.format("http://x.org/en/1")),
        (4, "http://y.org/p/r", canonical.format("q")),
        (5, "http://Example.COM/en/77", canonical.format("/en/1?a=1&amp;b=2")),
        (6, "http://n.net/de/1", ""),
        (7, "http://z.org/", refresh.format("http://n.net/de/1")),
        (8, "http://z.org/", canonical.format("http://a.com/en/1")),
        (9, None, canonical.format("http://a.com/en/1")),
        (10, "no scheme", canonical.format("http://b.com/en/x")),
        (11, "http://com/en/", None),
        (12, "http://notcom/en/", None),
        (13, "https://u@q.example.net/de/8#x?y", None),
        (14, "http://far.org/1", None),
        (15, "http://hub.io/1", None),
        (1, "http://a.com/en/1", None),
    ]
    frame = spark.createDataFrame([(*p, "h", 5) for p in pages], "page_id long, url string, html string, host string, __url int")
    edges = spark.createDataFrame([("http://hub.io/1", "http://far.org/1"), ("http://far.org/1", "http://o.org/es/1"), (None, "http://hub.io/1"), ("http://hub.io/1", "http://hub.io/1")], "src string, dst string")
    out = url_filters.judge_urls(frame, url_filters.rules_table(spark, url_filters.RULES), edges)
    assert out.columns == ["page_id", "url", "html", "__url", "host", "path", "rule", "verdict"]
    got = collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect())
    # 7 and 8 share a url, so n.net's allow reaches the whole component of a.com
    assert got == collections.Counter({
        (1, "a.com", "/en/1", "com/en/", "block"): 2,
        (2, "x.org", "/en/1", None, "allow"): 1,
        (3, "y.org", "/p/q", None, "allow"): 1,
        (4, "y.org", "/p/r", None, "allow"): 1,
        (5, "example.com", "/en/77", "example.com/en/7", "allow"): 1,
        (6, "n.net", "/de/1", "net/de/", "allow"): 1,
        (7, "z.org", "/", None, "allow"): 1,
        (8, "z.org", "/", None, "allow"): 1,
        (9, "", "", None, "allow"): 1,
        (10, "", "", None, "block"): 1,
        (11, "com", "/en/", "com/en/", "block"): 1,
        (12, "notcom", "/en/", None, "allow"): 1,
        (13, "u@q.example.net", "/de/8", "example.net/de/8", "block"): 1,
        (14, "far.org", "/1", None, "block"): 1,
        (15, "hub.io", "/1", None, "block"): 1,
    })
    assert url_filters.judge_urls(frame.limit(0), url_filters.rules_table(spark, [])).count() == 0


def test_components_with_hub(spark):
    from sparkloom.operators.graph import connected_components

    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1001 + i) for i in range(300)]
    frame = spark.createDataFrame(chain + hub + [(7, 7), (5000, 5000), (None, 9)], "src long, dst long")
    got = {r.node: r.component for r in connected_components(frame).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1301)} | {5000: 5000}
