"""Pruning inside components gives what the steps give on all links, and solves them once."""

import random

from pyspark.sql import functions as F

from sparkloom.operators import graph, layout, path
from sparkloom.session import materialize

LINK = "item1 long, item2 long, weight double"
INFO = "key long, chr long, cM double, length long"


def supers(links, info, excluded):
    """What make_supers() gives, with components found here."""
    gone = {r.node for r in excluded.collect()}
    edges, near = {}, {}
    for a, b, w in links.collect():
        if a is not None and b is not None and a < b and not {a, b} & gone:
            edges[a, b] = min(w, edges.get((a, b), w))
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    at, solved, seen = {r.key: r.cM for r in info.collect()}, [], set()
    for node in sorted(near):
        part = [] if node in seen else [node]
        seen.update(part)
        for u in part:
            part += sorted(near[u] - seen)
            seen |= near[u]
        if part:
            solved += [(node, *r) for r in path.solve([(a, b, w) for (a, b), w in edges.items() if a in part], at)]
    frame = links.sparkSession.createDataFrame(solved, "super long, node long, bin long, rank long, backbone boolean")
    return materialize(layout.add_singletons(frame, info))


def stepwise(links, info, max_length=10_000):
    """All supers anew after each step."""
    excluded = links.sparkSession.createDataFrame([], "node long")
    members = supers(links, info, excluded)

    def leave(found):
        nonlocal members, excluded
        found = materialize(found)
        if found.isEmpty():
            return False
        excluded = materialize(excluded.unionByName(found).distinct())
        members = supers(links, info, excluded)
        return True

    while leave(layout.branch_nodes(members)):
        pass
    leave(layout.short_tips(members, layout.link_degree(links, excluded), max_length))
    leave(layout.bulges(members, max_length))
    leave(layout.end_forks(members))
    leave(layout.bulges(members, max_length))
    leave(layout.single_tips(members, layout.link_degree(links, excluded)))
    leave(members.where("rank > 0").select("node"))
    return members, excluded


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_links(seed):
    """Trees with and without more edges, lengths and places missing, links repeated, one way only, to nothing and to themselves."""
    rng = random.Random(seed)
    links, info, k = [], [], 1
    for c in range(60):
        n = rng.choice([2, 3, 6, 12, 20])
        names = rng.sample(range(k, k + 3 * n), n)
        k += 3 * n
        edges = {tuple(sorted((names[i], names[max(0, i - rng.choice([1, 1, 1, 2, 3]))]))) for i in range(1, n)}
        edges |= {tuple(sorted(rng.sample(names, 2))) for _ in range(n // 4 if c % 2 else 0)}
        for a, b in sorted(edges):
            w = rng.random()
            links += [(a, b, w), (b, a, w)] * (2 if rng.random() < 0.05 else 1)
        info += [(x, 1, rng.choice([None, float(x)]), rng.choice([None, 500, 5_000, 50_000, 60_000])) for x in names if rng.random() < 0.95]
    links += [(x, x, 1.0) for x in range(1, k, 40)] + [(x, None, 1.0) for x in range(2, k, 40)] + [(None, x, 1.0) for x in range(3, k, 40)] + [(x, x - 30, 1.0) for x in range(50, k, 70)]
    return links, [*info, (k + 1, 2, 1.0, 5), (None, 2, 1.0, 5)]


def test_prune_equals_the_steps_on_all_links(spark):
    links, info = odd_links(5)
    links, info = spark.createDataFrame(links, LINK), spark.createDataFrame(info, INFO)
    members, excluded = layout.prune(links, info)
    want, left = stepwise(links, info)
    assert members.columns == want.columns and rows(members) == rows(want)
    assert rows(excluded) == rows(left) and len(rows(left)) > 50


def test_components_are_found_and_solved_once(spark, monkeypatch):
    """Before, each step found all components and solved them anew, one group of a pandas function for each: a line of ten took as long as a large graph."""
    monkeypatch.setattr(layout, "make_supers", lambda *a, **b: 1 / 0)
    pairs = [(20 * c + i, 20 * c + i + 1) for c in range(1, 40) for i in range(9)] + [(20 * c + 4, 20 * c + 15) for c in range(1, 40)]
    links = spark.createDataFrame([(a, b, 1.0) for x in pairs for a, b in (x, x[::-1])], LINK)
    info = spark.createDataFrame([(k, 1, float(k), 10) for k in sorted({x for p in pairs for x in p})], INFO)
    members, excluded = layout.prune(links, info)
    assert rows(excluded) == [(20 * c + 15,) for c in sorted(range(1, 40), key=lambda c: str((20 * c + 15,)))]
    assert {(r.super, r.super_size) for r in members.collect()} == {(20 * c, 10) for c in range(1, 40)} | {(20 * c + 15, 1) for c in range(1, 40)}


def test_no_links(spark):
    members, excluded = layout.prune(spark.createDataFrame([], LINK), spark.createDataFrame([(7, 1, 1.0, 5)], INFO))
    assert rows(members) == [(7, 7, 1, 0, True, 1, 1.0, 5, 1, 1)] and excluded.isEmpty()


def test_contracted_components_across_chunks(spark, monkeypatch):
    rng = random.Random(2)
    edges = [(a, a + rng.choice([0, 1, 2, 7])) for a in range(300) if rng.random() < 0.6] + [(None, 900), (901, None)]
    frame = spark.createDataFrame(rng.sample(edges, len(edges)), "src long, dst long").repartition(7)
    assert rows(graph.contracted_components(frame)) == rows(graph.connected_components(frame))
    text = frame.select(F.concat(F.lit("n"), "src").alias("src"), F.concat(F.lit("n"), "dst").alias("dst"))
    assert rows(graph.contracted_components(text)) == rows(graph.connected_components(text))


def test_tree_needs_no_search():
    """The longest path of a tree is what all the moves leave of it."""
    rng = random.Random(4)
    for n in [2, 3, 4, 9, 25] * 20:
        tree = path.to_graph([(i, rng.randrange(max(0, i - 4), i), rng.choice([1.0, 1.0, rng.random()])) for i in range(1, n)])
        start = path.insert_nodes(tree, path.backbone(path.spanning_tree(tree)))
        assert path.order_blocks(tree, path.improve(tree, start)) == path.backbone(tree)
