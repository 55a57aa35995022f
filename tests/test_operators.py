"""Edge cases on hand-made tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import aggregates, scalars
from sparkloom.operators import assign, coverage, hic, layout, lift, links, path, relational, rolling, split


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_rolling_join(spark):
    seg = spark.createDataFrame([(1, 1, 101), (1, 301, 102), (1, 601, 103), (2, 50, 201)], "k int, at int, v int")
    r = spark.createDataFrame([(1, 300), (1, 301), (1, 9999), (2, 10), (3, 7), (1, None)], "k int, at int")
    got = {(x.k, x.at): x.v for x in rolling.rolling_join(r, seg, ["k"], "at", "v").collect()}
    assert got == {(1, 300): 101, (1, 301): 102, (1, 9999): 103, (2, 10): None, (3, 7): None, (1, None): None}
    got = {(x.k, x.at): x.v for x in rolling.rolling_join(r, seg, ["k"], "at", "v", clamp=True).collect()}
    assert got[2, 10] == 201 and got[3, 7] is None and got[1, None] is None
    got = {(x.k, x.at): x.v for x in rolling.rolling_join(r, seg, ["k"], "at", "v", how="forward").collect()}
    assert got == {(1, 300): 102, (1, 301): 102, (1, 9999): None, (2, 10): 201, (3, 7): None, (1, None): None}
    by_range = rolling.range_join(r, seg.withColumnRenamed("at", "s"), ["k"], "at", "s")
    assert {(x.k, x.at): x.v for x in by_range.collect()} == {(1, 300): 101, (1, 301): 102, (1, 9999): 103, (2, 10): None, (3, 7): None, (1, None): None}
    with pytest.raises(ValueError):
        rolling.rolling_join(r, seg, ["k"], "at", "v", how="nearest")


def test_clamp_takes_one_segment_of_a_place(spark):
    """Of segments at the end's place the one of largest value counts, or the smallest if forward, as for rows in range."""
    seg = spark.createDataFrame([(1, 5, 101), (1, 5, 102), (1, 9, 103), (1, 9, 104)], "k int, at int, v int")
    r = spark.createDataFrame([(1, 2), (1, 5), (1, 12), (2, 1)], "k int, at int")
    got = {(x.k, x.at): x.v for x in rolling.rolling_join(r, seg, ["k"], "at", "v", clamp=True).collect()}
    assert got == {(1, 2): 102, (1, 5): 102, (1, 12): 104, (2, 1): None}
    got = {(x.k, x.at): x.v for x in rolling.rolling_join(r, seg, ["k"], "at", "v", how="forward", clamp=True).collect()}
    assert got == {(1, 2): 101, (1, 5): 101, (1, 12): 103, (2, 1): None}


@pytest.mark.parametrize("method", ["sweep", "explode"])
def test_coverage(spark, method):
    iv = spark.createDataFrame([("a", 150, 1250), ("b", 0, 400), ("b", -900, 100)], "key string, s long, e long")
    cov = coverage.interval_coverage(iv, "key", "s", "e", 200, method)
    assert rows(cov.where("key = 'a'"), "bin") == [(b,) for b in sorted([200, 400, 600, 800, 1000], key=lambda x: str((x,)))]
    assert rows(coverage.interval_coverage(iv, "key", "s", "e", 200, method, skip_first=True).where("key = 'a'"), "bin") == sorted([(b,) for b in (400, 600, 800, 1000)], key=str)
    assert {r.bin for r in cov.where("key = 'b'").collect()} == {-800, -600, -400, -200}
    assert coverage.interval_coverage(iv.limit(0), "key", "s", "e", 200, method).count() == 0


def test_sweep_equals_explode(spark):
    rng = random.Random(0)
    iv = spark.createDataFrame([(rng.randrange(4), s := rng.randrange(5000), s + rng.randrange(4000)) for _ in range(300)], "key int, s long, e long")
    a, b = (coverage.interval_coverage(iv, "key", "s", "e", 100, m) for m in ("sweep", "explode"))
    assert rows(a, "key", "bin", "n") == rows(b, "key", "bin", "n")


def test_top2(spark):
    r = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (2, None), (3, None)], "k int, c string")
    got = {x.k: (x.first, x.n1, x.second, x.n2, x.total, x.ratio) for x in assign.assign_top2(r, "k", "c").collect()}
    assert got == {1: ("a", 1, "b", 1, 2, 1.0), 2: ("x", 1, None, None, 1, None)}


def test_sd_and_mad_of_one(spark):
    r = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 3.0)], "k int, v double")
    assert rows(r.groupBy("k").agg(aggregates.sd(F.col("v")).alias("s")), "k", "s") == [(1, 0.0), (2, pytest.approx(2**0.5))]
    assert rows(aggregates.mad(r, ["k"], "v")) == [(1, 0.0), (2, pytest.approx(1.4826))]


def test_split(spark):
    seq = spark.createDataFrame([("s", 10000), ("t", 50)], "key string, length long")
    br = spark.createDataFrame([("s", 3000), ("s", 7000)], "key string, at long")
    got = split.split_segments(seq, br, "key", "length", "at", 200)
    assert [(r.start, r.end) for r in got.where("key = 's'").orderBy("piece").collect()] == [(1, 2800), (2801, 3200), (3201, 6800), (6801, 7200), (7201, 10000)]
    assert rows(got.where("key = 't'"), "start", "end", "length") == [(1, 50, 50)]
    assert split.uncovered(got, seq, "key", "length").count() == 0
    close = spark.createDataFrame([("s", 3000), ("s", 3500), ("s", 9000)], "key string, at long")
    assert rows(split.thin_breaks(close, "key", "at", 200), "at") == [(3000,), (9000,)]


def test_break_loop_without_breaks(spark):
    info = spark.createDataFrame([("a", 1, 1, 100, 100)], "key string, orig long, orig_start long, orig_end long, length long")
    mol = spark.createDataFrame([(1, 1, 50, "a", 1, 50)], "orig long, orig_start long, orig_end long, key string, start long, end long")
    none = lambda c: info.select("key", F.lit(1).cast("long").alias("breakpoint")).limit(0)
    out, molecules, cycles = split.break_loop(info, mol, lambda m, i: m, none, 10)
    assert cycles == 0 and rows(out) == rows(info) and rows(molecules) == rows(mol)
    always = lambda c: info.select("key", F.lit(50).cast("long").alias("breakpoint"))
    with pytest.raises(RuntimeError):
        split.break_loop(info, mol, lambda m, i: m, always, 1, max_cycles=0)


def test_links(spark):
    mol = spark.createDataFrame([(1, "x", "s"), (1, "x", "s"), (1, "y", "s"), (2, "y", "s"), (3, None, "s"), (4, None, "s")], "item int, barcode string, sample string")
    assert rows(links.barcode_links(mol, "item", "barcode", "sample"), "item1", "item2") == [(1, 2), (2, 1)]


def test_n50_and_bins(spark):
    r = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 10)], "length long")
    assert aggregates.n50(r).first()[0] == 4
    assert spark.range(1).select(scalars.floor_bin(F.lit(-250), 200)).first()[0] == -400
    assert spark.range(1).select(scalars.wrap(F.lit("A" * 120)), scalars.wrap(F.lit("A" * 61)), scalars.wrap(F.lit(""))).first()[:] == ("\n".join(["A" * 60] * 2), "A" * 60 + "\nA", "")
    assert spark.range(1).select(scalars.reverse_complement(F.lit("AacgRN"))).first()[0] == "NYcgtT"
    assert scalars.parse_size("20GB") == 20 << 30 and scalars.parse_size("1.5k") == 1536 and scalars.format_size(3 << 20) == "3MB"


def test_lift_strands(spark):
    lay = spark.createDataFrame([("a", 9, 101, 200, -1), ("b", 9, 301, 400, 1)], "key string, super long, super_start long, super_end long, orientation int")
    r = spark.createDataFrame([("a", 1, 10), ("b", 1, 10), ("c", 1, 10)], "key string, s long, e long")
    assert rows(lift.lift_strand(r, lay, "key", "s"), "key", "super_pos") == [("a", 200), ("b", 301)]
    assert rows(lift.lift_strand_intervals(r, lay, "key", "s", "e"), "key", "from", "to") == [("a", 191, 200), ("b", 301, 310)]


def test_lift_intervals_drops_straddlers(spark):
    info = spark.createDataFrame([("p1", 1, 1, 100), ("p2", 1, 101, 100)], "key string, orig long, orig_start long, length long")
    m = spark.createDataFrame([(1, 10, 100), (1, 90, 101), (1, 101, 150), (2, 1, 5)], "orig long, s long, e long")
    assert rows(lift.lift_intervals(m, info, "s", "e"), "key", "start", "end") == [("p1", 10, 100), ("p2", 1, 50)]


def test_agp(spark):
    m = spark.createDataFrame([(1, "x", 1, 10, -1), (2, "a", 1, 5, None), (2, "b", 2, 6, 1), (2, "c", 3, 7, -1)], "super long, node string, bin long, length long, orientation int")
    got = layout.agp(m, "super", ["bin"], "node", "length", "orientation", 100)
    assert rows(got.where("super = 1"), "start", "end", "type", "orientation") == [(1, 10, "W", "-")]
    two = got.where("super = 2").orderBy("start").collect()
    assert [r.type for r in two] == list("WUWUW") and [r.part for r in two] == [1, 2, 3, 4, 5]
    assert [(r.start, r.end) for r in two] == [(1, 5), (6, 105), (106, 111), (112, 211), (212, 218)]


def test_null_safe_and_dictionary(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "i int, k string")
    assert rows(relational.null_safe_join(a, spark.createDataFrame([(None, 7)], "k string, v int"), ["k"]), "i", "v") == [(1, 7)]
    d = relational.dictionary(spark.createDataFrame([(f"{x:03}",) for x in range(500)] + [(None,)], "k string"), "k")
    assert [(r.k, r.code) for r in d.orderBy("k").collect()] == [(f"{x:03}", x) for x in range(500)]


# ---- paths

def test_path_of_a_line():
    edges = [(i, i + 1, 1.0) for i in range(9)] + [(0, 5, 9.0)]
    got = path.solve(edges)
    assert [n for n, b, r, _ in sorted(got, key=lambda x: x[1])] == list(range(10)) and all(r == 0 for _, _, r, _ in got)
    got = path.solve(edges, {i: float(-i) for i in range(10)})
    assert [n for n, b, *_ in sorted(got, key=lambda x: x[1])] == list(range(10))[::-1]


@pytest.mark.parametrize("seed", range(8))
def test_path_properties(seed):
    rng = random.Random(seed)
    n = rng.choice([2, 3, 12, 40])
    edges = [(i, rng.randrange(i), rng.random()) for i in range(1, n)] + [(rng.randrange(n), rng.randrange(n), rng.random()) for _ in range(3 * n)]
    graph = path.to_graph(edges)
    tree = path.spanning_tree(graph)
    assert sum(len(v) for v in tree.values()) == 2 * (n - 1)
    start = path.insert_nodes(graph, path.backbone(tree))
    end = path.relocate(graph, path.two_opt(graph, start))
    moved = path.move_blocks(graph, end)
    assert path.path_cost(graph, moved) <= path.path_cost(graph, end) + 1e-9
    at = {x: i for i, x in enumerate(end)}
    weak = [i for i in range(1, len(end)) if any(w < graph[end[i - 1]][end[i]] - 1e-12 for u in end[:i] for v, w in graph[u].items() if at.get(v, -1) >= i)]
    assert path.weak_cuts(graph, end) == weak
    end = moved
    assert sorted(end) == sorted(start) and len(set(end)) == len(end)
    assert all(b in graph[a] for a, b in zip(end, end[1:]))
    assert path.path_cost(graph, end) <= path.path_cost(graph, start) + 1e-9
    got = path.solve(edges)
    assert sorted(x[0] for x in got) == list(range(n))
    bins = sorted(b for _, b, r, _ in got if r == 0)
    assert bins == list(range(1, len(bins) + 1))
    place = {x[0]: x for x in got}
    for node, b, r, _ in got:
        if r:
            assert any(place[m][2] == r - 1 and place[m][1] == b for m in graph[node])


def test_prune_leaves_paths(spark):
    # a path 1..8 with a branch of two at 4 and a short tip at 6
    pairs = [(i, i + 1) for i in range(1, 8)] + [(4, 20), (20, 21), (6, 30)]
    both = [(a, b, 1.0 + a / 100) for a, b in pairs] + [(b, a, 1.0 + a / 100) for a, b in pairs]
    found = spark.createDataFrame(both, "item1 long, item2 long, weight double")
    info = spark.createDataFrame([(k, 1, float(k), 500 if k == 30 else 50_000) for k in [*range(1, 9), 20, 21, 30, 99]], "key long, chr long, cM double, length long")
    members, excluded = layout.prune(found, info)
    got = members.collect()
    assert sorted(r.node for r in got) == [1, 2, 3, 4, 5, 6, 7, 8, 20, 21, 30, 99]
    assert all(r["rank"] == 0 for r in got)
    assert {r.super for r in got if r.node == 99} == {99}
    assert 30 in {r.node for r in excluded.collect()}


def test_blocks_move():
    # 0 1 2 | 6 7 8 | 3 4 5 in the path; the edges 2-3 and 5-6 are cheap
    edges = [(i, i + 1, 1.0) for i in range(8)] + [(2, 6, 5.0), (8, 3, 5.0), (5, 2, 9.0)]
    graph = path.to_graph(edges)
    assert path.move_blocks(graph, [0, 1, 2, 6, 7, 8, 3, 4, 5]) == list(range(9))


# ---- contacts


def test_neighbour_sign(spark):
    items = spark.createDataFrame([(1, f"k{i}", i, float(g)) for i, g in enumerate([1, 2, 3, 2.5, 1])] + [(2, "only", 1, 1.0)], "chr int, key string, hic_bin int, gbin double")
    assert dict(rows(hic.neighbour_sign(items), "key", "cc")) == {"k0": None, "k1": 1, "k2": 1, "k3": -1, "k4": None, "only": None}

def test_poisson_fit_finds_coefficients():
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.column_stack((np.ones(4000), rng.normal(size=(4000, 2))))
    offset = rng.normal(size=4000) * 0.1
    y = rng.poisson(np.exp(x @ [1.0, 0.5, -0.3] + offset)).astype(float)
    assert np.allclose(hic.poisson_fit(y, x, offset), [1.0, 0.5, -0.3], atol=0.05)


@pytest.mark.parametrize("n", [80, 300, 1000])
def test_equal_bins_have_no_spread(n):
    """Before, the rounding of the mean became a second intercept of plus or minus 1."""
    for value in (250.0, 0.5, 0.1):
        a = np.log(np.full(n, value))
        assert not hic._standard(a[:, None] + a[None, :]).any()


def test_reverse_ranges(spark):
    m = spark.createDataFrame([("a", 1, 1, 1), ("b", 1, 2, None), ("c", 1, 3, -1), ("d", 2, 1, 1)], "key string, chr long, hic_bin long, orientation int")
    got = hic.reverse_ranges(m, spark.createDataFrame([(1, 1, 3)], "chr long, start long, end long"))
    assert rows(got, "key", "hic_bin", "orientation") == [("a", 3, -1), ("b", 2, -1), ("c", 1, 1), ("d", 1, 1)]
    with pytest.raises(ValueError):
        hic.reverse_ranges(m, spark.createDataFrame([(1, 1, 2), (1, 2, 3)], "chr long, start long, end long"))
    assert rows(hic.flip(m, spark.createDataFrame([("a",), ("b",)], "key string")), "key", "orientation") == [("a", -1), ("b", -1), ("c", -1), ("d", 1)]


def test_normalise_blocks(spark):
    bins = spark.createDataFrame([(c, 100 * i, 50 + 7 * i, 0.4 + 0.01 * i, 1.0) for c in ("a", "b") for i in range(6)] + [("a", 900, 0, 0.5, 1.0)], "chr string, bin long, eff_length long, gc double, cov double")
    rng = random.Random(1)
    matrix = spark.createDataFrame([(x, 100 * i, y, 100 * j, rng.randrange(1, 9)) for x, y in (("a", "a"), ("a", "b"), ("b", "a")) for i in range(6) for j in range(6)] + [("a", 900, "a", 0, 5)], "chr1 string, bin1 long, chr2 string, bin2 long, nlinks long")
    cis = hic.normalise(matrix, bins).collect()
    assert len(cis) == 36 and all(r.chr1 == r.chr2 == "a" and r.nlinks_norm > 0 and r.dist == abs(r.bin1 - r.bin2) for r in cis)
    trans = hic.normalise(matrix, bins, cis=False).collect()
    assert len(trans) == 72 and all(r.dist is None for r in trans)
    assert hic.normalise(matrix, bins, omit_smallest=2, percentile=0.1).count() < 36
    assert hic.normalise(matrix.limit(0), bins).count() == 0
    # expected counts over the fit average to about one
    assert 0.5 < sum(r.nlinks_norm for r in trans) / len(trans) < 2


def test_renumber_and_lengths(spark):
    p = spark.createDataFrame([("s", 1, 10), ("s", 11, 20)], "name string, orig_start long, orig_end long")
    assert rows(split.renumber(p, "name", F.lit(100), ["orig_start"]), "id", "name") == [(101, "s:1-10"), (102, "s:11-20")]
    g = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (3, 9)], "g int, m int")
    assert rows(relational.same_groups(g, g, "g", "m").where("g < same_as")) == [(1, 2)]
    assert rows(relational.top_rows(g, ["g"], ["m"], 1), "g", "m") == [(1, 1), (2, 1), (3, 9)]


def test_inversions(spark):
    links = spark.createDataFrame([("a", 100 * i, 100 * j, 50.0 / (1 + abs(i - j)), 100 * abs(i - j)) for i in range(40) for j in range(40) if i != j], "chr1 string, bin1 long, bin2 long, nlinks_norm double, dist long")
    bias = hic.directional_bias(links, spark.createDataFrame([("a", 4000)], "chr string, length long"))
    trend, spread = hic.find_inversions(bias, spark.createDataFrame([("a", 1, "x"), ("a", 2001, "y")], "chr string, start long, component string"), 5)
    assert trend.where("cc is not null").count() > 0 and {r.component for r in spread.collect()} == {"x", "y"}


def test_spread_join_is_a_join(spark):
    from sparkloom.operators.relational import spread_join

    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(400)] + [(None, -k) for k in range(9)], "k int, x int")
    table = spark.createDataFrame([(k, f"t{k}") for k in range(5)], "k int, t string")
    for how in ("inner", "left", "left_semi"):
        want = sorted(map(tuple, rows.join(table, "k", how).collect()), key=str)
        assert sorted(map(tuple, spread_join(rows, table, "k", how, share=20).collect()), key=str) == want
    assert spread_join(rows.limit(0), table, "k").count() == 0


def test_neighbour_join_is_dealt_to_tasks(spark):
    """Small tables with many pairs: before, Spark put their shuffles, or a broadcast, into a task or two."""
    a = spark.range(0, 3000, 1, 1).selectExpr("id % 5 as k", "id as a", "id % 7 as x")
    b = a.selectExpr("k", "a as b", "x as y")
    met = relational.neighbour_join(a, b, ["k"], "x", "y", 1, "a < b").withColumn("task", F.spark_partition_id())
    assert met.select("task").distinct().count() > 8
    want = a.alias("a").join(b.alias("b"), F.expr("a.k = b.k and abs(x - y) <= 1 and a < b")).count()
    assert met.count() == want
