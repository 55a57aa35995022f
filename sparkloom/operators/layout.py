"""Super-scaffolds: membership, statistics, pruning, orientation and assembly tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.aggregates import mean_if
from ..session import materialize, repeatable
from .graph import connected_components, contracted_components
from .path import order_components, solve_graph, to_graph


def without_nodes(edges: DataFrame, excluded: DataFrame | None, src: str = "item1", dst: str = "item2") -> DataFrame:
    """Edges with neither end excluded; excluded: (node)."""
    if excluded is None:
        return edges
    for end in (src, dst):
        edges = edges.join(excluded.select(F.col("node").alias(end)), end, "left_anti")
    return edges


def make_supers(links: DataFrame, info: DataFrame, excluded: DataFrame | None = None, known_ends: bool = False, rounds: int = 100) -> DataFrame:
    """Membership of every item: node, super, bin, rank, backbone, chr, cM, length, super_size, super_nbin.

    links: item1, item2, weight.  info: key, chr, cM, length.  super is the least
    node of the component; items without a link are supers of their own.
    """
    node_type = dict(info.dtypes)["key"]
    edges = materialize(without_nodes(links, excluded).where("item1 < item2").groupBy("item1", "item2").agg(F.min("weight").alias("weight")))
    parts = connected_components(edges, "item1", "item2")
    place = info.select(F.col("key").alias("k"), F.col("cM").cast("double").alias("cM"))
    named = edges.join(parts.select(F.col("node").alias("item1"), F.col("component").alias("super")), "item1")
    named = named.join(place.select(F.col("k").alias("item1"), F.col("cM").alias("pos_src")), "item1", "left").join(place.select(F.col("k").alias("item2"), F.col("cM").alias("pos_dst")), "item2", "left")
    solved = order_components(named.withColumnsRenamed({"item1": "src", "item2": "dst"}), node_type, known_ends, rounds)
    return materialize(add_singletons(solved, info))


def add_singletons(solved: DataFrame, info: DataFrame) -> DataFrame:
    """Membership of all items of info, those not solved as supers of one; with super_size and super_nbin."""
    items = info.select(F.col("key").alias("node"), "chr", "cM", "length")
    joined = items.join(solved, "node", "left")
    whole = joined.select("node", F.coalesce("super", "node").alias("super"), F.coalesce("bin", F.lit(1)).cast("long").alias("bin"), F.coalesce("rank", F.lit(0)).cast("long").alias("rank"), F.coalesce("backbone", F.lit(True)).alias("backbone"), "chr", "cM", "length")
    of_super = Window.partitionBy("super")
    return whole.withColumn("super_size", F.count("*").over(of_super)).withColumn("super_nbin", F.max("bin").over(of_super))


def super_stats(members: DataFrame) -> DataFrame:
    """n, nbin, max_rank and length of each super."""
    return members.groupBy("super").agg(F.count("*").alias("n"), F.max("bin").alias("nbin"), F.max("rank").alias("max_rank"), F.sum("length").alias("length"))


def branch_nodes(members: DataFrame) -> DataFrame:
    """Path nodes of bins that hold a branch of two steps or more."""
    bins = members.where("rank > 1").select("super", "bin").distinct()
    return members.where("rank = 0").join(bins, ["super", "bin"], "left_semi").select("node")


def link_degree(links: DataFrame, excluded: DataFrame | None) -> DataFrame:
    """(node, degree): links of a node whose far end is not excluded; links are there both ways."""
    if excluded is not None:
        links = links.join(excluded.select(F.col("node").alias("item2")), "item2", "left_anti")
    return links.groupBy(F.col("item1").alias("node")).agg(F.count("*").alias("degree"))


def short_tips(members: DataFrame, degree: DataFrame, max_length: int = 10_000) -> DataFrame:
    """Short nodes with one link in the bin of a rank-1 node or next to it."""
    near = members.where("rank = 1").select("super", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin")).distinct()
    return members.where(F.col("length") <= max_length).join(near, ["super", "bin"], "left_semi").join(degree.where("degree = 1"), "node", "left_semi").select("node")


def bulges(members: DataFrame, max_length: int = 10_000) -> DataFrame:
    return members.where((F.col("rank") == 1) & (F.col("length") <= max_length)).select("node")


def end_forks(members: DataFrame) -> DataFrame:
    """Where a branch leaves next to an end of a path: the shorter of the branch and the end node."""
    off = members.where((F.col("rank") > 0) & ((F.col("bin") == 2) | (F.col("bin") == F.col("super_nbin") - 1)))
    sides = off.select("super", "node", "length", F.explode(F.array_compact(F.array(F.when(F.col("bin") == 2, F.lit(1).cast("long")), F.when(F.col("bin") == F.col("super_nbin") - 1, F.col("super_nbin"))))).alias("bin"))
    ends = members.where("rank = 0").select("super", "bin", F.col("node").alias("end"), F.col("length").alias("end_length"))
    return sides.join(ends, ["super", "bin"]).select(F.when(F.col("length") >= F.col("end_length"), F.col("end")).otherwise(F.col("node")).alias("node")).distinct()


def single_tips(members: DataFrame, degree: DataFrame) -> DataFrame:
    return members.where("rank = 1").join(degree.where("degree = 1"), "node", "left_semi").select("node")


def prune(links: DataFrame, info: DataFrame, max_rounds: int = 50, rounds: int = 100, max_length: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """Membership in which every super is a plain path, and the nodes left out for it; see prune_members()."""
    members = prune_members(links, info, max_rounds, rounds, max_length)
    return members.drop("left_out"), members.where("left_out").select("node").distinct()


def prune_members(links: DataFrame, info: DataFrame, max_rounds: int = 50, rounds: int = 100, max_length: int = 10_000) -> DataFrame:
    """Membership, as of make_supers(), in which every super is a plain path; left_out: whether a node was left out for it.

    Branches of two steps or more are cut until there are none; then short tips,
    bulges, forks at ends, other tips and, last, all that is off a path.  Left-out
    nodes come back as supers of their own.

    No step looks beyond a component, and leaving nodes out only divides it.  So components
    are found once, dealt to tasks sorted by component, and pruned there one after
    another to the end; of a component only the parts that lost a node are solved anew.
    """
    spark = links.sparkSession
    kind = dict(info.dtypes)["key"]
    one, two = F.col("item1"), F.col("item2")
    rows = repeatable(links.where("item1 is not null").select(one.cast(kind).alias("item1"), F.coalesce(two, one).cast(kind).alias("item2"), F.col("weight").cast("double").alias("weight")))
    up, down = F.when(one <= two, 1), F.when(one > two, 1)
    pairs = rows.groupBy(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).agg(F.min(F.when(one < two, F.col("weight"))).alias("weight"), F.count(up).alias("up"), F.count(down).alias("down"))
    pairs = materialize(pairs.withColumn("weight", F.coalesce("weight", F.lit(float("nan")))))
    # a link that is there one way only, against the order, joins a component as well: a degree counts it
    parts = contracted_components(rows, "item1", "item2")
    items = info.select(F.col("key").alias("a"), "chr", "cM", "length", F.lit(True).alias("item"))
    both = items.unionByName(pairs.withColumn("item", F.lit(False)), allowMissingColumns=True)
    named = both.join(parts.select(F.col("node").alias("a"), "component"), "a", "left").select(F.coalesce("component", "a").alias("super"), "a", "b", "weight", "up", "down", "item", "chr", "cM", "length", F.col("cM").cast("double").alias("at"))
    # a number of tasks that is not lowered for small tables: their components take time as well
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    types = {c: named.schema[c].dataType.simpleString() for c in ("chr", "cM", "length")}
    schema = f"node {kind}, super {kind}, bin long, rank long, backbone boolean, chr {types['chr']}, cM {types['cM']}, length {types['length']}, super_size long, super_nbin long, left_out boolean"
    dealt = named.repartition(tasks, "super").sortWithinPartitions("super")
    return materialize(dealt.mapInArrow(partial(_prune_sorted, max_rounds=max_rounds, rounds=rounds, max_length=max_length), schema))


def _prune_sorted(batches: Iterator[pa.RecordBatch], **bounds: int) -> Iterator[pa.RecordBatch]:
    """Members from rows of items and pairs (those have b) sorted by super; holds the batches of one super and one more."""
    held: list[pa.RecordBatch] = []
    name: object = held  # like no super
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column(0))
        cut = runs.run_ends[-2].as_py() if len(runs.values) > 1 else 0
        if cut or runs.values[0].as_py() != name:
            if held or cut:
                yield from _prune_whole([*held, batch.slice(0, cut)], **bounds)
            held = []
        held.append(batch.slice(cut))
        name = runs.values[-1].as_py()
    if held:
        yield from _prune_whole(held, **bounds)


def _values(column: pa.ChunkedArray) -> list:
    """to_pylist(), faster for numbers without nulls."""
    plain = not column.null_count and (pa.types.is_integer(column.type) or pa.types.is_floating(column.type))
    return column.to_numpy().tolist() if plain else column.to_pylist()


def _prune_whole(batches: list[pa.RecordBatch], **bounds: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches).combine_chunks()
    item = table.column("item")
    found, pairs = table.filter(item), table.filter(pc.invert(item))
    nodes, lengths, at = (_values(found.column(c)) for c in ("a", "length", "at"))
    links = list(zip(*(_values(pairs.column(c)) for c in ("a", "b", "weight", "up", "down"))))
    ends = pc.run_end_encode(table.column("super").combine_chunks()).run_ends.to_numpy()
    upto = np.cumsum(item.to_numpy())[ends - 1]  # items of this super and those before
    spots: list[tuple] = []
    sizes: list[tuple] = []
    out: list[bool] = []
    i = j = 0
    for n, m in zip(upto.tolist(), (ends - upto).tolist()):
        mine = nodes[i:n]
        place, left_out = prune_component(links[j:m], mine, lengths[i:n], dict(zip(mine, at[i:n])), **bounds)
        here = [place.get(x) or (x, 1, 0, True) for x in mine]
        size: dict = {}
        for spot in here:
            k, bins = size.get(spot[0], (0, 1))
            size[spot[0]] = (k + 1, max(bins, spot[1]))
        spots += here
        sizes += [size[spot[0]] for spot in here]
        out += [x in left_out for x in mine]
        i, j = n, m
    if not nodes:
        return
    supers, bins, ranks, on = zip(*spots)
    count, nbin = zip(*sizes)
    kind = table.schema.field("super").type
    made = {"node": found.column("a"), "super": pa.array(supers, kind), "bin": pa.array(bins, pa.int64()), "rank": pa.array(ranks, pa.int64()), "backbone": pa.array(on, pa.bool_())}
    made |= {c: found.column(c) for c in ("chr", "cM", "length")}
    made |= {"super_size": pa.array(count, pa.int64()), "super_nbin": pa.array(nbin, pa.int64()), "left_out": pa.array(out, pa.bool_())}
    yield from pa.table(made).to_batches(max_chunksize=100_000)


def prune_component(pairs: list[tuple], nodes: list, lengths: list, position: dict, max_rounds: int = 50, rounds: int = 100, max_length: int = 10_000) -> tuple[dict, set]:
    """Of the nodes of one component: node -> (super, bin, rank, backbone) where it has a link left, and the nodes left out.

    pairs: a <= b, weight, links from a to b, links from b to a.  The steps are branch_nodes(),
    short_tips(), bulges(), end_forks() and single_tips(), on the items with a row.
    """
    graph = to_graph([(a, b, w) for a, b, w, up, _ in pairs if up and a != b])
    place: dict = {}
    inside: dict = {}  # of each super all its nodes, without a row as well
    left_out: set = set()
    far: dict = {}  # node -> (far end, links)

    def settle(todo: list) -> None:
        todo = set(todo)
        while todo:
            reached = [todo.pop()]
            for u in reached:
                for v in graph[u]:
                    if v in todo:
                        todo.remove(v)
                        reached.append(v)
            if len(reached) == 1:
                place.pop(reached[0], None)
                continue
            name = min(reached)
            inside[name] = reached
            whole = graph if len(reached) == len(graph) else {u: graph[u] for u in reached}
            for u, bin_, rank, on in solve_graph(whole, position, False, rounds):
                place[u] = (name, bin_, rank, on)

    def leave(found: set) -> None:
        todo = [x for name in {place[u][0] for u in found} for x in inside.pop(name) if x not in found]
        for u in found:
            del place[u]
            for v in graph.pop(u):
                graph[v].pop(u, None)
        left_out.update(found)
        settle(todo)

    def degree(node: object) -> int:
        if not far:
            for a, b, _, up, down in pairs:
                far.setdefault(a, []).append((b, up))
                far.setdefault(b, []).append((a, down))
        return sum(n for x, n in far[node] if x not in left_out)

    def rows() -> list[tuple]:
        return [(u, length, *place[u][:3]) for u, length in zip(nodes, lengths) if u in place]

    def long_branches(m: list[tuple]) -> set:
        bins = {(s, b) for _, _, s, b, rank in m if rank > 1}
        return {u for u, _, s, b, rank in m if rank == 0 and (s, b) in bins}

    def tips(m: list[tuple]) -> set:
        near = {(s, b + d) for _, _, s, b, rank in m if rank == 1 for d in (-1, 0, 1)}
        return {u for u, length, s, b, _ in m if length is not None and length <= max_length and (s, b) in near and degree(u) == 1}

    def bubbles(m: list[tuple]) -> set:
        return {u for u, length, _, _, rank in m if rank == 1 and length is not None and length <= max_length}

    def forks(m: list[tuple]) -> set:
        nbin: dict = {}
        ends: dict = {}
        for u, length, s, b, rank in m:
            nbin[s] = max(b, nbin.get(s, 1))
            if rank == 0:
                ends.setdefault((s, b), []).append((u, length))
        found = set()
        for u, length, s, b, rank in m:
            if rank > 0:
                for end in ([1] if b == 2 else []) + ([nbin[s]] if b == nbin[s] - 1 else []):
                    found |= {x if length is not None and n is not None and length >= n else u for x, n in ends.get((s, end), [])}
        return found

    def lone(m: list[tuple]) -> set:
        return {u for u, _, _, _, rank in m if rank == 1 and degree(u) == 1}

    def off(m: list[tuple]) -> set:
        return {u for u, _, _, _, rank in m if rank > 0}

    settle(list(graph))
    for _ in range(max_rounds):
        found = long_branches(rows())
        if not found:
            break
        leave(found)
    else:
        raise RuntimeError(f"branches remain after {max_rounds} rounds")
    for step in (tips, bubbles, forks, bubbles, lone, off):
        if all(spot[2] == 0 for spot in place.values()):
            break  # nothing is off a path
        found = step(rows())
        if found:
            leave(found)
    return place, left_out


def rescue_links(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Items of no chromosome that alone join the ends of two supers of one chromosome: (link, item1, item2, super1, super2).

    pairs: item1, item2, chr1, length1 of supported pairs, both ways.  An item that
    joins more than one pair of ends is left out; of several items between two
    supers the longest counts, ties by id.
    """
    loose = pairs.where("chr1 is null").select(F.col("item1").alias("link"), F.col("length1").alias("link_length"), F.col("item2").alias("item"))
    ends = members.where("super_nbin > 1 and (bin = 1 or bin = super_nbin) and chr is not null").select(F.col("node").alias("item"), "super", "chr")
    placed = loose.join(ends, "item")
    a = placed.select("link", "link_length", F.col("item").alias("item1"), F.col("super").alias("super1"), F.col("chr").alias("chr1"))
    b = placed.select("link", F.col("item").alias("item2"), F.col("super").alias("super2"), F.col("chr").alias("chr2"))
    both = a.join(b, "link").where("super1 < super2 and chr1 = chr2")
    once = both.groupBy("link").agg(F.count("*").alias("n")).where("n = 1").select("link")
    best = both.join(once, "link", "left_semi").groupBy("super1", "super2").agg(F.max(F.struct("link_length", (-F.col("link")).alias("o"), "link", "item1", "item2")).alias("m"))
    return best.select("m.link", "m.item1", "m.item2", "super1", "super2")


def orient(members: DataFrame, positions: DataFrame, lengths: DataFrame, max_bins: int) -> DataFrame:
    """(node, orientation) of nodes linked to earlier or later bins of their super.

    positions: item1, pos1, item2.  prv and nxt are the mean places of a node's links
    to either side; with one side only, its nearness to an end decides.
    """
    m = members.where("super_nbin > 1").select("node", "bin", "super")
    one = m.select(F.col("node").alias("item1"), F.col("bin").alias("bin1"), F.col("super").alias("super1"))
    two = m.select(F.col("node").alias("item2"), F.col("bin").alias("bin2"), F.col("super").alias("super2"))
    linked = positions.join(one, "item1").join(two, "item2").where((F.col("super1") == F.col("super2")) & (F.col("bin1") != F.col("bin2")) & (F.abs(F.col("bin2") - F.col("bin1")) <= max_bins))
    sides = linked.groupBy(F.col("item1").alias("node")).agg(mean_if(F.col("bin2") > F.col("bin1"), F.col("pos1")).alias("nxt"), mean_if(F.col("bin2") < F.col("bin1"), F.col("pos1")).alias("prv"))
    sized = sides.join(lengths.select(F.col("key").alias("node"), "length"), "node")
    forward = F.when(F.col("prv").isNull(), F.col("length") - F.col("nxt") <= F.col("nxt")).when(F.col("nxt").isNull(), F.col("length") - F.col("prv") > F.col("prv")).otherwise(F.col("prv") <= F.col("nxt"))
    return sized.select("node", "prv", "nxt", F.when(forward, 1).otherwise(-1).alias("orientation"))


def super_positions(members: DataFrame, order: tuple[str, ...] = ("bin", "rank", "node"), length: str = "length") -> DataFrame:
    """members with super_pos: 1 for a super's first node, then after the lengths before."""
    before = Window.partitionBy("super").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return members.withColumn("super_pos", F.coalesce(F.sum(length).over(before), F.lit(0)) + 1)


def majority_chr(members: DataFrame) -> DataFrame:
    """Of each super with a chromosome: the commonest (ties by name), nchr, pchr, and mean, least and most cM on it."""
    counts = members.where("chr is not null").groupBy("super", "chr").agg(F.count("*").alias("nchr"), F.avg("cM").alias("cM"), F.min("cM").alias("min_cM"), F.max("cM").alias("max_cM"))
    w = Window.partitionBy("super")
    best = counts.withColumn("pchr", F.col("nchr") / F.sum("nchr").over(w)).withColumn("place", F.row_number().over(w.orderBy(F.desc("nchr"), "chr")))
    return best.where("place = 1").drop("place")


def agp(members: DataFrame, group: str, order: list, name: str, length: str, orientation: str, gap_size: int = 100) -> DataFrame:
    """Assembly table: group, start, end, part (1..), type ('W' or 'U'), component, component_length, orientation.

    A gap of gap_size stands between components, none after the last.  Orientation
    is '+' where unknown and null for gaps.
    """
    w = Window.partitionBy(group).orderBy(*order)
    placed = members.withColumn("__i", F.row_number().over(w)).withColumn("__n", F.count("*").over(Window.partitionBy(group)))
    before = Window.partitionBy(group).orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col(length) + gap_size).over(before), F.lit(0)) + 1
    sized = placed.withColumn("__start", start.cast("long"))
    part = F.struct(F.col("__start").alias("start"), (F.col("__start") + F.col(length) - 1).cast("long").alias("end"), (2 * F.col("__i") - 1).cast("long").alias("part"), F.lit("W").alias("type"), F.col(name).cast("string").alias("component"), F.col(length).cast("long").alias("component_length"), F.when(F.col(orientation) == -1, "-").otherwise("+").alias("orientation"))
    gap = F.struct((F.col("__start") + F.col(length)).cast("long").alias("start"), (F.col("__start") + F.col(length) + gap_size - 1).cast("long").alias("end"), (2 * F.col("__i")).cast("long").alias("part"), F.lit("U").alias("type"), F.lit("gap").alias("component"), F.lit(gap_size).cast("long").alias("component_length"), F.lit(None).cast("string").alias("orientation"))
    rows = F.when(F.col("__i") < F.col("__n"), F.array(part, gap)).otherwise(F.array(part))
    return sized.select(group, F.explode(rows).alias("r")).select(group, "r.*")


def chromosome_agp(oriented: DataFrame, names: DataFrame, gap_size: int = 100) -> DataFrame:
    """agp() of a Hi-C map by chromosome, with what has no bin or no chromosome in chrUn.

    oriented: key, chr, hic_bin, cM, length, orientation.  names: chr, alphachr.
    """
    named = oriented.join(names, "chr", "left")
    label = F.when(F.col("hic_bin").isNull() | F.col("alphachr").isNull(), "chrUn").otherwise(F.concat(F.lit("chr"), F.col("alphachr")))
    order = [F.col("hic_bin").asc_nulls_last(), F.col("chr").asc_nulls_last(), F.col("cM").asc_nulls_last(), F.desc("length"), "key"]
    return agp(named.withColumn("agp_chr", label), "agp_chr", order, "key", "length", "orientation", gap_size)


def chromosome_lengths(table: DataFrame, names: DataFrame) -> DataFrame:
    """Length and offset of each chromosome of an assembly table, chrUn last; a handful of rows."""
    lengths = table.groupBy("agp_chr").agg(F.sum("component_length").alias("length"))
    placed = lengths.join(names.select("chr", F.concat(F.lit("chr"), F.col("alphachr")).alias("agp_chr")), "agp_chr", "left")
    order = Window.orderBy(F.col("chr").asc_nulls_last(), "agp_chr").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
