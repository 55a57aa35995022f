"""Graph operators on edge tables: connected components, degrees, component statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release


#: A node with more than one in so many of all edges' ends is a hub; hence there are at most twice as many hubs.
HUB_SHARE = 1_000


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node that can be reached.

    Large-star and small-star rounds: a node hands its larger neighbours, then
    its smaller ones, to the smallest node it knows of.  A round is two
    aggregations by node and two joins.  The edges of a hub do not meet in the
    join: hubs, at most 2 * HUB_SHARE of them whatever the graph, are broadcast with
    their least neighbours, so a key of the shuffled join has at most one in HUB_SHARE
    of the edges.  Long chains shrink by a factor each round.  Each round's edges are
    written to the shared checkpoint folder, which cuts the lineage and outlives
    executors.  Null ends and self-loops link nothing; a node with only those is
    returned as its own component unless it is null.  No edges give no rows.
    """
    spark = edges.sparkSession
    pairs = materialize(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")))
    if pairs.isEmpty():
        return pairs.select(F.col("a").alias("node"), F.col("a").alias("component"))
    loops = pairs.where(F.col("a").isNotNull() | F.col("b").isNotNull()).select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct()
    now = materialize(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    rows = now.count()
    # small rounds write few files: one for so many edges, but no fewer than there are cores
    files = max(spark.sparkContext.defaultParallelism, rows // 500_000)
    few = files < int(spark.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(max_rounds):
        if _settled(now):
            break
        large = _star(now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), True, rows)
        small = _star(large, False, rows)
        step = materialize(small.repartition(files) if few else small)
        release(now)
        now = step
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return loops.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _settled(edges: DataFrame) -> bool:
    """Whether every edge u -> v ends in a root: no node has two edges out, or one out and one in."""
    role = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")), F.struct(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))))
    nodes = edges.select(role.alias("r")).select("r.*").groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 or (out = 1 and into = 1)").count() == 0


def _star(edges: DataFrame, larger: bool, rows: int) -> DataFrame:
    """Of directed edges u -> v: link the larger (or the smaller and itself) neighbours of u to the least node among u and them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("m", "u").alias("m"), "n")
    hubs = least.where(F.col("n") > max(1, rows // HUB_SHARE)).select("u", F.col("m").alias("hub_m"))
    marked = edges.join(F.broadcast(hubs), "u", "left")
    plain = marked.where("hub_m is null").select("u", "v").join(least.select("u", "m"), "u")
    joined = plain.unionByName(marked.where("hub_m is not null").select("u", "v", F.col("hub_m").alias("m")))
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


#: Edges that a task contracts at once, which bounds its memory.
CHUNK = 1_000_000


def _least_of_component(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least one that the edges u - v reach."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, up := label[label]):
            label = up


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of each node in a chunk of edges: the least node that it reaches by them."""

    def stars(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        ends = pa.chunked_array([*table.column(0).chunks, *table.column(1).chunks]).combine_chunks().dictionary_encode()
        names = ends.dictionary
        order = pc.sort_indices(names)
        rank = np.empty(len(names), np.int64)
        rank[order.to_numpy()] = np.arange(len(names))
        at = rank[ends.indices.to_numpy()]
        names = names.take(order)
        roots = names.take(pa.array(_least_of_component(at[: len(table)], at[len(table) :], len(names))))
        yield from pa.table({"node": names, "root": roots}).to_batches(max_chunksize=100_000)

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK:
            yield from stars(held)
            held, rows = [], 0
    if held:
        yield from stars(held)


def contracted_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """As connected_components(), for edges that mostly lie near others of their component.

    A task contracts the edges it reads, chunk by chunk, to stars around the least node.  Nodes
    of several stars link their roots, and only those links go through connected_components().
    """
    pairs = edges.select(F.coalesce(src, dst).alias("a"), F.coalesce(dst, src).alias("b")).where("a is not null")
    kind = pairs.schema["a"].dataType.simpleString()
    stars = materialize(pairs.mapInArrow(_contract, f"node {kind}, root {kind}"))
    nodes = materialize(stars.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")))
    twice = nodes.where("low < high")
    more = stars.join(twice.where("n > 2").select("node", "low"), "node").where("root > low").select("low", F.col("root").alias("high"))
    roots = connected_components(twice.select("low", "high").unionByName(more).distinct(), "low", "high")
    roots = materialize(roots.select(F.col("node").alias("low"), "component"))
    release(stars)
    return nodes.join(roots, "low", "left").select("node", F.coalesce("component", "low").alias("component"))


def component_stats(nodes: DataFrame, component: str = "component") -> DataFrame:
    """Nodes in each component."""
    return nodes.groupBy(component).agg(F.count("*").alias("n"))


def degrees(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, degree) counting each undirected edge once at either end."""
    both = edges.select(F.explode(F.array(src, dst)).alias("node"))
    return both.groupBy("node").agg(F.count("*").alias("degree"))
