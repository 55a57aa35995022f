"""SimHash near-dedup: fingerprints linked through BK-trees.

Fingerprints are made from XXH64 hashes of word shingles.  Distinct fingerprints
are then searched within a Hamming radius r by BK-trees, whose children hang on
edges keyed by their integer distance to the parent; a search follows only the
edges within r of its own distance.  No tree holds all fingerprints: codes are
dealt to shards by the values of some of their bit blocks.  With b blocks, two
codes that differ in r bits agree on at least b - r blocks, so a shard for each
choice of b - r blocks and each value they take finds every link.  b grows with the
number of codes so that shards stay small.  A shard that is large all the same (a
crowd of near copies) is cut into pieces, each piece a tree of bounded size.  Codes
first search their own piece; then those that are not in the shard's largest class
search all its other pieces.  Two codes of different classes are never both in the
largest, so no link between classes is lost, and a crowd of one class is not
searched again.  A task builds the trees of its shards and sends on, not every
linked pair, but a spanning forest of what it linked; connected components over
those edges give the classes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..operators.relational import spread_join
from ..session import materialize, release
from ._util import LOWER, offsets, quoted, table, text_bytes

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Codes in a shard that the number of blocks aims at, and the most in one tree.
SHARD_CODES, TREE_CODES = 256, 16_384
#: Pairs of query and node looked at in one step.
FRONTIER = 1 << 18


def simhash(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes; 0 without words."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    ones, batch = np.zeros(64, np.int64), 1 << 15
    for at in range(0, n, batch):
        pieces = map(joined.__getitem__, map(slice, starts[at : at + batch], stops[at : at + batch]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(seed)), np.uint64, min(batch, n - at))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """docs with code (bigint): the SimHash of A-Z lower-cased words between ASCII spaces.

    Fewer words than a shingle are hashed as one; null or empty texts have code
    0.  A column named code is replaced.  keep: the columns to return, all if None.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != "code"]
    frame = docs.select(F.struct(F.lit(True).alias("__sparkloom_row"), *(quoted(c) for c in kept)).alias("row"), quoted(text_col).alias("text"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([simhash(t.translate(LOWER).split(), shingle) for t in text_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(codes.view(np.int64))], ["row", "code"])

    out = frame.mapInArrow(code, frame.select("row").schema.add("code", "long"))
    return out.select(*(F.col("row")[c].alias(c) for c in kept), "code")


class Forest:
    """BK-trees, one for each distinct value of `shard`, over codes that are distinct within a shard."""

    def __init__(self, codes: np.ndarray, shard: np.ndarray) -> None:
        n = len(codes)
        self.codes = codes
        _, first, number = np.unique(shard, return_index=True, return_inverse=True)
        self.root = first[number]
        parent, label = np.full(n, -1), np.zeros(n, np.int64)
        todo = np.setdiff1d(np.arange(n), first)
        at = self.root[todo]
        while todo.size:  # all codes sink one level at a time
            distance = np.bitwise_count(codes[todo] ^ codes[at]).astype(np.int64)
            _, lead, edge = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
            child = todo[lead]
            parent[child], label[child] = at[lead], distance[lead]
            down = np.ones(len(todo), bool)
            down[lead] = False
            at, todo = child[edge][down], todo[down]
        self.children = np.lexsort((label, parent))
        self.children = self.children[np.searchsorted(parent[self.children], 0) :]
        #: parent and edge label as one sorted key
        self.edges = parent[self.children] * 65 + label[self.children]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query number, node) within the radius, level by level."""
        query, node = np.arange(len(queries)), roots
        while query.size:
            distance = np.bitwise_count(queries[query] ^ self.codes[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edges, node * 65 + np.minimum(distance + radius, 64), side="right")
            count = high - low
            query = np.repeat(query, count)
            node = self.children[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(offsets(count)[:-1], count)]


class Classes:
    """Union-find over 0..n-1 that takes links in blocks."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.up[a], self.up[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.up[self.up]
                if (above == self.up).all():
                    break
                self.up = above


def _link(radius: int, members_ask: bool = True):
    """Rows (shard, tree, code, in_tree) of whole pieces to a forest of links; codes in no tree search their piece's, members too if members_ask."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[], [], [], []]
        for batch in batches:
            for held, column in zip(columns, batch.columns):
                held.append(column.to_numpy(zero_copy_only=False))
        if not columns[0]:
            return
        shard, tree, code, inside = (np.concatenate(c) for c in columns)
        code = code.view(np.uint64)
        order = np.lexsort((code, tree, shard))
        shard, tree, code, inside = shard[order], tree[order], code[order], inside[order]
        new = np.concatenate(([True], (shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1])))
        piece = np.cumsum(new) - 1
        nodes = np.flatnonzero(inside)
        forest = Forest(code[nodes], piece[nodes])
        root_of = np.full(piece[-1] + 1, -1)
        root_of[piece[nodes]] = forest.root
        asking = np.flatnonzero((root_of[piece] >= 0) & (members_ask | ~inside))
        sizes = np.bincount(piece[nodes], minlength=piece[-1] + 1)[piece[asking]]
        distinct, number = np.unique(code, return_inverse=True)
        classes = Classes(len(distinct))
        begin, cost = 0, offsets(sizes)
        while begin < len(asking):
            end = max(begin + 1, int(np.searchsorted(cost, cost[begin] + FRONTIER)) - 1)
            part = asking[begin:end]
            for q, hit in forest.search(code[part], root_of[piece[part]], radius):
                classes.link(number[part[q]], number[nodes[hit]])
            begin = end
        linked = np.flatnonzero(classes.up != np.arange(len(distinct)))
        values = distinct.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(values[linked]), pa.array(values[classes.up[linked]])], ["src", "dst"])

    return link


def _blocks(n: int, radius: int, shard_codes: int) -> int:
    """The least number of blocks with which shards of n evenly spread codes hold at most shard_codes."""
    for blocks in range(radius + 1, min(64, radius + 5)):
        if n <= shard_codes << int(64 * (blocks - radius) / blocks):
            return blocks
    return min(64, radius + 4)


def _shard_keys(code: Column, blocks: int, radius: int) -> Column:
    """One hash for each choice of blocks - radius blocks: of the choice and the bits in it."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (bounds[i + 1] - bounds[i])) - 1) << bounds[i] for i in chosen) for chosen in itertools.combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*(F.xxhash64(F.lit(i), code.bitwiseAND(F.lit(m))) for i, m in enumerate(signed)))


def near_links(codes: DataFrame, radius: int = RADIUS, shard_codes: int = SHARD_CODES, tree_codes: int = TREE_CODES) -> DataFrame:
    """(src, dst) links among the distinct codes of column code, whose components are those of all pairs within the radius."""
    n = codes.count()
    if n == 0:
        return codes.select(F.col("code").alias("src"), F.col("code").alias("dst"))
    shards = codes.select("code", F.explode(_shard_keys(F.col("code"), _blocks(n, radius, shard_codes), radius)).alias("shard"))
    sizes = materialize(shards.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"))
    cut = sizes.select("shard", F.ceil(F.col("n") / tree_codes).cast("int").alias("trees"))
    own = F.pmod(F.xxhash64("code"), F.col("trees")).cast("int").alias("tree")
    dealt = shards.join(cut, "shard").select("shard", own, "code", F.lit(True).alias("in_tree"))
    tasks, kind = _tasks(codes, n), "src long, dst long"
    links = materialize(dealt.repartition(tasks, "shard", "tree").mapInArrow(_link(radius), kind))
    if cut.agg(F.max("trees")).first()[0] in (None, 1):
        return links
    classes = materialize(connected_components(links).select(F.col("node").alias("code"), "component"))
    crowded = cut.where("trees > 1")
    members = materialize(shards.join(crowded, "shard").join(classes, "code", "left").select("shard", "trees", own, "code", F.coalesce("component", "code").alias("class")))
    of_class = members.groupBy("shard", "class").agg(F.count("*").alias("n"))
    main = of_class.groupBy("shard").agg(F.max(F.struct("n", "class")).alias("most"), F.count("*").alias("classes")).where("classes > 1").select("shard", F.col("most.class").alias("main"))
    open_shards = materialize(spread_join(members, main, "shard"))
    asking = open_shards.where("class <> main").select("shard", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other"), F.col("tree").alias("own"), "code").where("other <> own")
    trees = open_shards.select("shard", "tree", "code", F.lit(True).alias("in_tree")).unionByName(asking.select("shard", F.col("other").alias("tree"), "code", F.lit(False).alias("in_tree")))
    between = materialize(trees.repartition(tasks, "shard", "tree").mapInArrow(_link(radius, False), kind))
    for done in (sizes, classes, members, open_shards):
        release(done)
    return links.unionByName(between)


def _tasks(codes: DataFrame, n: int) -> int:
    return max(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 100_000)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, **sizes: int) -> DataFrame:
    """(id, fingerprint, component_id): component_id is the smallest id among the documents linked, over any number of links.

    Documents link if their SimHash codes differ in at most `radius` bits; those
    without words all have code 0 and link like any other.  Texts of any length
    are hashed whole, 32,768 shingles at a time.  Repeated rows, repeated ids and
    ties stay as they are, one row each.  A null id is never the smallest; a class of
    only null ids has a null component_id.  An empty table gives no rows.  Other
    columns of docs play no part, whatever their names.  Codes are written once to
    the shared checkpoint folder, since both the search and the result read them;
    rows of one code, and codes of one class, are spread over tasks when they meet it.
    """
    coded = materialize(fingerprints(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), "text", shingle, ["id"]))
    least = materialize(coded.groupBy("code").agg(F.min("id").alias("least")))
    parts = connected_components(near_links(least.select("code"), radius, **sizes))
    class_of = materialize(least.join(parts.withColumnRenamed("node", "code"), "code", "left").withColumn("component", F.coalesce("component", "code")))
    release(least)
    smallest = class_of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(spread_join(class_of, smallest, "component").select("code", "component_id"))
    release(class_of)
    out = spread_join(coded, named, "code")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
