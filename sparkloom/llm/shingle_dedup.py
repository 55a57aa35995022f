"""Near-dedup by the Jaccard similarity of word shingles, found through SimHash codes and BK-trees.

Texts are dealt to shards by MinHash bands: with 20 bands of 5 MinHashes a pair of
similarity s shares one with probability 1 - (1 - s^5)^20: 0.9996 at 0.8, more above.
(Bit blocks, by which simhash.py deals codes, would at so wide a radius put nearly
all texts together.)  Inside a shard texts are searched by the SimHash codes of their
sets; a pair of similarity 0.8 differs in 10 of 64 bits on average, with a deviation of
3, so a radius of 24 passes over hardly any.  Every pair that is linked has been
checked on the sets themselves.

A crowd of near copies does not become all its pairs.  Each text of a shard is
checked against the shard's smallest first, and connected components make classes
of what links.  Where a shard still has several classes, those outside its largest
class search its BK-trees, each of a bounded number of texts; hits are checked in the
same task, which sends on only links that join two classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..operators.graph import connected_components
from ..operators.relational import spread_join
from ..session import materialize, release, repeatable
from ._util import LOWER, offsets, quoted, text_bytes
from .simhash import Forest

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
#: Bits in which codes may differ; texts in one tree, and texts that search it in one task.
RADIUS, TREE_TEXTS = 24, 256
#: Shingles hashed in one step, shingles in one batch of sets.
STEP, BATCH_SHINGLES = 1024, 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(42).integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted; fewer words than a shingle are one, and so are none."""
    if not words:
        return np.zeros(1, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _FACTOR + hashes[i : i + n]
    return np.unique(out)


def bands(hashes: np.ndarray) -> np.ndarray:
    """The buckets of a set of shingles, one for each band."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), STEP):
        np.minimum(least, (_FACTORS[:, None] * hashes[at : at + STEP]).min(axis=1), out=least)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        out = (out ^ column) * _FACTOR
        out ^= out >> np.uint64(32)
    return out


def code_of(hashes: np.ndarray) -> np.uint64:
    """The SimHash of a set of shingles: 64 bits, each set if it is in over half of their hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), STEP):
        mixed = (hashes[at : at + STEP] ^ (hashes[at : at + STEP] >> np.uint64(32))) * _FACTOR
        mixed ^= mixed >> np.uint64(29)
        ones += np.unpackbits(mixed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]


def _sets(size: int, banded: bool):
    """Rows (row, text) to (row, hashes): the bands and the code, or the shingles, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: pa.Array, held: list[np.ndarray]) -> pa.RecordBatch:
            values = pa.array(np.concatenate(held).view(np.int64))
            return pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(pa.array(offsets(np.array([len(h) for h in held])), pa.int32()), values)], ["row", "hashes"])

        for batch in batches:
            rows, begin, held, total = batch.column("row"), 0, [], 0
            for text in text_bytes(batch.column("text")):
                found = shingles(text.translate(LOWER).split(), size)
                held.append(np.append(bands(found), code_of(found)) if banded else found)
                total += len(held[-1])
                if total >= BATCH_SHINGLES:
                    yield batch_of(rows.slice(begin, len(held)), held)
                    begin, held, total = begin + len(held), [], 0
            if held:
                yield batch_of(rows.slice(begin, len(held)), held)

    return run


def _hashed(frame: DataFrame, size: int, banded: bool) -> DataFrame:
    return frame.mapInArrow(_sets(size, banded), frame.select("row").schema.add("hashes", ArrayType(LongType())))


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets have at least the similarity; a text in many pairs is spread over tasks."""
    met = spread_join(pairs, sets.select(F.col("row").alias("a"), F.col("hashes").alias("x")), "a")
    met = met.join(sets.select(F.col("row").alias("b"), F.col("hashes").alias("y")), "b").where(F.least(F.size("x"), F.size("y")) / F.greatest(F.size("x"), F.size("y")) >= similarity)
    both = F.size(F.array_intersect("x", "y"))
    return met.where(both / (F.size("x") + F.size("y") - both) >= similarity).select("a", "b")


def jaccard_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """(id, component_id): component_id is the smallest id among the documents linked, over any number of links.

    Documents link if the Jaccard similarity of their sets of shingles (A-Z lower-cased
    words between ASCII spaces) is at least `similarity`; those without words, null or
    empty, link.  Texts of any length are taken whole.  Repeated rows and ids stay as
    they are, one row each.  A null id is never the smallest; a class of only null ids
    has a null component_id.  An empty table gives no rows.  Other columns of docs play
    no part, whatever their names.  docs that are not repeatable() are written once.
    """
    docs = repeatable(docs.select(quoted(id_col), quoted(text_col)))
    text = F.coalesce(quoted(text_col), F.lit(""))
    frame = docs.select(quoted(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    signed = materialize(_hashed(frame.select(F.struct("id", "key").alias("row"), "text"), shingle, True).select("row.id", "row.key", F.slice("hashes", 1, BANDS).alias("hashes"), F.element_at("hashes", -1).alias("code")))
    texts = materialize(signed.groupBy("key").agg(F.min("id").alias("least"), F.first("hashes").alias("hashes"), F.first("code").alias("code")))
    buckets = materialize(texts.select("key", "code", F.explode("hashes").alias("bucket")))
    shared = buckets.groupBy("bucket").agg(F.min(F.struct("key", "code")).alias("least"), F.count("*").alias("n")).where("n > 1").select("bucket", F.col("least.key").alias("first"), F.col("least.code").alias("first_code"))
    members = materialize(spread_join(buckets, shared, "bucket"))
    release(buckets)
    chosen = spread_join(frame.select("key", "text"), members.select("key").distinct(), "key", "left_semi", counted=signed).select(F.col("key").alias("row"), "text").dropDuplicates(["row"])
    sets = materialize(_hashed(chosen, shingle, False))
    to_first = materialize(members.where((F.col("key") != F.col("first")) & (F.bit_count(F.col("code").bitwiseXOR(F.col("first_code"))) <= RADIUS)).select(F.col("first").alias("a"), F.col("key").alias("b")).distinct())
    linked = materialize(_similar(to_first, sets, similarity))
    classes = materialize(connected_components(linked, "a", "b"))
    open_shards = materialize(_open_shards(members, classes))
    between = materialize(_between(open_shards, sets, similarity))
    parts = connected_components(linked.unionByName(between), "a", "b").withColumnRenamed("node", "key")
    class_of = materialize(texts.select("key", "least").join(parts, "key", "left").withColumn("component", F.coalesce("component", "key")))
    for done in (texts, members, sets, to_first, linked, classes, open_shards, between):
        release(done)
    smallest = class_of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(spread_join(class_of, smallest, "component").select("key", "component_id"))
    release(class_of)
    return spread_join(signed.select("id", "key"), named, "key").select(F.col("id").alias(id_col), "component_id")


def _open_shards(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the shards in which pairs of different classes are unchecked: with the shard's largest class (main), its trees, and the parts of those that search them.

    Of shards with the same texts one is taken; in a shard of two the pair has been checked.
    """
    classed = materialize(members.join(classes.withColumnRenamed("node", "key"), "key", "left").select("bucket", "key", "code", F.coalesce("component", "key").alias("class")))
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "key")).alias(f"mark{i}") for i in (0, 1)]
    of_class = classed.groupBy("bucket", "class").agg(F.count("*").alias("n"), *marks)
    whole = of_class.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("classes"), *(F.bit_xor(f"mark{i}").alias(f"mark{i}") for i in (0, 1)))
    mixed = whole.where("classes > 1 and n > 2").groupBy("n", "mark0", "mark1").agg(F.min(F.struct("bucket", "most")).alias("one")).select("one.*", "n")
    parts = lambda n: F.ceil(n / TREE_TEXTS).cast("int")
    return spread_join(classed, mixed.select("bucket", F.col("most.class").alias("main"), parts(F.col("n")).alias("trees"), parts(F.col("n") - F.col("most.n")).alias("asks")), "bucket")


def _between(open_shards: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between classes of one shard: all classes that some pair of at least the similarity joins are joined by them.

    Those outside the shard's largest class meet all its trees, so a crowd of one class never meets itself.
    """
    place = lambda i, n: F.pmod(F.xxhash64(F.lit(i), "key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = ["key", "code", "class"]
    trees = open_shards.select("bucket", place(2, "trees").alias("tree"), every("asks").alias("ask"), *rest, F.lit(False).alias("asks"))
    asking = open_shards.where(F.col("class") != F.col("main")).select("bucket", every("trees").alias("tree"), place(3, "asks").alias("ask"), *rest, F.lit(True).alias("asks"))
    cells = materialize(trees.unionByName(asking).select(F.xxhash64("bucket", "tree", "ask").alias("cell"), *rest, "asks"))
    tasks = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells.count() // 10_000)
    met = spread_join(cells, sets.select(F.col("row").alias("key"), "hashes"), "key").select("cell", *rest, "asks", "hashes")
    return met.repartition(tasks, "cell").sortWithinPartitions("cell").mapInArrow(_search(similarity), "a long, b long")


def _search(similarity: float):
    """Rows of whole cells, one after another, to links between classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            links = _links_of(pa.Table.from_batches(held), similarity)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

        held, cell = [], None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1]))) if len(cells) else []
            for begin, end in zip(starts, [*starts[1:], len(cells)]):
                if held and cells[begin] != cell:
                    yield found(held)
                    held = []
                cell = cells[begin]
                held.append(batch.slice(begin, end - begin))
        if held:
            yield found(held)

    return run


def _links_of(cell: pa.Table, similarity: float) -> list[tuple[int, int]]:
    """Links of a cell's asking texts with those of its tree, each joining two classes that were apart."""
    whole = cell.combine_chunks()
    keys, asks = whole.column("key").to_numpy(), whole.column("asks").to_numpy()
    key, row, number = np.unique(keys, return_index=True, return_inverse=True)  # a text may both ask and be in the tree
    ask, inside = np.zeros(len(key), bool), np.zeros(len(key), bool)
    ask[number[asks]], inside[number[~asks]] = True, True
    nodes, asking = np.flatnonzero(inside), np.flatnonzero(ask)
    if not len(nodes) or not len(asking):
        return []
    whole = whole.take(pa.array(row))
    code = whole.column("code").to_numpy().view(np.uint64)
    lists = whole.column("hashes").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = lists.value_lengths().to_numpy().astype(np.int64)
    at = offsets(size)
    _, shingle, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    # no more shingles can be shared with another text than occur twice
    shared = np.add.reduceat((times[shingle] > 1).astype(np.int64), at[:-1])
    up = np.unique(whole.column("class").to_numpy(), return_inverse=True)[1].tolist()

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    of_class = up
    up = list(range(max(of_class) + 1))
    tree_codes, of_code = np.unique(code[nodes], return_inverse=True)
    by_code = nodes[np.argsort(of_code, kind="stable")]
    ends = offsets(np.bincount(of_code))
    hits = list(Forest(tree_codes, np.zeros(len(tree_codes), np.int64)).search(code[asking], np.zeros(len(asking), np.int64), RADIUS))
    query, node = (np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, np.int64),) * 2
    order = np.argsort(query, kind="stable")
    query, node = query[order], node[order]
    bounds, mark, links = np.searchsorted(query, np.arange(len(asking) + 1)), np.zeros(len(times), bool), []
    for i, one in enumerate(asking.tolist()):
        near = node[bounds[i] : bounds[i + 1]]
        if not len(near):
            continue
        other = np.concatenate([by_code[ends[c] : ends[c + 1]] for c in near.tolist()])
        most = np.minimum(shared[other], shared[one])
        other = other[most / (size[other] + size[one] - most) >= similarity].tolist()
        other = [x for x in other if top(of_class[x]) != top(of_class[one])]
        if not other:
            continue
        mark[shingle[at[one] : at[one + 1]]] = True
        for x in other:
            if (a := top(of_class[x])) != (b := top(of_class[one])):
                both = int(np.count_nonzero(mark[shingle[at[x] : at[x + 1]]]))
                if both / (size[x] + size[one] - both) >= similarity:
                    up[max(a, b)] = min(a, b)
                    links.append((int(key[one]), int(key[x])))
        mark[shingle[at[one] : at[one + 1]]] = False
    return links
