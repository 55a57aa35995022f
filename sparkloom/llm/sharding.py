"""Sharding by extendible hashing, in DataFrame operations.

A document hashes to 60 bits.  Shards are hash prefixes; a directory maps the
leading bits of a hash to its shard, and only a shard over the byte limit splits
on one more bit, again until every shard fits.  The splits of several bits are
found at once from the bytes of each prefix, so that the corpus is read once for
sizes however deep the directory goes; rows that hash alike split no further by
bits and go to numbered overflow shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from ._util import quoted, table

#: Bytes of text in a shard at most.
SHARD_BYTES = 16 << 20
#: Bits of the hash; bits looked at beyond the depth that even sizes need; bits added in each later round.
BITS, SPARE_BITS, MORE_BITS = 60, 3, 8


def _prefix(hashed: Column, depth: Column | int) -> Column:
    return F.shiftrightunsigned(hashed, BITS - depth) if isinstance(depth, int) else F.expr(f"shiftrightunsigned(h, {BITS} - depth)")


def _directory(sizes: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """Of prefixes of `depth` bits: slot, the depth of its shard (null: still too large), the shard's bytes and rows."""
    hist = sizes.groupBy(_prefix(F.col("h"), depth).alias("slot")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("h").alias("low"), F.max("h").alias("high"))
    hist = materialize(hist)
    levels = hist.select("slot", "bytes", "rows", "low", "high", F.explode(F.sequence(F.lit(above), F.lit(depth))).alias("depth")).withColumn("node", F.expr(f"shiftrightunsigned(slot, {depth} - depth)"))
    nodes = levels.groupBy("depth", "node").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
    fits = nodes.where((F.col("bytes") <= limit) | (F.col("low") == F.col("high"))).select("depth", "node", F.struct("depth", "bytes", "rows").alias("fit"))
    return materialize(levels.select("slot", "depth", "node").join(fits, ["depth", "node"], "left").groupBy("slot").agg(F.min("fit").alias("fit")))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES, keep: list[str] | None = None) -> DataFrame:
    """docs with shard (string), shard_depth (int), shard_bytes and shard_rows (bigint).

    shard is the prefix in bits ('' if one shard holds all), with '+k' for the
    k-th overflow shard of rows that hash alike.  Sizes are bytes of UTF-8; a null
    text has none.  The hash is of id and text, so repeated ids with other texts
    spread, and a null id counts as ''; repeated rows hash alike.  Only a single document
    over the limit makes a shard over the limit, and has it to itself.  Texts of any
    length stay whole; an empty table gives no rows.  Columns of docs with one
    of the new names are replaced.  keep: the columns to return, all if None.
    """
    added = ("shard", "shard_depth", "shard_bytes", "shard_rows")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    text = F.coalesce(quoted(text_col), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(quoted(id_col).cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    frame = docs.select(F.struct(F.lit(True).alias("__sparkloom_row"), *(quoted(c) for c in kept)).alias("row"), F.octet_length(text).cast("long").alias("bytes"), F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long").alias("h"))
    sizes = materialize(frame.groupBy("h").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows")))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    depth, above, active, levels = min(BITS, max(0, (-(-total // limit) - 1).bit_length()) + SPARE_BITS), 0, sizes, []
    while True:
        directory = _directory(active, above, depth, limit)
        levels.append((depth, directory.where("fit is not null")))
        open_slots = directory.where("fit is null").select("slot")
        if depth == BITS or open_slots.isEmpty():
            break
        active = active.withColumn("slot", _prefix(F.col("h"), depth)).join(open_slots, "slot", "left_semi").drop("slot")
        above, depth = depth + 1, min(BITS, depth + MORE_BITS)
    out = frame
    for k, (d, directory) in enumerate(levels):
        found = directory.select(F.col("slot").alias(f"slot{k}"), F.col("fit").alias(f"fit{k}"))
        out = out.withColumn(f"slot{k}", _prefix(F.col("h"), d)).join(found, f"slot{k}", "left").drop(f"slot{k}")
    out = out.withColumn("fit", reduce(lambda a, b: F.coalesce(a, b), (F.col(f"fit{k}") for k in range(len(levels)))))
    bits = F.when(F.col("fit.depth") == 0, "").otherwise(F.lpad(F.bin(F.expr(f"shiftrightunsigned(h, {BITS} - fit.depth)")), F.col("fit.depth"), F.lit("0")))
    out = out.select("row", "bytes", "h", bits.alias("shard"), F.col("fit.depth").cast("int").alias("shard_depth"), F.col("fit.bytes").alias("shard_bytes"), F.col("fit.rows").alias("shard_rows"))
    too_much = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    if not sizes.where((F.col("bytes") > limit) & (F.col("rows") > 1)).isEmpty():
        out = out.where(~too_much).unionByName(_overflow(out.where(too_much), limit))
    return out.select(*(F.col("row")[c].alias(c) for c in kept), *added)


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Numbered shards for rows of one hash, which have one size: positions are counted by partition first, then inside it."""
    dealt = materialize(rows.withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy("h", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("h", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("h", "part").orderBy("bytes")) - 1
    room = F.greatest(F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))), F.lit(1))
    out = dealt.join(starts, ["h", "part"]).withColumn("place", place).withColumn("room", room).withColumn("k", F.floor(F.col("place") / F.col("room")))
    mine = F.least(F.col("room"), F.col("shard_rows") - F.col("k") * F.col("room"))
    return out.select("row", "bytes", "h", F.concat("shard", F.lit("+"), F.col("k").cast("string")).alias("shard"), "shard_depth", (mine * F.col("bytes")).alias("shard_bytes"), mine.alias("shard_rows"))


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


OP4_SQL = f"""
with d as (
  select doc_id, strlen(coalesce(text, ''))::bigint as bytes,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, {BITS // 4}))::bigint as h
  from documents),
n as (
  select depth, h >> ({BITS} - depth)::bigint as node, sum(bytes)::bigint as shard_bytes, count(*)::bigint as shard_rows,
    sum(bytes) <= {SHARD_BYTES} or min(h) = max(h) as fits
  from d, (select unnest(generate_series(0, {BITS}))::bigint as depth) group by 1, 2),
f as (
  select doc_id, h, min(n.depth) as depth from d join n on n.node = h >> ({BITS} - n.depth)::bigint where fits group by doc_id, h)
select f.doc_id, case when f.depth = 0 then '' else right(lpad(bin(h >> ({BITS} - f.depth)::bigint), 64, '0'), f.depth::int) end as shard,
  f.depth::int as shard_depth, n.shard_bytes, n.shard_rows
from f join n on n.depth = f.depth and n.node = h >> ({BITS} - f.depth)::bigint
"""
