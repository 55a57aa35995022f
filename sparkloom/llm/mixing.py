"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations.

Documents of a source queue up in a shuffled order that a digest of id, source and
text fixes, epoch after epoch.  The virtual finish time of a queued document is
the words its source has sent up to and with it, divided by the source's target.
Entries are taken in the order of finish time until the total budget is used up.

Neither the running sums nor the global order ever passes through one task.  Rows
that are alike in id, source and text are counted first; a crowd of them is cut
into blocks with digests of their own.  A source's queue is cut into ranges of the
digest, as many as its rows need, and those into stretches; sums of stretches are
added up first, then ranges inside their stretch and rows inside their range.  The cut
at the budget is found likewise, from sums over stretches and ranges of finish time
and then inside the one range where the budget ends.

All that works on digests and sizes alone.  What it gives for each source and epoch
is the digest up to which its queue is taken, so whole documents are compared with
that where they are and are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from ._util import quoted, table, words_of

#: Weights of the sources in order, repeating; share of all words the mix has; most copies of a document.
WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2
#: Ranges of queues for each shuffle partition, most rows in a range.
RANGES_A_TASK, RANGE_ROWS = 16, 100_000
#: Rows that are alike make blocks of so many, or of one in so many of all rows if that is more; hence there are at most so many crowds of more than one block.
BLOCK_ROWS = 1_000


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """(source, source_size) with sid, weight and target.

    Targets divide share * all words by weight; one that would exceed epochs *
    source_size stops there and what it leaves is shared again.  Sorted by cap
    over weight, the sources that stop are the first ones.  The list of sources, a row
    each, passes through one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("sid", F.row_number().over(order))
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("sid") - 1, len(weights)) + 1).cast("int"))
    capped = numbered.withColumn("weight", pick.cast("double")).withColumn("cap", F.col("source_size") * float(epochs))
    queue = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    run = capped.withColumn("left", F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("cap").over(queue.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    run = run.withColumn("sharing", F.sum("weight").over(queue.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    run = run.withColumn("stops", F.col("cap") * F.col("sharing") <= F.col("left") * F.col("weight"))
    last = Window.partitionBy()
    free = run.withColumn("rest", F.max(F.when(~F.col("stops"), F.col("left"))).over(last)).withColumn("among", F.max(F.when(~F.col("stops"), F.col("sharing"))).over(last))
    target = F.when(F.col("stops"), F.col("cap")).otherwise(F.col("rest") * F.col("weight") / F.col("among"))
    return free.select("source", "source_size", "sid", target.alias("target"))


def _digest(key: Column, block: Column) -> Column:
    """The place in the queue of a block of rows that are alike."""
    return F.md5(F.concat(key, F.lit(":"), block.cast("string")).cast("binary"))


def _own_source(frame: DataFrame, sources: DataFrame) -> DataFrame:
    return frame.join(sources.withColumnRenamed("source", "__source"), F.col("__mix_source").eqNullSafe(F.col("__source")), "left").drop("__source")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = 8,
    keep: list[str] | None = None,
    range_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
    finish: bool = False,
) -> DataFrame:
    """docs with size, source_size (bigint words), target (double, of its source), copies (int) and taken (bigint, copies * size).

    A null text has no words; a document without words has the finish time of
    the one before it and is kept with it; texts of any length are counted whole.  Null
    is a source, the last.  Where all texts are empty every target is 0 and nothing is
    taken; an empty table gives no rows.  Rows alike in id, source and text are
    interchangeable: how many of them are taken is fixed, not which.  Columns of docs
    with one of the new names are replaced.  Results depend on the rows alone, not on
    their order or partitions.  keep: the columns to return, all if None.  finish: also the
    virtual finish time (double) in the first epoch, of the first of rows alike, for
    which whole documents are joined to their queue.
    """
    added = ("size", "source_size", "target", *(["finish"] if finish else []), "copies", "taken")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    text = F.coalesce(quoted(text_col), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(quoted(source_col).cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary"))).cast("binary"))
    frame = docs.select(
        F.struct(F.lit(True).alias("__sparkloom_row"), *(quoted(c) for c in kept)).alias("row"),
        quoted(source_col).cast("string").alias("__mix_source"),
        F.size(words_of(quoted(text_col))).cast("long").alias("size"),
        key.alias("__mix_key"),
    )
    alike = materialize(frame.groupBy("__mix_source", "__mix_key", "size").agg(F.count("*").alias("n")))
    rows, most = alike.agg(F.sum("n"), F.max("n")).first()
    rows, room = rows or 0, max(block_rows, (rows or 0) // block_rows)
    if range_rows is None:
        range_rows = min(RANGE_ROWS, max(1, rows // (RANGES_A_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    totals = alike.groupBy(F.col("__mix_source").alias("source")).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    bits = totals.select(F.col("source").alias("__source"), F.least(F.lit(32), F.ceil(F.log2(F.greatest(F.col("rows") / range_rows, F.lit(1.0))))).cast("int").alias("bits"))
    targets = source_targets(totals.drop("rows"), weights, share, epochs)
    sources = materialize(targets.join(bits, F.col("source").eqNullSafe(F.col("__source"))).drop("__source"))
    budget = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    queue = _queue(alike, sources, room)
    cut = _cut(queue, budget, epochs, max(1, rows * epochs // range_rows))
    taken = F.array(*(_taken(e, cut) for e in range(epochs)))
    upto = queue.select("sid", "__mix_key", "n", taken.alias("taken"))
    whole = upto.groupBy("sid").agg(F.array(*(F.max(F.when(F.col("taken")[e] == F.col("n"), F.col("__mix_key"))) for e in range(epochs))).alias("__upto"))
    # groups that an epoch takes in part: at most one for each source and epoch
    edges = materialize(upto.where(F.exists("taken", lambda t: (t > 0) & (t < F.col("n")))).select(F.col("__mix_key").alias("__edge"), F.col("taken").alias("__edge_taken")))
    sources = materialize(sources.join(whole, "sid", "left").select("source", "source_size", "target", "__upto"))
    if (most or 0) > room:
        crowds = alike.where(F.col("n") > room).select(F.col("__mix_key").alias("__crowd"))  # at most block_rows of them
        marked = frame.join(F.broadcast(crowds), F.col("__mix_key") == F.col("__crowd"), "left")
        apart = _numbered(marked.where("__crowd is not null").drop("__crowd"), room)
        frame = marked.where("__crowd is null").drop("__crowd").unionByName(apart)
    out = _own_source(frame, sources)
    copies = sum((F.when(F.col("__mix_key") <= F.col("__upto")[e], 1).otherwise(0) for e in range(1, epochs)), F.when(F.col("__mix_key") <= F.col("__upto")[0], 1).otherwise(0))
    out = out.withColumn("copies", copies.cast("int"))
    if not edges.isEmpty():
        marked = out.join(F.broadcast(edges), F.col("__mix_key") == F.col("__edge"), "left")
        nth = F.row_number().over(Window.partitionBy("__mix_key").orderBy("size"))  # of rows alike, one block at most
        some = marked.where("__edge is not null").withColumn("__nth", nth)
        some = some.withColumn("copies", F.size(F.filter("__edge_taken", lambda t: t >= F.col("__nth"))).cast("int"))
        out = marked.where("__edge is null").drop("__edge", "__edge_taken").unionByName(some.drop("__edge", "__edge_taken", "__nth"))
    if finish:
        first = queue.select("__mix_key", _time(F.col("before") + F.col("size"), 0).alias("finish"))
        out = out.join(first, "__mix_key")
    return out.select(*(F.col("row")[c].alias(c) for c in kept), *added[:-1], (F.col("copies") * F.col("size")).alias("taken"))


def _queue(alike: DataFrame, sources: DataFrame, room: int) -> DataFrame:
    """Blocks of at most `room` rows alike with their source's columns and before: words of its source before the block, in one epoch."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / room))).alias("block")
    blocks = alike.select("__mix_source", "__mix_key", "size", "n", block)
    apart = F.when(F.col("n") > room, _digest(F.col("__mix_key"), F.col("block"))).otherwise(F.col("__mix_key"))
    blocks = blocks.select("__mix_source", apart.alias("__mix_key"), "size", F.least(F.lit(room).cast("long"), F.col("n") - F.col("block") * room).alias("n"))
    number = F.conv(F.substring("__mix_key", 1, 8), 16, 10).cast("long").alias("__number")
    placed = _own_source(blocks, sources).select("sid", "source_size", "target", "__mix_key", "size", "n", "bits", number).withColumn("__range", F.expr("shiftright(__number, 32 - bits)"))
    stretch = F.expr("shiftright(__range, bits - bits div 2)").alias("__stretch")
    sums = placed.groupBy("sid", "__range", stretch).agg(F.sum(F.col("size") * F.col("n")).alias("__words"))
    ranges = _before(sums, ["sid"], "__stretch", "__range", "__words").select("sid", "__range", "__before")
    placed = placed.drop("bits", "__number")
    inside = Window.partitionBy("sid", "__range").orderBy("__mix_key").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("__before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0))
    return materialize(placed.join(materialize(ranges), ["sid", "__range"]).withColumn("before", words).drop("__range", "__before"))


def _before(sums: DataFrame, by: list[str], stretch: str, at: str, value: str) -> DataFrame:
    """sums with __before: the values before each row in the order of `at`, by stretches first and then inside them."""
    earlier = lambda w: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = sums.groupBy(*by, stretch).agg(F.sum(value).alias(value)).select(*by, stretch, earlier(Window.partitionBy(*by).orderBy(stretch)).alias("__base"))
    return sums.join(coarse, [*by, stretch]).withColumn("__before", F.col("__base") + earlier(Window.partitionBy(*by, stretch).orderBy(at))).drop("__base")


def _numbered(crowd: DataFrame, room: int) -> DataFrame:
    """Rows of crowds with the digest of their block; rows alike are numbered by partition first, then inside it."""
    dealt = materialize(crowd.withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy("__mix_key", "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__mix_key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__mix_key", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    nth = F.col("__start") + F.row_number().over(Window.partitionBy("__mix_key", "__part").orderBy("size")) - 1
    out = dealt.join(starts, ["__mix_key", "__part"]).withColumn("__nth", nth)
    return out.withColumn("__mix_key", _digest(F.col("__mix_key"), F.floor(F.col("__nth") / room))).select(*crowd.columns)


def _time(done: Column, epoch: int) -> Column:
    """Virtual finish time in this epoch; null (never) for a source that gets nothing."""
    return F.when(F.col("target") > 0, (done + F.col("source_size") * epoch) / F.col("target"))


def _taken(epoch: int, cut: float) -> Column:
    """How many rows of a block this epoch takes."""
    inside = lambda j: F.coalesce(_time(F.col("before") + j * F.col("size"), epoch) <= F.lit(cut), F.lit(False))
    return F.size(F.filter(F.sequence(F.lit(1).cast("long"), F.col("n")), inside)).cast("long")


def _cut(queue: DataFrame, budget: float, epochs: int, ranges: int) -> float:
    """The largest finish time such that all entries up to it hold at most `budget` words."""
    each = queue.withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    times = F.explode(F.array(*(_time(F.col("before") + F.col("j") * F.col("size"), e) for e in range(epochs)))).alias("t")
    entries = materialize(each.select(times, "size").where("t is not null"))
    part = F.least(F.floor(F.col("t") * ranges), F.lit(ranges * 8)).cast("long")
    sums = entries.groupBy(part.alias("part")).agg(F.sum("size").alias("n"), F.max("t").alias("latest")).withColumn("stretch", F.floor(F.col("part") / max(1, math.isqrt(ranges))))
    sums = materialize(_before(sums, [], "stretch", "part", "n").withColumn("upto", F.col("__before") + F.col("n")))
    full = sums.where(F.col("upto") <= budget).agg(F.max("part"), F.max("upto"), F.max("latest")).first()
    here = sums.where(F.col("upto") > budget).agg(F.min("part")).first()[0]
    best = full[2] if full[2] is not None else -1.0
    if here is None:
        return best
    at = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = entries.where(part == here).groupBy("t").agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(at) + F.lit(full[1] or 0))
    more = inside.where(F.col("upto") <= budget).agg(F.max("t")).first()[0]
    return best if more is None else more


def op8_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
with d as (
  select doc_id, source, md5('8:' || coalesce(doc_id::varchar, '') || ':' || coalesce(source, '') || ':' || md5(coalesce(text, ''))) as k,
    coalesce(len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0)::bigint as size
  from documents),
s as (
  select source, sum(size)::double as ssize from d group by source),
w as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
    row_number() over (order by source nulls last) as sid, 2.0::double * ssize as cap from s),
r as (
  select *, 1.5::double * sum(ssize) over () - coalesce(sum(cap) over (order by cap / weight, sid rows between unbounded preceding and 1 preceding), 0) as remaining,
    sum(weight) over (order by cap / weight, sid rows between current row and unbounded following) as sharing from w),
q as (select *, cap * sharing <= remaining * weight as stops from r),
t as (
  select source, ssize, case when stops then cap else (max(remaining) filter (not stops) over ()) * weight / (max(sharing) filter (not stops) over ()) end as target from q),
f as (
  select d.doc_id, d.size, t.ssize, t.target,
    sum(d.size) over (partition by d.source order by d.k, d.size rows between unbounded preceding and current row)::double as done
  from d join t on d.source is not distinct from t.source),
e as (
  select done / target as tm, size from f where target > 0
  union all select (done + ssize) / target, size from f where target > 0),
g as (select tm, sum(sum(size)) over (order by tm rows between unbounded preceding and current row) as upto from e group by tm),
c as (select coalesce(max(tm), -1) as cut from g where upto <= (select 1.5::double * sum(ssize) from s))
select doc_id, size, ssize::bigint as source_size, target,
  (size * (case when target > 0 and done / target <= cut then 1 else 0 end + case when target > 0 and (done + ssize) / target <= cut then 1 else 0 end))::bigint as taken
from f, c
"""
