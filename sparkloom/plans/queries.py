"""Queries over the test tables, one for each operator, with the SQL that gives the same rows.

The tables are business data; each query says which of its columns stand for
sequences, positions, molecules and so on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aggregates, scalars
from ..operators import assign, coverage, hic, layout, lift, links, path, relational, rolling, split
from ..operators.graph import component_stats, connected_components, degrees
from ..session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _n(c: str):
    return F.col(c).cast("long").alias(c)


def _r(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


# ---- scans, projections, scalars


@query("select l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount), 4) as revenue from lineitem where l_quantity >= 30 and l_shipdate >= timestamp '1996-01-01'")
def scan_filter_project(spark, sf):
    rows = _t(spark, sf, "lineitem").where((F.col("l_quantity") >= 30) & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")))
    return rows.select("l_orderkey", "l_partkey", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue"))


@query("select (floor(c_acctbal / 250) * 250)::bigint as bin, count(*)::bigint as n from customer group by 1")
def floor_bin_count(spark, sf):
    return _t(spark, sf, "customer").groupBy(scalars.floor_bin(F.col("c_acctbal"), 250).alias("bin")).agg(F.count("*").alias("n"))


@query("""
select distinct l_returnflag as g1, case when l_returnflag = l_linestatus or l_partkey <= l_suppkey then l_partkey else l_suppkey end as a,
  case when l_returnflag = l_linestatus or l_partkey <= l_suppkey then l_suppkey else l_partkey end as b from lineitem""")
def canonical_pairs(spark, sf):
    pairs = _t(spark, sf, "lineitem").select(F.col("l_returnflag").alias("g1"), F.col("l_partkey").alias("a"), F.col("l_returnflag").alias("g2"), F.col("l_suppkey").alias("b"))
    return relational.canonical_pairs(pairs, "g1", "a", "g2", "b").select("g1", "a", "b")


@query("""
with d as (select p_type, dense_rank() over (order by p_type) - 1 as code from part group by p_type)
select p_partkey, code::bigint as code from part join d using (p_type)""")
def dictionary_encode(spark, sf):
    return relational.encode(_t(spark, sf, "part").select("p_partkey", "p_type"), "p_type").select("p_partkey", "code")


@query("select c_custkey, case when c_acctbal < 0 then '-' else '+' end as strand, (floor((c_custkey + c_nationkey) / 2))::bigint as middle, c_name || ':' || c_nationkey || '-' || c_custkey as region, round(log2(c_custkey / 10.0), 6) as ratio, round(-log10((c_custkey + c_custkey) / 1e9), 6) as weight, round(c_acctbal / nullif(c_nationkey, 0), 6) as ratio_or_null, round(coalesce(case when c_acctbal > 0 then c_acctbal end, 0) / c_custkey, 6) as ratio_or_0, round(-log10(c_custkey), 6) + 0 as link_weight from customer where c_custkey > 0")
def scalar_functions(spark, sf):
    c = _t(spark, sf, "customer").where("c_custkey > 0")
    k = F.col("c_custkey")
    return c.select(k, scalars.strand(F.when(F.col("c_acctbal") < 0, -1).otherwise(1)).alias("strand"), scalars.midpoint(k, F.col("c_nationkey")).alias("middle"), scalars.region_name(F.col("c_name"), F.col("c_nationkey"), k).alias("region"), F.round(scalars.log2_ratio(k, F.lit(10.0)), 6).alias("ratio"), F.round(scalars.length_weight(k, k), 6).alias("weight"), F.round(scalars.safe_ratio(F.col("c_acctbal"), F.col("c_nationkey")), 6).alias("ratio_or_null"), F.round(scalars.coalesced_ratio(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")), k), 6).alias("ratio_or_0"), (F.round(scalars.link_weight(k), 6) + 0).alias("link_weight"))


@query("select p_partkey, reverse(translate(upper(p_name), 'ACGTUNRYKMSWBDHV', 'TGCAANYRMKSWVHDB')) as sequence from part")
def revcomp(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", scalars.reverse_complement(F.upper("p_name")).alias("sequence"))


@query("select p_partkey, array_to_string(list_transform(range(0, ((length(s) + 9) // 10)::bigint), lambda i: substr(s, i * 10 + 1, 10)), chr(10)) as lines from (select p_partkey, p_name || p_brand || p_type as s from part)")
def fasta_wrap(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", scalars.wrap(F.concat("p_name", "p_brand", "p_type"), 10).alias("lines"))


@query("""
select a.npairs::bigint as npairs, b.nmol::bigint as nmol, c.nsample::bigint as nsample, d.dist::bigint as dist, (a.npairs * b.nmol * c.nsample)::bigint as product
from (values (2), (3)) a(npairs), (values (2), (3)) b(nmol), (values (1), (2)) c(nsample), (values (60000), (70000), (80000), (90000)) d(dist)
where a.npairs * b.nmol * c.nsample between 6 and 10""")
def grid_skip(spark, sf):
    axes = {"npairs": [2, 3], "nmol": [2, 3], "nsample": [1, 2], "dist": [60000, 70000, 80000, 90000]}
    return relational.parameter_grid(spark, axes, ["npairs", "nmol", "nsample"], 6, 10)


@query("select l_returnflag, least(floor((l_extendedprice - 900) / ((105000 - 900) / 8.0)) + 1, 8)::bigint as colour, count(*)::bigint as n from lineitem where l_extendedprice between 900 and 105000 group by 1, 2")
def colour_index(spark, sf):
    rows = _t(spark, sf, "lineitem").where("l_extendedprice between 900 and 105000")
    return rows.groupBy("l_returnflag", scalars.colour_index(F.col("l_extendedprice"), 900.0, 105000.0, 8).cast("long").alias("colour")).agg(F.count("*").alias("n"))


# ---- assignment: parts to the nation of their suppliers

_ALN = "aln as (select l_partkey as key, s_nationkey::bigint as chr, l_suppkey as marker, s_acctbal as pos, case l_returnflag when 'A' then 'S' when 'R' then 'L' end as arm from lineitem join supplier on l_suppkey = s_suppkey)"
_TOP = """cnt as (select key, chr, count(*) as n from {0} where chr is not null group by 1, 2),
rk as (select *, row_number() over (partition by key order by n desc, chr) as i from cnt),
top as (select key, sum(n)::bigint as total, max(chr) filter (i = 1) as first, (max(n) filter (i = 1))::bigint as n1, max(chr) filter (i = 2) as second, (max(n) filter (i = 2))::bigint as n2 from rk group by key)"""


def _alignments(spark, sf):
    s = _t(spark, sf, "supplier").select("s_suppkey", _n("s_nationkey"), "s_acctbal")
    arm = F.when(F.col("l_returnflag") == "A", "S").when(F.col("l_returnflag") == "R", "L")
    return _t(spark, sf, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_partkey").alias("key"), F.col("s_nationkey").alias("chr"), F.col("l_suppkey").alias("marker"), F.col("s_acctbal").alias("pos"), arm.alias("arm"))


@query(f"with {_ALN}, {_TOP.format('aln')} select key, total, first, n1, second, n2, n1 / total as share, n2 / n1 as ratio from top")
def assign_top2(spark, sf):
    return assign.assign_top2(_alignments(spark, sf), "key", "chr")


@query(f"""with {_ALN}, {_TOP.format('aln')},
a as (select key, chr, count(*) filter (arm = 'S') as ns, count(*) filter (arm = 'L') as nl from aln group by 1, 2)
select top.key, first, ns::bigint as n_short, nl::bigint as n_long, case when first = 3 then null when ns >= nl then 'S' else 'L' end as arm,
  case when first = 3 then null when ns >= nl then ns / n1 else nl / n1 end as arm_share from top join a on a.key = top.key and a.chr = first""")
def assign_arm(spark, sf):
    rows = _alignments(spark, sf)
    return assign.assign_arm(rows, assign.assign_top2(rows, "key", "chr"), "key", "chr", "arm", (3,)).select("key", "first", "n_short", "n_long", "arm", "arm_share")


@query(f"""with {_ALN}, {_TOP.format('aln')},
p as (select key, chr, avg(pos) as m, case when count(*) > 1 then stddev_samp(pos) else 0 end as s, 1.4826 * mad(pos) as d from aln group by 1, 2)
select top.key, first, n1, round(m, 6) as pos_mean, round(s, 6) as pos_sd, round(d, 6) as pos_mad from top join p on p.key = top.key and p.chr = first""")
def assign_position_stats(spark, sf):
    out = assign.assign_position(_alignments(spark, sf), "key", "chr", "pos")
    return out.select("key", "first", "n1", _r("pos_mean"), _r("pos_sd"), _r("pos_mad"))


_PAIRS = "prs as (select a.l_partkey as k1, b.l_partkey as k2 from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_linenumber < b.l_linenumber)"


def _pairs(spark, sf):
    one = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("k"))
    a, b = one.withColumnsRenamed({"l_linenumber": "n1", "k": "k1"}), one.withColumnsRenamed({"l_linenumber": "n2", "k": "k2"})
    return a.join(b, "l_orderkey").where("n1 < n2").select("k1", "k2")


@query(f"""with {_ALN}, {_PAIRS}, t0 as (with {_TOP.format('aln')} select key, first from top where n1 / total >= 0.1),
t as (select prs.k2 as key, first as chr from prs join t0 on t0.key = prs.k1), {_TOP.format('t')}
select key, total, first, n1, second, n2 from top""")
def pair_label_tally(spark, sf):
    labels = assign.assign_top2(_alignments(spark, sf), "key", "chr").where("share >= 0.1").select(F.col("key"), F.col("first").alias("label"))
    out = assign.pair_label_tally(_pairs(spark, sf), labels, "k1", "k2")
    return out.select("key", "total", "first", "n1", "second", "n2")


@query("""
with a as (select p_partkey, case when p_size > 10 then p_size % 7 end as x, p_size % 5 as y, case when p_size < 40 then p_size % 3 end as z from part),
l as (select p_partkey, unnest([x, y, z]) as c from a)
select p_partkey, count(*)::bigint as n_assigned, count(distinct c)::bigint as n_distinct from l where c is not null group by 1""")
def assignment_conflicts(spark, sf):
    s = F.col("p_size")
    rows = _t(spark, sf, "part").select("p_partkey", F.when(s > 10, s % 7).alias("x"), (s % 5).alias("y"), F.when(s < 40, s % 3).alias("z"))
    return assign.assignment_conflicts(rows, "p_partkey", ["x", "y", "z"])


@query(f"""with {_ALN}, {_TOP.format('aln')}, q as (select quantile_cont(n2 / n1, 0.95) as x from top where total >= 30)
select key, total, n2, coalesce(n2 / n1 >= x and n2 >= 2, false) as bad from top, q""")
def flag_outliers(spark, sf):
    return assign.flag_outliers(assign.assign_top2(_alignments(spark, sf), "key", "chr"), "ratio", "total", "n2", 0.95).select("key", "total", "n2", "bad")


# ---- coverage: events as intervals on their user's time line

_IV = "iv as (select user_id as key, (floor(epoch(ts)) - 1704067200)::bigint as s, (floor(epoch(ts)) - 1704067200)::bigint + floor(value * 3600)::bigint as e from events), len as (select key, max(e) + 3600 as length from iv group by 1)"
_COV = _IV + """, sp as (select key, floor(s / 3600)::bigint * 3600 as a, floor(e / 3600)::bigint * 3600 as b from iv),
cov as (select key, bin, count(*)::bigint as n from (select key, unnest(generate_series(a + 3600, b - 3600, 3600)) as bin from sp where b - a > 7200) group by 1, 2)"""
_RATIO = _COV + """, d as (select cov.*, length, least(bin, floor((length - bin) / 3600)::bigint * 3600) as d, (count(*) over (partition by cov.key))::bigint as nbin from cov join len using (key)),
ratio as (select *, avg(n) over (partition by d) as mn, log2(n / avg(n) over (partition by d)) as r from d)"""


def _intervals(spark, sf):
    s = F.unix_timestamp("ts") - 1704067200
    iv = _t(spark, sf, "events").select(F.col("user_id").alias("key"), s.alias("s"), (s + F.floor(F.col("value") * 3600)).cast("long").alias("e"))
    return iv, iv.groupBy("key").agg((F.max("e") + 3600).alias("length"))


def _ratio(spark, sf):
    iv, lengths = _intervals(spark, sf)
    return coverage.coverage_ratio(coverage.interval_coverage(iv, "key", "s", "e", 3600), lengths, "key", 3600)


@query(f"with {_COV} select key, bin, n from cov")
def interval_coverage_explode(spark, sf):
    return coverage.interval_coverage(_intervals(spark, sf)[0], "key", "s", "e", 3600, "explode")


@query(f"with {_COV} select key, bin, n from cov")
def interval_coverage_sweep(spark, sf):
    return coverage.interval_coverage(_intervals(spark, sf)[0], "key", "s", "e", 3600, "sweep")


@query(f"with {_IV}, sp as (select key, floor(s / 3600)::bigint * 3600 as a, floor(e / 3600)::bigint * 3600 as b from iv) select key, bin, count(*)::bigint as n from (select key, unnest(generate_series(a + 7200, b - 3600, 3600)) as bin from sp where b - a > 7200 and b - a <= 200000) group by 1, 2")
def interval_coverage_bounded(spark, sf):
    return coverage.interval_coverage(_intervals(spark, sf)[0], "key", "s", "e", 3600, "sweep", skip_first=True, max_span=200_000)


@query(f"with {_RATIO} select key, bin, n, length, d, nbin, round(mn, 6) as mn, round(r, 6) as r from ratio")
def coverage_ratio(spark, sf):
    return _ratio(spark, sf).select("key", "bin", "n", "length", "d", "nbin", _r("mn"), _r("r"))


@query(f"with {_RATIO} select key, round(min(r) filter (nbin >= 50), 6) as mr, round(min(r) filter (nbin > 50 and d >= 100000), 6) as mri from ratio group by key")
def coverage_group_min(spark, sf):
    return coverage.coverage_minima(_ratio(spark, sf), "key", 50, 100_000).select("key", _r("mr"), _r("mri"))


@query(f"""with {_RATIO}, e as (select *, floor(bin / 864000)::bigint * 864000 as b from ratio where nbin >= 20 and r <= -1 and least(bin, length - bin) >= 7200),
i as (select *, row_number() over (partition by key, b order by r, bin) as i from e) select key, b, bin as breakpoint, n, d, nbin from i where i = 1""")
def coverage_breaks(spark, sf):
    return coverage.find_breaks(_ratio(spark, sf), "key", 864_000, 20, 7200, -1.0).select("key", "b", "breakpoint", "n", "d", "nbin")


@query(f"with {_RATIO}, i as (select key, floor(bin / 864000)::bigint * 864000 as \"window\", bin, r, row_number() over (partition by key, floor(bin / 864000) order by r, bin) as i from ratio where r < -0.5) select key, \"window\", bin, round(r, 6) as r from i where i = 1")
def top_windows(spark, sf):
    return coverage.lowest_windows(_ratio(spark, sf), "key", 864_000, -0.5).select("key", "window", "bin", _r("r"))


# ---- splitting and lifting: parts as sequences

_SEQ = "seq as (select p_partkey as key, (p_size * 200 + 1000)::bigint as length from part), brk as (select key, cutpos from seq, (values (3000), (7000)) v(cutpos) where cutpos + 200 < length)"
_PIECES = _SEQ + """, cut as (select key, length, list_sort(list_concat([0::bigint, length], flatten(list(brk_at)))) as c from (
  select seq.key, length, case when cutpos is null then []::bigint[] else [cutpos - 200, cutpos + 200]::bigint[] end as brk_at from seq left join brk on brk.key = seq.key) group by key, length),
pc as (select key, unnest(range(1, len(c)))::bigint as piece, c, length as whole from cut),
pieces as (select key, piece, c[piece] + 1 as "start", c[piece + 1] as "end", c[piece + 1] - c[piece] as length from pc)"""


def _pieces(spark, sf):
    seq = _t(spark, sf, "part").select(F.col("p_partkey").alias("key"), (F.col("p_size") * 200 + 1000).cast("long").alias("length"))
    breaks = seq.select("key", "length", F.explode(F.array(F.lit(3000), F.lit(7000))).alias("at")).where("at + 200 < length")
    return seq, split.split_segments(seq, breaks, "key", "length", "at", 200)


@query(f'with {_PIECES} select key, piece, "start", "end", length from pieces')
def split_segments(spark, sf):
    return _pieces(spark, sf)[1]


@query(f'with {_PIECES}, s as (select key, sum("end" - "start" + 1) as c from pieces group by 1) select count(*)::bigint as n_sequences, count(*) filter (s.c <> seq.length)::bigint as n_wrong from seq left join s using (key)')
def segment_invariant(spark, sf):
    seq, pieces = _pieces(spark, sf)
    wrong = split.uncovered(pieces, seq, "key", "length").agg(F.count("*").alias("n_wrong"))
    return seq.agg(F.count("*").alias("n_sequences")).withColumn("n_wrong", wrong.scalar())


@query("""
with b as (select distinct p_partkey as key, x as p from part, (values (1000), (1500), (2700), (2900), (5000)) v(x) where x < p_size * 200),
o as (select key, p, lag(p) over (partition by key order by p) as prev from b) select key, p::bigint as "at" from o where prev is null or p - prev > 600""")
def thin_breaks(spark, sf):
    points = F.explode(F.array(*(F.lit(x) for x in (1000, 1500, 2700, 2900, 5000)))).alias("at")
    return split.thin_breaks(_t(spark, sf, "part").select(F.col("p_partkey").alias("key"), "p_size", points).where("at < p_size * 200"), "key", "at", 200)


@query("select a.p_partkey as node, (a.p_partkey // 3)::bigint as parent, not exists (select 1 from part b where b.p_partkey // 3 = a.p_partkey and b.p_partkey <> a.p_partkey) as to_use from part a")
def leaf_flag(spark, sf):
    return split.leaf_flag(_t(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.floor(F.col("p_partkey") / 3).alias("parent")), "node", "parent")


_INFO = _PIECES + ", info as (select key as orig, \"start\" as orig_start, \"end\" as orig_end, length, key || ':' || piece as key from pieces)"


def _info(spark, sf):
    return _pieces(spark, sf)[1].select(F.concat_ws(":", "key", "piece").alias("key"), F.col("key").alias("orig"), F.col("start").alias("orig_start"), F.col("end").alias("orig_end"), "length")


@query(f"with {_INFO}, p as (select l_orderkey as id, l_partkey as orig, l_orderkey % 5000 + 1 as orig_pos from lineitem) select id, p.orig, orig_pos, key, orig_pos - orig_start + 1 as pos from p asof left join info on info.orig = p.orig and p.orig_pos >= info.orig_start")
def lift_positions(spark, sf):
    p = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("orig"), (F.col("l_orderkey") % 5000 + 1).alias("orig_pos"))
    return lift.lift_positions(p, _info(spark, sf)).select("id", "orig", "orig_pos", "key", "pos")


@query(f"""with {_INFO}, m as (select l_orderkey as id, l_partkey as orig, l_orderkey % 4000 + 1 as s, l_orderkey % 4000 + 1 + l_suppkey * 5 as e from lineitem)
select id, m.orig, key, s - orig_start + 1 as "start", e - orig_start + 1 as "end" from m asof join info on info.orig = m.orig and m.s >= info.orig_start where e <= orig_end""")
def lift_intervals(spark, sf):
    s = F.col("l_orderkey") % 4000 + 1
    m = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("orig"), s.alias("s"), (s + F.col("l_suppkey") * 5).alias("e"))
    return lift.lift_intervals(m, _info(spark, sf), "s", "e").select("id", "orig", "key", "start", "end")


@query(f"""with {_INFO}, p as (select l_orderkey as id, l_partkey as orig1, l_orderkey % 5000 + 1 as p1, l_partkey % 50 + 1 as orig2, l_suppkey * 17 % 6000 + 1 as p2 from lineitem),
a as (select p.*, key as key1, p1 - orig_start + 1 as pos1 from p asof left join info on info.orig = p.orig1 and p.p1 >= info.orig_start)
select id, key1, pos1, key as key2, p2 - orig_start + 1 as pos2 from a asof left join info on info.orig = a.orig2 and a.p2 >= info.orig_start""")
def lift_pairs(spark, sf):
    k = F.col("l_orderkey")
    p = _t(spark, sf, "lineitem").select(k.alias("id"), F.col("l_partkey").alias("orig1"), (k % 5000 + 1).alias("orig_pos1"), (F.col("l_partkey") % 50 + 1).alias("orig2"), (F.col("l_suppkey") * 17 % 6000 + 1).alias("orig_pos2"))
    return lift.lift_pairs(p, _info(spark, sf)).select("id", "key1", "pos1", "key2", "pos2")


_LAY = "lay as (select p_partkey as key, (p_partkey // 10)::bigint as super, (p_partkey % 10 * 20000 + 1)::bigint as ss, (p_partkey % 10 * 20000 + p_size * 200 + 1000)::bigint as se, case when p_size % 2 = 0 then 1 else -1 end as o from part)"


def _layout(spark, sf):
    k = F.col("p_partkey")
    at = k % 10 * 20000
    return _t(spark, sf, "part").select(k.alias("key"), F.floor(k / 10).cast("long").alias("super"), (at + 1).alias("super_start"), (at + F.col("p_size") * 200 + 1000).alias("super_end"), F.when(F.col("p_size") % 2 == 0, 1).otherwise(-1).alias("orientation"))


@query(f"with {_LAY} select l_orderkey as id, key, super, case o when -1 then se - (l_suppkey) + 1 else ss + l_suppkey - 1 end as super_pos from lineitem join lay on l_partkey = key")
def lift_strand(spark, sf):
    rows = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("key"), "l_suppkey")
    return lift.lift_strand(rows, _layout(spark, sf), "key", "l_suppkey").select("id", "key", "super", "super_pos")


@query(f"with {_LAY} select l_orderkey as id, key, super, case o when -1 then se - (l_suppkey + 10) + 1 else ss + l_suppkey - 1 end as \"from\", case o when -1 then se - l_suppkey + 1 else ss + l_suppkey + 9 end as \"to\" from lineitem join lay on l_partkey = key")
def lift_strand_intervals(spark, sf):
    rows = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("key"), F.col("l_suppkey").alias("a"), (F.col("l_suppkey") + 10).alias("b"))
    return lift.lift_strand_intervals(rows, _layout(spark, sf), "key", "a", "b").select("id", "key", "super", "from", "to")


@query(f"""with {_LAY}, up as (select super as key, (super % 5)::bigint as chr, super * 1000000 + 1 as ss, super * 1000000 + 300000 as se, case when super % 3 = 0 then -1 else 1 end as o from lay group by super)
select lay.key, up.chr as super, case up.o when -1 then up.se - lay.se + 1 else up.ss + lay.ss - 1 end as super_start, case up.o when -1 then up.se - lay.ss + 1 else up.ss + lay.se - 1 end as super_end, (lay.o * up.o)::int as orientation from lay join up on lay.super = up.key""")
def compose_layouts(spark, sf):
    inner = _layout(spark, sf)
    s = F.col("key")
    outer = inner.select(F.col("super").alias("key")).distinct().select("key", (s % 5).alias("super"), (s * 1000000 + 1).alias("super_start"), (s * 1000000 + 300000).alias("super_end"), F.when(s % 3 == 0, -1).otherwise(1).alias("orientation"))
    return lift.compose_layouts(inner, outer)


@query(f"""with {_PIECES}, info as (select key as orig, "start" as os, length, key * 10 + piece as key from pieces), lay as (select key, key % 50 as super, key * 1000 + 1 as ss, key * 1000 + length as se, case when key % 2 = 0 then 1 else -1 end as o from info),
p as (select l_orderkey as id, l_partkey as orig, l_orderkey % 5000 + 1 as orig_pos from lineitem), a as (select id, p.orig, info.key, orig_pos - os + 1 as pos from p asof join info on info.orig = p.orig and p.orig_pos >= info.os)
select id, a.key, pos, super, case o when -1 then se - pos + 1 else ss + pos - 1 end as super_pos from a join lay on lay.key = a.key""")
def lift_alignments(spark, sf):
    """Foreign alignments on whole sequences, lifted to pieces and on to what the pieces were built into."""
    pieces = _pieces(spark, sf)[1].withColumn("orig", F.col("key")).withColumn("key", F.col("orig") * 10 + F.col("piece"))
    info = pieces.select("key", "orig", F.col("start").alias("orig_start"), "length")
    k = F.col("key")
    lay = info.select(k, (k % 50).alias("super"), (k * 1000 + 1).alias("super_start"), (k * 1000 + F.col("length")).alias("super_end"), F.when(k % 2 == 0, 1).otherwise(-1).alias("orientation"))
    p = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("orig"), (F.col("l_orderkey") % 5000 + 1).alias("orig_pos"))
    return lift.lift_alignments(p, info, lay).select("id", "key", "pos", "super", "super_pos")


# ---- rolling joins: the last urgent order of a customer

_ROLL = "r as (select o_orderkey as id, o_custkey as k, floor(epoch(o_orderdate))::bigint as at from orders), seg as (select o_custkey as k, floor(epoch(o_orderdate))::bigint as at, {}(o_orderkey) as seg from orders where o_orderpriority = '1-URGENT' group by 1, 2)"


def _rolling(spark, sf, **how):
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.unix_timestamp("o_orderdate").alias("at"), "o_orderpriority")
    seg = o.where("o_orderpriority = '1-URGENT'").select("k", "at", F.col("id").alias("seg"))
    return rolling.rolling_join(o.select("id", "k", "at"), seg, ["k"], "at", "seg", **how)


@query(f"with {_ROLL.format('max')} select id, r.k, r.at, seg from r asof left join seg on r.k = seg.k and r.at >= seg.at")
def rolling_join_backward(spark, sf):
    return _rolling(spark, sf)


@query(f"with {_ROLL.format('min')} select id, r.k, r.at, seg from r asof left join seg on r.k = seg.k and r.at <= seg.at")
def rolling_join_forward(spark, sf):
    return _rolling(spark, sf, how="forward")


@query(f"with {_ROLL.format('max')}, f as (select k, min_by(seg, seg.at) as f from seg group by 1), j as (select id, r.k, r.at, seg from r asof left join seg on r.k = seg.k and r.at >= seg.at) select id, j.k, j.at, coalesce(j.seg, f) as seg from j left join f on f.k = j.k")
def rolling_join_clamped(spark, sf):
    return _rolling(spark, sf, clamp=True)


# ---- links: parts that share orders

_ONCE = "once as (select distinct l_linestatus as sample, l_orderkey as barcode, l_partkey as item from lineitem), bl as (select a.sample, a.barcode, a.item as item1, b.item as item2 from once a join once b on a.sample = b.sample and a.barcode = b.barcode where a.item <> b.item)"
_SUP = _ONCE + ", ns as (select item1, item2, sample, count(distinct barcode) as nmol from bl group by all having count(distinct barcode) >= 2), sup as (select item1, item2, count(*)::bigint as nsample, sum(nmol)::bigint as nmol from ns group by 1, 2)"
_LNK = _SUP + """, pi as (select p_partkey as k, (p_size % 7)::bigint as chr, p_retailprice as cM, (p_size * 1000)::bigint as length from part),
lnk as (select sup.*, a.chr as chr1, b.chr as chr2, a.cM as cM1, b.cM as cM2, a.length as length1, b.length as length2, a.chr = b.chr as same_chr, -log10((a.length + b.length) / 1e9) as weight from sup join pi a on a.k = item1 join pi b on b.k = item2)"""


def _barcodes(spark, sf):
    return links.barcode_links(_t(spark, sf, "lineitem"), "l_partkey", "l_orderkey", "l_linestatus").withColumnsRenamed({"l_linestatus": "sample", "l_orderkey": "barcode"})


def _support(spark, sf):
    return links.link_support(_barcodes(spark, sf), "barcode", "sample", 2, 1)


def _part_info(spark, sf):
    return _t(spark, sf, "part").select(F.col("p_partkey").alias("key"), (F.col("p_size") % 7).cast("long").alias("chr"), F.col("p_retailprice").alias("cM"), (F.col("p_size") * 1000).cast("long").alias("length"))


def _links(spark, sf):
    return links.annotate_links(_support(spark, sf), _part_info(spark, sf), "key", {"chr": "chr", "cM": "cM", "length": "length"})


@query(f"with {_ONCE} select sample, barcode, item1, item2 from bl")
def barcode_links(spark, sf):
    return _barcodes(spark, sf)


@query(f"with {_SUP} select item1, item2, nsample, nmol from sup")
def link_support(spark, sf):
    return _support(spark, sf)


@query(f"with {_LNK} select item1, item2, nsample, nmol, chr1, chr2, same_chr, round(weight, 6) as weight from lnk")
def link_annotate(spark, sf):
    return _links(spark, sf).select("item1", "item2", "nsample", "nmol", "chr1", "chr2", "same_chr", _r("weight"))


@query(f"with {_LNK} select item1, item2, chr1 from lnk where same_chr and abs(cM1 - cM2) <= 300")
def link_filter(spark, sf):
    return links.filter_links(_links(spark, sf), 300).select("item1", "item2", "chr1")


# ---- joins and sets


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def semi_join(spark, sf):
    o = _t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return _t(spark, sf, "customer").join(o, "c_custkey", "left_semi").select("c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def anti_join(spark, sf):
    o = _t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return _t(spark, sf, "customer").join(o, "c_custkey", "left_anti").select("c_custkey")


@query("""
with a as (select o_custkey as k, count(*)::bigint as n from orders where o_orderstatus = 'F' group by 1), b as (select o_custkey as k, count(*)::bigint as m from orders where o_orderstatus = 'O' group by 1)
select coalesce(a.k, b.k) as k, n, m from a full join b on a.k = b.k""")
def full_join(spark, sf):
    o = _t(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    a = o.where("o_orderstatus = 'F'").groupBy("k").agg(F.count("*").alias("n"))
    return a.join(o.where("o_orderstatus = 'O'").groupBy("k").agg(F.count("*").alias("m")), "k", "full").select("k", "n", "m")


@query("""
with a as (select p_partkey, case when p_size % 4 = 0 then null else p_size % 4 end as g from part), b as (select g, count(*)::bigint as n from a group by g)
select p_partkey, a.g::bigint as g, n from a join b on a.g is not distinct from b.g""")
def null_safe_join(spark, sf):
    s = F.col("p_size") % 4
    a = _t(spark, sf, "part").select("p_partkey", F.when(s != 0, s).cast("long").alias("g"))
    return relational.null_safe_join(a, a.groupBy("g").agg(F.count("*").alias("n")), ["g"])


@query("select a.p_brand, a.p_partkey as a, b.p_partkey as b from part a join part b on a.p_brand = b.p_brand and b.p_size between a.p_size - 1 and a.p_size + 1 where a.p_partkey < b.p_partkey")
def neighbour_bins(spark, sf):
    p = _t(spark, sf, "part")
    a, b = p.select("p_brand", F.col("p_partkey").alias("a"), F.col("p_size").alias("x")), p.select("p_brand", F.col("p_partkey").alias("b"), F.col("p_size").alias("y"))
    return relational.neighbour_join(a, b, ["p_brand"], "x", "y", 1, "a < b").select("p_brand", "a", "b")


@query("""
with f as (select distinct c_custkey as k from customer where c_nationkey < 12), o as (select distinct o_custkey as k from orders)
select 'both' as kind, k from (select k from f intersect select k from o) union all select 'only', k from (select k from f except select k from o) union all select 'any', k from (select k from f union select k from o)""")
def set_ops(spark, sf):
    f = _t(spark, sf, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("k"))
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    tag = lambda name, df: df.select(F.lit(name).alias("kind"), "k")
    return tag("both", f.intersect(o)).unionByName(tag("only", f.subtract(o))).unionByName(tag("any", f.union(o).distinct()))


@query("""
with g as (select o_custkey as g, string_agg(distinct o_orderstatus || o_orderpriority, ',' order by o_orderstatus || o_orderpriority) as m from orders group by 1)
select a.g as g, b.g as same_as from g a join g b on a.m = b.m where a.g < b.g""")
def same_groups(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("g"), F.concat("o_orderstatus", "o_orderpriority").alias("m"))
    return relational.same_groups(o, o, "g", "m").where("g < same_as").select("g", "same_as")


@query("select l_returnflag, count(*) filter (l_linestatus = 'F')::bigint as \"F\", count(*) filter (l_linestatus = 'O')::bigint as \"O\" from lineitem group by 1")
def pivot_counts(spark, sf):
    return relational.pivot_counts(_t(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@query("with u as (select *, count(*) over (partition by l_partkey, l_suppkey) as n from lineitem) select l_suppkey, median(l_quantity) as position, max(median(l_quantity)) over () - median(l_quantity) as flipped from u where n = 1 group by l_suppkey")
def median_marker(spark, sf):
    once = relational.unique_only(_t(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity"), ["l_partkey", "l_suppkey"])
    m = once.groupBy("l_suppkey").agg(F.median("l_quantity").alias("position"))
    return m.withColumn("flipped", m.agg(F.max("position")).scalar() - F.col("position"))


@query("select l_returnflag, l_linestatus, min(l_shipdate) as first, max(l_shipdate) as last, count(*)::bigint as n, count(distinct l_suppkey)::bigint as targets from lineitem group by 1, 2")
def paf_summary(spark, sf):
    return _t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("targets"))


# ---- graph


@query(f"""with recursive {_SUP}, e as (select item1, item2 from sup),
reach as (select item1 as node, item1 as other from e union select item1, item2 from e union select reach.node, e.item2 from reach join e on reach.other = e.item1)
select node, min(other) as component from reach group by node""")
def connected_components_links(spark, sf):
    return connected_components(_support(spark, sf), "item1", "item2")


@query(f"""with recursive {_SUP}, e as (select item1, item2 from sup),
reach as (select item1 as node, item1 as other from e union select item1, item2 from e union select reach.node, e.item2 from reach join e on reach.other = e.item1),
c as (select node, min(other) as component from reach group by node) select component, count(*)::bigint as n from c group by 1""")
def component_sizes(spark, sf):
    return component_stats(connected_components(_support(spark, sf), "item1", "item2"))


@query(f"with {_SUP} select node, count(*)::bigint as degree from (select item1 as node from sup where item1 < item2 union all select item2 from sup where item1 < item2) group by 1")
def degree(spark, sf):
    return degrees(_support(spark, sf).where("item1 < item2"), "item1", "item2")


@query("select key as node, key as super, 1::bigint as bin, 0::bigint as rank, true as backbone, 1::bigint as super_size, 1::bigint as super_nbin from (select p_partkey as key from part)")
def singletons(spark, sf):
    none = spark.createDataFrame([], "super long, node long, bin long, rank long, backbone boolean")
    return layout.add_singletons(none, _part_info(spark, sf)).select("node", "super", "bin", "rank", "backbone", "super_size", "super_nbin")


_MEM = "mem as (select o_orderkey as node, o_custkey as super, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey)::bigint as bin, case when o_orderkey % 5 = 0 then null else (o_orderkey % 7)::bigint end as chr, o_totalprice as cM, (o_orderkey % 1000 + 1)::bigint as length, case when o_orderstatus = 'F' then -1 when o_orderstatus = 'O' then 1 end as orientation, 0 as rank from orders)"


def _members(spark, sf):
    from pyspark.sql.window import Window

    k = F.col("o_orderkey")
    bin = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).cast("long")
    return _t(spark, sf, "orders").select(k.alias("node"), F.col("o_custkey").alias("super"), bin.alias("bin"), F.when(k % 5 != 0, k % 7).alias("chr"), F.col("o_totalprice").alias("cM"), (k % 1000 + 1).alias("length"), F.when(F.col("o_orderstatus") == "F", -1).when(F.col("o_orderstatus") == "O", 1).alias("orientation"), F.lit(0).alias("rank"))


@query(f"with {_MEM} select super, count(*)::bigint as n, max(bin) as nbin, max(rank)::bigint as max_rank, sum(length)::bigint as length from mem group by 1")
def super_statistics(spark, sf):
    return layout.super_stats(_members(spark, sf)).select("super", "n", "nbin", _n("max_rank"), "length")


@query(f"with {_MEM} select node, super, bin, (1 + coalesce(sum(length) over (partition by super order by bin, node rows between unbounded preceding and 1 preceding), 0))::bigint as super_pos from mem")
def super_positions(spark, sf):
    return layout.super_positions(_members(spark, sf)).select("node", "super", "bin", "super_pos")


@query(f"""with {_MEM}, c as (select super, chr, count(*) as nchr, avg(cM) as cm, min(cM) as a, max(cM) as b from mem where chr is not null group by 1, 2),
i as (select *, nchr / sum(nchr) over (partition by super) as pchr, row_number() over (partition by super order by nchr desc, chr) as i from c)
select super, chr, nchr::bigint as nchr, round(pchr, 6) as pchr, round(cm, 6) as "cM", a as "min_cM", b as "max_cM" from i where i = 1""")
def majority_chr(spark, sf):
    return layout.majority_chr(_members(spark, sf)).select("super", "chr", "nchr", _r("pchr"), _r("cM"), "min_cM", "max_cM")


@query(f"""with {_MEM}, p as (select *, row_number() over (partition by super order by bin) as i, count(*) over (partition by super) as n, (1 + coalesce(sum(length + 100) over (partition by super order by bin rows between unbounded preceding and 1 preceding), 0))::bigint as s from mem)
select super, s as "start", s + length - 1 as "end", (2 * i - 1)::bigint as part, 'W' as type, node::varchar as component, length as component_length, case when orientation = -1 then '-' else '+' end as orientation from p
union all select super, s + length, s + length + 99, (2 * i)::bigint, 'U', 'gap', 100, null from p where i < n""")
def agp_with_gaps(spark, sf):
    return layout.agp(_members(spark, sf), "super", ["bin"], "node", "length", "orientation", 100)


@query(f"with {_MEM}, c as (select chr, sum(length)::bigint as length from mem where chr is not null group by 1) select chr, length, (coalesce(sum(length) over (order by chr rows between unbounded preceding and 1 preceding), 0))::bigint as \"offset\" from c")
def chr_offsets(spark, sf):
    table = _members(spark, sf).where("chr is not null").select(F.concat(F.lit("chr"), F.col("chr").cast("string")).alias("agp_chr"), F.col("length").alias("component_length"))
    names = spark.range(7).select(F.col("id").alias("chr"), F.col("id").cast("string").alias("alphachr"))
    return layout.chromosome_lengths(table, names).select("chr", "length", "offset")


@query(f"with {_MEM}, r as (select super, length, sum(length) over (partition by super order by length) as run, sum(length) over (partition by super) as whole from mem) select super, min(length) as n50 from r where run >= 0.5 * whole group by 1")
def n50(spark, sf):
    return aggregates.n50(_members(spark, sf), "length", 0.5, ("super",))


@query(f"""with {_MEM}, a as (select m.node, m.bin as b1, o.bin as b2, m.node % 997 as pos, m.length from mem m join mem o on o.super = m.super and o.bin <> m.bin and abs(o.bin - m.bin) <= 2),
s as (select node, length, avg(pos + b2) filter (b2 > b1) as nxt, avg(pos - b2) filter (b2 < b1) as prv from a group by 1, 2)
select node, round(prv, 6) as prv, round(nxt, 6) as nxt, case when prv is null then case when length - nxt <= nxt then 1 else -1 end when nxt is null then case when length - prv <= prv then -1 else 1 end when prv <= nxt then 1 else -1 end as orientation from s""")
def orient(spark, sf):
    m = _members(spark, sf)
    m = m.withColumn("super_nbin", F.lit(2))
    one = m.select(F.col("node").alias("item1"), "super", F.col("bin").alias("b1"))
    two = m.select(F.col("node").alias("item2"), "super", F.col("bin").alias("b2"))
    at = F.col("item1") % 997 + F.when(F.col("b2") > F.col("b1"), F.col("b2")).otherwise(-F.col("b2"))
    pos = one.join(two, "super").where("b1 <> b2 and abs(b1 - b2) <= 3").select("item1", at.alias("pos1"), "item2")
    return layout.orient(m, pos, m.select(F.col("node").alias("key"), "length"), 2).select("node", _r("prv"), _r("nxt"), "orientation")


_RES = """mm as (select p_partkey as node, (p_partkey // 4)::bigint as super, p_partkey % 4 + 1 as bin, 4 as nbin, (p_size % 3)::bigint as chr from part),
pr as (select distinct l_orderkey + 1000000000 as link, l_orderkey % 1000 + 1 as len, l_partkey as item from lineitem),
pl as (select link, len, item, super, chr from pr join mm on node = item where bin in (1, 4)),
bo as (select a.link, a.len, a.item as i1, b.item as i2, a.super as s1, b.super as s2 from pl a join pl b on a.link = b.link and a.super < b.super and a.chr = b.chr),
un as (select *, count(*) over (partition by link) as k from bo), be as (select *, row_number() over (partition by s1, s2 order by len desc, link) as i from un where k = 1)"""


@query(f"with {_RES} select link, i1 as item1, i2 as item2, s1 as super1, s2 as super2 from be where i = 1")
def rescue_links(spark, sf):
    """Orders as items of no chromosome, the parts in them as members of supers of four."""
    k = F.col("p_partkey")
    members = _t(spark, sf, "part").select(k.alias("node"), F.floor(k / 4).cast("long").alias("super"), (k % 4 + 1).alias("bin"), F.lit(4).cast("long").alias("super_nbin"), (F.col("p_size") % 3).cast("long").alias("chr"))
    o = F.col("l_orderkey")
    pairs = _t(spark, sf, "lineitem").select((o + 1_000_000_000).alias("item1"), F.col("l_partkey").alias("item2"), F.lit(None).cast("long").alias("chr1"), (o % 1000 + 1).alias("length1")).distinct()
    return layout.rescue_links(pairs, members)


# ---- pruning, step by step: orders with made-up branches off their customer's path

_OFF = _MEM.removesuffix(", 0 as rank from orders)") + """, case when o_orderkey % 11 = 0 then 2 when o_orderkey % 5 = 0 then 1 else 0 end::bigint as rank from orders),
off as (select *, max(bin) over (partition by super) as nbin, (node % 3)::bigint as degree from mem)"""


def _branched(spark, sf):
    from pyspark.sql.window import Window

    k = F.col("node")
    m = _members(spark, sf).withColumn("rank", F.when(k % 11 == 0, 2).when(k % 5 == 0, 1).otherwise(0).cast("long"))
    return m.withColumn("super_nbin", F.max("bin").over(Window.partitionBy("super"))), m.select("node", (k % 3).alias("degree"))


@query(f"with {_OFF}, tw as (select node, super, bin // 2 as bin, rank from off) select node from tw where rank = 0 and exists (select 1 from tw b where b.super = tw.super and b.bin = tw.bin and b.rank > 1)")
def branch_nodes(spark, sf):
    m = _branched(spark, sf)[0]
    two = m.withColumn("bin", F.floor(F.col("bin") / 2).cast("long"))  # two nodes a bin
    return layout.branch_nodes(two)


@query(f"with {_SUP} select item1 as node, count(*)::bigint as degree from sup where item2 not in (select p_partkey from part where p_size % 5 = 0) group by 1")
def link_degree(spark, sf):
    excluded = _t(spark, sf, "part").where("p_size % 5 = 0").select(F.col("p_partkey").alias("node"))
    return layout.link_degree(_support(spark, sf), excluded)


@query(f"with {_OFF} select node from off where length <= 400 and degree = 1 and exists (select 1 from off b where b.super = off.super and b.rank = 1 and abs(b.bin - off.bin) <= 1)")
def short_tips(spark, sf):
    return layout.short_tips(*_branched(spark, sf), 400)


@query(f"with {_OFF} select node from off where rank = 1 and length <= 400")
def bulges(spark, sf):
    return layout.bulges(_branched(spark, sf)[0], 400)


@query(f"""with {_OFF}, tw as (select node, super, (bin + 1) // 2 as bin, rank, length from off), w as (select *, max(bin) over (partition by super) as nbin from tw),
s as (select super, node, length, unnest([2, nbin - 1]) as near, unnest([1, nbin]) as at, bin from w where rank > 0)
select distinct case when s.length >= e.length then e.node else s.node end as node from s join w e on e.super = s.super and e.bin = s.at and e.rank = 0 where s.bin = s.near""")
def end_forks(spark, sf):
    from pyspark.sql.window import Window

    two = _branched(spark, sf)[0].withColumn("bin", F.floor((F.col("bin") + 1) / 2).cast("long"))
    return layout.end_forks(two.withColumn("super_nbin", F.max("bin").over(Window.partitionBy("super"))))


@query(f"with {_OFF} select node from off where rank = 1 and degree = 1")
def single_tips(spark, sf):
    return layout.single_tips(*_branched(spark, sf))


# ---- paths of graphs with one solution: a customer's orders by date, with a leaf off inner orders

_LINE = """ord as (select o_orderkey as node, o_custkey as super, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey)::bigint as bin, count(*) over (partition by o_custkey) as n, min(o_orderkey) over (partition by o_custkey) as least from orders),
lf as (select node + 1000000000 as node, super, bin, least from ord where bin >= 3 and bin <= n - 2 and node % 2 = 0)"""
_LINE_PATH = """(select super, node, case when n = 2 then case when node = least then 1 else 2 end else bin end as bin, 0::bigint as rank, true as backbone, least, n from ord where n > 1
  union all select super, node, bin, 1, false, least, 0 from lf)"""


def _line(spark, sf):
    """(edges, leaves): orders next to one another, and a leaf to every other inner order."""
    from pyspark.sql.window import Window

    by = Window.partitionBy("super").orderBy("o_orderdate", "node")
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("node"), F.col("o_custkey").alias("super"), "o_orderdate")
    o = o.select("node", "super", F.row_number().over(by).alias("bin"), F.lead("node").over(by).alias("next"), F.count("*").over(Window.partitionBy("super")).alias("n"))
    at = F.col("bin").cast("double")
    step = F.struct(F.col("node").alias("src"), F.col("next").alias("dst"), F.lit(1.0).alias("weight"), at.alias("pos_src"), (at + 1).alias("pos_dst"))
    leaf = F.struct(F.col("node").alias("src"), (F.col("node") + 1_000_000_000).alias("dst"), F.lit(5.0).alias("weight"), at.alias("pos_src"), F.lit(None).cast("double").alias("pos_dst"))
    return o.select("super", F.inline(F.array_compact(F.array(F.when(F.col("next").isNotNull(), step), F.when(F.expr("bin >= 3 and bin <= n - 2 and node % 2 = 0"), leaf)))))


@query(f"with {_LINE} select super, node, bin, rank, backbone from {_LINE_PATH}")
def path_of_lines(spark, sf):
    return path.order_components(_line(spark, sf))


@query(f"""with {_LINE}, l as (select * from {_LINE_PATH})
select node, case when rank = 1 then node else least end as super, case when rank = 1 then 1 else bin end as bin, 0::bigint as rank, true as backbone, case when rank = 1 then 1 else n end::bigint as super_size, rank = 1 as left_out from l""")
def prune_lines(spark, sf):
    edges = materialize(_line(spark, sf))
    ends = edges.select(F.inline(F.array(*(F.struct(F.col(e).alias("key"), F.col(f"pos_{e}").alias("cM")) for e in ("src", "dst")))))
    info = ends.groupBy("key").agg(F.max("cM").alias("cM")).select("key", F.lit(1).cast("long").alias("chr"), "cM", (F.col("key") % 20_000).alias("length"))
    both = edges.select(F.inline(F.array(*(F.struct(F.col(a).alias("item1"), F.col(b).alias("item2"), "weight") for a, b in (("src", "dst"), ("dst", "src"))))))
    return layout.prune_members(both, info).select("node", "super", "bin", "rank", "backbone", "super_size", "left_out")


# ---- contact matrices: pairs of lines of one order, by return flag and part

_CON = "con as (select a.l_returnflag as chr1, a.l_partkey as start1, b.l_returnflag as chr2, b.l_partkey as start2 from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_linenumber < b.l_linenumber)"
_MAT = _CON + ", mat as (select chr1, floor(start1 / {w})::bigint * {w} as bin1, chr2, floor(start2 / {w})::bigint * {w} as bin2, count(*)::bigint as nlinks from con group by 1, 2, 3, 4)"


def _contacts(spark, sf):
    one = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    a = one.withColumnsRenamed({"l_linenumber": "n1", "l_returnflag": "chr1", "l_partkey": "start1"})
    b = one.withColumnsRenamed({"l_linenumber": "n2", "l_returnflag": "chr2", "l_partkey": "start2"})
    return a.join(b, "l_orderkey").where("n1 < n2").select("chr1", "start1", "chr2", "start2")


@query(f"with {_MAT.format(w=200)} select chr1, bin1, chr2, bin2, nlinks from mat")
def contact_matrix(spark, sf):
    return hic.contact_matrix(_contacts(spark, sf), 200)


@query(f"""with {_MAT.format(w=100)}, s as (select chr1, chr2, nlinks, bin1 - 100 * i as b1, bin2 - 100 * j as b2 from mat, (values (0), (1), (2)) a(i), (values (0), (1), (2)) b(j) where chr1 = chr2)
select chr1, b1::bigint as bin1, chr2, b2::bigint as bin2, n as nlinks, t as total, abs(b1 - b2)::bigint as dist from (select chr1, chr2, b1, b2, count(*)::bigint as n, sum(nlinks)::bigint as t from s where b1 >= 0 and b2 >= 0 group by chr1, chr2, b1, b2)""")
def sliding_bin_join(spark, sf):
    return hic.sliding_contacts(_contacts(spark, sf), 300, 100)


@query("""
with f as (select p_brand as chr, (floor(p_partkey / 250) * 250)::bigint as bin, p_size as l, p_size % 7 as c, p_size % 5 as g, p_size % 11 as t, p_retailprice / 1000 as cov from part)
select chr, bin, count(*)::bigint as nfrags, sum(l)::bigint as eff_length, round(sum(cov * l) / sum(l), 6) as cov, round((sum(c) + sum(g)) / (sum(l) + sum(c) + sum(g) + sum(t)), 6) as gc from f group by 1, 2""")
def bin_fragment_stats(spark, sf):
    return hic.bin_composition(_fragments(spark, sf, None), 250).select("chr", "bin", "nfrags", "eff_length", _r("cov"), _r("gc"))


def _fragments(spark, sf, chr="x"):
    s = F.col("p_size")
    return _t(spark, sf, "part").select((F.col("p_brand") if chr is None else F.lit(chr)).alias("chr"), F.col("p_partkey").alias("start"), s.alias("length"), s.alias("nA"), (s % 7).alias("nC"), (s % 5).alias("nG"), (s % 11).alias("nT"), (F.col("p_retailprice") / 1000).alias("cov"))


_BIAS = _MAT.format(w=100) + """, lk as (select chr1, bin1, bin2, nlinks::double as v, abs(bin1 - bin2) as dist, log(nlinks::double * 100 / sum(nlinks::double) over () * 1e6) / log(exp(1)) as l from mat where chr1 = chr2),
ln as (select chr1, max(bin1) + 100 as length from mat group by 1),
bias as (select chr1 as chr, bin1 as bin, sum(sign(bin1 - bin2) * ln(100 * v / s.t * 1e6)) as r from lk join ln using (chr1), (select sum(v) as t from lk) s
  where dist <= bin1 and dist <= bin2 and length - bin1 >= dist and length - bin2 >= dist and ln(100 * v / s.t * 1e6) >= 0 group by 1, 2)"""


def _bias(spark, sf):
    m = hic.contact_matrix(_contacts(spark, sf), 100)
    lengths = m.groupBy(F.col("chr1").alias("chr")).agg((F.max("bin1") + 100).alias("length"))
    cis = m.where("chr1 = chr2").select("chr1", "bin1", "bin2", F.col("nlinks").cast("double").alias("nlinks_norm"), F.abs(F.col("bin1") - F.col("bin2")).alias("dist"))
    return hic.directional_bias(cis, lengths)


@query(f"with {_BIAS} select chr, bin, round(r, 6) as r from bias")
def directional_bias(spark, sf):
    return _bias(spark, sf).select("chr", "bin", F.round("r", 6).alias("r"))


@query("""
with o as (select c_nationkey, c_custkey, c_acctbal, row_number() over (partition by c_nationkey order by c_custkey)::double / 15::double as i from customer)
select c_nationkey, c_custkey, case when count(*) over w = 15 then round(corr(c_acctbal, i) over w, 6) end as cc, case when count(*) over w = 15 then round(regr_slope(c_acctbal, i) over w / 7, 3) end as slope from o
window w as (partition by c_nationkey order by c_custkey rows between current row and 14 following)""")
def rolling_corr_slope(spark, sf):
    rows = _t(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return aggregates.rolling_fit(rows, ["c_nationkey"], "c_custkey", "c_acctbal", 15).select("c_nationkey", "c_custkey", _r("cc"), F.round(F.col("slope") / 7, 3).alias("slope"))


@query("""
with r as (select c_nationkey, rank() over (partition by c_nationkey order by c_acctbal) + (count(*) over (partition by c_nationkey, c_acctbal) - 1) / 2.0 as a, rank() over (partition by c_nationkey order by c_custkey) as b from customer)
select c_nationkey as key, round(corr(a, b), 6) as hic_cor, case when corr(a, b) > 0 then 1 else -1 end as orientation from r group by 1""")
def spearman(spark, sf):
    rows = _t(spark, sf, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_acctbal").alias("hic_bin"), F.col("c_custkey").alias("pos"))
    return hic.bin_order_sign(rows).select("key", _r("hic_cor"), "orientation")


@query(f"""with {_PAIRS}, n as (select k1 as key1, k2 as key2, count(*)::bigint as nlinks from prs where k1 <> k2 group by 1, 2), pi as (select p_partkey as k, p_size % 7 as chr, case when p_size % 9 = 0 then null else p_retailprice end as cm from part)
select key1, key2, nlinks, round(-log10(nlinks), 6) + 0 as weight from n join pi a on a.k = key1 join pi b on b.k = key2 where a.chr = b.chr and (a.cm is null or b.cm is null or abs(a.cm - b.cm) <= 20)""")
def hic_links(spark, sf):
    info = _t(spark, sf, "part").select(F.col("p_partkey").alias("key"), (F.col("p_size") % 7).alias("chr"), F.when(F.col("p_size") % 9 != 0, F.col("p_retailprice")).alias("cM"))
    pairs = _pairs(spark, sf).withColumnsRenamed({"k1": "key1", "k2": "key2"})
    return hic.interscaffold_links(pairs, info).select("key1", "key2", "nlinks", (F.round("weight", 6) + 0).alias("weight"))


@query(f"""with {_MEM}, rg as (select * from (values (1, 1, 3), (2, 2, 4), (5, 1, 2)) v(super, a, b)), x as (select node, mem.super, bin, orientation, a, b from mem left join rg on rg.super = mem.super and bin between a and b)
select node, super, case when a is null then bin else a + b - bin end::bigint as hic_bin, case when a is null then orientation else coalesce(-orientation, -1) end as orientation from x""")
def reverse_ranges(spark, sf):
    m = _members(spark, sf).select("node", F.col("super").alias("chr"), F.col("bin").alias("hic_bin"), "orientation")
    ranges = spark.createDataFrame([(1, 1, 3), (2, 2, 4), (5, 1, 2)], "chr long, start long, end long")
    return hic.reverse_ranges(m, ranges).select("node", F.col("chr").alias("super"), "hic_bin", "orientation")


# ---- operators without SQL: heuristics, fixpoints, regression


@query()
def path_order(spark, sf):
    e = links.annotate_links(_support(spark, sf).where("item1 < item2"), _part_info(spark, sf), "key", {"chr": "chr", "cM": "cM", "length": "length"})
    parts = connected_components(e, "item1", "item2").withColumnsRenamed({"node": "item1", "component": "super"})
    edges = e.join(parts, "item1").select("super", F.col("item1").alias("src"), F.col("item2").alias("dst"), "weight", F.col("cM1").cast("double").alias("pos_src"), F.col("cM2").cast("double").alias("pos_dst"))
    return path.order_components(edges)


@query()
def prune_loop(spark, sf):
    found = _links(spark, sf)
    return layout.prune(found, _part_info(spark, sf))[0].select("node", "super", "bin", "rank", "super_size")


@query()
def poisson_normalise(spark, sf):
    contacts = _contacts(spark, sf).withColumns({"chr1": F.lit("x"), "chr2": F.lit("x")})
    return hic.normalise(hic.contact_matrix(contacts, 250), hic.bin_composition(_fragments(spark, sf), 250))


@query(f"""with {_MAT.format(w=250)}, m as (select * from mat where chr1 = chr2), b as (select chr1, bin1 as bin from m union select chr1, bin2 from m),
n as (select chr1, count(*) as n from b group by 1), c as (select m.chr1, round(ln(sum(nlinks) filter (bin1 < bin2) / (any_value(n) * (any_value(n) - 1) / 2)), 4) as c from m join n using (chr1) group by 1)
select m.chr1, bin1, chr2, bin2, round(nlinks / exp(c), 4) as nlinks_norm, abs(bin1 - bin2) as dist from m join c using (chr1)""")
def poisson_even(spark, sf):
    """Bins alike in length, GC and mappability: the regression has only its mean left, so what is expected has a closed form."""
    matrix = hic.contact_matrix(_contacts(spark, sf), 250)
    bins = matrix.select(F.col("chr1").alias("chr"), F.col("bin1").alias("bin")).union(matrix.select("chr2", "bin2")).distinct()
    return hic.normalise(matrix, bins.withColumns({"eff_length": F.lit(250), "gc": F.lit(0.5), "cov": F.lit(1.0)}))


@query()
def break_loop(spark, sf):
    iv, lengths = _intervals(spark, sf)
    info = lengths.select(F.col("key").cast("string").alias("key"), F.col("key").alias("orig"), F.lit(1).cast("long").alias("orig_start"), F.col("length").alias("orig_end"), "length")
    molecules = iv.select(F.col("key").alias("orig"), (F.col("s") + 1).alias("orig_start"), (F.col("e") + 1).alias("orig_end"), F.col("key").cast("string").alias("key"), (F.col("s") + 1).alias("start"), (F.col("e") + 1).alias("end"))
    measure = lambda m, i: coverage.coverage_ratio(coverage.interval_coverage(m, "key", "start", "end", 3600), i, "key", 3600)
    find = lambda r: coverage.find_breaks(r, "key", 864_000, 20, 40_000, -2.0)
    return split.break_loop(info, molecules, measure, find, 7200)[0]


@query("""
with recursive r(k, s, e) as (select p_partkey, 1::bigint, (p_size * 200 + 1000)::bigint from part
  union all select k, s + unnest([1, x - 199, x + 201]) - 1, s + unnest([x - 200, x + 200, l]) - 1 from (select k, s, e - s + 1 as l, (e - s + 1) // 2 as x from r where e - s + 1 > 4000)),
p as (select * from r where e - s + 1 <= 4000), m as (select l_partkey as k, l_orderkey % 4000 + 1 as s, l_orderkey % 4000 + 1 + l_suppkey * 5 as e from lineitem)
select p.k || ':' || p.s || '-' || p.e as key, p.k as orig, p.s as orig_start, p.e as orig_end, p.e - p.s + 1 as length, count(m.k)::bigint as n_molecules
from p left join m on m.k = p.k and m.s >= p.s and m.e <= p.e group by p.k, p.s, p.e""")
def break_loop_halves(spark, sf):
    """The loop with a rule that needs several cycles: what is over 4,000 long breaks in its middle; and the molecules that no cut crosses."""
    seq = _t(spark, sf, "part").select(F.col("p_partkey").alias("orig"), (F.col("p_size") * 200 + 1000).cast("long").alias("length"))
    info = seq.select(F.col("orig").cast("string").alias("key"), "orig", F.lit(1).cast("long").alias("orig_start"), F.col("length").alias("orig_end"), "length")
    s = F.col("l_orderkey") % 4000 + 1
    molecules = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("orig"), s.alias("orig_start"), (s + F.col("l_suppkey") * 5).alias("orig_end"))
    find = lambda i: i.where("length > 4000").select("key", F.floor(F.col("length") / 2).alias("breakpoint"))
    pieces, lifted, _ = split.break_loop(info, molecules, lambda m, i: i, find, 200)
    held = lifted.groupBy("key").agg(F.count("*").alias("n_molecules"))
    return pieces.join(held, "key", "left").select("key", "orig", "orig_start", "orig_end", "length", F.coalesce("n_molecules", F.lit(0)).alias("n_molecules"))


# ---- streams: the same functions take a stream of events


@query("select event_type, (floor(epoch(ts) / 3600) * 3600)::bigint as start, count(*)::bigint as n, round(avg(value), 6) as mean from events group by 1, 2")
def windowed_counts(spark, sf):
    from ..streaming.windows import windowed_counts as counts

    return counts(_t(spark, sf, "events"), "event_type", "ts", "value", "1 hour").select("event_type", "start", "n", _r("mean"))
