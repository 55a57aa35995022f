"""The assembly pipeline: anchor, measure coverage, break, link, order, orient, lay out."""

from __future__ import annotations

import itertools
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import n50
from ..operators import assign, coverage, hic, layout, lift, links, split
from ..session import materialize
from ..sources.formats import run_name


@dataclass(frozen=True)
class Assembly:
    """Tables by role; each function returns a new one.

    info: key, orig, orig_start, orig_end, length.  markers: orig, orig_pos, key, pos,
    marker, sorted_chr, arm, popseq_chr, cM.  pairs: orig1, orig_pos1, orig2,
    orig_pos2, key1, pos1, key2, pos2.  molecules: orig, orig_start, orig_end,
    key, start, end, barcode, sample, npairs.
    """

    info: DataFrame
    markers: DataFrame
    pairs: DataFrame
    molecules: DataFrame
    anchored: DataFrame | None = None
    molecule_cov: DataFrame | None = None
    hic_cov: DataFrame | None = None


def anchor(a: Assembly, without_arms: tuple = (), percentiles: tuple[float, float, float] = (0.95, 0.90, 0.98)) -> Assembly:
    """Chromosome of each sequence by sorted markers, map and Hi-C neighbours; conflicts and outliers flagged."""
    def prefixed(df: DataFrame, p: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{p}_{c}" for c in df.columns if c != "key"})

    sorted_ = prefixed(assign.assign_arm(a.markers, assign.assign_top2(a.markers, "key", "sorted_chr"), "key", "sorted_chr", "arm", without_arms), "sorted")
    popseq = prefixed(assign.assign_position(a.markers, "key", "popseq_chr", "cM"), "popseq")
    info = materialize(a.info.join(sorted_, "key", "left").join(popseq, "key", "left"))
    labels = info.where("popseq_first = sorted_first").select("key", F.col("popseq_first").alias("label"))
    hic_ = prefixed(assign.pair_label_tally(a.pairs, labels, "key1", "key2"), "hic")
    info = info.join(hic_, "key", "left")
    conflicts = assign.assignment_conflicts(info, "key", ["popseq_first", "hic_first", "sorted_first"])
    info = materialize(info.join(conflicts, "key", "left").fillna(0, ["n_assigned", "n_distinct"]))
    for p, q in zip(("sorted", "popseq", "hic"), percentiles):
        info = assign.flag_outliers(info, f"{p}_ratio", f"{p}_total", f"{p}_n2", q, require_total=p == "hic", name=f"bad_{p}")
    bad = sum((F.col(f"bad_{p}").cast("int") for p in ("popseq", "hic")), F.col("bad_sorted").cast("int"))
    return replace(a, anchored=materialize(info.withColumn("n_bad", bad)))


def add_molecule_coverage(a: Assembly, width: int = 200) -> Assembly:
    cov = coverage.interval_coverage(a.molecules, "key", "start", "end", width)
    return replace(a, molecule_cov=coverage.coverage_ratio(cov, a.info, "key", width))


def add_hic_coverage(a: Assembly, width: int = 1000, width2: int = 100_000) -> Assembly:
    if width2 <= 3 * width:
        raise ValueError("width2 must be over three times width")
    inside = a.pairs.where("key1 = key2 and pos1 < pos2").select(F.col("key1").alias("key"), F.col("pos1").alias("start"), F.col("pos2").alias("end"))
    return replace(a, hic_cov=coverage.coverage_ratio(coverage.interval_coverage(inside, "key", "start", "end", width), a.info, "key", width))


def hic_coverage_of_map(contacts: DataFrame, lengths: DataFrame, width: int = 1000, max_dist: int = 1_000_000) -> DataFrame:
    """Coverage ratio along chromosomes of contacts (chr1, start1, chr2, start2) that span at most max_dist."""
    inside = contacts.where("chr1 = chr2 and start1 < start2").select(F.col("chr1").alias("key"), F.col("start1").alias("start"), F.col("start2").alias("end"))
    cov = coverage.interval_coverage(inside, "key", "start", "end", width, max_span=max_dist)
    return coverage.coverage_ratio(cov, lengths, "key", width)


def break_chimeras(a: Assembly, width: int = 200, slop: int = 200, interval: int = 50_000, min_nbin: int = 20, dist: int = 2_000, ratio: float = -3.0, max_cycles: int = 20, hic_width: int = 1000, hic_width2: int = 100_000, anchoring: dict | None = None) -> Assembly:
    """Break sequences where molecule coverage falls, until it does nowhere; then lift all tables to the pieces.

    What the assembly had of molecule coverage, Hi-C coverage and anchors is measured anew on
    the pieces; anchoring: what to call anchor() with.
    """
    dist = max(dist, 2 * slop + 1)
    measure = lambda m, i: coverage.coverage_ratio(coverage.interval_coverage(m, "key", "start", "end", width), i, "key", width)
    find = lambda c: coverage.find_breaks(c, "key", interval, min_nbin, dist, ratio)
    info, _, cycles = split.break_loop(a.info, a.molecules, measure, find, slop, max_cycles)
    if not cycles:
        return a
    drop = lambda df, *c: df.drop(*c)
    out = Assembly(
        info,
        lift.lift_positions(drop(a.markers, "key", "pos"), info),
        lift.lift_pairs(drop(a.pairs, "key1", "key2", "pos1", "pos2"), info),
        lift.lift_intervals(drop(a.molecules, "key", "start", "end"), info),
    )
    if a.anchored is not None:
        out = anchor(out, **(anchoring or {}))
    if a.molecule_cov is not None:
        out = add_molecule_coverage(out, width)
    return out if a.hic_cov is None else add_hic_coverage(out, hic_width, hic_width2)


@dataclass(frozen=True)
class Scaffolds:
    members: DataFrame
    supers: DataFrame
    excluded: DataFrame
    table: DataFrame


def scaffold(info: DataFrame, molecules: DataFrame, min_npairs: int = 2, max_dist: int = 90_000, min_nmol: int = 3, min_nsample: int = 1, max_cm: float = 5.0, max_bins: int = 5, unanchored: bool = False, gap_size: int = 100) -> Scaffolds:
    """Super-scaffolds from shared barcodes: links, paths, orientation, anchors, assembly table.

    info: key (long), length, chr, cM.  molecules: key, start, end, npairs, barcode,
    sample.  With a Hi-C map's chromosome and bin as chr and cM this is
    the second round of scaffolding.
    """
    found, supported = (materialize(x) for x in links.find_links(molecules, info, min_npairs, max_dist, min_nmol, min_nsample, max_cm))
    members, excluded = layout.prune(found, info)
    if unanchored and max_cm > 0:
        rescue = layout.rescue_links(supported, members)
        ends = rescue.select("link", F.explode(F.array("item1", "item2")).alias("other"))
        more = ends.select(F.col("link").alias("item1"), F.col("other").alias("item2")).unionByName(ends.select(F.col("other").alias("item1"), F.col("link").alias("item2")))
        members, excluded = layout.prune(materialize(found.unionByName(supported.join(more, ["item1", "item2"], "left_semi"))), info)
    places = links.link_positions(molecules.where(F.col("npairs") >= min_npairs))
    turned = layout.orient(members, places, info, max_bins).select("node", "orientation")
    whole = members.join(turned, "node", "left").withColumn("oriented", F.col("orientation").isNotNull())
    whole = materialize(layout.super_positions(whole.withColumn("orientation", F.coalesce("orientation", F.lit(1)))))
    supers = layout.super_stats(whole).join(layout.majority_chr(whole), "super", "left")
    table = layout.agp(whole, "super", ["bin", F.desc("length"), "node"], "node", "length", "orientation", gap_size)
    return Scaffolds(whole, supers, excluded, table)


def grid(info: DataFrame, molecules: DataFrame, axes: dict[str, list], low: float = 6, high: float = 10) -> list[dict]:
    """scaffold() for each combination of parameters worth trying; parameters, run name and N50, best first."""
    rows = []
    for values in itertools.product(*axes.values()):
        p = dict(zip(axes, values))
        if low <= p.get("min_npairs", 1) * p.get("min_nmol", 1) * p.get("min_nsample", 1) <= high:
            got = scaffold(info, molecules, **p)
            rows.append(p | {"run": run_name(p), "n50": n50(got.supers, "length").first()["n50"]})
    return sorted(rows, key=lambda r: (-r["n50"], r["run"]))


def hic_map(info: DataFrame, pairs: DataFrame, names: DataFrame, max_cm: float = 20.0, min_fragments: int = 50, min_bin: int = 100_000, bins_each: int = 5, gap_size: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chromosome maps from contacts: (oriented items, assembly table, chromosome lengths).

    info: key (long), chr, cM, length, nfrag.  pairs: key1, pos1, key2, pos2.  Items
    are ordered within a chromosome; each is cut into bins, which are ordered as well,
    and the rank correlation of that order with their places orients the item.
    """
    used = info.where(F.col("nfrag") >= min_fragments)
    found = hic.interscaffold_links(pairs, used, max_cm).withColumnsRenamed({"key1": "item1", "key2": "item2"})
    members = layout.make_supers(found, used, known_ends=True)
    placed = members.where("super_nbin > 1 and rank = 0").select(F.col("node").alias("key"), F.col("bin").alias("hic_bin"))
    sized = info.select("key", F.greatest(F.floor(F.col("length") / bins_each), F.lit(min_bin)).cast("long").alias("w"))
    on = pairs
    for k in ("1", "2"):
        on = on.join(sized.select(F.col("key").alias(f"key{k}"), F.col("w").alias(f"w{k}")), f"key{k}").join(placed.select(F.col("key").alias(f"key{k}"), F.col("hic_bin").alias(f"b{k}")), f"key{k}")
        on = on.withColumn(f"at{k}", (F.floor(F.col(f"pos{k}") / F.col(f"w{k}")) * F.col(f"w{k}")).cast("long"))
    near = on.where("not (key1 = key2 and at1 = at2) and abs(b1 - b2) <= 2")
    ids = materialize(near.select(F.explode(F.array(F.struct(F.col("key1").alias("key"), F.col("at1").alias("pos"), F.col("b1").alias("b")), F.struct(F.col("key2").alias("key"), F.col("at2").alias("pos"), F.col("b2").alias("b")))).alias("x")).select("x.*").distinct().withColumn("id", F.xxhash64("key", "pos")))
    edges = near.select(F.xxhash64("key1", "at1").alias("a"), F.xxhash64("key2", "at2").alias("b")).select(F.least("a", "b").alias("item1"), F.greatest("a", "b").alias("item2")).groupBy("item1", "item2").agg((-F.log10(F.count("*"))).alias("weight"))
    cells = layout.make_supers(edges, ids.select(F.col("id").alias("key"), F.lit(0).cast("long").alias("chr"), F.col("b").cast("double").alias("cM"), F.lit(1).cast("long").alias("length")), known_ends=True)
    on_path = cells.where("super_nbin > 1 and rank = 0").select(F.col("node").alias("id"), F.col("bin").alias("hic_bin")).join(ids.select("id", "key", "pos"), "id")
    means = on_path.groupBy("key").agg(F.avg("hic_bin").alias("gbin")).join(placed, "key").join(info.select("key", "chr"), "key")
    signs = hic.bin_order_sign(on_path).join(hic.neighbour_sign(means), "key", "left")
    signs = signs.withColumn("orientation", (F.col("orientation") * F.coalesce("cc", F.lit(1))).cast("int"))
    oriented = materialize(info.join(placed, "key", "left").join(signs.select("key", "hic_cor", "orientation"), "key", "left"))
    table = materialize(layout.chromosome_agp(oriented, names, gap_size))
    return oriented, table, layout.chromosome_lengths(table, names)
