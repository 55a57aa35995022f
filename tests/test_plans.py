"""The assembly pipeline on a made-up genome: two chromosomes cut into scaffolds, one chimeric scaffold."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.plans import assembly as plan
from sparkloom.session import materialize
from sparkloom.sources.formats import chromosome_names


@pytest.fixture(scope="module")
def genome(spark):
    rng = random.Random(3)
    # scaffolds 1-5 on chromosome 1, 6-10 on chromosome 2, in order, 100 kb each
    length = 100_000
    info = [(k, k, 1, length, length) for k in range(1, 11)]
    molecules, markers, pairs = [], [], []
    for chrom, first in ((1, 1), (2, 6)):
        for b in range(600):
            at, size = rng.randrange(5 * length), rng.randrange(20_000, 60_000)
            for k in range(5):
                s, e = max(at, k * length), min(at + size, (k + 1) * length)
                if e - s > 500:
                    molecules.append((first + k, s - k * length + 1, e - k * length, f"{chrom}-{b}", 1, 5))
        for k in range(5):
            for m in range(12):
                markers.append((first + k, rng.randrange(1, length), f"m{chrom}-{k}-{m}", chrom, "S" if k < 2 else "L", chrom, k * 1.0 + m / 12))
            for _ in range(60):
                other = min(4, k + rng.randrange(2))
                pairs.append((first + k, rng.randrange(1, length), first + other, rng.randrange(1, length)))
    make = spark.createDataFrame
    return plan.Assembly(
        info=make(info, "key long, orig long, orig_start long, orig_end long, length long"),
        markers=make(markers, "key long, pos long, marker string, sorted_chr long, arm string, popseq_chr long, cM double").withColumns({"orig": F.col("key"), "orig_pos": F.col("pos")}),
        pairs=make(pairs, "key1 long, pos1 long, key2 long, pos2 long").withColumns({"orig1": F.col("key1"), "orig_pos1": F.col("pos1"), "orig2": F.col("key2"), "orig_pos2": F.col("pos2")}),
        molecules=make(molecules, "key long, start long, end long, barcode string, sample long, npairs long").withColumns({"orig": F.col("key"), "orig_start": F.col("start"), "orig_end": F.col("end")}),
    )


def test_anchor(genome):
    got = {r.key: r for r in plan.anchor(genome).anchored.collect()}
    assert all(got[k].popseq_first == got[k].sorted_first == got[k].hic_first == (1 if k < 6 else 2) for k in got)
    assert all(got[k].sorted_arm == ("S" if (k - 1) % 5 < 2 else "L") and got[k].n_distinct == 1 and got[k].n_bad == 0 for k in got)


def test_coverage_and_no_breaks(genome):
    a = plan.add_hic_coverage(plan.add_molecule_coverage(genome, 1000), 1000)
    assert a.molecule_cov.count() > 0 and a.hic_cov.count() > 0
    with pytest.raises(ValueError):
        plan.add_hic_coverage(genome, 1000, 3000)
    assert plan.break_chimeras(genome, width=1000, ratio=-30.0) is genome


def test_chimera_breaks(spark, genome):
    # no molecule spans 50 kb of scaffold 1
    holes = genome.molecules.where("not (key = 1 and start < 52000 and end > 48000)")
    a = plan.Assembly(genome.info.withColumn("key", F.col("key").cast("string")), genome.markers.withColumn("key", F.col("key").cast("string")), genome.pairs.withColumns({"key1": F.col("key1").cast("string"), "key2": F.col("key2").cast("string")}), holes.withColumn("key", F.col("key").cast("string")))
    extra = spark.createDataFrame([("1", 44_000, 56_000, "x", 1, 5, 1, 44_000, 56_000)], "key string, start long, end long, barcode string, sample long, npairs long, orig long, orig_start long, orig_end long")
    a = plan.Assembly(a.info, a.markers, a.pairs, a.molecules.unionByName(extra))
    a = plan.add_hic_coverage(plan.add_molecule_coverage(plan.anchor(a), 1000), 1000)
    out = plan.break_chimeras(a, width=1000, slop=500, interval=50_000, min_nbin=20, dist=5_000, ratio=-3.0)
    info = out.info.collect()
    # all is measured anew on the pieces
    keys = {r.key for r in info}
    anchored = {r.key: r for r in out.anchored.collect()}
    assert anchored.keys() == keys != {r.key for r in a.anchored.collect()}
    assert all(r.popseq_first in (None, 1 if r.orig < 6 else 2) for r in anchored.values())
    for cov in (out.molecule_cov, out.hic_cov):
        assert {r.key for r in cov.select("key").distinct().collect()} <= keys and cov.count() > 0
    assert len([r for r in info if r.orig == 1]) >= 3
    for k in range(1, 11):
        assert sum(r.orig_end - r.orig_start + 1 for r in info if r.orig == k) == 100_000
    assert out.markers.where("key is null").count() == 0 and out.pairs.where("key1 is null or key2 is null").count() == 0
    sized = out.molecules.join(out.info.select("key", "length"), "key")
    assert sized.where("end > length or start < 1").count() == 0


def test_scaffold_orders_the_genome(genome):
    info = materialize(genome.info.select("key", "length").join(plan.anchor(genome).anchored.select("key", F.col("popseq_first").alias("chr"), F.col("popseq_pos_mean").alias("cM")), "key"))
    got = plan.scaffold(info, genome.molecules, min_npairs=2, max_dist=60_000, min_nmol=2, max_cm=3.0)
    order = [[r.node for r in sorted(got.members.where(f"super = {s}").collect(), key=lambda r: r.bin)] for s in (1, 6)]
    assert order == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10]]
    assert {r.orientation for r in got.members.collect()} == {1}
    stats = {r.super: (r.n, r.length, r.chr, r.pchr) for r in got.supers.collect()}
    assert stats == {1: (5, 500_000, 1, 1.0), 6: (5, 500_000, 2, 1.0)}
    assert got.table.where("type = 'U'").count() == 8
    best = plan.grid(info, genome.molecules, {"min_npairs": [2, 3], "min_nmol": [2], "max_dist": [60_000], "max_cm": [3.0]}, 4, 5)
    assert len(best) == 1 and best[0]["n50"] == 500_000


def test_hic_map(spark, genome):
    info = genome.info.select("key", "length").withColumns({"chr": F.when(F.col("key") < 6, 1).otherwise(2).cast("long"), "cM": F.pmod(F.col("key") - 1, F.lit(5)).cast("double"), "nfrag": F.lit(99).cast("long")})
    oriented, table, lengths = plan.hic_map(info, genome.pairs, chromosome_names(spark, "barley"), min_bin=20_000)
    got = {r.key: r.hic_bin for r in oriented.collect()}
    assert [got[k] for k in range(1, 6)] == [1, 2, 3, 4, 5]
    assert {r.agp_chr: r.length for r in lengths.collect()} == {"chr1H": 500_400, "chr2H": 500_400}
    assert table.count() == 18
    inside = genome.pairs.select(F.lit("c").alias("chr1"), F.col("pos1").alias("start1"), F.lit("c").alias("chr2"), F.col("pos2").alias("start2"))
    assert plan.hic_coverage_of_map(inside, spark.createDataFrame([("c", 100_000)], "key string, length long"), 1000, 50_000).count() > 0


def test_frames(spark, genome):
    from sparkloom.plans import frames

    a = plan.add_molecule_coverage(genome, 1000)
    keys = spark.createDataFrame([(1,)], "key long")
    got = frames.chimera_frame(a.molecule_cov, genome.markers.withColumn("chr", F.col("popseq_chr")), keys)
    assert {r.kind for r in got.select("kind").distinct().collect()} == {"ratio", "marker"} and got.where("key <> 1").count() == 0
    links = spark.createDataFrame([("a", 0, "b", 10, 1.0), ("a", 5, "b", 10, 100.0)], "chr1 string, bin1 long, chr2 string, bin2 long, nlinks_norm double")
    assert sorted(r.colour for r in frames.contact_frame(links, 10).collect()) == [1, 10]
    assert frames.contact_frame(links.limit(0)).count() == 0
    offsets = spark.createDataFrame([("a", 0), ("b", 100)], "chr string, offset long")
    assert sorted((r.at1, r.at2) for r in frames.genome_frame(links, offsets).collect()) == [(0, 110), (5, 110)]
    flagged = spark.createDataFrame([("x", 5, True), ("y", 9, True), ("z", 99, False)], "key string, length long, bad boolean")
    assert [r.key for r in frames.assignment_frame(flagged, "bad", 1).collect()] == ["y"]
    lifted = spark.createDataFrame([(1, 50)], "super long, super_pos long")
    assert frames.alignment_frame(lifted, spark.createDataFrame([(1, 100)], "super long, length long")).first().x == 0.5
