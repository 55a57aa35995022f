"""Links between items that share molecules (barcodes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import length_weight


def end_molecules(molecules: DataFrame, lengths: DataFrame, key: str, start: str, end: str, length: str, max_dist: int) -> DataFrame:
    """Molecules near an end of the item they lie on."""
    sized = molecules.join(lengths.select(key, length), key)
    return sized.where((F.col(end) <= max_dist) | (F.col(length) - F.col(start) <= max_dist))


#: Rows of a barcode that meet its others in one task; a barcode of more is cut into parts of so many.
PART_ROWS = 2_000


def barcode_links(molecules: DataFrame, item: str, barcode: str, sample: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(sample, barcode, item1, item2) of distinct items that share a barcode, both ways.

    Items of a barcode are first made distinct, and barcodes with one item left out,
    so that the self join meets only what can link.  The links of a barcode grow with
    the square of its items; one with many is cut into parts, each of which meets all
    its items in a task of its own.
    """
    once = molecules.where(F.col(barcode).isNotNull()).select(sample, barcode, F.col(item).alias("item")).distinct()
    return _pairs(once, [sample, barcode], "item", part_rows).select(sample, barcode, F.col("one.item").alias("item1"), F.col("two.item").alias("item2"))


def _pairs(rows: DataFrame, keys: list[str], item: str, part_rows: int) -> DataFrame:
    """(keys, one, two): all pairs of rows of a key with different items."""
    wide = rows.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n >= 2").select(*keys, F.ceil(F.col("__n") / part_rows).cast("int").alias("__parts"))
    held = rows.join(wide, keys).select(*keys, "__parts", F.struct(*(F.col(c) for c in rows.columns if c not in keys)).alias("row"))
    one = held.select(*keys, F.pmod(F.xxhash64("row"), F.col("__parts")).cast("int").alias("__part"), F.col("row").alias("one"))
    two = held.select(*keys, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"), F.col("row").alias("two"))
    return one.join(two, [*keys, "__part"]).where(F.col("one")[item] != F.col("two")[item]).drop("__part")


def link_support(links: DataFrame, barcode: str, sample: str, min_nmol: int, min_nsample: int, count_rows: bool = False) -> DataFrame:
    """(item1, item2, nsample, nmol): pairs with min_nmol barcodes in each of min_nsample samples; nmol over those samples.

    count_rows: links are counted as rows, not as barcodes.
    """
    n = F.count("*") if count_rows else F.count_distinct(barcode)
    each = links.groupBy("item1", "item2", sample).agg(n.alias("nmol")).where(F.col("nmol") >= min_nmol)
    return each.groupBy("item1", "item2").agg(F.count("*").alias("nsample"), F.sum("nmol").alias("nmol")).where(F.col("nsample") >= min_nsample)


def annotate_links(pairs: DataFrame, info: DataFrame, item: str, columns: dict[str, str]) -> DataFrame:
    """pairs with chr, cM and length of either end, same_chr and weight; columns: which of info's are chr, cM and length."""
    for k in ("1", "2"):
        side = info.select(F.col(item).alias(f"item{k}"), *(F.col(columns[c]).alias(f"{c}{k}") for c in ("chr", "cM", "length")))
        pairs = pairs.join(side, f"item{k}")
    return pairs.withColumn("same_chr", F.col("chr1") == F.col("chr2")).withColumn("weight", length_weight(F.col("length1"), F.col("length2")))


def filter_links(links: DataFrame, max_cm: float) -> DataFrame:
    """Links within a chromosome whose ends lie at most max_cm apart; all if max_cm is 0."""
    return links if max_cm <= 0 else links.where(F.col("same_chr") & (F.abs(F.col("cM1") - F.col("cM2")) <= max_cm))


def find_links(molecules: DataFrame, info: DataFrame, min_npairs: int, max_dist: int, min_nmol: int, min_nsample: int, max_cm: float) -> tuple[DataFrame, DataFrame]:
    """Links of an assembly, and all supported pairs before the map filter.

    molecules: key, start, end, npairs, barcode, sample.  info: key, length, chr, cM.
    """
    ends = end_molecules(molecules.where(F.col("npairs") >= min_npairs), info, "key", "start", "end", "length", max_dist)
    pairs = link_support(barcode_links(ends, "key", "barcode", "sample"), "barcode", "sample", min_nmol, min_nsample)
    annotated = annotate_links(pairs, info, "key", {"chr": "chr", "cM": "cM", "length": "length"})
    return filter_links(annotated, max_cm), annotated


def link_positions(molecules: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(item1, pos1, item2, pos2) of molecules of one barcode and sample on two items; pos is a molecule's middle."""
    one = molecules.where("sample is not null and barcode is not null").select("sample", "barcode", "key", F.floor((F.col("start") + F.col("end")) / 2).cast("long").alias("pos"))
    return _pairs(one, ["sample", "barcode"], "key", part_rows).select(F.col("one.key").alias("item1"), F.col("one.pos").alias("pos1"), F.col("two.key").alias("item2"), F.col("two.pos").alias("pos2"))
