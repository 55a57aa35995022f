"""The data behind the plots: one frame each, drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import colour_index
from ..operators.relational import top_rows


def chimera_frame(coverage: DataFrame, markers: DataFrame, keys: DataFrame) -> DataFrame:
    """Coverage ratio along chosen sequences and the places of their markers: (key, kind, at, value, chr)."""
    chosen = keys.select("key").distinct()
    line = coverage.join(chosen, "key", "left_semi").select("key", F.lit("ratio").alias("kind"), F.col("bin").alias("at"), F.col("r").alias("value"), F.lit(None).cast("string").alias("chr"))
    dots = markers.join(chosen, "key", "left_semi").select("key", F.lit("marker").alias("kind"), F.col("pos").alias("at"), F.col("cM").cast("double").alias("value"), F.col("chr").cast("string").alias("chr"))
    return line.unionByName(dots)


def assignment_frame(anchored: DataFrame, flag: str, n: int = 100) -> DataFrame:
    """The longest sequences with a conflict flag."""
    return top_rows(anchored.where(F.col(flag)).withColumn("__one", F.lit(1)), ["__one"], [F.desc("length"), "key"], n).drop("__one")


def contact_frame(links: DataFrame, colours: int = 100) -> DataFrame:
    """Contacts with an index 1..colours by equal cuts of log strength."""
    logged = links.withColumn("l", F.log10("nlinks_norm"))
    ends = logged.agg(F.min("l").alias("low"), F.max("l").alias("high")).first()
    if ends.low is None or ends.low == ends.high:
        return logged.withColumn("colour", F.lit(1).cast("long"))
    return logged.withColumn("colour", colour_index(F.col("l"), ends.low, ends.high, colours).cast("long"))


def alignment_frame(lifted: DataFrame, lengths: DataFrame) -> DataFrame:
    """Lifted alignments with places on either axis from 0 to 1; lengths: super, length."""
    return lifted.join(lengths.select("super", "length"), "super").withColumn("x", F.col("super_pos") / F.col("length"))


def genome_frame(links: DataFrame, offsets: DataFrame) -> DataFrame:
    """Contacts between chromosomes on one axis of added offsets; offsets: chr, offset."""
    for k in ("1", "2"):
        links = links.join(offsets.select(F.col("chr").alias(f"chr{k}"), F.col("offset").alias(f"__o{k}")), f"chr{k}")
        links = links.withColumn(f"at{k}", F.col(f"bin{k}") + F.col(f"__o{k}")).drop(f"__o{k}")
    return links
