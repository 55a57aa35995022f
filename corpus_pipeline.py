"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
documents; the last adds the shard.  run() writes each stage's result as Parquet
to the shared checkpoint folder and reads it again, so that a lost executor costs
one stage's tasks and no stage is planned twice; what a stage has read is deleted.

For all stages: an empty table gives an empty table; columns of docs besides those of
documents are dropped, whatever their names; texts of any length are taken whole;
lang, source and n_chars may be null anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm._util import table
from sparkloom.llm.decontaminate import decontaminate
from sparkloom.llm.mixing import mix_sources
from sparkloom.llm.quality import judge_quality, trusted_ids
from sparkloom.llm.sharding import shard
from sparkloom.llm.shingle_dedup import jaccard_duplicates
from sparkloom.session import materialize, release

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the log-likelihood ratio reject go.

    Null and empty texts have too few words and go.  A null id is never a trusted row.
    Repeated rows are judged each, alike; a ratio equal to the threshold is kept.
    """
    judged = judge_quality(docs.select(*COLUMNS), trusted_ids(table(spark, sf_dir, "labels")))
    return judged.where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (0.8 or more of Jaccard on five-word shingles) the document of the smallest id stays; a null id is the largest.

    A document is named by its id and its text's hash, so repeated ids with other
    texts are documents of their own, and of rows with one id and text the one of
    least lang, source and n_chars stays.  Of texts of one class that share the smallest
    id the one of smallest hash stays.  Null and empty texts are one class; shorter texts
    than a shingle are one shingle.
    """
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), hashed.alias("hash"), *COLUMNS)
    # equal rows meet before the shuffle, so a crowd of them is one row of each task
    once = named.groupBy("none", "id", "hash").agg(F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("row"))
    classes = jaccard_duplicates(named.select(F.struct("none", "id", "hash").alias("name"), "text"), "name")
    stay = classes.where(F.col("name") == F.col("component_id")).select("name.*").distinct()
    return once.join(stay, ["none", "id", "hash"], "left_semi").select("row.*").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows make up a twentieth or more of the words go.

    Null and empty texts have no words and stay, as does all if the benchmark is empty;
    ids may be null or repeat, and repeated rows are judged alike.
    """
    return decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes; one that it takes twice is there twice.

    A null source is a source like any other.  Null and empty texts have no words: one is
    taken as often as the document before it in its source's queue.  Of rows alike in id,
    source and text, null ids among them, any may be the ones taken, but always as many.
    """
    return mix_sources(docs.select(*COLUMNS)).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard.

    Null texts have no bytes and a null id counts as ''.  Repeated rows hash alike and, if
    they are more than a shard holds, go to numbered overflow shards.  A text larger than
    a shard has one to itself.
    """
    return shard(docs.select(*COLUMNS))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]

#: XXH64 fingerprints and hashed n-grams have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for number, (_, stage) in enumerate(STAGES, 1):
        before, docs = docs, stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs)
            release(before)
    return docs
