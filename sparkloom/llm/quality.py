"""Quality rules: per-document counts and a hashed n-gram log-likelihood ratio, in DataFrame operations.

N-grams (words, pairs of words, last three characters of words) hash to a fixed
number of buckets.  A trusted target, a bounded sample of rows labelled good, and
the raw corpus each give a multinomial over the buckets; the target's is smoothed
towards the raw one.  A document's score is the mean log ratio of its n-grams,
target over raw, and every document is held to one fixed threshold.

All per-document work stays inside array functions of one row, so the only
shuffle is of partial counts by bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import NOT_SPACES, quoted, table, words_of

#: Buckets (2^13: with more, small targets leave too few counts in each); strength of the smoothing, in n-grams; least mean log ratio of a kept document; most trusted rows.
BUCKETS, SMOOTHING, THRESHOLD, TRUSTED_ROWS = 1 << 13, 1 << 15, -0.1, 20_000
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Fixed value: the characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


def _hashes(docs: DataFrame) -> DataFrame:
    """words; ids, their hashes; pairs, the hashes of two words in a row."""
    split = docs.withColumn("words", words_of(F.col("text")))
    return split.withColumn("ids", F.transform("words", lambda w: F.xxhash64(w))).withColumn("pairs", _joined("ids", 1))


def _joined(hashes: str, apart: int) -> Column:
    """Hash of each element and the one so far after it."""
    h, n = F.col(hashes), F.size(hashes)
    return F.when(n > apart, F.transform(F.sequence(F.lit(0), n - apart - 1), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + apart)))).otherwise(F.array().cast("array<bigint>"))


def _tail(word: Column) -> Column:
    """Hash of the last three characters."""
    return F.xxhash64(F.right(word, F.lit(3)), F.lit(3))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


#: Of ranked, the windows (hash h, place i) in order of h: words in windows found again.
_REPEATED = f"""
  aggregate(
    array_sort(transform(filter(ranked, (p, i) -> p.h = get(ranked, i - 1).h OR p.h = get(ranked, i + 1).h), p -> p.i)),
    named_struct('upto', 0L, 'n', 0L),
    (a, i) -> named_struct('upto', i + {WINDOW}L, 'n', a.n + i + {WINDOW}L - greatest(i, a.upto)),
    a -> a.n)"""


def bucket_weights(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """Log ratio of each bucket, target over raw; 0 where the raw corpus has nothing.  trusted: (id), of bounded size."""
    mine = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(F.broadcast(trusted.select(F.col("id"), F.lit(1).alias("good"))), "id", "left")
    # a row for each word, so that hashing is compiled code
    split = mine.select("good", words_of(F.col("text")).alias("words"))
    after = F.slice("words", 2, 1 << 30)
    each = split.select("good", F.inline(F.arrays_zip("words", after))).toDF("good", "word", "after")
    word, pair = F.xxhash64("word"), F.xxhash64(F.xxhash64("word"), F.xxhash64("after"))
    grams = F.array(_bucket(word, buckets), F.when(F.col("after").isNotNull(), _bucket(pair, buckets)), _bucket(_tail(F.col("word")), buckets))
    counts = each.select("good", F.explode(grams).alias("b")).where("b is not null").groupBy("b").agg(F.count("*").alias("raw"), F.count("good").alias("target")).collect()
    raw, target = sum(r.raw for r in counts), sum(r.target for r in counts)
    weights = [0.0] * buckets
    for r in counts:
        share = r.raw / raw
        weights[r.b] = round(math.log((r.target + smoothing * share) / (target + smoothing)) - math.log(share), 4)
    return weights


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", rows: int = TRUSTED_ROWS) -> DataFrame:
    """(id) of at most `rows` rows labelled 1, those of smallest hash; an id with a 0 anywhere, and a null id, is not trusted."""
    known = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("y")).where("id is not null").groupBy("id").agg(F.min("y").alias("y"))
    return known.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(rows).select("id")


def judge_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint), base_failed, score and kept.

    A null or empty text has no words and fails for its length; a document
    without n-grams scores 0.  With an empty target every score is 0 and only the
    base rules decide.  Repeated ids and rows are judged each by its own text, and a score
    equal to the threshold is kept.  Texts of any length are judged whole; an empty table
    gives no rows.  Windows and n-grams are compared by 64-bit hashes.  Columns of docs with one
    of the new names are replaced.  keep: the columns to return, all if None.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    weights = bucket_weights(docs, trusted, id_col, text_col)
    rows = docs.select(F.struct(F.lit(True).alias("__sparkloom_row"), *(quoted(c) for c in kept)).alias("row"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    # windows of eight are hashed from windows of four, and those from pairs
    hashed = _hashes(rows).withColumn("fours", _joined("pairs", 2)).withColumn("eights", _joined("fours", 4))
    ranked = F.array_sort(F.transform("eights", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_SPACES))
    counted = hashed.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(F.size(F.array_distinct("eights")) < F.size("eights"), ranked).otherwise(F.array().cast("array<struct<h:bigint,i:bigint>>")).alias("ranked"),
        _score(weights).alias("score"),
    )
    # a generator, so that no filter on its columns moves below it: there it would compute them inside array functions, for each element again
    made = F.struct("n_words", "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.expr(_REPEATED).alias("n_repeat_words"), "score")
    out = counted.select("row", F.inline(F.array(made)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))
    return out.select(*(F.col("row")[c].alias(c) for c in kept), *added)


def _score(weights: list[float]) -> Column:
    """Mean weight of a row's n-grams.  The weights, of fixed number, stand in the plan as one folded literal."""
    table_of = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")
    weigh = lambda h: F.get(table_of, _bucket(h, len(weights)))
    add = lambda column, of: F.aggregate(column, F.lit(0.0), lambda a, x: a + weigh(of(x)))
    total = add("ids", lambda h: h) + add("pairs", lambda h: h) + add("words", _tail)
    return total / F.greatest(F.size("ids") * 3 - 1, F.lit(1))


def op6_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, trusted_ids(table(spark, sf_dir, "labels")), keep=["doc_id"])
