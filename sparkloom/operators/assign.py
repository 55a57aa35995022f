"""Assignment of items to categories by their most frequent category, with confidence measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.aggregates import mad, sd


def assign_top2(rows: DataFrame, key: str, category: str, prefix: str = "") -> DataFrame:
    """For each key: total, first and second category with their counts, share of the first and ratio second to first.

    Counts tie by category.  Null categories are left out.  Without a second
    category its columns and the ratio are null.
    """
    counts = rows.where(F.col(category).isNotNull()).groupBy(key, category).agg(F.count("*").alias("n"))
    placed = counts.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), category)))
    pick = lambda c, k: F.max(F.when(F.col("place") == k, F.col(c)))
    out = placed.groupBy(key).agg(F.sum("n").alias(f"{prefix}total"), pick(category, 1).alias(f"{prefix}first"), pick("n", 1).alias(f"{prefix}n1"), pick(category, 2).alias(f"{prefix}second"), pick("n", 2).alias(f"{prefix}n2"))
    return out.withColumn(f"{prefix}share", F.col(f"{prefix}n1") / F.col(f"{prefix}total")).withColumn(f"{prefix}ratio", F.col(f"{prefix}n2") / F.col(f"{prefix}n1"))


def assign_arm(rows: DataFrame, top: DataFrame, key: str, category: str, arm: str, without: tuple = ()) -> DataFrame:
    """top with n_short, n_long, arm ('S' on a tie, null for the categories `without` arms) and arm_share within the first category."""
    counts = rows.groupBy(key, category).agg(F.count_if(F.col(arm) == "S").alias("n_short"), F.count_if(F.col(arm) == "L").alias("n_long"))
    joined = top.join(counts.withColumnRenamed(category, "first"), [key, "first"], "left")
    name = F.when(F.col("first").isin(*without), None).when(F.col("n_short") >= F.col("n_long"), "S").otherwise("L")
    share = F.when(F.col("arm") == "S", F.col("n_short") / F.col("n1")).when(F.col("arm") == "L", F.col("n_long") / F.col("n1"))
    return joined.withColumn("arm", name).withColumn("arm_share", share)


def assign_position(rows: DataFrame, key: str, category: str, position: str, distinct: str | None = None) -> DataFrame:
    """assign_top2() with mean, sd and MAD of the positions in the first category.

    distinct: count each value of this column once a key and category.
    """
    used = rows.where(F.col(category).isNotNull())
    if distinct:
        used = used.dropDuplicates([key, category, distinct])
    stats = used.groupBy(key, category).agg(F.avg(position).alias("pos_mean"), sd(F.col(position)).alias("pos_sd"))
    stats = stats.join(mad(used, [key, category], position, "pos_mad"), [key, category])
    return assign_top2(used, key, category).join(stats.withColumnRenamed(category, "first"), [key, "first"])


def pair_label_tally(pairs: DataFrame, labels: DataFrame, left: str, right: str, key: str = "key", label: str = "label") -> DataFrame:
    """assign_top2() of each right end over the labels of the left ends it is paired with."""
    named = pairs.join(labels.select(F.col(key).alias(left), F.col(label).alias("__label")), left)
    return assign_top2(named.select(F.col(right).alias(key), F.col("__label").alias(label)), key, label)


def assignment_conflicts(assigned: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """For each key how many assignments it has (n_assigned) and to how many categories (n_distinct)."""
    long = assigned.select(key, *columns).unpivot([key], columns, "by", "category").where("category is not null")
    return long.groupBy(key).agg(F.count("*").alias("n_assigned"), F.count_distinct("category").alias("n_distinct"))


def flag_outliers(assigned: DataFrame, ratio: str, total: str, second: str, percentile: float, least_total: int = 30, least_second: int = 2, require_total: bool = False, name: str = "bad") -> DataFrame:
    """assigned with a flag: ratio at or over the exact percentile of rows with enough in total, and a second category that counts.

    require_total: only rows with enough in total are flagged.  Null ratios are not flagged.
    The threshold is one row, joined as a scalar subquery.
    """
    limit = assigned.where(F.col(total) >= least_total).agg(F.percentile(ratio, F.lit(percentile)).alias("limit"))
    bad = (F.col(ratio) >= limit.scalar()) & (F.col(second) >= least_second)
    if require_total:
        bad = bad & (F.col(total) >= least_total)
    return assigned.withColumn(name, F.coalesce(bad, F.lit(False)))
