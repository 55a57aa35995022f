"""Relational helpers that Spark has no single call for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import swap_if


def canonical_pairs(pairs: DataFrame, group1: str, at1: str, group2: str, at2: str) -> DataFrame:
    """Distinct pairs; within a group the smaller place comes first."""
    wrong = (F.col(group1) == F.col(group2)) & (F.col(at1) > F.col(at2))
    return pairs.withColumns(swap_if(wrong, at1, at2)).distinct()


def dictionary(rows: DataFrame, column: str, code: str = "code") -> DataFrame:
    """(column, code): distinct values numbered from 0 in ascending order.

    Values are dealt by range and counted by partition, so that numbering does not
    pass through one task.
    """
    values = rows.where(F.col(column).isNotNull()).select(column).distinct()
    from ..session import materialize

    dealt = materialize(values.repartitionByRange(F.col(column)).sortWithinPartitions(column).withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(column))
    return dealt.join(F.broadcast(starts), "__part").select(column, (F.col("__start") + inside - 1).cast("long").alias(code))


def encode(rows: DataFrame, column: str, code: str = "code") -> DataFrame:
    """rows with the code of column's value; null for null."""
    return rows.join(dictionary(rows, column, code), column, "left")


def null_safe_join(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null matches null; keys appear once, from the left."""
    right = b.withColumnsRenamed({c: f"__{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return a.join(right, condition, how).drop(*(f"__{c}" for c in on))


def neighbour_join(a: DataFrame, b: DataFrame, keys: list[str], at: str, other_at: str, reach: int = 1, where: str | None = None) -> DataFrame:
    """Pairs of rows of the same keys whose places differ by at most reach; an equi-join after spreading a.

    where: a condition on a pair, met inside the join.  Small tables may give many pairs, so rows are dealt to
    as many tasks as shuffles have, or four for each core, whatever their size.
    """
    spark = a.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = a.withColumn("__at", F.explode(F.sequence(F.col(at) - reach, F.col(at) + reach))).repartition(tasks, *keys, "__at")
    other = b.withColumn("__at", F.col(other_at)).repartition(tasks, *keys, "__at")
    met = spread.join(other, [*keys, "__at"])
    return (met if where is None else met.where(where)).drop("__at")


def top_rows(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key; order must settle ties."""
    return rows.withColumn("__i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__i") <= n).drop("__i")


def unique_only(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur once."""
    return rows.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where("__n = 1").drop("__n")


def same_groups(a: DataFrame, b: DataFrame, group: str, member: str) -> DataFrame:
    """Groups of a that have the same members as some group of b: (group, same_as).  Groups are compared by digests of their sorted members."""
    def mark(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(group).alias(name)).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(F.col(member).cast("string"))), "\n"), 256).alias("mark"))

    return mark(a, group).join(mark(b, "same_as"), "mark").drop("mark")


def pivot_counts(rows: DataFrame, key: str, column: str, values: list) -> DataFrame:
    """Counts of each value as a column, 0 where there are none."""
    return rows.groupBy(key).agg(*(F.count_if(F.col(column) == v).alias(str(v)) for v in values))


def parameter_grid(spark, axes: dict[str, list], product: list[str], low: float, high: float) -> DataFrame:
    """All combinations of parameters whose product over some of them lies in low..high."""
    import itertools

    rows = list(itertools.product(*axes.values()))
    frame = spark.createDataFrame(rows, list(axes))
    p = F.lit(1)
    for c in product:
        p = p * F.col(c)
    return frame.withColumn("product", p).where(F.col("product").between(low, high))


def spread_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", share: int = 1_000, counted: DataFrame | None = None) -> DataFrame:
    """rows joined with the table, which has each key once; the rows of a hot key are dealt to several tasks.

    A key with more than one in `share` of all rows is hot: there are at most `share` of them, so their list may
    come to the driver.  Its rows get numbers of as many parts as it needs, rounded up to a power of two, and the
    table's row is repeated for each part.
    rows must give the same partitions each time it is read (a table, or what materialize() returns).
    counted: another table with the same keys as often, if that is cheaper to count.  A null key meets nothing.
    """
    known = rows if counted is None else counted
    part = max(1, known.count() // share)
    hot: dict[int, list] = {}
    for key_of, n in known.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > part).collect():
        hot.setdefault(1 << (-(-n // part) - 1).bit_length(), []).append(key_of)
    if not hot:
        return rows.join(table, key, how)
    parts = F.lit(1)
    for number, keys in hot.items():
        some = [k for k in keys if k is not None]
        if some:
            parts = F.when(F.col(key).isin(some), number).otherwise(parts)
    # null keys are dealt out as well
    left = rows.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.when(F.col(key).isNull(), share).otherwise(parts)).cast("int"))
    right = table.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.join(right, [key, "__part"], how).drop("__part")
