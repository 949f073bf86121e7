"""Largest-remainder allocation of rows to groups, and ranges in order.

The groups stay a DataFrame. Which remainders are rounded up is decided by the
k-th largest one, found by counting remainders in buckets, and in the buckets of
the bucket it falls into; only groups that tie with it are ranked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.sources.io import shared_path

#: Buckets of a round of counting; so many counts reach the driver.
BUCKETS = 1024
WIDE = "decimal(38,0)"


def kth_largest(df: DataFrame, col: str, k: int, upper: int) -> tuple[int, int]:
    """The k-th largest (from 1) of whole numbers in 0 .. upper - 1, and how
    many of ``col`` are larger. Each round counts BUCKETS equal ranges of what
    is left, so log(upper) / log(BUCKETS) aggregates are needed."""
    low, high, above = 0, upper, 0
    while high - low > 1:
        size = -(-(high - low) // BUCKETS)
        part = df.where((F.col(col) >= low) & (F.col(col) < high))
        at = F.expr(f"(`{col}` - {low}L) div {size}L")
        counts = {r["b"]: r["n"] for r in part.groupBy(at.alias("b")).agg(F.count("*").alias("n")).collect()}
        for b in sorted(counts, reverse=True):
            if above + counts[b] >= k:
                low, high = low + b * size, min(high, low + (b + 1) * size)
                break
            above += counts[b]
        else:
            raise ValueError("fewer than k values")
    return low, above


def allocate(groups: DataFrame, keys: list[str], count_col: str, n_rows: int, total: int) -> DataFrame:
    """``groups`` with ``alloc``: n_rows shared in proportion to the counts,
    rounded down, and the rows left over given to the largest remainders, ties
    in key order. Exact integers throughout."""
    share = F.col(count_col).cast(WIDE) * F.lit(n_rows).cast(WIDE)
    all_ = F.lit(total).cast(WIDE)
    rem = (share % all_).cast("bigint")
    parts = groups.select("*", ((share - share % all_) / all_).cast("bigint").alias("alloc"), rem.alias("__rem"))
    left = n_rows - (parts.agg(F.sum("alloc")).first()[0] or 0)
    if left == 0:
        return parts.drop("__rem")
    cut, above = kth_largest(parts, "__rem", left, total)
    ranked = parts.where(F.col("__rem") == cut).withColumn("__r", F.row_number().over(Window.orderBy(*keys)))
    tied = ranked.withColumn("alloc", F.col("alloc") + (F.col("__r") <= left - above).cast("bigint"))
    rest = parts.where(F.col("__rem") != cut).withColumn("alloc", F.col("alloc") + (F.col("__rem") > cut).cast("bigint"))
    return rest.drop("__rem").unionByName(tied.drop("__rem", "__r"))


def with_starts(df: DataFrame, order: list[str], size_col: str, start: str = "start") -> DataFrame:
    """``df`` with the sum of ``size_col`` over the rows before it in order, in
    two passes: sums within range partitions, and the partitions' totals as
    offsets."""
    spark = df.sparkSession
    path = shared_path(spark, "starts", uuid.uuid4().hex)
    df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    totals = rows.groupBy("__part").agg(F.sum(size_col).alias("__t"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    offsets = totals.select("__part", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn(start, F.coalesce(F.sum(size_col).over(inside), F.lit(0))).join(offsets, "__part")
    return out.withColumn(start, F.col(start) + F.col("__o")).drop("__part", "__o")


def found_in(values: Column, bound: Column, width: int) -> Column:
    """How many leading entries of the ascending array are <= ``bound``; places
    past the end count as larger. Few entries (``width`` at most) are compared
    one by one, more by binary search."""
    if width <= 16:
        return sum((F.when(F.get(values, F.lit(i)) <= bound, 1).otherwise(0) for i in range(width)), F.lit(0))
    steps = F.array(*[F.lit(1 << i) for i in range(width.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(values, at + step - 1) <= bound, step).otherwise(0))
