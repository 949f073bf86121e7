"""Filter strip, coverage, point lookup, eligible ids, acquisition curve and
top-k listings (F4, F5, F7, F9, W1, O1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_mask(education: Sequence[str] | None = None, marital: Sequence[str] | None = None,
                kids: str = "All", segments: Sequence[str] | None = None) -> Column:
    """multi-select filter; kids 'All'/'Any' = no predicate, 'Yes' →
    Kidhome + Teenhome > 0, 'No' → = 0."""
    m = F.lit(True)
    if education is not None:
        m = m & F.col("Education").isin(*education)
    if marital is not None:
        m = m & F.col("Marital_Status").isin(*marital)
    if segments is not None and "All" not in segments:
        m = m & F.col("Segmentation").isin(*segments)
    kids_n = F.col("Kidhome") + F.col("Teenhome")
    if kids == "Yes":
        m = m & (kids_n > 0)
    elif kids == "No":
        m = m & (kids_n == 0)
    return m


def filter_strip(df: DataFrame, **kw) -> DataFrame:
    """rows kept by the filter strip (pushed down as a plain predicate)."""
    return df.where(filter_mask(**kw))


def filter_coverage(df: DataFrame, **kw) -> DataFrame:
    """kept, total and % kept (1 dp) in one scan."""
    m = filter_mask(**kw)
    return df.agg(F.sum(F.when(m, 1).otherwise(0)).cast("bigint").alias("kept"),
                  F.count(F.lit(1)).alias("total")).select(
        "kept", "total", F.round(F.col("kept") * 100 / F.col("total"), 1).alias("pct"))


def customer_row(df: DataFrame, customer_id: int) -> DataFrame:
    """one customer's row, read once; ``KeyError`` when absent."""
    rows = df.where(F.col("ID") == customer_id).head(1)
    if not rows:
        raise KeyError(f"Customer ID {customer_id} not found")
    return df.sparkSession.createDataFrame(rows, df.schema)


def eligible_ids(df: DataFrame, **kw) -> DataFrame:
    """distinct ids after the filters, ascending."""
    return df.where(filter_mask(**kw)).select("ID").distinct().orderBy("ID")


def id_bounds(df: DataFrame) -> DataFrame:
    """bounds for the direct id input."""
    return df.agg(F.min("ID").alias("min_id"), F.max("ID").alias("max_id"))


def acquisition_curve(df: DataFrame, column: str = "Dt_Customer") -> DataFrame:
    """Cumulative customers at each month end, empty months carried
    forward. Customers are aggregated per month first, so the running-sum
    window sees one row per month of the bounded calendar spine."""
    month = F.last_day(F.col(column))
    monthly = df.where(F.col(column).isNotNull()).groupBy(month.alias("month_end")).agg(F.count(F.lit(1)).alias("n"))
    span = df.agg(F.trunc(F.min(column), "month").alias("a"), F.trunc(F.max(column), "month").alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("m")).select(
        F.last_day("m").alias("month_end"))
    j = spine.join(monthly, "month_end", "left")
    w = Window.orderBy("month_end").rowsBetween(Window.unboundedPreceding, 0)
    return j.select("month_end", F.sum(F.coalesce(F.col("n"), F.lit(0))).over(w).cast("bigint").alias("cumulative_customers"))


def top_k(df: DataFrame, column: str, k: int, id_col: str = "ID") -> DataFrame:
    """O1: the k largest values (ties by id) — planned as TakeOrderedAndProject."""
    return df.orderBy(F.desc(column), F.asc(id_col)).limit(k).select(id_col, column)
