"""Aggregations and reporting tables.

Pattern used throughout: ONE wide aggregate over the customer table (partial
aggregation on each partition, a single small final merge), then shaping of
the tiny result (unpivot, shares). Windows only ever run over already
aggregated rows, whose count is bounded by the number of categories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.config import (
    CAMPAIGN_COLUMNS, CAMPAIGN_LABELS, CHANNEL_COLUMNS, GROUP_COLUMNS,
    GROUP_MEASURES, INTEGER_NOISE_COLUMNS, FLOAT_NOISE_COLUMNS, MONEY_MEASURES,
    PRODUCT_COLUMNS, TOP_DECILE_FEATURES, product_label,
)
from cohortlens.functions.exprs import half_even, null_safe_sum, round_half_up, unpivot_exprs
from cohortlens.functions.quantiles import quantile_scalar

def _whole() -> Window:
    """Window over all rows — only applied to aggregated, category-bounded rows."""
    return Window.partitionBy()


def product_share(df: DataFrame) -> DataFrame:
    """A1: gross spend per product, % of all spend (2 dp), descending."""
    wide = df.agg(*[F.sum(c).alias(c) for c in PRODUCT_COLUMNS])
    long = wide.select(unpivot_exprs([(product_label(c), F.col(c)) for c in PRODUCT_COLUMNS], "Product", "Gross").alias("kv")).select("kv.*")
    total = F.sum("Gross").over(_whole())
    return long.select(
        "Product", half_even(F.col("Gross") * 100 / total, 2).alias("Pct"), F.col("Gross").cast("bigint").alias("Gross")
    ).orderBy(F.desc("Pct"), "Product")


def _rounded_group_table(agg_fn, df: DataFrame, null_int_to_zero: bool) -> DataFrame:
    grouped = df.groupBy(*GROUP_COLUMNS).agg(*[agg_fn(c).alias(c) for c in GROUP_MEASURES])
    out = []
    for c in GROUP_MEASURES:
        x = F.col(c)
        if c in MONEY_MEASURES:
            out.append(half_even(x, 2).alias(c))
        else:
            v = round_half_up(x).cast("bigint")
            out.append((F.coalesce(v, F.lit(0).cast("bigint")) if null_int_to_zero else v).alias(c))
    return grouped.select(*GROUP_COLUMNS, *out)


def group_means(df: DataFrame) -> DataFrame:
    """A2+A4: mean of 25 measures per (Marital_Status, Education); count
    measures to the nearest whole number (.5 up), money to 2 dp."""
    return _rounded_group_table(F.avg, df, null_int_to_zero=False)


def group_stds(df: DataFrame) -> DataFrame:
    """A3+A4: sample std per group; a one-member group gives null, which is
    0 for count measures and stays null for money measures."""
    return _rounded_group_table(F.stddev_samp, df, null_int_to_zero=True)


def highest_spent_props(df: DataFrame) -> DataFrame:
    """A5: share of each dominant category within its group."""
    counts = df.groupBy(*GROUP_COLUMNS, "Highest_Spent").count()
    w = Window.partitionBy(*GROUP_COLUMNS)
    return counts.select(*GROUP_COLUMNS, "Highest_Spent", (F.col("count") / F.sum("count").over(w)).alias("proportion"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Count and % (2 dp) per category, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("Frequency"))
    return counts.select(
        column, "Frequency", half_even(F.col("Frequency") * 100 / F.sum("Frequency").over(_whole()), 2).alias("Percentage")
    ).orderBy(F.desc("Frequency"), column)


#: Columns a pivot may get from the data.
MOST_PIVOT_COLUMNS = 1000


def pivot_domain(df: DataFrame, column: str) -> list:
    """The distinct non-null values of a column, in order. Raises beyond
    MOST_PIVOT_COLUMNS, as each becomes a column."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(MOST_PIVOT_COLUMNS + 1).collect()
    if len(found) > MOST_PIVOT_COLUMNS:
        raise ValueError(f"{column} has more than {MOST_PIVOT_COLUMNS} values")
    return sorted(r[0] for r in found)


def crosstab(df: DataFrame, row: str = "Education", column: str = "Marital_Status",
             values: Sequence | None = None, pct: bool = False) -> DataFrame:
    """Contingency table; the columns are the values in the data unless
    given; missing cell = 0; ``pct`` gives % of the grand total (2 dp)."""
    values = pivot_domain(df, column) if values is None else list(values)
    ct = df.groupBy(row).pivot(column, values).count().fillna(0, subset=[str(v) for v in values])
    names = [str(v) for v in values]
    if not pct:
        return ct.select(row, *[F.col(f"`{n}`").cast("bigint").alias(n) for n in names])
    total = sum((F.col(f"`{n}`") for n in names), F.lit(0))
    grand = F.sum(total).over(_whole())
    return ct.select(row, *[half_even(F.col(f"`{n}`") * 100 / grand, 2).alias(n) for n in names])


def crosstab_cells(df: DataFrame, row: str = "Education", column: str = "Marital_Status") -> DataFrame:
    """A7 with a row per cell that occurs, null categories included: row,
    column, n, pct of the grand total (2 dp). For domains of any size."""
    n = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    return n.select(row, column, "n", half_even(F.col("n") * 100 / F.sum("n").over(_whole()), 2).alias("pct"))


def household_crosstab(df: DataFrame) -> DataFrame:
    """Kidhome × Teenhome counts, a column teen_<n> per value in the data."""
    ct = crosstab(df, "Kidhome", "Teenhome")
    return ct.select("Kidhome", *[F.col(f"`{c}`").alias(f"teen_{c}") for c in ct.columns if c != "Kidhome"])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A9."""
    return df.select(column).distinct()


def kpi_scorecard(df: DataFrame) -> DataFrame:
    """A10: one-row scorecard from one aggregate."""
    any_cmp = F.when(null_safe_sum(CAMPAIGN_COLUMNS) > 0, 1).otherwise(0)
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("Total_Spent").cast("double").alias("total_revenue"),
        F.avg("Total_Spent").alias("avg_customer_value"),
        F.avg("Response").alias("last_campaign_response"),
        F.avg(any_cmp).alias("cumulative_acceptance"),
        F.avg("Complain").alias("complaint_rate"),
    )


def highest_spent_counts(df: DataFrame) -> DataFrame:
    """Customers per dominant category, ascending, with share %."""
    counts = df.groupBy("Highest_Spent").agg(F.count(F.lit(1)).alias("customers"))
    return counts.select(
        "Highest_Spent", "customers", (F.col("customers") * 100 / F.sum("customers").over(_whole())).alias("pct")
    ).orderBy("customers", "Highest_Spent")


def channel_mix(df: DataFrame) -> DataFrame:
    """Purchases per channel and share %."""
    wide = df.agg(*[F.sum(c).alias(c) for c in CHANNEL_COLUMNS])
    long = wide.select(unpivot_exprs([(lbl, F.col(c)) for c, lbl in CHANNEL_COLUMNS.items()], "Channel", "total").alias("kv")).select("kv.*")
    return long.select("Channel", F.col("total").cast("bigint").alias("total"),
                       (F.col("total") * 100 / F.sum("total").over(_whole())).alias("pct"))


def channel_preference_by(df: DataFrame, dimension: str = "Education") -> DataFrame:
    """Mean channel use per category, melted long."""
    g = df.groupBy(dimension).agg(*[F.avg(c).alias(c) for c in CHANNEL_COLUMNS])
    return g.select(dimension, unpivot_exprs([(lbl, F.col(c)) for c, lbl in CHANNEL_COLUMNS.items()], "Channel", "Avg_purchases").alias("kv")).select(dimension, "kv.*")


def campaign_rates(df: DataFrame) -> DataFrame:
    """Acceptance rate (%) per campaign."""
    wide = df.agg(*[F.avg(c).alias(c) for c in CAMPAIGN_COLUMNS])
    return wide.select(unpivot_exprs([(lbl, F.col(c) * 100) for c, lbl in zip(CAMPAIGN_COLUMNS, CAMPAIGN_LABELS)], "Campaign", "rate").alias("kv")).select("kv.*")


def campaigns_accepted_dist(df: DataFrame) -> DataFrame:
    """Customers by number of campaigns accepted (0–6), share %."""
    n = null_safe_sum(CAMPAIGN_COLUMNS).cast("bigint")
    counts = df.groupBy(n.alias("campaigns_accepted")).agg(F.count(F.lit(1)).alias("customers"))
    return counts.select("campaigns_accepted", "customers",
                         (F.col("customers") * 100 / F.sum("customers").over(_whole())).alias("pct")).orderBy("campaigns_accepted")


def response_by(df: DataFrame, dimension: str = "Education") -> DataFrame:
    """Last-campaign response rate (%) per category, ascending."""
    return df.groupBy(dimension).agg((F.avg("Response") * 100).alias("response_rate")).orderBy("response_rate", dimension)


def spend_pivot(df: DataFrame) -> DataFrame:
    """Mean Total_Spent, Marital × Education; empty cell null."""
    values = pivot_domain(df, "Education")
    p = df.groupBy("Marital_Status").pivot("Education", values).avg("Total_Spent")
    return p.select("Marital_Status", *[F.col(f"`{e}`").alias(e) for e in values])


def top_decile_profile(df: DataFrame, features: Sequence[str] = TOP_DECILE_FEATURES) -> DataFrame:
    """Mean features of the top spend decile (≥ linear 0.9 quantile) and
    of the rest, min–max scaled by the population (zero range → 1)."""
    thr = quantile_scalar(df, "Total_Spent", 0.9)
    top = F.col("Total_Spent") >= thr
    aggs = []
    for f in features:
        aggs += [
            F.avg(F.when(top, F.col(f))).alias(f"t_{f}"),
            F.avg(F.when(~top, F.col(f))).alias(f"r_{f}"),
            F.min(f).alias(f"lo_{f}"),
            F.max(f).alias(f"hi_{f}"),
        ]
    wide = df.agg(*aggs)
    pairs = []
    for f in features:
        rng = F.coalesce(F.nullif(F.col(f"hi_{f}") - F.col(f"lo_{f}"), F.lit(0)), F.lit(1))
        pairs.append((f, F.struct(
            ((F.col(f"t_{f}") - F.col(f"lo_{f}")) / rng).alias("top"),
            ((F.col(f"r_{f}") - F.col(f"lo_{f}")) / rng).alias("rest"),
        )))
    return wide.select(unpivot_exprs(pairs, "feature", "v").alias("kv")).select("kv.feature", "kv.v.top", "kv.v.rest")


def numeric_source_columns(df: DataFrame) -> list[str]:
    return [c for c in INTEGER_NOISE_COLUMNS + FLOAT_NOISE_COLUMNS + ["Age"] if c in df.columns]


def global_bounds(df: DataFrame) -> DataFrame:
    """Global mean / std / min / max of the numeric measures, one pass."""
    cols = numeric_source_columns(df)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"),
                 F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}")]
    wide = df.agg(*aggs)
    pairs = [(c, F.struct(F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std"),
                          F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max"))) for c in cols]
    return wide.select(unpivot_exprs(pairs, "column", "v").alias("kv")).select("kv.column", "kv.v.*")
