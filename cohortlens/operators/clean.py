"""Cleaning and feature engineering (raw → treated).

Each step is a ``DataFrame → DataFrame`` transform usable with
``df.transform``. Steps that need a table-wide scalar (mean age, mean spend,
max income, median income) read it through a scalar subquery
(``DataFrame.scalar()``): the plan stays lazy and single, Catalyst merges
sibling scalar aggregates into one job, and nothing passes through the driver.
Only text dates need one aggregate first, as one rule holds for the column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import (
    DEFAULT, EXCLUDED_RAW_COLUMNS, MARITAL_NOISE, MARITAL_NOISE_TARGET, PRODUCT_COLUMNS,
    CampaignSchema,
)
from cohortlens.functions.exprs import first_argmax_label, null_safe_sum
from cohortlens.functions.quantiles import quantile_scalar

PURCHASE_COLUMNS = ["NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases"]
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def drop_constants(df: DataFrame, columns=EXCLUDED_RAW_COLUMNS) -> DataFrame:
    """drop the zero-variance constant columns."""
    return df.drop(*columns)


def add_total_spent(df: DataFrame) -> DataFrame:
    """Σ of the six product amounts, nulls skipped."""
    return df.withColumn("Total_Spent", null_safe_sum(PRODUCT_COLUMNS).cast("bigint"))


def add_total_purchases(df: DataFrame) -> DataFrame:
    """Deals + web + catalog + store purchases."""
    return df.withColumn("Total_Purchases", null_safe_sum(PURCHASE_COLUMNS).cast("bigint"))


def add_highest_spent(df: DataFrame) -> DataFrame:
    """Dominant product category label; ties → first in column order."""
    return df.withColumn("Highest_Spent", first_argmax_label(PRODUCT_COLUMNS))


UNPARSED = "Unable to parse all Dt_Customer values as dates."


def parse_dates_expr(df: DataFrame, column: str = "Dt_Customer") -> Column:
    """Adaptive date parse, decided for the whole column.

    All texts ISO → ISO, otherwise day first; if a value is left null, the
    whole column is tried again with the default parser; if one is still null
    (a null among them), ValueError. The decision is one aggregate. A streaming
    source has no whole column to look at: :func:`split_by_date` takes its batches.
    """
    c = F.col(column)
    if dict(df.dtypes)[column] == "date":
        return c
    if dict(df.dtypes)[column] == "timestamp":
        return F.to_date(c)
    if df.isStreaming:
        raise ValueError(f"{column} of a streaming source must be a date or timestamp")
    text = c.cast("string")
    iso = F.try_to_date(text, "yyyy-MM-dd")
    day_first = F.coalesce(F.try_to_date(text, "d-M-yyyy"), F.try_to_date(text, "d/M/yyyy"))
    default = F.try_to_date(text)
    seen = df.agg(F.coalesce(F.bool_and(text.rlike(ISO_DATE)), F.lit(True)).alias("all_iso"), F.count("*").alias("n"),
                  *[F.count(x).alias(k) for k, x in (("iso", iso), ("day_first", day_first), ("default", default))]).first()
    first = ("iso", iso) if seen["all_iso"] else ("day_first", day_first)
    for name, parsed in (first, ("default", default)):
        if seen[name] == seen["n"]:
            return parsed
    raise ValueError(UNPARSED)


def split_by_date(df: DataFrame, column: str = "Dt_Customer") -> tuple[DataFrame, DataFrame]:
    """C6 for one batch of a stream: the rows with their dates parsed by the
    whole-batch rule, and the rows for the dead-letter sink. Those are the rows
    without a date that any format can read; and all rows of a batch whose
    dates no single format can read."""
    if dict(df.dtypes)[column] in ("date", "timestamp"):
        return df.withColumn(column, F.to_date(column)), df.where("false")
    text = F.col(column).cast("string")
    known = F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "d-M-yyyy"), F.try_to_date(text, "d/M/yyyy"),
                       F.try_to_date(text)).isNotNull()
    good = df.where(known)
    try:
        return good.withColumn(column, parse_dates_expr(good, column)), df.where(~known)
    except ValueError:
        return good.withColumn(column, F.lit(None).cast("date")).where("false"), df


def parse_customer_dates(df: DataFrame, column: str = "Dt_Customer") -> DataFrame:
    """Enrollment date as DATE (day-first text in the raw file)."""
    return df.withColumn(column, parse_dates_expr(df, column))


def add_age(df: DataFrame, cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """Age = fixed reference year − Year_Birth (never the wall clock)."""
    return df.withColumn("Age", (F.lit(cfg.reference_year) - F.col("Year_Birth")).cast("bigint"))


def is_age_outlier(cfg: CampaignSchema = DEFAULT) -> Column:
    return F.coalesce(F.col("Age") >= cfg.age_outlier_threshold, F.lit(False))


def treat_age_outliers(df: DataFrame, cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """An impossible age with below-average spend is a ghost record and is
    dropped; an active one keeps the row with Age set to the truncated mean
    of the plausible ages. Both means are taken before any drop."""
    outlier = is_age_outlier(cfg)
    age_mean = df.filter(~outlier).select(F.avg("Age")).scalar()
    spend_mean = df.select(F.avg("Total_Spent")).scalar()
    drop = outlier & F.coalesce(F.col("Total_Spent") < spend_mean, F.lit(False))
    return df.filter(~drop).withColumn(
        "Age", F.when(outlier, age_mean.cast("bigint")).otherwise(F.col("Age"))
    )


def drop_income_outlier(df: DataFrame) -> DataFrame:
    """Drop the row(s) holding the maximum Income; null incomes stay."""
    mx = df.select(F.max("Income")).scalar()
    return df.filter(F.col("Income").isNull() | (F.col("Income") != mx))


def impute_income(df: DataFrame) -> DataFrame:
    """Fill null Income with the median (2 dp, half-even)."""
    med = quantile_scalar(df, "Income", 0.5)
    return df.withColumn("Income", F.coalesce(F.col("Income"), F.bround(med, 2)))


def consolidate_marital(df: DataFrame) -> DataFrame:
    """C11: merge the noise categories into Single."""
    ms = F.col("Marital_Status")
    return df.withColumn("Marital_Status", F.when(ms.isin(*MARITAL_NOISE), F.lit(MARITAL_NOISE_TARGET)).otherwise(ms))


def treat(raw: DataFrame, cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """Full treatment in the reference order
    F3 → C1 → C2 → C3 → C5 → C7 → C8 → C9 → C10 → C11."""
    return (
        raw.transform(drop_constants)
        .transform(add_total_spent)
        .transform(add_total_purchases)
        .transform(add_highest_spent)
        .transform(parse_customer_dates)
        .transform(lambda d: add_age(d, cfg))
        .transform(lambda d: treat_age_outliers(d, cfg))
        .transform(drop_income_outlier)
        .transform(impute_income)
        .transform(consolidate_marital)
    )


def engineer(raw: DataFrame, cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """Feature steps only (F3, C1, C2, C3, C5, C7), without row changes."""
    return (
        raw.transform(drop_constants)
        .transform(add_total_spent)
        .transform(add_total_purchases)
        .transform(add_highest_spent)
        .transform(parse_customer_dates)
        .transform(lambda d: add_age(d, cfg))
    )
