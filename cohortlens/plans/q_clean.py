"""Cleaning-step queries C1–C12 and the F8 listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.config import DEFAULT, MARITAL_NOISE
from cohortlens.operators import clean
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, raw

T = S.base()


def sel(select: str) -> str:
    return S.with_ctes(*T, select=select)


def eng(s, d):
    return clean.engineer(raw(s, d), DEFAULT)


def aged(s, d):
    return clean.treat_age_outliers(eng(s, d), DEFAULT)


def inc(s, d):
    return clean.drop_income_outlier(aged(s, d))


add("total_spent", lambda s, d: eng(s, d).select("ID", "Total_Spent"), sel("SELECT ID, Total_Spent FROM eng"))
add("total_purchases", lambda s, d: eng(s, d).select("ID", "Total_Purchases"), sel("SELECT ID, Total_Purchases FROM eng"))
add("highest_spent", lambda s, d: eng(s, d).select("ID", "Highest_Spent"), sel("SELECT ID, Highest_Spent FROM eng"))


def parse_dates_roundtrip(s, d):
    """Enrollment dates written as day-first text are parsed back. The
    rule decides for the whole column of dates there are; a customer without
    one (no order yet) keeps a null."""
    text = raw(s, d).select("ID", F.date_format("Dt_Customer", "dd-MM-yyyy").alias("Dt_Customer"))
    parsed = clean.parse_dates_expr(text.where(F.col("Dt_Customer").isNotNull()), "Dt_Customer")
    return text.select("ID", F.when(F.col("Dt_Customer").isNotNull(), parsed).alias("Dt_Customer"))


add("parse_dates", parse_dates_roundtrip, sel("SELECT ID, Dt_Customer FROM raw"))
add("age", lambda s, d: eng(s, d).select("ID", "Year_Birth", "Age"), sel("SELECT ID, Year_Birth, Age FROM eng"))
add("treat_age", lambda s, d: aged(s, d).select("ID", "Age", "Total_Spent"), sel("SELECT ID, Age, Total_Spent FROM aged"))
add("drop_income_outlier", lambda s, d: inc(s, d).select("ID", "Income"), sel("SELECT ID, Income FROM inc"))
add("impute_income", lambda s, d: clean.impute_income(inc(s, d)).select("ID", "Income"), sel("SELECT ID, Income FROM imp"))
add("consolidate_marital", lambda s, d: clean.consolidate_marital(raw(s, d)).groupBy("Marital_Status").count(),
    sel("SELECT CASE WHEN Marital_Status IN (" + ", ".join(S.q(x) for x in MARITAL_NOISE)
        + ") THEN 'Single' ELSE Marital_Status END AS Marital_Status, count(*) AS count FROM raw GROUP BY 1"))


def noise_present(s, d):
    """Which noise categories occur."""
    return raw(s, d).where(F.col("Marital_Status").isin(*MARITAL_NOISE)).select("Marital_Status").distinct()


add("noise_present", noise_present, sel(
    "SELECT DISTINCT Marital_Status FROM raw WHERE Marital_Status IN (" + ", ".join(S.q(x) for x in MARITAL_NOISE) + ")"))
add("age_outliers", lambda s, d: eng(s, d).where(clean.is_age_outlier(DEFAULT)).select("ID", "Year_Birth", "Age", "Total_Spent"),
    sel(f"SELECT ID, Year_Birth, Age, Total_Spent FROM eng WHERE Age >= {DEFAULT.age_outlier_threshold}"))
add("income_null_rows", lambda s, d: raw(s, d).where(F.col("Income").isNull()).select("ID", "Education", "Marital_Status", "Income"),
    sel("SELECT ID, Education, Marital_Status, Income FROM raw WHERE Income IS NULL"))
