"""Dashboard filter / listing queries: F4, F5, F7, F9, W1, O1, L7."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import reports
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, segmented, segmented_by_id, treated

# A fixed, representative filter selection (the dashboard's multi-selects).
EDU = ["Graduation", "PhD", "Master"]
MAR = ["Married", "Together", "Single"]
FILTER = dict(education=EDU, marital=MAR, kids="Yes")
MASK_SQL = (f"Education IN ({', '.join(S.q(x) for x in EDU)}) AND Marital_Status IN ({', '.join(S.q(x) for x in MAR)}) "
            "AND Kidhome + Teenhome > 0")


def sel(select: str, *extra: str) -> str:
    return S.with_ctes(*S.base(), *extra, select=select)


def ssel(select: str, *extra: str) -> str:
    return S.with_ctes(*S.seg_base(), *extra, select=select)


add("filter_strip", lambda s, d: reports.filter_strip(treated(s, d), **FILTER).select(
    "ID", "Education", "Marital_Status", "Kidhome", "Teenhome"),
    sel(f"SELECT ID, Education, Marital_Status, Kidhome, Teenhome FROM treated WHERE {MASK_SQL}"))
add("filter_coverage", lambda s, d: reports.filter_coverage(treated(s, d), **FILTER), sel(
    f"SELECT CAST(count(*) FILTER (WHERE {MASK_SQL}) AS BIGINT) AS kept, count(*) AS total, "
    f"round(count(*) FILTER (WHERE {MASK_SQL}) * 100 / count(*), 1) AS pct FROM treated"))


def customer_lookup(spark, sf_dir):
    """the row of one customer (the smallest id present), from its bucket."""
    seg = segmented_by_id(spark, sf_dir)
    first_id = treated(spark, sf_dir).agg(F.min("ID")).first()[0]
    return seg.where(F.col("ID") == first_id).select("ID", "Segmentation", "RMF_Score", "Total_Spent", "Recency")


add("customer_lookup", customer_lookup, ssel(
    "SELECT ID, Segmentation, RMF_Score, Total_Spent, Recency FROM segmented WHERE ID = (SELECT min(ID) FROM segmented)"))
add("eligible_ids", lambda s, d: reports.eligible_ids(segmented(s, d), segments=["Premium", "Loyal"], **FILTER), ssel(
    f"SELECT DISTINCT ID FROM segmented WHERE Segmentation IN ('Premium', 'Loyal') AND {MASK_SQL} ORDER BY ID"))
add("id_bounds", lambda s, d: reports.id_bounds(segmented(s, d)),
    ssel("SELECT min(ID) AS min_id, max(ID) AS max_id FROM segmented"))
add("acquisition_curve", lambda s, d: reports.acquisition_curve(treated(s, d)), sel(
    "SELECT CAST(last_day(m) AS DATE) AS month_end, CAST(sum(coalesce(c.n, 0)) OVER (ORDER BY m ROWS UNBOUNDED PRECEDING) AS BIGINT) "
    "AS cumulative_customers FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(Dt_Customer)), "
    "date_trunc('month', max(Dt_Customer)), INTERVAL 1 MONTH)) AS DATE) AS m FROM treated) sp "
    "LEFT JOIN (SELECT last_day(Dt_Customer) AS me, count(*) AS n FROM treated GROUP BY 1) c ON c.me = last_day(sp.m)"))
add("top_spenders", lambda s, d: reports.top_k(treated(s, d), "Total_Spent", 5),
    sel("SELECT ID, Total_Spent FROM treated ORDER BY Total_Spent DESC, ID LIMIT 5"))
add("top_purchasers", lambda s, d: reports.top_k(treated(s, d), "Total_Purchases", 5),
    sel("SELECT ID, Total_Purchases FROM treated ORDER BY Total_Purchases DESC, ID LIMIT 5"))
add("oldest", lambda s, d: reports.top_k(treated(s, d), "Age", 20),
    sel("SELECT ID, Age FROM treated ORDER BY Age DESC, ID LIMIT 20"))
add("rfm_points", lambda s, d: segmented(s, d).select(
    "ID", "Total_Purchases", "Recency", "Total_Spent", "Segmentation",
    F.col("Cluster_Recency").cast("string").alias("Cluster_Recency_label"),
    (F.col("ID") == segmented(s, d).select(F.min("ID")).scalar()).alias("is_selected")),
    ssel("SELECT ID, Total_Purchases, Recency, Total_Spent, Segmentation, CAST(Cluster_Recency AS VARCHAR) AS Cluster_Recency_label, "
         "ID = (SELECT min(ID) FROM segmented) AS is_selected FROM segmented"))
add("spend_income_points", lambda s, d: treated(s, d).select("ID", "Income", "Total_Spent", "Highest_Spent", "Age", "Total_Purchases"),
    sel("SELECT ID, Income, Total_Spent, Highest_Spent, Age, Total_Purchases FROM treated"))
add("web_visits_points", lambda s, d: treated(s, d).select("ID", "NumWebVisitsMonth", "NumWebPurchases", "Total_Spent", "Income"),
    sel("SELECT ID, NumWebVisitsMonth, NumWebPurchases, Total_Spent, Income FROM treated"))
