"""RFM queries: clustering, scores, segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.config import DEFAULT
from cohortlens.functions.exprs import segment_code
from cohortlens.operators import rfm
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, segmented

SB = S.seg_base()


def sel(select: str, *extra: str) -> str:
    return S.with_ctes(*SB, *extra, select=select)


add("segmented", segmented, sel("SELECT * FROM segmented"))
add("rfm_clusters", lambda s, d: segmented(s, d).select("ID", "Cluster_Frequency", "Cluster_Monetary", "Cluster_Recency"),
    sel("SELECT ID, Cluster_Frequency, Cluster_Monetary, Cluster_Recency FROM segmented"))
add("cluster_ranks", lambda s, d: rfm.cluster_ranks(segmented(s, d)), sel(" UNION ALL ".join(
    f"SELECT {S.q(vc)} AS component, {cc} AS cluster, avg({vc}) AS mean, "
    f"CAST(row_number() OVER (ORDER BY avg({vc}) {'ASC' if hib else 'DESC'}) - 1 AS BIGINT) AS score "
    f"FROM segmented WHERE {cc} IS NOT NULL GROUP BY {cc}"
    for vc, cc, hib in DEFAULT.rfm_components
)))
add("rfm_scores", lambda s, d: segmented(s, d).select("ID", "Frequency_Score", "Recency_Score", "Monetary_Score", "RMF_Score"),
    sel("SELECT ID, Frequency_Score, Recency_Score, Monetary_Score, RMF_Score FROM segmented"))
add("segments", lambda s, d: segmented(s, d).select("ID", "RMF_Score", "Segmentation"),
    sel("SELECT ID, RMF_Score, Segmentation FROM segmented"))
add("apv", lambda s, d: segmented(s, d).select("ID", "Total_Spent", "Total_Purchases", "APV"),
    sel("SELECT ID, Total_Spent, Total_Purchases, APV FROM segmented"))
add("apv_by_segment", lambda s, d: rfm.apv_by_segment(segmented(s, d)),
    sel("SELECT Segmentation, round(avg(APV), 6) AS mean_APV FROM segmented GROUP BY Segmentation ORDER BY mean_APV DESC, Segmentation"))
add("segment_counts", lambda s, d: rfm.segment_counts(segmented(s, d)), sel(
    "SELECT d.Segmentation, CAST(coalesce(c.customers, 0) AS BIGINT) AS customers, "
    "coalesce(c.customers, 0) * 100 / sum(coalesce(c.customers, 0)) OVER () AS pct "
    "FROM segdim d LEFT JOIN (SELECT Segmentation, count(*) AS customers FROM segmented GROUP BY Segmentation) c "
    "ON d.Segmentation = c.Segmentation ORDER BY d.seg_order",
    S.segment_dim(),
))
add("segment_comparison", lambda s, d: rfm.segment_comparison(segmented(s, d)), sel(
    "SELECT d.Segmentation, g.Customers, g.Customers / sum(g.Customers) OVER () AS Share, g.Avg_RFM_Score, "
    "g.Avg_Recency, g.Avg_Frequency, g.Avg_Monetary, round(g.Avg_APV, 6) AS Avg_APV, g.Response_Rate "
    "FROM segdim d LEFT JOIN (SELECT Segmentation, count(ID) AS Customers, avg(RMF_Score) AS Avg_RFM_Score, "
    "avg(Recency) AS Avg_Recency, avg(Total_Purchases) AS Avg_Frequency, avg(Total_Spent) AS Avg_Monetary, "
    "avg(APV) AS Avg_APV, avg(Response) AS Response_Rate FROM segmented GROUP BY Segmentation) g "
    "ON d.Segmentation = g.Segmentation ORDER BY d.seg_order",
    S.segment_dim(),
))


def segment_members(seg, segments=("Premium",)):
    """members of the selected segments ('All' = no predicate)."""
    if "All" in segments:
        return seg
    return seg.filter(F.col("Segmentation").isin(*segments))


add("segment_members", lambda s, d: segment_members(segmented(s, d)).select("ID", "Segmentation", "RMF_Score"),
    sel("SELECT ID, Segmentation, RMF_Score FROM segmented WHERE Segmentation IN ('Premium')"))
add("segment_codes", lambda s, d: segmented(s, d).select(
    "ID", "RMF_Score", "Recency", "Total_Purchases", "Total_Spent", "APV", "Segmentation",
    segment_code(F.col("Segmentation")).alias("Segment_Code")),
    sel("SELECT ID, RMF_Score, Recency, Total_Purchases, Total_Spent, APV, Segmentation, "
        f"{S.segment_code('Segmentation')} AS Segment_Code FROM segmented"))
