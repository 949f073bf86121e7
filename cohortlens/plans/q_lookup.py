"""Lookup queries L1–L7, R13, R14."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.config import (
    ACTIONS, CAMPAIGN_COLUMNS, CAMPAIGN_LABELS, CHANNEL_COLUMNS, PERSONAS, PRODUCT_COLUMNS,
    RADAR_FEATURES, SEGMENT_ORDER, product_label,
)
from cohortlens.operators import lookup
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, rounded, segment_profile, segmented

SB = S.seg_base()
ACC = " + ".join(f"coalesce({c}, 0)" for c in CAMPAIGN_COLUMNS)


def sel(select: str, *extra: str) -> str:
    return S.with_ctes(*SB, *extra, select=select)


def U(parts) -> str:
    return " UNION ALL ".join(parts)


_med = lookup.MEDIAN_MEASURES
def lookup_kpis(s, d):
    out = lookup.lookup_kpis(segmented(s, d), segment_profile(s, d))
    return out.select(*[F.round(c, 6).alias(c) if c.endswith("_median") else c for c in out.columns])


def lookup_radar(s, d):
    out = lookup.lookup_radar(segmented(s, d), segment_profile(s, d))
    return out.select("ID", "Segmentation", "feature", *[F.round(c, 6).alias(c) for c in out.columns[3:]])


add("lookup_kpis", lookup_kpis, sel(
    "SELECT s.ID AS id, s.Age AS age, s.Income AS income, s.Education AS education, s.Marital_Status AS marital_status, "
    "s.Kidhome AS kidhome, s.Teenhome AS teenhome, s.Kidhome + s.Teenhome AS total_kids, s.Dt_Customer AS dt_customer, "
    "date_diff('day', s.Dt_Customer, (SELECT max(Dt_Customer) FROM segmented)) / 365.25 AS tenure_years, "
    "s.Segmentation AS segmentation, s.Recency AS recency, s.Recency_Score AS recency_score, "
    "s.Total_Purchases AS frequency, s.Frequency_Score AS frequency_score, CAST(s.Total_Spent AS DOUBLE) AS monetary, "
    "s.Monetary_Score AS monetary_score, s.RMF_Score AS rfm_score, s.APV AS apv, "
    f"CAST({' + '.join('coalesce(s.' + c + ', 0)' for c in CAMPAIGN_COLUMNS)} AS BIGINT) AS campaigns_accepted, "
    + ", ".join(f"m.{k}_seg_median" for k, _ in _med) + ", " + ", ".join(f"p.{k}_pop_median" for k, _ in _med)
    + " FROM segmented s LEFT JOIN segmed m ON s.Segmentation = m.Segmentation CROSS JOIN popmed p",
    "segmed AS (SELECT Segmentation, " + ", ".join(f"round(median(CAST({c} AS DOUBLE)), 6) AS {k}_seg_median" for k, c in _med)
    + " FROM segmented GROUP BY Segmentation)",
    "popmed AS (SELECT " + ", ".join(f"round(median(CAST({c} AS DOUBLE)), 6) AS {k}_pop_median" for k, c in _med) + " FROM segmented)",
))
add("tenure", lambda s, d: lookup.tenure(segmented(s, d)), sel(
    "SELECT ID, date_diff('day', Dt_Customer, (SELECT max(Dt_Customer) FROM segmented)) / 365.25 AS tenure_years FROM segmented"))
add("campaign_flags", lambda s, d: lookup.campaign_flags(segmented(s, d)), sel(U(
    f"SELECT ID, CAST({ACC} AS BIGINT) AS campaigns_accepted, {S.q(l)} AS campaign, "
    f"CASE WHEN {c} = 1 THEN 'Accepted' ELSE 'Declined' END AS status FROM segmented"
    for c, l in zip(CAMPAIGN_COLUMNS, CAMPAIGN_LABELS)
)))


def _radar_sql() -> str:
    def norm(f, v):
        rng = f"(CASE WHEN b.hi_{f} > b.lo_{f} THEN b.hi_{f} - b.lo_{f} ELSE 1.0 END)"
        x = f"(({v}) - b.lo_{f}) / {rng}"
        return f"round({'1 - ' + x if f == 'Recency' else x}, 6)"
    parts = [
        f"SELECT w.ID, w.Segmentation, {S.q(f)} AS feature, {norm(f, f'CAST(w.{f} AS DOUBLE)')} AS customer, "
        f"{norm(f, f'sm.sm_{f}')} AS segment_median, {norm(f, f'p.{f}')} AS population_median "
        "FROM work w LEFT JOIN sm ON w.Segmentation = sm.Segmentation, rbnd b, pm p"
        for f in RADAR_FEATURES
    ]
    return sel(
        U(parts),
        f"work AS (SELECT *, CAST({ACC} AS BIGINT) AS Campaigns_Accepted FROM segmented)",
        "rbnd AS (SELECT " + ", ".join(f"min(CAST({f} AS DOUBLE)) AS lo_{f}, max(CAST({f} AS DOUBLE)) AS hi_{f}" for f in RADAR_FEATURES) + " FROM work)",
        "sm AS (SELECT Segmentation, " + ", ".join(f"median(CAST({f} AS DOUBLE)) AS sm_{f}" for f in RADAR_FEATURES) + " FROM work GROUP BY Segmentation)",
        "pm AS (SELECT " + ", ".join(f"median(CAST({f} AS DOUBLE)) AS {f}" for f in RADAR_FEATURES) + " FROM work)",
    )


add("lookup_radar", lookup_radar, _radar_sql())


def _vs_sql(cols, labels) -> str:
    parts = [
        f"SELECT s.ID, s.Segmentation, {S.q(labels[c])} AS category, CAST(s.{c} AS DOUBLE) AS customer, "
        f"round(m.sm_{c}, 6) AS segment_mean, round(p.{c}, 6) AS population_mean "
        "FROM segmented s LEFT JOIN sm m ON s.Segmentation = m.Segmentation, pm p"
        for c in cols
    ]
    return sel(
        U(parts),
        "sm AS (SELECT Segmentation, " + ", ".join(f"avg({c}) AS sm_{c}" for c in cols) + " FROM segmented GROUP BY Segmentation)",
        "pm AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in cols) + " FROM segmented)",
    )


add("lookup_spend", rounded(lambda s, d: lookup.lookup_spend(segmented(s, d)), segment_mean=6, population_mean=6),
    _vs_sql(PRODUCT_COLUMNS, {c: product_label(c) for c in PRODUCT_COLUMNS}))
add("lookup_channels", rounded(lambda s, d: lookup.lookup_channels(segmented(s, d)), segment_mean=6, population_mean=6),
    _vs_sql(list(CHANNEL_COLUMNS), CHANNEL_COLUMNS))

_sc = [("rfm", "RMF_Score"), ("total_spent", "Total_Spent"), ("total_purchases", "Total_Purchases"), ("recency", "Recency"), ("apv", "APV")]
add("segment_scorecard", rounded(lambda s, d: lookup.segment_scorecard(segmented(s, d)), avg_apv=6, avg_apv_baseline=6), sel(
    "SELECT Segmentation, count(*) AS customers, (SELECT count(*) FROM segmented) AS baseline_customers, "
    + ", ".join(
        (f"round(avg({c}), 6) AS avg_{k}, round((SELECT avg({c}) FROM segmented), 6) AS avg_{k}_baseline" if k == "apv"
         else f"avg({c}) AS avg_{k}, (SELECT avg({c}) FROM segmented) AS avg_{k}_baseline")
        for k, c in _sc)
    + ", avg(Response) AS response_rate, (SELECT avg(Response) FROM segmented) AS response_rate_baseline "
    "FROM segmented GROUP BY Segmentation"
))


def _playbook_sql() -> str:
    rows = []
    for s in SEGMENT_ORDER:
        acts = ACTIONS[s]
        half = (len(acts) + 1) // 2
        for i, a in enumerate(acts):
            rows.append(f"({S.q(s)}, {S.q(PERSONAS[s])}, {i}, {S.q(a)}, {1 if i < half else 2})")
    return sel(
        "SELECT p.Segmentation, c.customers, p.persona, CAST(p.action_no AS BIGINT) AS action_no, p.action, "
        "CAST(p.column_no AS BIGINT) AS column_no FROM pb p JOIN (SELECT Segmentation, count(*) AS customers "
        "FROM segmented GROUP BY Segmentation) c ON p.Segmentation = c.Segmentation",
        f"pb AS (SELECT * FROM (VALUES {', '.join(rows)}) t(Segmentation, persona, action_no, action, column_no))",
    )


add("segment_playbook", lambda s, d: lookup.segment_playbook(segmented(s, d)), _playbook_sql())
