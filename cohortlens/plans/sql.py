"""DuckDB-dialect SQL twins of the Spark plans, used as the correctness
oracle. Each builder returns CTE text; :func:`with_ctes` assembles a query.
The Spark side never runs these strings."""

from __future__ import annotations

from cohortlens.config import (
    DEFAULT, MARITAL_NOISE, MARITAL_NOISE_TARGET, PRODUCT_COLUMNS, SEGMENT_LOWER_BOUNDS,
    SEGMENT_ORDER, CampaignSchema, product_label,
)
from cohortlens.sources.mart import raw_campaign_sql

PURCHASES = ["NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases"]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def null_safe_sum(cols) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in cols)


def first_argmax(cols, labels=None) -> str:
    labels = labels or [product_label(c) for c in cols]
    g = f"greatest({', '.join(cols)})"
    whens = " ".join(f"WHEN {c} = {g} THEN {q(l)}" for c, l in zip(cols, labels))
    return f"CASE {whens} END"


def round_half_up(x: str) -> str:
    return f"CASE WHEN ceil({x}) - ({x}) <= 0.5 THEN ceil({x}) ELSE floor({x}) END"


def segment_label(score: str) -> str:
    whens = " ".join(
        f"WHEN {score} >= {b} THEN {q(n)}"
        for b, n in reversed(list(zip(SEGMENT_LOWER_BOUNDS, SEGMENT_ORDER)))
    )
    return f"CASE {whens} END"


def segment_code(seg: str) -> str:
    whens = " ".join(f"WHEN {seg} = {q(s)} THEN {i}" for i, s in enumerate(SEGMENT_ORDER))
    return f"CAST(CASE {whens} END AS BIGINT)"


def segment_dim() -> str:
    rows = ", ".join(f"({q(s)}, {i})" for i, s in enumerate(SEGMENT_ORDER))
    return f"segdim AS (SELECT * FROM (VALUES {rows}) t(Segmentation, seg_order))"


def mart() -> str:
    return raw_campaign_sql()


def engineered(cfg: CampaignSchema = DEFAULT) -> str:
    return f"""eng AS (
  SELECT * EXCLUDE (Z_CostContact, Z_Revenue),
    CAST({null_safe_sum(PRODUCT_COLUMNS)} AS BIGINT) AS Total_Spent,
    CAST({null_safe_sum(PURCHASES)} AS BIGINT) AS Total_Purchases,
    {first_argmax(PRODUCT_COLUMNS)} AS Highest_Spent,
    CAST({cfg.reference_year} - Year_Birth AS BIGINT) AS Age
  FROM raw
)"""


def treated(cfg: CampaignSchema = DEFAULT) -> str:
    """CTEs eng → aged → inc → imp → treated (needs ``raw``)."""
    out = f"coalesce(Age >= {cfg.age_outlier_threshold}, false)"
    noise = ", ".join(q(x) for x in MARITAL_NOISE)
    return engineered(cfg) + f""",
aged AS (
  SELECT * REPLACE (
    CASE WHEN {out} THEN (SELECT CAST(trunc(avg(Age)) AS BIGINT) FROM eng WHERE NOT {out}) ELSE Age END AS Age)
  FROM eng
  WHERE NOT ({out} AND coalesce(Total_Spent < (SELECT avg(Total_Spent) FROM eng), false))
),
inc AS (
  SELECT * FROM aged WHERE Income IS NULL OR Income <> (SELECT max(Income) FROM aged)
),
imp AS (
  SELECT * REPLACE (coalesce(Income, round_even((SELECT median(Income) FROM inc), 2)) AS Income) FROM inc
),
treated AS (
  SELECT * REPLACE (
    CASE WHEN Marital_Status IN ({noise}) THEN {q(MARITAL_NOISE_TARGET)} ELSE Marital_Status END AS Marital_Status)
  FROM imp
)"""


def base(cfg: CampaignSchema = DEFAULT) -> list[str]:
    return [mart(), treated(cfg)]


def segmented(cfg: CampaignSchema = DEFAULT) -> str:
    """CTEs hist → bnd → km (recursive Lloyd) → fin → seg0 → ranks →
    segmented (needs ``treated``). Mirrors operators.rfm exactly."""
    k = cfg.rfm_k
    comps = cfg.rfm_components
    hist = " UNION ALL ".join(
        f"SELECT {q(vc)} AS comp, CAST({vc} AS BIGINT) AS v, count(*) AS w FROM treated WHERE {vc} IS NOT NULL GROUP BY {vc}"
        for vc, _, _ in comps
    )
    cs = [f"c{i}" for i in range(k)]
    init = ", ".join(f"lo + (hi - lo) * {2 * i + 1} / {2 * k}" for i in range(k))

    def lab(prefix: str, v: str) -> str:
        return " + ".join(
            f"CASE WHEN {v} > ({prefix}c{i} + {prefix}c{i + 1}) / 2 THEN 1 ELSE 0 END" for i in range(k - 1)
        ) or "0"

    new = ", ".join(
        f"coalesce(sum(h.v * h.w) FILTER (WHERE {lab('km.', 'h.v')} = {i}) / "
        f"sum(h.w) FILTER (WHERE {lab('km.', 'h.v')} = {i}), km.c{i}) AS n{i}"
        for i in range(k)
    )
    same = " AND ".join(f"n{i} = c{i}" for i in range(k))
    seg_cols = []
    joins = []
    for vc, cc, _ in comps:
        a = cc.lower()
        seg_cols.append(f"CASE WHEN t.{vc} IS NOT NULL THEN CAST({lab(a + '.', 't.' + vc)} AS BIGINT) END AS {cc}")
        joins.append(f"(SELECT * FROM fin WHERE comp = {q(vc)}) {a}")
    rank_parts = []
    for vc, cc, hib in comps:
        order = "ASC" if hib else "DESC"
        rank_parts.append(
            f"SELECT {q(vc)} AS comp, {cc} AS cl, CAST(row_number() OVER (ORDER BY avg({vc}) {order}) - 1 AS BIGINT) AS score "
            f"FROM seg0 WHERE {cc} IS NOT NULL GROUP BY {cc}"
        )
    score_name = {"Cluster_Frequency": "Frequency_Score", "Cluster_Monetary": "Monetary_Score", "Cluster_Recency": "Recency_Score"}
    score_joins = " ".join(
        f"LEFT JOIN ranks r{j} ON r{j}.comp = {q(vc)} AND r{j}.cl = s.{cc}" for j, (vc, cc, _) in enumerate(comps)
    )
    idx = {cc: j for j, (_, cc, _) in enumerate(comps)}
    score_sel = ", ".join(
        f"r{idx[cc]}.score AS {score_name[cc]}" for cc in ("Cluster_Frequency", "Cluster_Recency", "Cluster_Monetary")
    )
    rmf = " + ".join(f"r{idx[cc]}.score" for cc in ("Cluster_Frequency", "Cluster_Recency", "Cluster_Monetary"))
    return f"""hist AS ({hist}),
bnd AS (SELECT comp, min(v) AS lo, max(v) AS hi FROM hist GROUP BY comp),
km(comp, it, {', '.join(cs)}, done) AS (
  SELECT comp, 0, {init}, false FROM bnd
  UNION ALL
  SELECT comp, it + 1, {', '.join(f'n{i}' for i in range(k))}, ({same})
  FROM (
    SELECT km.comp, km.it, {', '.join('km.' + c for c in cs)}, {new}
    FROM km JOIN hist h ON h.comp = km.comp
    WHERE NOT km.done
    GROUP BY km.comp, km.it, {', '.join('km.' + c for c in cs)}
  )
),
fin AS (SELECT * FROM km WHERE (comp, it) IN (SELECT comp, max(it) FROM km GROUP BY comp)),
seg0 AS (SELECT t.*, {', '.join(seg_cols)} FROM treated t, {', '.join(joins)}),
ranks AS ({' UNION ALL '.join(rank_parts)}),
segmented AS (
  SELECT s.*, {score_sel}, CAST({rmf} AS BIGINT) AS RMF_Score,
    {segment_label('(' + rmf + ')')} AS Segmentation,
    CASE WHEN s.Total_Purchases > 0 THEN s.Total_Spent / s.Total_Purchases ELSE 0.0 END AS APV
  FROM seg0 s {score_joins}
)"""


def seg_base(cfg: CampaignSchema = DEFAULT) -> list[str]:
    return [mart(), treated(cfg), segmented(cfg)]


def group_table(agg: str, zero_null_ints: bool) -> str:
    """SELECT text of the rounded group mean / std table (A2–A4) over treated."""
    from cohortlens.config import GROUP_MEASURES, MONEY_MEASURES
    cols = []
    for c in GROUP_MEASURES:
        if c in MONEY_MEASURES:
            cols.append(f"round_even({agg}({c}), 2) AS {c}")
        else:
            v = f"CAST({round_half_up(f'{agg}({c})')} AS BIGINT)"
            cols.append(f"coalesce({v}, 0) AS {c}" if zero_null_ints else f"{v} AS {c}")
    return f"SELECT Marital_Status, Education, {', '.join(cols)} FROM treated GROUP BY Marital_Status, Education"
