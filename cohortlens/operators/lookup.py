"""Customer lookup (L1–L7), segment scorecard (R13) and playbook.

The reference computes these for one customer at a time. Here each is built
for ALL customers in one job (per-segment aggregates are one row per
segment — a fixed five-row dimension — and are broadcast back), so a single
lookup is just a filter on the result and the work scales out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import (
    ACTIONS, CAMPAIGN_COLUMNS, CAMPAIGN_LABELS, CHANNEL_COLUMNS, PERSONAS, PRODUCT_COLUMNS,
    RADAR_FEATURES, SEGMENT_ORDER, product_label,
)
from cohortlens.functions.exprs import null_safe_sum, unpivot_exprs
from cohortlens.functions.quantiles import quantile_wide

MEDIAN_MEASURES = [
    ("recency", "Recency"), ("frequency", "Total_Purchases"), ("monetary", "Total_Spent"),
    ("apv", "APV"), ("rfm", "RMF_Score"), ("income", "Income"),
]


def with_campaigns_accepted(df: DataFrame) -> DataFrame:
    """L3: campaigns accepted per customer (0–6)."""
    return df.withColumn("Campaigns_Accepted", null_safe_sum(CAMPAIGN_COLUMNS).cast("bigint"))


def _melt(df: DataFrame, cols, keys=("Segmentation",)) -> DataFrame:
    return df.select(*keys, unpivot_exprs([(c, F.col(c).cast("double")) for c in cols], "measure", "value").alias("kv")).select(*keys, "kv.*")


POPULATION = "__population__"


def _segment_and_population_medians(df: DataFrame, cols) -> DataFrame:
    """Exact medians per segment AND for the whole population in ONE quantile
    job: every value is stacked under its segment and under the population key
    (a 2× narrow fan-out), so one sketch/rank pipeline serves both."""
    key = F.explode(F.array(F.col("Segmentation"), F.lit(POPULATION))).alias("__key")
    stacked = df.select(key, *cols)
    long = _melt(stacked, cols, ["__key"])
    med = quantile_wide(long, "value", [0.5], ["__key", "measure"], ["median"])
    return med.groupBy("__key").agg(*[F.max(F.when(F.col("measure") == c, F.col("median"))).alias(c) for c in cols])


def segment_profile(seg: DataFrame) -> DataFrame:
    """What the lookups compare a customer with: a row per segment and one for
    the population (``__key``), with the medians of all lookup measures, and on
    the population's row the latest enrollment and the bounds of the radar
    features. Made once per segmented table and kept; lookups only read it."""
    work = with_campaigns_accepted(seg)
    cols = list(dict.fromkeys([*[c for _, c in MEDIAN_MEASURES], *RADAR_FEATURES]))
    medians = _segment_and_population_medians(work, cols)
    whole = work.agg(F.max("Dt_Customer").alias("max_dt"), *[F.min(F.col(f).cast("double")).alias(f"lo_{f}") for f in RADAR_FEATURES],
                     *[F.max(F.col(f).cast("double")).alias(f"hi_{f}") for f in RADAR_FEATURES]).withColumn("__pop", F.lit(POPULATION))
    return medians.join(whole, F.col("__key") == F.col("__pop"), "left").drop("__pop")


def _population(profile: DataFrame) -> Column:
    return profile.where(F.col("__key") == POPULATION).select(F.struct(*[c for c in profile.columns if c != "__key"]).alias("p")).scalar()


def _of_segment(profile: DataFrame, cols) -> DataFrame:
    """The segments' rows, at most one per segment name."""
    return profile.where(F.col("__key") != POPULATION).select(F.col("__key").alias("Segmentation"), *[F.col(c).alias(f"sm_{c}") for c in cols])


def lookup_kpis(seg: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """L1: profile, scores and segment / population medians for every customer
    of ``seg``; ``profile`` is that of the whole table (default: of ``seg``)."""
    profile = segment_profile(seg) if profile is None else profile
    pop, max_dt = _population(profile), _population(profile)["max_dt"]
    j = seg.join(F.broadcast(_of_segment(profile, [c for _, c in MEDIAN_MEASURES])), "Segmentation", "left")
    return j.select(
        F.col("ID").alias("id"), F.col("Age").alias("age"), F.col("Income").alias("income"),
        F.col("Education").alias("education"), F.col("Marital_Status").alias("marital_status"),
        F.col("Kidhome").alias("kidhome"), F.col("Teenhome").alias("teenhome"),
        (F.col("Kidhome") + F.col("Teenhome")).alias("total_kids"), F.col("Dt_Customer").alias("dt_customer"),
        (F.datediff(max_dt, F.col("Dt_Customer")) / 365.25).alias("tenure_years"),
        F.col("Segmentation").alias("segmentation"),
        F.col("Recency").alias("recency"), F.col("Recency_Score").alias("recency_score"),
        F.col("Total_Purchases").alias("frequency"), F.col("Frequency_Score").alias("frequency_score"),
        F.col("Total_Spent").cast("double").alias("monetary"), F.col("Monetary_Score").alias("monetary_score"),
        F.col("RMF_Score").alias("rfm_score"), F.col("APV").alias("apv"),
        null_safe_sum(CAMPAIGN_COLUMNS).cast("bigint").alias("campaigns_accepted"),
        *[F.col(f"sm_{c}").alias(f"{k}_seg_median") for k, c in MEDIAN_MEASURES],
        *[pop[c].alias(f"{k}_pop_median") for k, c in MEDIAN_MEASURES],
    )


def tenure(seg: DataFrame) -> DataFrame:
    """L2: years since enrollment, relative to the latest enrollment."""
    max_dt = seg.select(F.max("Dt_Customer")).scalar()
    return seg.select("ID", (F.datediff(max_dt, F.col("Dt_Customer")) / 365.25).alias("tenure_years"))


def campaign_flags(seg: DataFrame) -> DataFrame:
    """L3: accepted / declined per campaign, with the customer's total."""
    n = null_safe_sum(CAMPAIGN_COLUMNS).cast("bigint")
    pairs = [(lbl, F.when(F.col(c) == 1, "Accepted").otherwise("Declined")) for c, lbl in zip(CAMPAIGN_COLUMNS, CAMPAIGN_LABELS)]
    return seg.select("ID", n.alias("campaigns_accepted"), unpivot_exprs(pairs, "campaign", "status").alias("kv")).select(
        "ID", "campaigns_accepted", "kv.*")


def lookup_radar(seg: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """L4: six radar features for each customer, their segment median and the
    population median, min–max scaled by the population (zero range → 1),
    Recency inverted so that higher reads better. ``profile`` as in L1."""
    work = with_campaigns_accepted(seg)
    profile = segment_profile(seg) if profile is None else profile
    pop = _population(profile)

    def norm(f: str, v: Column) -> Column:
        lo, hi = pop[f"lo_{f}"], pop[f"hi_{f}"]
        rng = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
        x = (v - lo) / rng
        return 1 - x if f == "Recency" else x

    j = work.join(F.broadcast(_of_segment(profile, RADAR_FEATURES)), "Segmentation", "left")
    pairs = [(f, F.struct(norm(f, F.col(f).cast("double")).alias("customer"),
                          norm(f, F.col(f"sm_{f}")).alias("segment_median"),
                          norm(f, pop[f]).alias("population_median"))) for f in RADAR_FEATURES]
    return j.select("ID", "Segmentation", unpivot_exprs(pairs, "feature", "v").alias("kv")).select(
        "ID", "Segmentation", "kv.feature", "kv.v.*")


def _vs_segment(seg: DataFrame, cols, labels) -> DataFrame:
    seg_mean = seg.groupBy("Segmentation").agg(*[F.avg(c).alias(f"sm_{c}") for c in cols])
    pop = seg.select(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("p")).scalar()
    j = seg.join(F.broadcast(seg_mean), "Segmentation", "left")
    pairs = [(labels[c], F.struct(F.col(c).cast("double").alias("customer"),
                                  F.col(f"sm_{c}").alias("segment_mean"),
                                  pop[c].alias("population_mean"))) for c in cols]
    return j.select("ID", "Segmentation", unpivot_exprs(pairs, "category", "v").alias("kv")).select(
        "ID", "Segmentation", "kv.category", "kv.v.*")


def lookup_spend(seg: DataFrame) -> DataFrame:
    """Spend per category — customer vs segment mean vs population mean."""
    return _vs_segment(seg, PRODUCT_COLUMNS, {c: product_label(c) for c in PRODUCT_COLUMNS})


def lookup_channels(seg: DataFrame) -> DataFrame:
    """Purchases per channel — same three values."""
    return _vs_segment(seg, list(CHANNEL_COLUMNS), CHANNEL_COLUMNS)


def segment_scorecard(seg: DataFrame) -> DataFrame:
    """Per-segment KPIs beside the population baseline."""
    measures = [("rfm", "RMF_Score"), ("total_spent", "Total_Spent"), ("total_purchases", "Total_Purchases"),
                ("recency", "Recency"), ("apv", "APV")]
    base = seg.select(F.struct(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(k) for k, c in measures], F.avg("Response").alias("response")
    ).alias("b")).scalar()
    g = seg.groupBy("Segmentation").agg(
        F.count(F.lit(1)).alias("customers"), *[F.avg(c).alias(f"avg_{k}") for k, c in measures],
        F.avg("Response").alias("response_rate"))
    out = [F.col("Segmentation"), F.col("customers"), base["n"].alias("baseline_customers")]
    for k, _ in measures:
        out += [F.col(f"avg_{k}"), base[k].alias(f"avg_{k}_baseline")]
    out += [F.col("response_rate"), base["response"].alias("response_rate_baseline")]
    return g.select(*out)


def segment_playbook(seg: DataFrame) -> DataFrame:
    """Persona and actions per segment present in the data; actions in
    two columns, the first holding the larger half."""
    rows = [(s, i, PERSONAS[s], ACTIONS[s]) for i, s in enumerate(SEGMENT_ORDER)]
    dim = seg.sparkSession.createDataFrame(rows, "Segmentation string, seg_order int, persona string, actions array<string>")
    counts = seg.groupBy("Segmentation").agg(F.count(F.lit(1)).alias("customers"))
    j = F.broadcast(dim).join(counts, "Segmentation")
    ex = j.select("Segmentation", "customers", "persona", F.size("actions").alias("n"),
                  F.posexplode("actions").alias("action_no", "action"))
    half = F.floor((F.col("n") + 1) / 2)
    return ex.select("Segmentation", "customers", "persona", F.col("action_no").cast("bigint").alias("action_no"), "action",
                     F.when(F.col("action_no") < half, 1).otherwise(2).cast("bigint").alias("column_no"))
