"""RFM scoring and segmentation.

Clustering (R2b) is a deterministic one-dimensional Lloyd iteration, run until
no centre changes, on the prefix sums of :mod:`cohortlens.operators.lloyd`: the
customer table is reduced once to ``(component, value, weight)`` rows, and a
round reads their running sums at the k−1 boundaries.
Labels are "number of adjacent-centre midpoints strictly below the value", so
labels come out sorted by centre. Scores are the rank of the cluster mean
(R3/R4) and are applied to the customer table with literal maps, so labelling
and scoring are narrow projections without joins or shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.config import DEFAULT, SEARCH_SEED, SEGMENT_ORDER, CampaignSchema
from cohortlens.functions.exprs import segment_label
from cohortlens.operators.lloyd import Fit, PrefixSums, best_of_starts, boundaries, even_start, run


@dataclass
class ComponentModel:
    value_col: str
    cluster_col: str
    higher_is_better: bool
    centers: list[float]
    rounds: int
    nonempty: list[int]

    @property
    def midpoints(self) -> list[float]:
        c = self.centers
        return [(c[i] + c[i + 1]) / 2 for i in range(len(c) - 1)]

    def label(self, value: Column) -> Column:
        """Cluster label; a null value has none."""
        expr = F.lit(0)
        for m in self.midpoints:
            expr = expr + F.when(value > F.lit(m), 1).otherwise(0)
        return F.when(value.isNotNull(), expr.cast("bigint"))

    def score_map(self) -> dict[int, int]:
        """cluster label → score: rank of the cluster mean among non-empty
        clusters (ascending for F and M, descending for R)."""
        order = sorted(self.nonempty) if self.higher_is_better else sorted(self.nonempty, reverse=True)
        return {lab: i for i, lab in enumerate(order)}

    def score(self, label: Column) -> Column:
        m = self.score_map()
        arr = F.array(*[F.lit(m.get(i)) for i in range(len(self.centers))]).cast("array<bigint>")
        return F.element_at(arr, (label + 1).cast("int"))


def value_histogram(df: DataFrame, cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """(component, value, weight) for all RFM components in one pass."""
    comps = F.array(*[
        F.struct(F.lit(vc).alias("component"), F.col(vc).cast("bigint").alias("value"))
        for vc, _, _ in cfg.rfm_components
    ])
    return (
        df.select(F.explode(comps).alias("cv"))
        .select("cv.component", "cv.value")
        .where(F.col("value").isNotNull())
        .groupBy("component", "value")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def small_checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a derived table."""
    from cohortlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fit_rfm(df: DataFrame, cfg: CampaignSchema = DEFAULT, params: dict[str, dict] | None = None) -> dict[str, ComponentModel]:
    """Fit the three component models; returns centres per component.

    A component starts from evenly spaced centres and runs until no centre
    changes; after ``rfm_max_rounds`` rounds it raises. ``params`` gives k,
    init, n_init and max_iter of a component, as
    :func:`cohortlens.operators.rfm_ml.best_parameters` finds them: then the
    best of n_init drawn starts counts, of at most max_iter rounds each."""
    sums = PrefixSums.build(value_histogram(df, cfg))
    params = params or {}
    drawn = [(vc, p["k"], p["init"], p["n_init"], p["max_iter"]) for vc, p in params.items() if vc in sums.span]
    fits = {p[0]: Fit(p[0], c, 1) for p, c in zip(drawn, best_of_starts(sums, drawn, SEARCH_SEED))}
    even = [Fit(vc, even_start(sums, vc, cfg.rfm_k), cfg.rfm_max_rounds) for vc, _, _ in cfg.rfm_components
            if vc in sums.span and vc not in fits]
    run(sums, even)
    for f in even:
        if not f.settled:
            raise RuntimeError(f"the clustering of {f.component} still moved after {f.rounds} rounds")
    fits |= {f.component: f for f in even}
    sums.read({(f.component, b) for f in fits.values() for b in boundaries(f.centers)})
    return {vc: ComponentModel(vc, cc, hib, fits[vc].centers, fits[vc].rounds,
                               [i for i, (w, _, _) in enumerate(sums.clusters(vc, fits[vc].centers)) if w])
            for vc, cc, hib in cfg.rfm_components if vc in fits}


def apply_rfm(df: DataFrame, models: dict[str, ComponentModel]) -> DataFrame:
    """R2 labels, R4 scores, R5 RMF_Score, R6 Segmentation, R7 APV."""
    by_cluster = {m.cluster_col: m for m in models.values()}
    f, mo, r = by_cluster["Cluster_Frequency"], by_cluster["Cluster_Monetary"], by_cluster["Cluster_Recency"]
    out = df.select(
        "*",
        f.label(F.col(f.value_col)).alias("Cluster_Frequency"),
        mo.label(F.col(mo.value_col)).alias("Cluster_Monetary"),
        r.label(F.col(r.value_col)).alias("Cluster_Recency"),
    )
    out = out.select(
        "*",
        f.score(F.col("Cluster_Frequency")).alias("Frequency_Score"),
        r.score(F.col("Cluster_Recency")).alias("Recency_Score"),
        mo.score(F.col("Cluster_Monetary")).alias("Monetary_Score"),
    )
    rmf = F.col("Frequency_Score") + F.col("Recency_Score") + F.col("Monetary_Score")
    return out.select("*", rmf.alias("RMF_Score")).select(
        "*",
        segment_label(F.col("RMF_Score")).alias("Segmentation"),
        F.when(F.col("Total_Purchases") > 0, F.col("Total_Spent") / F.col("Total_Purchases"))
        .otherwise(F.lit(0.0)).alias("APV"),
    )


def segment(treated: DataFrame, cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """Treated → segmented table."""
    return apply_rfm(treated, fit_rfm(treated, cfg))


def cluster_ranks(seg: DataFrame, cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """Mean value per cluster and its rank (F, M ascending; R descending)."""
    parts = []
    for vc, cc, hib in cfg.rfm_components:
        g = seg.where(F.col(cc).isNotNull()).groupBy(F.col(cc).alias("cluster")).agg(F.avg(vc).alias("mean"))
        w = Window.orderBy(F.col("mean").asc() if hib else F.col("mean").desc())
        parts.append(g.select(F.lit(vc).alias("component"), "cluster", "mean",
                              (F.row_number().over(w) - 1).cast("bigint").alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segment_dimension(spark) -> DataFrame:
    """Fixed five-row segment dimension (name, order)."""
    return spark.createDataFrame([(s, i) for i, s in enumerate(SEGMENT_ORDER)], "Segmentation string, seg_order int")


def segment_counts(seg: DataFrame) -> DataFrame:
    """Customers per segment in fixed order; absent segment → 0; share %."""
    counts = seg.groupBy("Segmentation").agg(F.count(F.lit(1)).alias("customers"))
    dim = F.broadcast(segment_dimension(seg.sparkSession))
    joined = dim.join(counts, "Segmentation", "left").select(
        "Segmentation", "seg_order", F.coalesce(F.col("customers"), F.lit(0)).cast("bigint").alias("customers")
    )
    return joined.select(
        "Segmentation", "customers",
        (F.col("customers") * 100 / F.sum("customers").over(Window.partitionBy())).alias("pct"),
        "seg_order",
    ).orderBy("seg_order").drop("seg_order")


def segment_comparison(seg: DataFrame) -> DataFrame:
    """One row per segment (all five; missing → null measures)."""
    g = seg.groupBy("Segmentation").agg(
        F.count("ID").alias("Customers"),
        F.avg("RMF_Score").alias("Avg_RFM_Score"),
        F.avg("Recency").alias("Avg_Recency"),
        F.avg("Total_Purchases").alias("Avg_Frequency"),
        F.avg("Total_Spent").alias("Avg_Monetary"),
        F.avg("APV").alias("Avg_APV"),
        F.avg("Response").alias("Response_Rate"),
    )
    dim = F.broadcast(segment_dimension(seg.sparkSession))
    j = dim.join(g, "Segmentation", "left")
    share = F.col("Customers") / F.sum("Customers").over(Window.partitionBy())
    return j.select(
        "Segmentation", "Customers", share.alias("Share"), "Avg_RFM_Score", "Avg_Recency", "Avg_Frequency",
        "Avg_Monetary", F.round("Avg_APV", 6).alias("Avg_APV"), "Response_Rate",
        "seg_order",
    ).orderBy("seg_order").drop("seg_order")


def apv_by_segment(seg: DataFrame) -> DataFrame:
    """Mean APV per segment, descending."""
    return seg.groupBy("Segmentation").agg(F.round(F.avg("APV"), 6).alias("mean_APV")).orderBy(F.desc("mean_APV"), "Segmentation")
