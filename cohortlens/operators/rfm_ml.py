"""Parameter search (R1), MLlib clustering (R2a), persisted models (R10) and
scoring of new customers with saved centres (R11)."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import DEFAULT, SEARCH_GRID, SEARCH_SEED, CampaignSchema
from cohortlens.operators.clean import engineer
from cohortlens.operators.lloyd import PrefixSums, best_of_starts, boundaries
from cohortlens.operators.rfm import ComponentModel, apply_rfm, small_checkpoint, value_histogram


def sample_grid(n_points: int = 10, seed: int = SEARCH_SEED) -> list[tuple]:
    """Seeded sample of the 3·2·5·4 = 120-point search grid."""
    grid = list(itertools.product(SEARCH_GRID["n_clusters"], SEARCH_GRID["init"], SEARCH_GRID["n_init"], SEARCH_GRID["max_iter"]))
    return random.Random(seed).sample(grid, n_points)


def parameter_search(treated: DataFrame, cfg: CampaignSchema = DEFAULT, n_points: int = 10, folds: int = 5,
                     points: list[tuple] | None = None) -> DataFrame:
    """K-fold search per component over a sample of the grid (or the given
    ``points``: k, init, n_init, max_iter).

    Folds come from a hash of ID (stable under any partitioning). A point is
    fitted on the other folds' histogram: ``n_init`` starts drawn by ``init``,
    each run for at most ``max_iter`` rounds, the one of least cost counts. Its
    score is the held-out −Σ w·min(v − c)² (the estimator's own score),
    averaged over folds; the best mean has rank 1. All fits of all components,
    folds and points share their jobs, and both sides are read from prefix sums."""
    points = points or sample_grid(n_points)
    sums = PrefixSums.build(fold_histograms(treated, cfg, folds))
    tasks = [(vc, f, *p) for vc, _, _ in cfg.rfm_components for f in range(folds) for p in points
             if f"{vc}|{f}|train" in sums.span and f"{vc}|{f}|test" in sums.span]
    fits = best_of_starts(sums, [(f"{vc}|{f}|train", *p) for vc, f, *p in tasks], SEARCH_SEED)
    sums.read({(f"{vc}|{f}|test", b) for (vc, f, *_), centers in zip(tasks, fits) for b in boundaries(centers)})
    scores: dict[tuple, list[float]] = {}
    for (vc, f, *p), centers in zip(tasks, fits):
        scores.setdefault((vc, *p), []).append(-float(sums.cost(f"{vc}|{f}|test", centers)))
    mean = {key: sum(x) / len(x) for key, x in scores.items()}
    rows = [(*key, m, 1 + sum(o > m for other, o in mean.items() if other[0] == key[0])) for key, m in mean.items()]
    return treated.sparkSession.createDataFrame(  # a row per component and point
        rows, "component string, k int, init string, n_init int, max_iter int, mean_test_score double, rank_test_score int")


def fold_histograms(treated: DataFrame, cfg: CampaignSchema = DEFAULT, folds: int = 5) -> DataFrame:
    """Histograms keyed ``component|fold|test`` (the fold's values) and
    ``component|fold|train`` (those of the other folds)."""
    fold = F.pmod(F.xxhash64(F.col("ID")), F.lit(folds))
    comps = F.array(*[F.struct(F.lit(vc).alias("c"), F.col(vc).cast("bigint").alias("v")) for vc, _, _ in cfg.rfm_components])
    per = (treated.select(fold.alias("fold"), F.explode(comps).alias("x"))
           .select("fold", F.col("x.c").alias("c"), F.col("x.v").alias("value")).where(F.col("value").isNotNull())
           .groupBy("c", "fold", "value").agg(F.count(F.lit(1)).alias("weight")))
    held = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("held")  # bounded fan-out
    side = F.when(F.col("held") == F.col("fold"), "test").otherwise("train")
    return (per.select("c", "fold", "value", "weight", held)
            .groupBy(F.concat_ws("|", "c", "held", side).alias("component"), "value").agg(F.sum("weight").alias("weight")))


def best_parameters(search: DataFrame) -> dict[str, dict]:
    """k, init, n_init and max_iter of the best-ranked point per component (of
    equals the smallest), for ``fit_rfm(params=...)``. One row per component
    reaches the driver."""
    point = F.struct("k", "init", "n_init", "max_iter")
    best = search.where("rank_test_score = 1").groupBy("component").agg(F.min(point).alias("p"))
    return {r["component"]: r["p"].asDict() for r in best.collect()}


def mllib_kmeans(treated: DataFrame, cfg: CampaignSchema = DEFAULT, n_init: int = 3, max_iter: int = 300):
    """``pyspark.ml`` KMeans per component on the weighted value
    histogram; the best of ``n_init`` seeds by training cost."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    hist = small_checkpoint(value_histogram(treated, cfg))
    models = {}
    for vc, _, _ in cfg.rfm_components:
        h = VectorAssembler(inputCols=["value"], outputCol="features").transform(
            hist.where(F.col("component") == vc).withColumn("value", F.col("value").cast("double")))
        best = None
        for seed in range(n_init):
            m = KMeans(k=cfg.rfm_k, initMode="k-means||", maxIter=max_iter, seed=SEARCH_SEED + seed,
                       weightCol="weight").fit(h)
            if best is None or m.summary.trainingCost < best.summary.trainingCost:
                best = m
        models[vc] = best
    return hist, models


def mllib_cluster_table(hist: DataFrame, models: dict) -> DataFrame:
    """Customers per predicted cluster and its centre, per component."""
    from pyspark.ml.feature import VectorAssembler
    parts = []
    for vc, m in models.items():
        h = VectorAssembler(inputCols=["value"], outputCol="features").transform(
            hist.where(F.col("component") == vc).withColumn("value", F.col("value").cast("double")))
        centers = [float(c[0]) for c in m.clusterCenters()]
        pred = m.transform(h).groupBy("prediction").agg(F.sum("weight").alias("customers"))
        cdf = hist.sparkSession.createDataFrame([(i, c) for i, c in enumerate(centers)], "prediction int, center double")
        parts.append(pred.join(F.broadcast(cdf), "prediction").select(
            F.lit(vc).alias("component"), F.col("prediction").cast("bigint").alias("cluster"),
            F.round("center", 4).alias("center"), F.col("customers").cast("bigint").alias("customers")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def save_mllib_models(models: dict, path: str) -> dict[str, str]:
    """MLlib models written to shared storage."""
    out = {}
    for vc, m in models.items():
        p = f"{path}/{vc}"
        m.write().overwrite().save(p)
        out[vc] = p
    return out


def load_mllib_models(paths: dict[str, str]) -> dict:
    from pyspark.ml.clustering import KMeansModel
    return {vc: KMeansModel.load(p) for vc, p in paths.items()}


def save_centers(spark: SparkSession, models: dict[str, ComponentModel], path: str) -> str:
    """R10 for the deterministic models: centres, non-empty clusters and
    orientation as a small parquet table."""
    rows = [(m.value_col, m.cluster_col, m.higher_is_better, i, c, i in m.nonempty, m.rounds)
            for m in models.values() for i, c in enumerate(m.centers)]
    spark.createDataFrame(rows, "value_col string, cluster_col string, higher_is_better boolean, cluster int, "
                                "center double, nonempty boolean, rounds int").write.mode("overwrite").parquet(path)
    return path


def load_centers(spark: SparkSession, path: str) -> dict[str, ComponentModel]:
    rows = spark.read.parquet(path).orderBy("value_col", "cluster").collect()
    models: dict[str, ComponentModel] = {}
    for r in rows:
        m = models.setdefault(r["value_col"], ComponentModel(r["value_col"], r["cluster_col"], r["higher_is_better"], [], r["rounds"], []))
        m.centers.append(r["center"])
        if r["nonempty"]:
            m.nonempty.append(r["cluster"])
    return models


SCORE_COLUMNS = ["ID", "Cluster_Frequency", "Cluster_Monetary", "Cluster_Recency", "Frequency_Score",
                 "Recency_Score", "Monetary_Score", "RMF_Score", "Segmentation"]


def score_new(customers: DataFrame, models: dict[str, ComponentModel], cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """Label, score and segment customers that were not part of the fit
    (a narrow projection with the saved centres)."""
    feats = customers if "Total_Spent" in customers.columns else engineer(customers, cfg)
    return apply_rfm(feats, models).select(*SCORE_COLUMNS)
