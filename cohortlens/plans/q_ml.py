"""R1 search, R2a MLlib clustering, R10 persisted models, R11 scoring (batch and streaming)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.config import DEFAULT
from cohortlens.operators import rfm_ml
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, materialized, raw, rfm_models, treated
from cohortlens.sources import io
from cohortlens.streaming.scoring import run_dated_scoring_stream, run_scoring_stream


def rfm_search(s, d):
    return materialized(s, d, "rfm_search", lambda: rfm_ml.parameter_search(treated(s, d), DEFAULT))


def rfm_kmeans_ml(s, d):
    hist, models = rfm_ml.mllib_kmeans(treated(s, d), DEFAULT)
    return rfm_ml.mllib_cluster_table(hist, models)


def model_roundtrip(s, d):
    """MLlib models saved to shared storage, loaded and re-scored."""
    hist, models = rfm_ml.mllib_kmeans(treated(s, d), DEFAULT)
    paths = rfm_ml.save_mllib_models(models, io.shared_path(s, "models"))
    return rfm_ml.mllib_cluster_table(hist, rfm_ml.load_mllib_models(paths))


def saved_models(s, d):
    path = rfm_ml.save_centers(s, rfm_models(s, d), io.shared_path(s, "rfm_centers"))
    return rfm_ml.load_centers(s, path)


def score_new(s, d):
    """Every customer of the raw table (also those the cleaning dropped)
    scored with the centres saved after fitting on the treated table."""
    return rfm_ml.score_new(raw(s, d), saved_models(s, d), DEFAULT)


def score_new_stream(s, d):
    """R11 on Structured Streaming: raw customers land as parquet files in a
    shared folder and are scored by an availableNow streaming query."""
    r = raw(s, d)
    src = io.write_parquet(r, io.shared_path(s, "incoming"))
    sink = run_scoring_stream(s, src, r.schema, saved_models(s, d), io.shared_path(s, "scored"), io.shared_path(s, "stream_ckpt"))
    return s.read.parquet(sink)


def score_stream_dates(s, d):
    """C6 / R11 on a stream whose dates are day-first text; customers without
    a date end in the dead-letter sink."""
    r = raw(s, d).withColumn("Dt_Customer", F.date_format("Dt_Customer", "dd-MM-yyyy"))
    src = io.write_parquet(r, io.shared_path(s, "incoming_text"))
    sink, dead = io.shared_path(s, "scored_dates"), io.shared_path(s, "dead_letters")
    run_dated_scoring_stream(s, src, r.schema, saved_models(s, d), sink, dead, io.shared_path(s, "stream_ckpt"))
    return s.read.parquet(sink).select("ID", "RMF_Score", "Segmentation", "Dt_Customer")


def _score_sql() -> str:
    comps = DEFAULT.rfm_components
    k = DEFAULT.rfm_k

    def lab(a, v):
        return " + ".join(f"CASE WHEN {v} > ({a}.c{i} + {a}.c{i + 1}) / 2 THEN 1 ELSE 0 END" for i in range(k - 1))
    labs = ", ".join(f"CASE WHEN e.{vc} IS NOT NULL THEN CAST({lab('f_' + cc.lower(), 'e.' + vc)} AS BIGINT) END AS {cc}" for vc, cc, _ in comps)
    fins = ", ".join(f"(SELECT * FROM fin WHERE comp = {S.q(vc)}) f_{cc.lower()}" for vc, cc, _ in comps)
    names = {"Cluster_Frequency": "Frequency_Score", "Cluster_Recency": "Recency_Score", "Cluster_Monetary": "Monetary_Score"}
    joins = " ".join(f"LEFT JOIN ranks r_{cc.lower()} ON r_{cc.lower()}.comp = {S.q(vc)} AND r_{cc.lower()}.cl = s.{cc}" for vc, cc, _ in comps)
    order = ["Cluster_Frequency", "Cluster_Recency", "Cluster_Monetary"]
    rmf = " + ".join(f"r_{cc.lower()}.score" for cc in order)
    return S.with_ctes(
        *S.seg_base(), f"sc0 AS (SELECT e.ID, {labs} FROM eng e, {fins})",
        select=f"SELECT s.ID, s.Cluster_Frequency, s.Cluster_Monetary, s.Cluster_Recency, "
        + ", ".join(f"r_{cc.lower()}.score AS {names[cc]}" for cc in order)
        + f", CAST({rmf} AS BIGINT) AS RMF_Score, {S.segment_label('(' + rmf + ')')} AS Segmentation FROM sc0 s {joins}",
    )


add("rfm_search", rfm_search)
add("rfm_kmeans_ml", rfm_kmeans_ml)
add("model_roundtrip", model_roundtrip)
add("score_new", score_new, _score_sql())
add("score_new_stream", score_new_stream, _score_sql())
add("score_stream_dates", score_stream_dates, _score_sql().replace("SELECT s.ID,", "SELECT * EXCLUDE (Cluster_Frequency, Cluster_Monetary, "
    "Cluster_Recency, Frequency_Score, Recency_Score, Monetary_Score) FROM (SELECT r.Dt_Customer, s.ID,").replace(
    " FROM sc0 s ", " FROM sc0 s JOIN raw r ON r.ID = s.ID AND r.Dt_Customer IS NOT NULL ") + ")")
