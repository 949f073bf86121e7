"""Query registry: name → (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import AbstractContextManager, nullcontext
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import DEFAULT
from cohortlens.operators.clean import treat
from cohortlens.sources.io import shared_path
from cohortlens.sources.mart import raw_campaign

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def add(name: str, fn: Builder, sql: str | None = None) -> None:
    REGISTRY[name] = (fn, sql)


def rounded(build: Builder, **digits: int) -> Builder:
    """The query with some columns rounded to so many digits, as its SQL has
    them; the operators themselves keep every digit."""
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = build(spark, sf_dir)
        return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in out.columns])
    return fn


_MEMO: dict[tuple, DataFrame] = {}


def materialized(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
                 writing: AbstractContextManager | None = None) -> DataFrame:
    """Build a shared intermediate table once per session and scale, written
    as Parquet below the shared checkpoint folder (cuts the lineage, survives
    executor loss, and later queries read only the columns and rows they need). Used for the mart, the treated table and
    derived tables several queries read (synthetic rows, the warehouse table,
    the search result); the reference likewise persists its treated table.
    ``writing`` is entered for the write only, not for what ``build`` runs."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    df = _MEMO.get(key)
    if df is None:
        path = shared_path(spark, "base", name)
        built = build()
        with writing or nullcontext():
            built.write.parquet(path)
        df = spark.read.parquet(path)
        _MEMO[key] = df
    return df


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "raw", lambda: raw_campaign(spark, sf_dir))


def treated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "treated", lambda: treat(raw(spark, sf_dir), DEFAULT))


_MODELS: dict[tuple, dict] = {}


def rfm_models(spark: SparkSession, sf_dir: str) -> dict:
    """R2b component models, fitted once per session and scale."""
    from cohortlens.operators.rfm import fit_rfm
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _MODELS:
        _MODELS[key] = fit_rfm(treated(spark, sf_dir), DEFAULT)
    return _MODELS[key]


def segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow projection (labels, scores, segment, APV as literal-centre
    expressions) over the checkpointed treated table: recomputing it is a
    scan, so it is not written a second time."""
    from cohortlens.operators.rfm import apply_rfm
    return apply_rfm(treated(spark, sf_dir), rfm_models(spark, sf_dir))


def segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians and bounds that the lookups compare with, made once."""
    from cohortlens.operators import lookup
    return materialized(spark, sf_dir, "segment_profile", lambda: lookup.segment_profile(segmented(spark, sf_dir)))


#: Customers per bucket of the lookup table.
BUCKET_ROWS = 1_000_000


def segmented_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segmented table bucketed and sorted by ID, so that a point lookup
    reads one bucket, and of it the row groups around the ID."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "segmented_by_id")
    if key not in _MEMO:
        seg = segmented(spark, sf_dir)
        buckets = max(8, seg.count() // BUCKET_ROWS)
        name = f"cohortlens_segmented_{uuid.uuid4().hex}"
        (seg.repartition(buckets, "ID").write.bucketBy(buckets, "ID").sortBy("ID")
         .option("path", shared_path(spark, "base", "segmented_by_id")).saveAsTable(name))
        _MEMO[key] = spark.table(name)
    return _MEMO[key]


@lru_cache(maxsize=1)
def load_all() -> dict[str, tuple[Builder, str | None]]:
    # importing the modules fills REGISTRY
    from cohortlens.plans import (  # noqa: F401
        q_clean, q_io, q_lookup, q_ml, q_profile, q_reports, q_rfm, q_stats, q_synth,
    )
    return dict(REGISTRY)
