"""Structured Streaming scorer for newly arriving customers (R11 on a stream).

Row-wise feature steps and the saved-centre scoring are pure projections, so
they run unchanged on a streaming DataFrame. The sink and its checkpoint live
in shared storage, so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortlens.config import DEFAULT, CampaignSchema
from cohortlens.operators.clean import engineer, split_by_date
from cohortlens.operators.rfm import ComponentModel, apply_rfm
from cohortlens.operators.rfm_ml import SCORE_COLUMNS, score_new


def score_stream(stream: DataFrame, models: dict[str, ComponentModel], cfg: CampaignSchema = DEFAULT) -> DataFrame:
    """Streaming DataFrame of raw customers → scored customers."""
    return score_new(stream, models, cfg)


def run_scoring_stream(spark: SparkSession, source_dir: str, schema: T.StructType, models: dict[str, ComponentModel],
                       sink_dir: str, checkpoint_dir: str, cfg: CampaignSchema = DEFAULT) -> str:
    """Score every file present in ``source_dir`` (availableNow trigger) into
    parquet under ``sink_dir``; returns the sink path."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    q = (score_stream(src, models, cfg).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint_dir).outputMode("append")
         .trigger(availableNow=True).start(sink_dir))
    q.awaitTermination()
    return sink_dir


def run_dated_scoring_stream(spark: SparkSession, source_dir: str, schema: T.StructType, models: dict[str, ComponentModel],
                             sink_dir: str, dead_letter_dir: str, checkpoint_dir: str, cfg: CampaignSchema = DEFAULT) -> str:
    """As :func:`run_scoring_stream` for files whose enrollment dates may be
    text: a batch's dates are parsed by the rule for a whole column and kept
    beside the scores; rows it can't read go to ``dead_letter_dir`` as they
    came. Each batch overwrites its own folder ``batch=<n>`` of either sink, so
    a batch that is run again after a failure leaves one copy."""
    def write(batch: DataFrame, n: int) -> None:
        dated, dead = split_by_date(batch)
        scored = apply_rfm(engineer(dated, cfg), models).select(*SCORE_COLUMNS, "Dt_Customer")
        scored.write.mode("overwrite").parquet(f"{sink_dir}/batch={n}")
        dead.write.mode("overwrite").parquet(f"{dead_letter_dir}/batch={n}")

    q = (spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink_dir
