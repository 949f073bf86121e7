"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens",
                  event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench. A cluster job receives its session
    from the launcher and only needs :func:`ensure_checkpoint_dir`.
    ``event_log_dir`` writes Spark's event log there (stage/task timings
    without any UI)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Where it is unset, a local master (tests) gets a
    folder of its own; on a cluster, where executors don't see the driver's
    disk, that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="cohortlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


class per_expression_codegen:
    """Run an action with per-expression code generation instead of
    whole-stage codegen. Used for the synthetic generator: its single wide
    projection (~27 outputs over ~30 hash slices) compiles into one method too
    large for the JIT, which made it ~3.5× slower in measurement."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.prev = None

    def __enter__(self):
        self.prev = self.spark.conf.get("spark.sql.codegen.wholeStage")
        self.spark.conf.set("spark.sql.codegen.wholeStage", "false")
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.codegen.wholeStage", self.prev)
        return False
