from pyspark.sql import functions as F

from cohortlens.operators import clean, rfm_ml
from cohortlens.plans.registry import raw, rfm_models
from cohortlens.sources import io
from cohortlens.streaming.scoring import run_dated_scoring_stream, run_scoring_stream

SF = "/root/testdata/sf0.001"


def test_stream_restart_scores_each_customer_once(spark):
    r = raw(spark, SF)
    models = rfm_models(spark, SF)
    src, sink, ckpt = io.shared_path(spark, "src"), io.shared_path(spark, "sink"), io.shared_path(spark, "ckpt")
    r.where(F.col("ID") % 2 == 0).write.mode("append").parquet(src)
    run_scoring_stream(spark, src, r.schema, models, sink, ckpt)
    first = spark.read.parquet(sink).count()
    # new files arrive; the restarted query picks up only those
    r.where(F.col("ID") % 2 == 1).write.mode("append").parquet(src)
    run_scoring_stream(spark, src, r.schema, models, sink, ckpt)
    out = spark.read.parquet(sink)
    assert first == r.where(F.col("ID") % 2 == 0).count()
    assert out.count() == r.count() == out.select("ID").distinct().count()
    batch = rfm_ml.score_new(r, models)
    assert out.exceptAll(batch.select(*out.columns)).count() == 0


def test_text_dates_are_scored_and_others_set_aside(spark):
    """Batches of different formats, bad rows in the dead-letter sink, one copy after a restart."""
    r = raw(spark, SF).where("Dt_Customer IS NOT NULL")
    models = rfm_models(spark, SF)
    src, sink, dead, ckpt = (io.shared_path(spark, x) for x in ("src", "sink", "dead", "ckpt"))
    iso, day = r.where("ID % 3 = 0"), r.where("ID % 3 = 1")
    text = iso.withColumn("Dt_Customer", F.date_format("Dt_Customer", "yyyy-MM-dd"))
    bad = text.limit(2).withColumn("Dt_Customer", F.lit("no date"))
    text.union(bad).union(text.limit(1).withColumn("Dt_Customer", F.lit(None).cast("string"))).coalesce(1).write.parquet(src)
    run_dated_scoring_stream(spark, src, text.schema, models, sink, dead, ckpt)
    day.withColumn("Dt_Customer", F.date_format("Dt_Customer", "dd/MM/yyyy")).coalesce(1).write.mode("append").parquet(src)
    run_dated_scoring_stream(spark, src, text.schema, models, sink, dead, ckpt)
    run_dated_scoring_stream(spark, src, text.schema, models, sink, dead, ckpt)  # nothing new
    out = spark.read.parquet(sink)
    both = iso.union(day)
    expected = rfm_ml.score_new(both, models).join(both.select("ID", "Dt_Customer"), "ID")
    assert out.count() == both.count() and out.drop("batch").exceptAll(expected.select(*out.drop("batch").columns)).count() == 0
    letters = spark.read.parquet(dead)
    assert letters.count() == 3 and letters.where("Dt_Customer IS NULL").count() == 1


def test_a_batch_no_format_can_read_is_set_aside_whole(spark):
    df = spark.createDataFrame([(1, "2020-01-31"), (2, "31-01-2020"), (3, "1/31/2020")], "ID long, Dt_Customer string")
    dated, dead = clean.split_by_date(df.where("ID < 3"))
    assert dated.count() == 0 and dead.count() == 2
    dated, dead = clean.split_by_date(df.where("ID <> 2"))
    assert [str(x.Dt_Customer) for x in dated.collect()] == ["2020-01-31"] and [x.ID for x in dead.collect()] == [3]


def test_a_batch_run_again_leaves_one_copy(spark):
    r = raw(spark, SF).where("Dt_Customer IS NOT NULL").limit(20)
    src, sink, dead = (io.shared_path(spark, x) for x in ("src", "sink", "dead"))
    r.write.parquet(src)
    for _ in range(2):  # the second checkpoint knows nothing of the first run
        run_dated_scoring_stream(spark, src, r.schema, rfm_models(spark, SF), sink, dead, io.shared_path(spark, "ckpt"))
    assert spark.read.parquet(sink).count() == 20
