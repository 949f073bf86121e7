"""Plan-shape checks: the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from cohortlens.config import DEFAULT
from cohortlens.functions.exprs import nearest
from cohortlens.functions.quantiles import quantile_wide
from cohortlens.operators import clean, lookup, profile, stats, synth
from cohortlens.plans.registry import raw, segmented, treated
from cohortlens.sources.mart import raw_campaign

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_prunes_columns(spark):
    p = plan(raw_campaign(spark, SF))
    # lineitem is read with only the four columns the spend needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_discount:double>" in p
    assert "l_shipdate" not in p and "CartesianProduct" not in p


def test_mart_rounds_and_sorts_lines_cheaply(spark):
    """A line's cents are not rounded by way of decimal text, and its category
    is a number of its part; the latest order is read without an exchange by customer."""
    p = raw_campaign(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "round((l_extendedprice" not in p and "round((l_discount" not in p
    assert "max(last_order" not in p
    sums = [x for x in p.splitlines() if "Aggregate [l_orderkey" in x]
    assert sums and all("StartsWith" not in x for x in sums)


def test_nearest_is_round(spark):
    vals = [0.0, -0.0, 0.5, -0.5, 1.5, -1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1.005 * 100, 8419704.499999999,
            4503599627370495.5, -4503599627370495.5, 4503599627370497.0, 1e15 + 0.5, 1e18, 123456.5 + 2**-36, 123456.5 - 2**-36, None]
    vals += [float(f"{i}.{i % 100:02d}") * 100 for i in range(900, 3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert df.where(~F.round("x").eqNullSafe(nearest(F.col("x")))).collect() == []


def test_global_stats_are_compiled(spark):
    """No aggregate has more columns than Spark generates code for."""
    df = synth.global_stats_frame(treated(spark, SF))
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    aggs = [x for x in final.splitlines() if "HashAggregate(" in x]
    assert len(aggs) >= 4 and all(re.search(r"\*\(\d+\) HashAggregate", x) for x in aggs)


def test_cleaning_has_no_cartesian_join(spark):
    p = plan(clean.treat(raw(spark, SF), DEFAULT))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_synthetic_generation_has_no_shuffle(spark):
    t = treated(spark, SF)
    md = synth.prepare_generation_metadata(t, stats.group_means(t), stats.group_stds(t), raw(spark, SF))
    p = plan(synth.generate_synthetic(spark, md, n_rows=1000))
    assert "Exchange" not in p and "Sort" not in p


def test_no_whole_group_percentile_buffers(spark):
    seg = segmented(spark, SF)
    for df in (lookup.lookup_kpis(seg), profile.describe_numeric(raw(spark, SF)), clean.impute_income(raw(spark, SF))):
        p = plan(df)
        assert "percentile(" not in p.replace("percentile_approx(", "")


def test_column_profile_approx_close_to_exact(spark):
    r = raw(spark, SF)
    exact = {x["Column"]: x["Unique_Values"] for x in profile.column_profile(r).collect()}
    approx = {x["Column"]: x["Unique_Values"] for x in profile.column_profile(r, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[c] - exact[c]) <= max(2, 0.1 * exact[c]) for c in exact)


def test_base_tables_are_parquet_read_in_part(spark):
    from cohortlens.plans.registry import load_all
    for name in ("segment_members", "customer_lookup", "kpi_scorecard"):
        p = plan(load_all()[name][0](spark, SF))
        assert "Scan parquet" in p or "FileScan parquet" in p, name
        assert "ExistingRDD" not in p and "NumWebVisitsMonth" not in p.replace("lookup", ""), name


def test_quantiles_exchange_counts_not_values(spark):
    """The only exchanges are of partial aggregates and what comes after them."""
    t = treated(spark, SF)
    for df in (profile.describe_numeric(raw(spark, SF)), quantile_wide(t, "Recency", [0.25, 0.5, 0.75], ["Response"])):
        lines = [x.strip(" :+-|") for x in plan(df).split("\n")]
        assert not any("SortMergeJoin" in x and "__b_" in x for x in lines)
        assert any("BroadcastHashJoin" in x and "__b_" in x for x in lines)


def test_box_statistics_exchange_no_rows(spark):
    """Groups' fences are read as a map: only partial aggregates are exchanged."""
    t = treated(spark, SF)
    for df in (profile.box_stats_by(t, "Recency", "Response"), profile.box_stats(t, ["Age", "Income"])):
        p = plan(df)
        assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p and "ShuffledHashJoin" not in p


def test_box_statistics_beyond_the_map(spark, monkeypatch):
    monkeypatch.setattr(profile, "GROUPS", 1)
    t = treated(spark, SF)
    many = profile.box_stats_by(t, "Recency", "Response")
    assert "Join" in plan(many)
    monkeypatch.undo()
    assert many.exceptAll(profile.box_stats_by(t, "Recency", "Response")).count() == 0


def test_distinct_counts_without_expand(spark):
    from pyspark.sql import functions as F
    df = spark.range(5000).select(
        F.col("id"), (F.col("id") % 7 - 3).alias("neg"), (F.col("id") * 10**15).alias("wide"), F.when(F.col("id") % 2 == 0, F.col("id") % 40_000).alias("some"),
        F.lit(None).cast("bigint").alias("none"), (F.col("id") % 11 / 2).alias("real"), F.concat(F.lit("s"), F.col("id") % 13).alias("text"),
        F.expr("date'2020-01-01' + int(id % 17)").alias("day"), (F.col("id") % 2 == 0).alias("flag"))
    out = profile.column_profile(df)
    assert {r.Column: r.Unique_Values for r in out.collect()} == {c: df.agg(F.count_distinct(c)).first()[0] for c in df.columns}
    assert "Expand" not in plan(out) and "Expand" not in plan(profile._distinct_counts(df, ["id", "neg", "some"]))


def test_kernel_density_is_exact_and_exchanges_no_values(spark):
    import math
    from pyspark.sql import functions as F
    df = spark.range(300).select((F.col("id") * F.col("id") % 97 + F.when(F.col("id") == 0, 4000).otherwise(0)).cast("double").alias("v"))
    xs = [r.v for r in df.collect()]
    out = profile.kde_grid(df, "v").orderBy("point").collect()
    n, mean = len(xs), sum(xs) / len(xs)
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (n - 1)) * n ** -0.2
    for r in out:
        at = min(xs) + (max(xs) - min(xs)) * r.point / 63
        exact = sum(math.exp(-0.5 * ((at - x) / h) ** 2) for x in xs)
        assert abs(r.kernel_sum - exact) <= 5.1e-7 + n * 1e-18
    assert len(out) == 64 and "hashpartitioning(v" not in plan(profile.kde_grid(df, "v"))
    same = spark.range(5).select(F.lit(2.0).alias("v"))
    assert profile.kde_grid(same, "v").count() == 64


def test_lookup_reads_one_bucket(spark):
    from cohortlens.plans.registry import segmented_by_id
    seg = segmented_by_id(spark, SF)
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # the plan names the buckets only without it
    before = spark.conf.get(auto)
    spark.conf.set(auto, "false")
    try:
        p = seg.where("ID = 5")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set(auto, before)
    assert "SelectedBucketsCount: 1 out of 8" in p
    assert seg.count() == segmented(spark, SF).count()


def test_lookups_compute_no_medians(spark):
    from cohortlens.plans.registry import load_all
    for name in ("lookup_kpis", "lookup_radar"):
        p = plan(load_all()[name][0](spark, SF))
        assert "percentile" not in p and "Window" not in p, name
