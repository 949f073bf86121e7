"""Entry points under the names and signatures users of the original
application call, backed by the Spark operators. Functions that returned a
dict there return a dict here (computed by one small aggregate); everything
else returns a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import SEGMENT_ORDER
from cohortlens.operators import lookup, profile, reports, rfm, stats, synth
from cohortlens.operators.synth import GenerationMetadata
from cohortlens.sources import io


# -- synthetic expansion -------------------------------------------------------------
def get_synthetic_output_columns(raw_df: DataFrame | Sequence[str]) -> list[str]:
    cols = raw_df.columns if isinstance(raw_df, DataFrame) else list(raw_df)
    return synth.get_synthetic_output_columns(cols)


def prepare_generation_metadata(treated_df: DataFrame, grouped_mean_df: DataFrame, grouped_std_df: DataFrame,
                                raw_df: DataFrame, *, min_group_size: int = 10) -> GenerationMetadata:
    return synth.prepare_generation_metadata(treated_df, grouped_mean_df, grouped_std_df, raw_df,
                                             min_group_size=min_group_size)


def generate_synthetic_campaign_data(treated_df: DataFrame, grouped_mean_df: DataFrame, grouped_std_df: DataFrame,
                                     raw_df: DataFrame, *, n_rows: int = 1_000_000, random_state: int = 42,
                                     noise_scale: float = 1.0, metadata: GenerationMetadata | None = None) -> DataFrame:
    """Argument checks first, then metadata (or the precomputed one), then the
    shuffle-free generator."""
    if n_rows <= 0:
        raise ValueError("n_rows must be greater than zero.")
    if noise_scale < 0:
        raise ValueError("noise_scale must be non-negative.")
    md = metadata or synth.prepare_generation_metadata(treated_df, grouped_mean_df, grouped_std_df, raw_df)
    return synth.generate_synthetic(treated_df.sparkSession, md, n_rows=n_rows, random_state=random_state,
                                    noise_scale=noise_scale)


def write_synthetic_dataset(df: DataFrame, output_path: str, *, file_format: str = "parquet", index: bool = False) -> str:
    """Writes the rows and returns the path. ``index`` adds a column ``index``
    that numbers them from 0 in the order of their ID, as the generator's are."""
    return synth.write_synthetic_dataset(synth.with_index(df) if index else df, output_path, file_format=file_format)["path"]


def validate_synthetic_campaign_data(synthetic_df: DataFrame, raw_df: DataFrame, *, expected_rows: int | None = None) -> dict:
    """The check table as a dict: lists for the column checks, booleans for
    the pass/fail checks, the row count as an int."""
    out = {}
    for r in synth.validate_synthetic(synthetic_df, raw_df, expected_rows).collect():
        v = r["value"]
        if r["check"] == "row_count":
            out["row_count"] = int(v)
        elif v in ("true", "false"):
            out[r["check"]] = v == "true"
        else:
            out[r["check"]] = [x for x in v.split(",") if x]
    return out


def summarize_group_proportions(original_df: DataFrame, synthetic_df: DataFrame) -> DataFrame:
    return synth.proportion_comparison(original_df, synthetic_df)


# -- profiling ---------------------------------------------------------------------
def dataset_info(df: DataFrame) -> DataFrame:
    return profile.column_profile(df)


# -- dashboard -------------------------------------------------------------------
def kpi_scorecard(df: DataFrame) -> dict:
    return stats.kpi_scorecard(df).first().asDict()


def segments_comparison_df(df: DataFrame) -> DataFrame:
    return rfm.segment_comparison(df)


def segment_count_bar(df: DataFrame) -> DataFrame:
    return rfm.segment_counts(df)


def segment_scorecard(segment_df: DataFrame, baseline_df: DataFrame) -> dict:
    """Scorecard of one segment slice against a baseline frame."""
    measures = [("rfm", "RMF_Score"), ("total_spent", "Total_Spent"), ("total_purchases", "Total_Purchases"),
                ("recency", "Recency"), ("apv", "APV")]
    s = segment_df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(k) for k, c in measures],
                       F.avg("Response").alias("r")).first()
    b = baseline_df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(k) for k, c in measures],
                        F.avg("Response").alias("r")).first()
    out = {"customers": s["n"], "baseline_customers": b["n"]}
    for k, _ in measures:
        out[f"avg_{k}"], out[f"avg_{k}_baseline"] = s[k], b[k]
    out["response_rate"], out["response_rate_baseline"] = s["r"], b["r"]
    return out


_PROFILES: dict[tuple, DataFrame] = {}


def _profile(df: DataFrame) -> DataFrame:
    """The segment profile of a segmented table, written on the first lookup
    in it; later lookups read its few rows."""
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash())
    if key not in _PROFILES:
        path = io.shared_path(df.sparkSession, "segment_profile")
        lookup.segment_profile(df).write.parquet(path)
        _PROFILES[key] = df.sparkSession.read.parquet(path)
    return _PROFILES[key]


def lookup_kpis(df: DataFrame, customer_id: int) -> dict:
    one = reports.customer_row(df, customer_id)  # KeyError when absent
    return lookup.lookup_kpis(one, _profile(df)).first().asDict()


def spend_product_share(df: DataFrame) -> DataFrame:
    return stats.product_share(df)


def channel_mix(df: DataFrame) -> DataFrame:
    return stats.channel_mix(df)


def channel_preference_by(df: DataFrame, dimension: str = "Education") -> DataFrame:
    return stats.channel_preference_by(df, dimension)


def campaign_response_rates(df: DataFrame) -> DataFrame:
    return stats.campaign_rates(df)


def campaign_acceptance_distribution(df: DataFrame) -> DataFrame:
    return stats.campaigns_accepted_dist(df)


def campaign_response_by(df: DataFrame, dimension: str = "Education") -> DataFrame:
    return stats.response_by(df, dimension)


def cross_spend_heatmap(df: DataFrame) -> DataFrame:
    return stats.spend_pivot(df)


def cross_top_decile_profile(df: DataFrame) -> DataFrame:
    return stats.top_decile_profile(df)


def lookup_spend_vs_segment(df: DataFrame, customer_id: int) -> DataFrame:
    reports.customer_row(df, customer_id)
    return lookup.lookup_spend(df).where(F.col("ID") == customer_id)


def lookup_channels_vs_segment(df: DataFrame, customer_id: int) -> DataFrame:
    reports.customer_row(df, customer_id)
    return lookup.lookup_channels(df).where(F.col("ID") == customer_id)


def lookup_radar(df: DataFrame, customer_id: int) -> DataFrame:
    return lookup.lookup_radar(reports.customer_row(df, customer_id), _profile(df))


def demo_age_hist(df: DataFrame) -> DataFrame:
    return profile.histogram(df, "Age", 30)


def demo_income_hist(df: DataFrame) -> DataFrame:
    return profile.histogram(df, "Income", 40)


def demo_education_donut(df: DataFrame) -> DataFrame:
    return stats.frequency(df, "Education")


def demo_marital_donut(df: DataFrame) -> DataFrame:
    return stats.frequency(df, "Marital_Status")


def demo_household_heatmap(df: DataFrame) -> DataFrame:
    return stats.household_crosstab(df)


def demo_acquisition_curve(df: DataFrame) -> DataFrame:
    return reports.acquisition_curve(df)


def spend_highest_breakdown(df: DataFrame) -> DataFrame:
    return stats.highest_spent_counts(df)


def spend_total_distribution(df: DataFrame) -> DataFrame:
    return profile.histogram(df, "Total_Spent", 40)


def _color(color_by: str):
    """The colour column; cluster labels are categories, so text."""
    c = F.col(color_by)
    return (c.cast("string") if color_by.startswith("Cluster_") else c).alias("color")


def spend_vs_income_scatter(df: DataFrame, color_by: str = "Highest_Spent") -> DataFrame:
    return df.select("ID", "Income", "Total_Spent", "Highest_Spent", "Age", "Total_Purchases", _color(color_by))


def channel_web_visits_vs_purchases(df: DataFrame) -> DataFrame:
    return df.select("ID", "NumWebVisitsMonth", "NumWebPurchases", "Total_Spent", "Income")


def campaign_recency_vs_response(df: DataFrame) -> DataFrame:
    return profile.box_stats_by(df, "Recency", "Response")


def cluster_3d_scatter(df: DataFrame, color_by: str = "Segmentation") -> DataFrame:
    """Points in RFM space; ``color_by`` takes the segment or a cluster column."""
    return df.select("ID", "Recency", "Total_Purchases", "Total_Spent", "Segmentation", _color(color_by))


def cluster_pairwise_2d(df: DataFrame, x_dim: str, y_dim: str, color_by: str = "Segmentation") -> DataFrame:
    return df.select("ID", F.col(x_dim).alias("x"), F.col(y_dim).alias("y"), _color(color_by))


def segments_parallel_coords(df: DataFrame) -> DataFrame:
    """Recency, purchases, spend and RMF_Score of each customer with the
    number of its segment, lowest first."""
    order = F.array(*[F.lit(x) for x in SEGMENT_ORDER])
    return df.select("ID", "Recency", "Total_Purchases", "Total_Spent", "RMF_Score", "Segmentation",
                     (F.array_position(order, F.col("Segmentation")) - 1).alias("segment_code"))


def lookup_3d_highlight(df: DataFrame, customer_id: int, color_by: str = "Segmentation") -> DataFrame:
    """The points of all customers, the chosen one marked."""
    reports.customer_row(df, customer_id)
    return cluster_3d_scatter(df, color_by).withColumn("highlight", F.col("ID") == customer_id)


# -- catalog -------------------------------------------------------------------
def table_creation(json_file: str, dataset: str, spark=None) -> str:
    spark = spark or SparkSession.active()
    io.create_dataset(spark, dataset)
    return io.table_creation(spark, json_file, dataset)

