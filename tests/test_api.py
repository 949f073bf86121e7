import pytest

from cohortlens import api
from cohortlens.operators import stats
from cohortlens.plans.registry import raw, segmented, treated

SF = "/root/testdata/sf0.001"


def test_reference_style_entry_points(spark):
    t, r, seg = treated(spark, SF), raw(spark, SF), segmented(spark, SF)
    syn = api.generate_synthetic_campaign_data(t, stats.group_means(t), stats.group_stds(t), r, n_rows=500)
    checks = api.validate_synthetic_campaign_data(syn, r, expected_rows=500)
    assert checks["row_count"] == 500 and checks["columns_match"] and checks["negative_value_columns"] == []
    assert len(checks) == 8
    kpi = api.kpi_scorecard(t)
    assert kpi["total_customers"] == t.count()
    cid = seg.first()["ID"]
    k = api.lookup_kpis(seg, cid)
    assert k["id"] == cid and k["segmentation"] in ("Inactive", "Occasional", "Moderate", "Loyal", "Premium")
    with pytest.raises(KeyError):
        api.lookup_kpis(seg, -5)
    sc = api.segment_scorecard(seg.where(seg.Segmentation == k["segmentation"]), seg)
    assert sc["baseline_customers"] == seg.count()
    with pytest.raises(ValueError):
        api.generate_synthetic_campaign_data(t, stats.group_means(t), stats.group_stds(t), r, n_rows=0)


def test_dashboard_names(spark):
    t, seg = treated(spark, SF), segmented(spark, SF)
    n = t.count()
    for f in (api.demo_age_hist, api.demo_income_hist, api.spend_total_distribution):
        assert f(t).count() > 1
    assert api.demo_education_donut(t).agg({"Frequency": "sum"}).first()[0] == n
    assert api.demo_marital_donut(t).agg({"Frequency": "sum"}).first()[0] == n
    heat = api.demo_household_heatmap(t).collect()
    assert sum(sum(r[1:]) for r in heat) == n
    assert api.demo_acquisition_curve(t).count() > 0
    assert api.spend_highest_breakdown(t).count() > 0
    for f in (api.spend_vs_income_scatter, api.channel_web_visits_vs_purchases):
        assert f(t).count() == n
    assert api.campaign_recency_vs_response(t).count() == t.select("Response").distinct().count()
    for f in (api.cluster_3d_scatter, api.segments_parallel_coords):
        assert f(seg).count() == n
    cid = seg.first()["ID"]
    assert api.lookup_3d_highlight(seg, cid).where("highlight").first()["ID"] == cid


def test_plot_arguments(spark):
    seg = segmented(spark, SF)
    first = seg.orderBy("ID").first()

    def row(df):
        return df.where(f"ID = {first.ID}").first()
    assert row(api.spend_vs_income_scatter(seg)).color == first.Highest_Spent
    assert row(api.spend_vs_income_scatter(seg, color_by="Education")).color == first.Education
    assert row(api.cluster_3d_scatter(seg)).color == first.Segmentation
    assert row(api.cluster_3d_scatter(seg, "Cluster_Recency")).color == str(first.Cluster_Recency)
    two = row(api.cluster_pairwise_2d(seg, "Recency", "Total_Spent", color_by="Cluster_Monetary"))
    assert (two.x, two.y, two.color) == (first.Recency, first.Total_Spent, str(first.Cluster_Monetary))
    assert row(api.lookup_3d_highlight(seg, first.ID, color_by="Cluster_Frequency")).color == str(first.Cluster_Frequency)
