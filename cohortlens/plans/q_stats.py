"""Aggregation queries A1–A18, A20."""

from __future__ import annotations

from cohortlens.config import (
    CAMPAIGN_COLUMNS, CAMPAIGN_LABELS, CHANNEL_COLUMNS, EDUCATION_VALUES, GROUP_MEASURES,
    MARITAL_VALUES, MONEY_MEASURES, PRODUCT_COLUMNS, TOP_DECILE_FEATURES, INTEGER_NOISE_COLUMNS,
    product_label,
)
from cohortlens.operators import stats
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, raw, rounded, treated

T = S.base()


def sel(select: str) -> str:
    return S.with_ctes(*T, select=select)


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


add("raw_campaign", raw, S.with_ctes(S.mart(), select="SELECT * FROM raw"))
add("treated", treated, sel("SELECT * FROM treated"))

add("product_share", lambda s, d: stats.product_share(treated(s, d)), sel(
    "SELECT Product, round_even(Gross * 100 / sum(Gross) OVER (), 2) AS Pct, CAST(Gross AS BIGINT) AS Gross FROM ("
    + _union(f"SELECT {S.q(product_label(c))} AS Product, sum({c}) AS Gross FROM treated" for c in PRODUCT_COLUMNS)
    + ") ORDER BY Pct DESC, Product"
))


def _group_sql(agg: str, zero_null_ints: bool) -> str:
    cols = []
    for c in GROUP_MEASURES:
        if c in MONEY_MEASURES:
            cols.append(f"round_even({agg}({c}), 2) AS {c}")
        else:
            v = f"CAST({S.round_half_up(f'{agg}({c})')} AS BIGINT)"
            cols.append(f"coalesce({v}, 0) AS {c}" if zero_null_ints else f"{v} AS {c}")
    return sel(f"SELECT Marital_Status, Education, {', '.join(cols)} FROM treated GROUP BY Marital_Status, Education")


add("group_means", lambda s, d: stats.group_means(treated(s, d)), _group_sql("avg", False))
add("group_stds", lambda s, d: stats.group_stds(treated(s, d)), _group_sql("stddev_samp", True))
add("highest_spent_props", lambda s, d: stats.highest_spent_props(treated(s, d)), sel(
    "SELECT Marital_Status, Education, Highest_Spent, "
    "count(*) / sum(count(*)) OVER (PARTITION BY Marital_Status, Education) AS proportion "
    "FROM treated GROUP BY Marital_Status, Education, Highest_Spent"
))


def _freq_sql(col: str) -> str:
    return sel(
        f"SELECT {col}, count(*) AS Frequency, round_even(count(*) * 100 / sum(count(*)) OVER (), 2) AS Percentage "
        f"FROM treated GROUP BY {col} ORDER BY Frequency DESC, {col}"
    )


add("freq_marital", lambda s, d: stats.frequency(treated(s, d), "Marital_Status"), _freq_sql("Marital_Status"))
add("freq_education", lambda s, d: stats.frequency(treated(s, d), "Education"), _freq_sql("Education"))


def _crosstab_sql(pct: bool) -> str:
    cells = []
    for m in MARITAL_VALUES:
        cnt = f"count(*) FILTER (WHERE Marital_Status = {S.q(m)})"
        cells.append(f"round_even({cnt} * 100 / sum(count(*)) OVER (), 2) AS {m}" if pct else f"CAST({cnt} AS BIGINT) AS {m}")
    return sel(f"SELECT Education, {', '.join(cells)} FROM treated GROUP BY Education")


add("crosstab_abs", lambda s, d: stats.crosstab(treated(s, d)), _crosstab_sql(False))
add("crosstab_pct", lambda s, d: stats.crosstab(treated(s, d), pct=True), _crosstab_sql(True))
add("crosstab_raw", lambda s, d: stats.crosstab_cells(raw(s, d)), sel(
    "SELECT Education, Marital_Status, count(*) AS n, round_even(count(*) * 100 / sum(count(*)) OVER (), 2) AS pct "
    "FROM raw GROUP BY Education, Marital_Status"))
add("household_crosstab", lambda s, d: stats.household_crosstab(treated(s, d)), sel(
    "SELECT Kidhome, " + ", ".join(f"CAST(count(*) FILTER (WHERE Teenhome = {v}) AS BIGINT) AS teen_{v}" for v in (0, 1, 2))
    + " FROM treated GROUP BY Kidhome"
))
add("marital_values", lambda s, d: stats.distinct_values(raw(s, d), "Marital_Status"),
    sel("SELECT DISTINCT Marital_Status FROM raw"))

_any = " + ".join(f"coalesce({c}, 0)" for c in CAMPAIGN_COLUMNS)
add("kpi_scorecard", lambda s, d: stats.kpi_scorecard(treated(s, d)), sel(
    "SELECT count(*) AS total_customers, CAST(sum(Total_Spent) AS DOUBLE) AS total_revenue, "
    "avg(Total_Spent) AS avg_customer_value, avg(Response) AS last_campaign_response, "
    f"avg(CASE WHEN {_any} > 0 THEN 1 ELSE 0 END) AS cumulative_acceptance, avg(Complain) AS complaint_rate FROM treated"
))
add("highest_spent_counts", lambda s, d: stats.highest_spent_counts(treated(s, d)), sel(
    "SELECT Highest_Spent, count(*) AS customers, count(*) * 100 / sum(count(*)) OVER () AS pct "
    "FROM treated GROUP BY Highest_Spent ORDER BY customers, Highest_Spent"
))
add("channel_mix", lambda s, d: stats.channel_mix(treated(s, d)), sel(
    "SELECT Channel, CAST(total AS BIGINT) AS total, total * 100 / sum(total) OVER () AS pct FROM ("
    + _union(f"SELECT {S.q(l)} AS Channel, sum({c}) AS total FROM treated" for c, l in CHANNEL_COLUMNS.items()) + ")"
))


def _chan_by_sql(dim: str) -> str:
    return sel(_union(
        f"SELECT {dim}, {S.q(l)} AS Channel, avg({c}) AS Avg_purchases FROM treated GROUP BY {dim}"
        for c, l in CHANNEL_COLUMNS.items()
    ))


add("channel_by_education", lambda s, d: stats.channel_preference_by(treated(s, d), "Education"), _chan_by_sql("Education"))
add("channel_by_marital", lambda s, d: stats.channel_preference_by(treated(s, d), "Marital_Status"), _chan_by_sql("Marital_Status"))
add("campaign_rates", lambda s, d: stats.campaign_rates(treated(s, d)), sel(_union(
    f"SELECT {S.q(l)} AS Campaign, avg({c}) * 100 AS rate FROM treated" for c, l in zip(CAMPAIGN_COLUMNS, CAMPAIGN_LABELS)
)))
add("campaigns_accepted_dist", lambda s, d: stats.campaigns_accepted_dist(treated(s, d)), sel(
    f"SELECT CAST({_any} AS BIGINT) AS campaigns_accepted, count(*) AS customers, "
    "count(*) * 100 / sum(count(*)) OVER () AS pct FROM treated GROUP BY 1 ORDER BY 1"
))


def _resp_sql(dim: str) -> str:
    return sel(f"SELECT {dim}, avg(Response) * 100 AS response_rate FROM treated GROUP BY {dim} ORDER BY response_rate, {dim}")


add("response_by_education", lambda s, d: stats.response_by(treated(s, d), "Education"), _resp_sql("Education"))
add("response_by_marital", lambda s, d: stats.response_by(treated(s, d), "Marital_Status"), _resp_sql("Marital_Status"))
add("spend_pivot", lambda s, d: stats.spend_pivot(treated(s, d)), sel(
    "SELECT Marital_Status, "
    + ", ".join(f"avg(Total_Spent) FILTER (WHERE Education = {S.q(e)}) AS \"{e}\"" for e in EDUCATION_VALUES)
    + " FROM treated GROUP BY Marital_Status"
))


def _top_decile_sql() -> str:
    top = "Total_Spent >= (SELECT quantile_cont(Total_Spent, 0.9) FROM treated)"
    parts = []
    for f in TOP_DECILE_FEATURES:
        rng = f"coalesce(nullif(max({f}) - min({f}), 0), 1)"
        parts.append(
            f"SELECT {S.q(f)} AS feature, round((avg({f}) FILTER (WHERE {top}) - min({f})) / {rng}, 6) AS top, "
            f"round((avg({f}) FILTER (WHERE NOT ({top})) - min({f})) / {rng}, 6) AS rest FROM treated"
        )
    return sel(_union(parts))


add("top_decile_profile", rounded(lambda s, d: stats.top_decile_profile(treated(s, d)), top=6, rest=6), _top_decile_sql())
add("global_bounds", rounded(lambda s, d: stats.global_bounds(treated(s, d)), mean=4, std=4), sel(_union(
    f"SELECT {S.q(c)} AS \"column\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM treated"
    for c in INTEGER_NOISE_COLUMNS + ["Income", "Age"]
)))
