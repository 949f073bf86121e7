"""Profiling queries P1–P11 (raw and treated tables)."""

from __future__ import annotations

from cohortlens.config import RAW_COLUMNS
from cohortlens.operators import clean, profile
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, raw, rounded, treated

RAW_TYPES = {c: ("string" if c in ("Education", "Marital_Status") else "double" if c == "Income"
                 else "date" if c == "Dt_Customer" else "bigint") for c in RAW_COLUMNS}
NUMERIC_RAW = [c for c in RAW_COLUMNS if RAW_TYPES[c] in ("bigint", "double")]


def sel(select: str, *extra: str) -> str:
    return S.with_ctes(*S.base(), *extra, select=select)


def U(parts) -> str:
    return " UNION ALL ".join(parts)


add("table_overview", lambda s, d: profile.table_overview(raw(s, d)), sel(
    f"SELECT count(*) AS n_rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS n_columns, CAST("
    + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in RAW_COLUMNS) + " AS BIGINT) AS n_nulls FROM raw"
))
add("column_profile", lambda s, d: profile.column_profile(raw(s, d)), sel(U(
    f"SELECT {S.q(c)} AS \"Column\", {S.q(RAW_TYPES[c])} AS Type, CAST(count(DISTINCT {c}) AS BIGINT) AS Unique_Values, "
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS Nulls, "
    f"round_even(count(*) FILTER (WHERE {c} IS NULL) * 100 / count(*), 2) AS Pct_Nulls FROM raw"
    for c in RAW_COLUMNS
)))
add("null_columns", lambda s, d: profile.null_columns(raw(s, d)), sel(
    "SELECT \"Column\", Nulls, CAST(sum(Nulls) OVER () AS BIGINT) AS Total FROM (" + U(
        f"SELECT {S.q(c)} AS \"Column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS Nulls FROM raw" for c in RAW_COLUMNS
    ) + ") WHERE Nulls > 0 ORDER BY Nulls, \"Column\""
))
add("constant_columns", lambda s, d: profile.constant_columns(raw(s, d)), sel(
    "SELECT \"Column\", Value FROM (" + U(
        f"SELECT {S.q(c)} AS \"Column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS k, "
        f"CAST(min({c}) AS VARCHAR) AS Value FROM raw" for c in RAW_COLUMNS
    ) + ") WHERE k = 1"
))
add("describe_numeric", rounded(lambda s, d: profile.describe_numeric(raw(s, d), NUMERIC_RAW), mean=4, std=4, q25=4, q50=4, q75=4), sel(U(
    f"SELECT {S.q(c)} AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
    f"round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM raw"
    for c in NUMERIC_RAW
)))
add("scalar_stats", rounded(lambda s, d: profile.scalar_stats(treated(s, d)), mean=4, median=4, std=4), sel(U(
    f"SELECT {S.q(c)} AS \"column\", round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, "
    f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM treated"
    for c in ("Age", "Income")
)))


def _box_sql(src: str, c: str) -> str:
    q = f"(SELECT quantile_cont({c}, [0.25, 0.5, 0.75]) AS q FROM {src})"
    return (
        f"SELECT {S.q(c)} AS \"column\", q[1] AS q1, q[2] AS median, q[3] AS q3, q[1] - 1.5 * (q[3] - q[1]) AS lower_fence, "
        f"q[3] + 1.5 * (q[3] - q[1]) AS upper_fence, "
        f"min(CAST({c} AS DOUBLE)) FILTER (WHERE {c} >= q[1] - 1.5 * (q[3] - q[1]) AND {c} <= q[3] + 1.5 * (q[3] - q[1])) AS whisker_low, "
        f"max(CAST({c} AS DOUBLE)) FILTER (WHERE {c} >= q[1] - 1.5 * (q[3] - q[1]) AND {c} <= q[3] + 1.5 * (q[3] - q[1])) AS whisker_high, "
        f"CAST(count({c}) FILTER (WHERE NOT ({c} >= q[1] - 1.5 * (q[3] - q[1]) AND {c} <= q[3] + 1.5 * (q[3] - q[1]))) AS BIGINT) AS n_outliers "
        f"FROM {src}, {q} qq GROUP BY q"
    )


BOX_TREATED = ["Total_Purchases", "Total_Spent", "Age", "Income"]
add("box_stats", lambda s, d: profile.box_stats(treated(s, d), BOX_TREATED), sel(U(_box_sql("treated", c) for c in BOX_TREATED)))
add("box_outliers", lambda s, d: profile.box_outliers(clean.engineer(raw(s, d)), "Income"), sel(
    "SELECT ID, CAST(Income AS DOUBLE) AS value FROM eng, (SELECT quantile_cont(Income, [0.25, 0.5, 0.75]) AS q FROM eng) qq "
    "WHERE Income < q[1] - 1.5 * (q[3] - q[1]) OR Income > q[3] + 1.5 * (q[3] - q[1])"
))
add("age_box_outliers", lambda s, d: profile.box_outliers(clean.engineer(raw(s, d)), "Age"), sel(
    "SELECT ID, CAST(Age AS DOUBLE) AS value FROM eng, (SELECT quantile_cont(Age, [0.25, 0.5, 0.75]) AS q FROM eng) qq "
    "WHERE Age < q[1] - 1.5 * (q[3] - q[1]) OR Age > q[3] + 1.5 * (q[3] - q[1])"
))
add("recency_box_by_response", lambda s, d: profile.box_stats_by(treated(s, d), "Recency", "Response"), sel(
    "SELECT t.Response, q.q1, q.median, q.q3, q.lower_fence, q.upper_fence, "
    "min(CAST(Recency AS DOUBLE)) FILTER (WHERE Recency >= lower_fence AND Recency <= upper_fence) AS whisker_low, "
    "max(CAST(Recency AS DOUBLE)) FILTER (WHERE Recency >= lower_fence AND Recency <= upper_fence) AS whisker_high, "
    "CAST(count(*) FILTER (WHERE NOT (Recency >= lower_fence AND Recency <= upper_fence)) AS BIGINT) AS n_outliers "
    "FROM treated t JOIN (SELECT Response, q[1] AS q1, q[2] AS median, q[3] AS q3, q[1] - 1.5 * (q[3] - q[1]) AS lower_fence, "
    "q[3] + 1.5 * (q[3] - q[1]) AS upper_fence FROM (SELECT Response, quantile_cont(Recency, [0.25, 0.5, 0.75]) AS q "
    "FROM treated GROUP BY Response)) q ON t.Response = q.Response "
    "GROUP BY t.Response, q.q1, q.median, q.q3, q.lower_fence, q.upper_fence"
))


def _sturges(n: str) -> str:
    return f"CAST(CASE WHEN {n} <= 1 THEN 1 ELSE 1 + length(bin({n} - 1)) END AS BIGINT)"


def _hist_sql(src: str, c: str, bins: int | None) -> str:
    nb = str(bins) if bins else _sturges("st.n")
    b = f"CASE WHEN st.hi - st.lo = 0 THEN 0 ELSE least(CAST(floor(({c} - st.lo) / (st.hi - st.lo) * {nb}) AS BIGINT), {nb} - 1) END"
    return (
        f"SELECT sp.bin, CAST(st.lo + (st.hi - st.lo) * sp.bin / {nb} AS DOUBLE) AS bin_start, "
        f"CAST(st.lo + (st.hi - st.lo) * (sp.bin + 1) / {nb} AS DOUBLE) AS bin_end, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count "
        f"FROM (SELECT min({c}) AS lo, max({c}) AS hi, count({c}) AS n FROM {src} WHERE {c} IS NOT NULL) st "
        f"CROSS JOIN LATERAL (SELECT CAST(range AS BIGINT) AS bin FROM range({nb})) sp "
        f"LEFT JOIN (SELECT {b} AS bin, count(*) AS cnt FROM {src}, (SELECT min({c}) AS lo, max({c}) AS hi, count({c}) AS n "
        f"FROM {src} WHERE {c} IS NOT NULL) st WHERE {c} IS NOT NULL GROUP BY 1) c ON c.bin = sp.bin"
    )


add("hist_age", lambda s, d: profile.histogram(treated(s, d), "Age", 30), sel(_hist_sql("treated", "Age", 30)))
add("hist_income", lambda s, d: profile.histogram(treated(s, d), "Income", 40), sel(_hist_sql("treated", "Income", 40)))
add("hist_spent", lambda s, d: profile.histogram(treated(s, d), "Total_Spent", 40), sel(_hist_sql("treated", "Total_Spent", 40)))
add("hist_raw_income", lambda s, d: profile.histogram(raw(s, d), "Income", 50), sel(_hist_sql("raw", "Income", 50)))
add("hist_sturges", lambda s, d: profile.histogram(treated(s, d), "Age"), sel(_hist_sql("treated", "Age", None)))


def _kde_sql(src: str, c: str, points: int = profile.KDE_POINTS) -> str:
    h = "(st.sd * pow(st.n, -0.2))"
    x = f"(st.lo + (st.hi - st.lo) * g.point / {points - 1})"
    return (
        f"SELECT g.point, {x} AS x, round(sum(hv.w * exp(-0.5 * pow(({x} - hv.v) / {h}, 2))), 6) AS kernel_sum, "
        f"round(sum(hv.w * exp(-0.5 * pow(({x} - hv.v) / {h}, 2))) / (st.n * {h} * sqrt(2 * 3.141592653589793)), 12) AS density "
        f"FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi, count({c}) AS n, stddev_samp(CAST({c} AS DOUBLE)) AS sd "
        f"FROM {src} WHERE {c} IS NOT NULL) st, (SELECT CAST(range AS BIGINT) AS point FROM range({points})) g, "
        f"(SELECT CAST({c} AS DOUBLE) AS v, count(*) AS w FROM {src} WHERE {c} IS NOT NULL GROUP BY 1) hv "
        f"GROUP BY g.point, st.lo, st.hi, st.n, st.sd"
    )


add("kde_grid", rounded(lambda s, d: profile.kde_grid(treated(s, d), "Age"), kernel_sum=6, density=12), sel(_kde_sql("treated", "Age")))
add("kde_income", rounded(lambda s, d: profile.kde_grid(treated(s, d), "Income"), kernel_sum=6, density=12), sel(_kde_sql("treated", "Income")))
add("income_age_regression", rounded(lambda s, d: profile.regression(treated(s, d)), slope=10, intercept=4, corr=6, r2=6), sel(
    "SELECT round(regr_slope(Age, Income), 10) AS slope, round(regr_intercept(Age, Income), 4) AS intercept, "
    "round(corr(Age, Income), 6) AS corr, round(regr_r2(Age, Income), 6) AS r2, CAST(regr_count(Age, Income) AS BIGINT) AS n FROM treated"
))
MARKER_COLUMNS = ("Age", "Income", "Total_Spent")
add("hist_markers", rounded(lambda s, d: profile.scalar_stats(treated(s, d), MARKER_COLUMNS), mean=4, median=4, std=4), sel(U(
    f"SELECT {S.q(c)} AS \"column\", round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, "
    f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM treated"
    for c in MARKER_COLUMNS
)))
