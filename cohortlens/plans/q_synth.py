"""Synthetic expansion queries G1–G17, A19 (n = 10 × treated rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.config import (
    BINARY_COLUMNS, DEFAULT, DISCRETE_EMPIRICAL_COLUMNS, FLOAT_NOISE_COLUMNS, GROUP_COLUMNS,
    INTEGER_NOISE_COLUMNS, METRIC_COMPARISON_COLUMNS, RAW_COLUMNS,
)
from cohortlens.functions.permutation import sql_pass
from cohortlens.operators import stats, synth
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, materialized, raw, treated

SEED = DEFAULT.synthetic_seed
MIN_GROUP = DEFAULT.min_group_size
EXPANSION = 10
NUMERIC = INTEGER_NOISE_COLUMNS + FLOAT_NOISE_COLUMNS + ["Age"]
OUT_COLS = synth.get_synthetic_output_columns(RAW_COLUMNS)


def metadata(s, d):
    t = treated(s, d)
    return synth.prepare_generation_metadata(t, stats.group_means(t), stats.group_stds(t), raw(s, d), min_group_size=MIN_GROUP)


def synthetic(s, d):
    def build():
        md = metadata(s, d)
        return synth.generate_synthetic(s, md, n_rows=EXPANSION * md.total, random_state=SEED)

    # only the generator's write: the mart, the treated table and the metadata
    # that it builds first are several times slower that way
    from cohortlens.session import per_expression_codegen
    return materialized(s, d, "synthetic", build, per_expression_codegen(s))


def params(s, d):
    t = treated(s, d)
    return synth.group_params_frame(t, stats.group_means(t), stats.group_stds(t), min_group_size=MIN_GROUP)


# ---------------------------------------------------------------- SQL twin
def _u(name: str, k: int) -> str:
    h = f"md5(concat_ws('|', '{SEED}', CAST(r.ID AS VARCHAR), '{name}'))"
    return f"((CAST(CAST(('0x' || substr({h}, {1 + 8 * k}, 8)) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296.0)"


def _normal(c: str) -> str:
    name, k = synth.NORMAL_DRAWS[c]
    return f"(sqrt(-2.0 * ln({_u(name, k)})) * cos(6.283185307179586 * {_u(name, k + 1)}))"


def _noisy(c: str) -> str:
    return f"least(greatest(r.mean_{c} + r.std_{c} * {_normal(c)}, gl.lo_{c}), gl.hi_{c})"


def _pos_finite(x: str) -> str:
    return f"({x} IS NOT NULL AND isfinite({x}) AND {x} > 0)"


GL = ("gl AS (SELECT count(*) AS total, "
      + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}, CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}" for c in NUMERIC)
      + ", " + ", ".join(f"avg({b}) AS p_{b}" for b in BINARY_COLUMNS) + " FROM treated)")
GC = ("gc AS (SELECT Marital_Status, Education, count(*) AS cnt, "
      + ", ".join(f"avg({b}) AS gp_{b}" for b in BINARY_COLUMNS) + " FROM treated GROUP BY Marital_Status, Education)")
GP = ("gpar AS (SELECT gc.Marital_Status, gc.Education, gc.cnt, gc.cnt / gl.total AS proportion, "
      + ", ".join(
          f"coalesce(CAST(gm.{c} AS DOUBLE), gl.m_{c}) AS mean_{c}, "
          f"CASE WHEN {_pos_finite(f'coalesce(CAST(gs.{c} AS DOUBLE), gl.s_{c})')} THEN coalesce(CAST(gs.{c} AS DOUBLE), gl.s_{c}) "
          f"WHEN {_pos_finite(f'gl.s_{c}')} THEN gl.s_{c} ELSE 1.0 END AS std_{c}" for c in NUMERIC)
      + ", " + ", ".join(f"CASE WHEN gc.cnt >= {MIN_GROUP} THEN gc.gp_{b} ELSE gl.p_{b} END AS p_{b}" for b in BINARY_COLUMNS)
      + " FROM gc LEFT JOIN gm ON gc.Marital_Status = gm.Marital_Status AND gc.Education = gm.Education "
      "LEFT JOIN gs ON gc.Marital_Status = gs.Marital_Status AND gc.Education = gs.Education, gl)")


def _dist_ctes() -> list[str]:
    kd = " UNION ALL ".join(
        f"SELECT Marital_Status, Education, '{c}' AS col, {c} AS v, count(*) AS k FROM treated GROUP BY Marital_Status, Education, {c}"
        for c in DISCRETE_EMPIRICAL_COLUMNS)
    kg = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS v, count(*) AS k FROM treated GROUP BY {c}" for c in DISCRETE_EMPIRICAL_COLUMNS)
    return [
        f"kd AS ({kd})",
        "kdc AS (SELECT Marital_Status, Education, col, v, sum(k) OVER (PARTITION BY Marital_Status, Education, col ORDER BY v "
        "ROWS UNBOUNDED PRECEDING) / sum(k) OVER (PARTITION BY Marital_Status, Education, col) AS cum FROM kd)",
        f"kg AS (SELECT col, v, sum(k) OVER (PARTITION BY col ORDER BY v ROWS UNBOUNDED PRECEDING) / sum(k) OVER (PARTITION BY col) AS cum FROM ({kg}))",
        f"dd AS (SELECT kdc.Marital_Status, kdc.Education, kdc.col, kdc.v, kdc.cum FROM kdc JOIN gc ON kdc.Marital_Status = gc.Marital_Status "
        f"AND kdc.Education = gc.Education WHERE gc.cnt >= {MIN_GROUP} UNION ALL SELECT gc.Marital_Status, gc.Education, kg.col, kg.v, kg.cum "
        f"FROM gc, kg WHERE gc.cnt < {MIN_GROUP})",
    ]


def synth_ctes() -> list[str]:
    outs = []
    for c in OUT_COLS:
        if c == "ID":
            outs.append("r.ID")
        elif c == "Year_Birth":
            outs.append(f"CAST({DEFAULT.reference_year} - CAST(round_even({_noisy('Age')}, 0) AS BIGINT) AS BIGINT) AS Year_Birth")
        elif c in ("Education", "Marital_Status"):
            outs.append(f"r.{c}")
        elif c == "Income":
            outs.append(f"CAST(round_even({_noisy('Income')}, 2) AS DOUBLE) AS Income")
        elif c in INTEGER_NOISE_COLUMNS:
            outs.append(f"CAST(round_even({_noisy(c)}, 0) AS BIGINT) AS {c}")
        elif c == "Dt_Customer":
            outs.append(f"dts.dmin + CAST(floor({_u(*synth.UNIFORM_DRAWS['Dt_Customer'])} * (date_diff('day', dts.dmin, dts.dmax) + 1)) AS INTEGER) AS Dt_Customer")
        elif c in DISCRETE_EMPIRICAL_COLUMNS:
            outs.append(f"CAST((SELECT min(d.v) FROM dd d WHERE d.Marital_Status = r.Marital_Status AND d.Education = r.Education "
                        f"AND d.col = '{c}' AND d.cum > {_u(*synth.UNIFORM_DRAWS[c])}) AS BIGINT) AS {c}")
        elif c in BINARY_COLUMNS:
            outs.append(f"CAST(CASE WHEN {_u(*synth.UNIFORM_DRAWS[c])} < r.p_{c} THEN 1 ELSE 0 END AS BIGINT) AS {c}")
        else:
            raise AssertionError(c)
    return [
        f"gm AS ({S.group_table('avg', False)})",
        f"gs AS ({S.group_table('stddev_samp', True)})",
        GL, GC, GP, *_dist_ctes(),
        "dts AS (SELECT min(Dt_Customer) AS dmin, max(Dt_Customer) AS dmax FROM raw)",
        f"nn AS (SELECT {EXPANSION} * count(*) AS n FROM treated)",
        "al AS (SELECT gc.Marital_Status, gc.Education, nn.n * gc.cnt // gl.total AS base_alloc, (nn.n * gc.cnt) % gl.total AS rem FROM gc, gl, nn)",
        "al2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, Marital_Status, Education) AS rn, "
        "(SELECT n FROM nn) - sum(base_alloc) OVER () AS left_over FROM al)",
        "alloc AS (SELECT Marital_Status, Education, CAST(base_alloc + CASE WHEN rn <= left_over THEN 1 ELSE 0 END AS BIGINT) AS alloc FROM al2)",
        "starts AS (SELECT a.Marital_Status, a.Education, a.alloc, sum(a.alloc) OVER (ORDER BY a.Marital_Status, a.Education "
        "ROWS UNBOUNDED PRECEDING) - a.alloc AS start FROM alloc a WHERE a.alloc > 0)",
        "sides AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM nn))",
        "ids AS (SELECT CAST(unnest(generate_series(0, n - 1)) AS BIGINT) AS slot FROM nn)",
        f"walk(slot, x) AS (SELECT slot, y FROM (SELECT slot, {sql_pass('slot', 'a', 'b', SEED)} FROM ids, sides) "
        f"UNION ALL SELECT slot, y FROM (SELECT slot, {sql_pass('x', 'a', 'b', SEED)} FROM walk, sides WHERE x >= n))",
        "slots AS (SELECT slot, x + 1 AS ID FROM walk, nn WHERE x < n)",
        "rws AS (SELECT s.ID, p.* FROM slots s JOIN starts st ON s.slot >= st.start AND s.slot < st.start + st.alloc "
        "JOIN gpar p ON p.Marital_Status = st.Marital_Status AND p.Education = st.Education)",
        f"syn AS (SELECT {', '.join(outs)} FROM rws r, gl, dts)",
    ]


def sel(select: str, *extra: str) -> str:
    return S.with_ctes(*S.base(), *synth_ctes(), *extra, select=select)


R6 = lambda x: f"round({x}, 6)"
add("group_params", lambda s, d: params(s, d).select(
    *GROUP_COLUMNS, "cnt", "proportion", *[F.round(f"{p}_{c}", 6).alias(f"{p}_{c}") for c in NUMERIC for p in ("mean", "std")]),
    sel("SELECT Marital_Status, Education, cnt, proportion, "
        + ", ".join(f"{R6(f'{p}_{c}')} AS {p}_{c}" for c in NUMERIC for p in ("mean", "std")) + " FROM gpar"))
add("group_proportions", lambda s, d: synth.group_proportions(treated(s, d)),
    sel("SELECT Marital_Status, Education, count(*) AS count, count(*) / sum(count(*)) OVER () AS proportion FROM treated GROUP BY 1, 2"))
add("binary_rates", lambda s, d: params(s, d).select(*GROUP_COLUMNS, *[f"p_{b}" for b in BINARY_COLUMNS]),
    sel("SELECT Marital_Status, Education, " + ", ".join(f"p_{b}" for b in BINARY_COLUMNS) + " FROM gpar"))
add("discrete_dists", lambda s, d: synth.discrete_distributions(treated(s, d), min_group_size=MIN_GROUP),
    sel("SELECT col AS \"column\", Marital_Status, Education, CAST(v AS BIGINT) AS v, cum FROM dd"))
add("noise_params", lambda s, d: params(s, d).select(*GROUP_COLUMNS, F.explode(F.array(*[
    F.struct(F.lit(c).alias("column"), F.round(f"mean_{c}", 6).alias("mean"), F.round(f"std_{c}", 6).alias("std")) for c in NUMERIC
])).alias("x")).select(*GROUP_COLUMNS, "x.*"), sel(" UNION ALL ".join(
    f"SELECT Marital_Status, Education, '{c}' AS \"column\", {R6(f'mean_{c}')} AS mean, {R6(f'std_{c}')} AS std FROM gpar" for c in NUMERIC)))


def allocation(s, d, rows=lambda total: EXPANSION * total):
    counts = synth.group_proportions(treated(s, d)).select(*GROUP_COLUMNS, F.col("count").alias("cnt"))
    total = treated(s, d).count()
    out = synth.allocate_group_rows(counts, rows(total), total)
    return out.select(*GROUP_COLUMNS, F.col("cnt").alias("count"), "alloc")


add("allocation", allocation, sel(
    "SELECT gc.Marital_Status, gc.Education, gc.cnt AS count, a.alloc FROM gc JOIN alloc a "
    "ON gc.Marital_Status = a.Marital_Status AND gc.Education = a.Education"))
# 7/3 of the rows: most groups have a remainder, and some tie
add("allocation_uneven", lambda s, d: allocation(s, d, lambda total: 7 * total // 3), sel(
    "SELECT Marital_Status, Education, cnt AS count, CAST(base + CASE WHEN row_number() OVER (ORDER BY rem DESC, Marital_Status, Education) "
    "<= m - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS alloc FROM (SELECT gc.Marital_Status, gc.Education, gc.cnt, m, "
    "m * gc.cnt // total AS base, (m * gc.cnt) % total AS rem FROM gc, (SELECT total, 7 * total // 3 AS m FROM gl))"))
add("synthetic", synthetic, sel("SELECT * FROM syn"))
add("validate_synthetic", lambda s, d: synth.validate_synthetic(synthetic(s, d), raw(s, d), expected_rows=EXPANSION * treated(s, d).count()),
    sel(
        "SELECT * FROM (SELECT 'row_count' AS \"check\", CAST(count(*) AS VARCHAR) AS value, count(*) > 0 AS passed FROM syn "
        "UNION ALL SELECT 'columns_match', 'true', true UNION ALL SELECT 'unexpected_derived_columns', '', true "
        "UNION ALL SELECT 'excluded_raw_columns_present', '', true "
        "UNION ALL SELECT 'expected_row_count_match', lower(CAST(count(*) = (SELECT n FROM nn) AS VARCHAR)), count(*) = (SELECT n FROM nn) FROM syn "
        "UNION ALL SELECT 'negative_value_columns', v, v = '' FROM (SELECT concat_ws(',', "
        + ", ".join(f"CASE WHEN min({c}) < 0 THEN '{c}' END" for c in INTEGER_NOISE_COLUMNS + FLOAT_NOISE_COLUMNS + DISCRETE_EMPIRICAL_COLUMNS)
        + ") AS v FROM syn) UNION ALL SELECT 'invalid_binary_columns', v, v = '' FROM (SELECT concat_ws(',', "
        + ", ".join(f"CASE WHEN max(CASE WHEN {b} IS NOT NULL AND {b} NOT IN (0, 1) THEN 1 ELSE 0 END) = 1 THEN '{b}' END" for b in BINARY_COLUMNS)
        + ") AS v FROM syn) UNION ALL SELECT 'date_range_valid', lower(CAST(ok AS VARCHAR)), ok FROM (SELECT min(Dt_Customer) >= "
        "(SELECT min(Dt_Customer) FROM raw) AND max(Dt_Customer) <= (SELECT max(Dt_Customer) FROM raw) AS ok FROM syn))"))
add("proportion_comparison", lambda s, d: synth.proportion_comparison(treated(s, d), synthetic(s, d)), sel(
    "SELECT coalesce(o.Marital_Status, y.Marital_Status) AS Marital_Status, coalesce(o.Education, y.Education) AS Education, "
    "coalesce(o.p, 0.0) AS original_proportion, coalesce(y.p, 0.0) AS synthetic_proportion, coalesce(y.p, 0.0) - coalesce(o.p, 0.0) AS difference "
    "FROM (SELECT Marital_Status, Education, count(*) / sum(count(*)) OVER () AS p FROM treated GROUP BY 1, 2) o FULL OUTER JOIN "
    "(SELECT Marital_Status, Education, count(*) / sum(count(*)) OVER () AS p FROM syn GROUP BY 1, 2) y "
    "ON o.Marital_Status = y.Marital_Status AND o.Education = y.Education ORDER BY 1, 2"))
add("metric_comparison", lambda s, d: synth.metric_comparison(treated(s, d), synthetic(s, d), METRIC_COMPARISON_COLUMNS), sel(
    " UNION ALL ".join(f"SELECT '{c}' AS metric, round_even((SELECT avg({c}) FROM treated), 2) AS original_mean, "
                       f"round_even((SELECT avg({c}) FROM syn), 2) AS synthetic_mean" for c in METRIC_COMPARISON_COLUMNS)))
add("output_projection", lambda s, d: raw(s, d).select(*synth.get_synthetic_output_columns(raw(s, d).columns)),
    S.with_ctes(S.mart(), select="SELECT " + ", ".join(OUT_COLS) + " FROM raw"))
