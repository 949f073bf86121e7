"""Synthetic expansion of the treated table (G1–G15) and its checks.

Generation plan: a table of groups → pieces of slots → one projection:

* each group owns a range of slots (largest remainders, running sums), and a
  keyed permutation of the slots gives the IDs, so every seed has its own order;
* group parameters (one row per Marital × Education cell) are columns of the
  group table, which is written and joined, never collected;
* every random draw is a uniform taken from md5(seed | ID | column), so the
  output is identical under any partitioning, any executor loss / retry and in
  any engine with md5 (the DuckDB oracle reproduces it).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.config import (
    BINARY_COLUMNS, DEFAULT, DERIVED_COLUMNS, DISCRETE_EMPIRICAL_COLUMNS, EXCLUDED_RAW_COLUMNS,
    FLOAT_NOISE_COLUMNS, GROUP_COLUMNS, INTEGER_NOISE_COLUMNS, CampaignSchema,
)
from cohortlens.functions.exprs import half_even
from cohortlens.functions.permutation import Permutation
from cohortlens.operators.allocation import allocate, found_in, with_starts
from cohortlens.operators.clean import parse_dates_expr
from cohortlens.sources.io import shared_path

def get_synthetic_output_columns(raw_columns) -> list[str]:
    """raw column order minus the constants and the derived columns."""
    return [c for c in raw_columns if c not in EXCLUDED_RAW_COLUMNS and c not in DERIVED_COLUMNS]


# Draw layout: one md5 gives four 32-bit uniforms (slices 0..3).
# Normal draws use two slices (k, k + 1); two numeric columns share one md5.
_NUMERIC_ORDER = ["Age"] + FLOAT_NOISE_COLUMNS + INTEGER_NOISE_COLUMNS
NORMAL_DRAWS = {c: (f"n{i // 2}", 2 * (i % 2)) for i, c in enumerate(_NUMERIC_ORDER)}
UNIFORM_DRAWS = {
    "Kidhome": ("disc", 0), "Teenhome": ("disc", 1), "Dt_Customer": ("disc", 2), BINARY_COLUMNS[0]: ("disc", 3),
    **{c: ("bin0", k) for k, c in enumerate(BINARY_COLUMNS[1:5])},
    **{c: ("bin1", k) for k, c in enumerate(BINARY_COLUMNS[5:])},
}


def hex_half(h: Column, i: int) -> Column:
    """16 digits of an md5, first (0) or last (1), as a signed 64-bit number."""
    return F.conv(F.substring(h, 1 + 16 * i, 16), 16, -10).cast("bigint")


def uniform(half: Column, low: int) -> Column:
    """The upper (0) or lower (1) 32 bits of a number as a uniform in (0, 1)."""
    bits = half.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")) if low else F.shiftrightunsigned(half, 32)
    return (bits.cast("double") + 0.5) / 4294967296.0


@dataclass
class GenerationMetadata:
    """What the generator needs. ``groups`` is a written table: the group keys,
    cnt, proportion, mean / std (arrays over ``numeric``), p (over ``binary``),
    cum / val (arrays over ``discrete`` of cumulative shares and values)."""
    output_columns: list[str]
    groups: DataFrame
    numeric: list[str]
    binary: list[str]
    discrete: list[str]
    widths: dict[str, int]
    total: int
    bounds: dict[str, tuple[float, float]]
    global_means: dict[str, float]
    global_stds: dict[str, float]
    date_min: date
    date_max: date
    reference_year: int = 2026
    min_group_size: int = 10


def _pos_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (x > 0) & (x < float("inf"))


def global_stats_frame(treated: DataFrame) -> DataFrame:
    """Row count, mean / sample std / min / max of the numeric measures and
    the binary rates over the whole table, in two aggregates: as one it has
    more columns than Spark generates code for (100), which is slow per row."""
    numeric = [c for c in INTEGER_NOISE_COLUMNS + FLOAT_NOISE_COLUMNS + ["Age"] if c in treated.columns]
    binary = [c for c in BINARY_COLUMNS if c in treated.columns]
    means = treated.agg(F.count(F.lit(1)).alias("total"), *[F.avg(c).alias(f"m_{c}") for c in numeric], *[F.avg(c).alias(f"p_{c}") for c in binary])
    spread = treated.agg(
        *[F.stddev_samp(c).alias(f"s_{c}") for c in numeric],
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in numeric], *[F.max(c).cast("double").alias(f"hi_{c}") for c in numeric])
    return means.crossJoin(spread)


def global_stats(treated: DataFrame) -> dict:
    return global_stats_frame(treated).first().asDict()


def group_params_frame(treated: DataFrame, grouped_mean: DataFrame, grouped_std: DataFrame, *,
                       min_group_size: int = 10, global_row: dict | None = None) -> DataFrame:
    """G2/G3/G5 as one DataFrame, one row per group cell: count, proportion,
    noise mean/std per numeric column (group value, else global; a std that is
    missing, non-finite or ≤ 0 falls back to the global std, then to 1) and
    binary rates (group rate only when the group has ≥ min_group_size rows)."""
    numeric = [c for c in INTEGER_NOISE_COLUMNS + FLOAT_NOISE_COLUMNS + ["Age"] if c in treated.columns]
    binary = [c for c in BINARY_COLUMNS if c in treated.columns]
    # one small action (or the caller's): the global fallbacks become literals
    g = global_row or global_stats(treated)
    glob = {k: F.lit(v).cast("double") if k != "total" else F.lit(v) for k, v in g.items()}
    counts = treated.groupBy(*GROUP_COLUMNS).agg(F.count(F.lit(1)).alias("cnt"), *[F.avg(c).alias(f"gp_{c}") for c in binary])
    gm = grouped_mean.select(*GROUP_COLUMNS, *[F.col(c).cast("double").alias(f"gm_{c}") for c in numeric])
    gs = grouped_std.select(*GROUP_COLUMNS, *[F.col(c).cast("double").alias(f"gs_{c}") for c in numeric])
    j = counts.join(gm, GROUP_COLUMNS, "left").join(gs, GROUP_COLUMNS, "left")
    out = [*GROUP_COLUMNS, "cnt", (F.col("cnt") / glob["total"]).alias("proportion")]
    for c in numeric:
        s1 = F.coalesce(F.col(f"gs_{c}"), glob[f"s_{c}"])
        out.append(F.coalesce(F.col(f"gm_{c}"), glob[f"m_{c}"]).alias(f"mean_{c}"))
        out.append(F.when(_pos_finite(s1), s1).when(_pos_finite(glob[f"s_{c}"]), glob[f"s_{c}"]).otherwise(F.lit(1.0)).alias(f"std_{c}"))
    for c in binary:
        out.append(F.when(F.col("cnt") >= min_group_size, F.col(f"gp_{c}")).otherwise(glob[f"p_{c}"]).alias(f"p_{c}"))
    return j.select(*out)


def discrete_distributions(treated: DataFrame, *, min_group_size: int = 10) -> DataFrame:
    """Per group and column the value distribution as (v, cumulative
    share); groups below min_group_size take the global distribution. All
    discrete columns go through one pipeline as (column, value) rows."""
    cols = [c for c in DISCRETE_EMPIRICAL_COLUMNS if c in treated.columns]
    melted = treated.select(*GROUP_COLUMNS, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("v")) for c in cols])).alias("x")).select(
        *GROUP_COLUMNS, "x.column", "x.v")
    per = melted.groupBy(*GROUP_COLUMNS, "column", "v").agg(F.count(F.lit(1)).alias("k"))
    part = Window.partitionBy(*GROUP_COLUMNS, "column")
    per = per.select(*GROUP_COLUMNS, "column", "v",
                     (F.sum("k").over(part.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("k").over(part)).alias("cum"))
    gl = melted.groupBy("column", "v").agg(F.count(F.lit(1)).alias("k"))
    gpart = Window.partitionBy("column")  # rows: distinct values of small-count columns
    gl = gl.select("column", "v", (F.sum("k").over(gpart.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("k").over(gpart)).alias("cum"))
    sizes = treated.groupBy(*GROUP_COLUMNS).agg(F.count(F.lit(1)).alias("cnt"))
    big = per.join(sizes.where(F.col("cnt") >= min_group_size), GROUP_COLUMNS, "left_semi")
    # small groups take the global distribution: one array per column (one
    # entry per distinct value of a small-count column) read as a scalar subquery
    glob = gl.groupBy("column").agg(F.sort_array(F.collect_list(F.struct("v", "cum"))).alias("a"))
    glob_map = glob.select(F.map_from_entries(F.collect_list(F.struct("column", "a"))).alias("m")).scalar()
    small = sizes.where(F.col("cnt") < min_group_size).select(
        *GROUP_COLUMNS, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), glob_map[c].alias("a")) for c in cols])).alias("y")
    ).select(*GROUP_COLUMNS, "y.column", F.explode("y.a").alias("x")).select(*GROUP_COLUMNS, "column", "x.v", "x.cum")
    return big.unionByName(small).select("column", *GROUP_COLUMNS, "v", "cum")


def prepare_generation_metadata(treated: DataFrame, grouped_mean: DataFrame, grouped_std: DataFrame, raw: DataFrame,
                                *, min_group_size: int = 10, cfg: CampaignSchema = DEFAULT) -> GenerationMetadata:
    """G1: everything the generator needs. Group parameters and distributions
    are joined and written as a table; scalars and array widths reach the driver."""
    output_columns = get_synthetic_output_columns(raw.columns)
    missing = set(output_columns) - set(treated.columns) - {"Dt_Customer"}
    if missing:
        raise ValueError(f"These output columns are not available for generation: {sorted(missing)}")
    if "Age" not in treated.columns:
        raise ValueError("The treated table needs an Age column.")
    numeric = [c for c in INTEGER_NOISE_COLUMNS + FLOAT_NOISE_COLUMNS + ["Age"] if c in treated.columns]
    binary = [c for c in BINARY_COLUMNS if c in output_columns]
    discrete = [c for c in DISCRETE_EMPIRICAL_COLUMNS if c in output_columns]
    g = global_stats(treated)
    params = group_params_frame(treated, grouped_mean, grouped_std, min_group_size=min_group_size, global_row=g)
    listed = (discrete_distributions(treated, min_group_size=min_group_size).groupBy(*GROUP_COLUMNS, "column")
              .agg(F.sort_array(F.collect_list(F.struct("v", "cum"))).alias("d"))  # an entry per distinct value
              .groupBy(*[F.col(k).alias(f"__{k}") for k in GROUP_COLUMNS])
              .agg(*[F.max(F.when(F.col("column") == c, F.col("d"))).alias(f"d_{c}") for c in discrete]))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in GROUP_COLUMNS]

    def doubles(prefix: str, cols: list[str]) -> Column:
        return F.array(*[F.col(f"{prefix}_{c}").cast("double") for c in cols])
    path = shared_path(treated.sparkSession, "groups")
    params.join(listed, same, "left").select(
        *GROUP_COLUMNS, "cnt", "proportion", doubles("mean", numeric).alias("mean"), doubles("std", numeric).alias("std"),
        doubles("p", binary).alias("p"), F.array(*[F.col(f"d_{c}.cum") for c in discrete]).alias("cum"),
        F.array(*[F.col(f"d_{c}.v") for c in discrete]).alias("val")).write.parquet(path)
    groups = treated.sparkSession.read.parquet(path)
    widths = groups.agg(*[F.max(F.size(F.get("val", F.lit(j)))).alias(c) for j, c in enumerate(discrete)]).first().asDict()
    dts = raw.select(parse_dates_expr(raw, "Dt_Customer").alias("d")).agg(F.min("d").alias("a"), F.max("d").alias("b")).first()
    return GenerationMetadata(
        output_columns=output_columns, groups=groups, numeric=numeric, binary=binary, discrete=discrete, widths=widths, total=g["total"],
        bounds={c: (g[f"lo_{c}"], g[f"hi_{c}"]) for c in numeric},
        global_means={c: g[f"m_{c}"] for c in numeric}, global_stds={c: g[f"s_{c}"] for c in numeric},
        date_min=dts["a"], date_max=dts["b"], reference_year=cfg.reference_year, min_group_size=min_group_size,
    )


def allocate_group_rows(groups: DataFrame, n_rows: int, total: int) -> DataFrame:
    """Largest-remainder allocation in exact integers; ties in group order."""
    return allocate(groups, GROUP_COLUMNS, "cnt", n_rows, total)


#: Pieces of slots per task; a task generates its pieces one after the other.
PIECES = 16


def slot_pieces(metadata: GenerationMetadata, n_rows: int, parts: int) -> DataFrame:
    """The group table, one row per piece of a group's slots: the group's
    parameters, first and last slot. Written in ``parts`` files, so that the
    generator reads it without an exchange."""
    size = max(1, n_rows // (PIECES * parts))
    owned = with_starts(allocate_group_rows(metadata.groups.select(*GROUP_COLUMNS, "cnt"), n_rows, metadata.total).drop("cnt"), GROUP_COLUMNS, "alloc")
    owned = owned.where("alloc > 0").select(*[F.col(k).alias(f"__{k}") for k in GROUP_COLUMNS], "alloc", "start")
    joined = metadata.groups.join(owned, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in GROUP_COLUMNS])
    end = F.col("start") + F.col("alloc") - 1
    cut = joined.select(*GROUP_COLUMNS, "mean", "std", "p", "cum", "val", end.alias("end"),
                        F.explode(F.sequence("start", end, F.lit(size).cast("bigint"))).alias("from"))
    path = shared_path(metadata.groups.sparkSession, "pieces")
    (cut.withColumn("to", F.least(F.col("from") + size - 1, F.col("end"))).drop("end")
     .repartition(parts, *GROUP_COLUMNS, "from").write.parquet(path))
    return metadata.groups.sparkSession.read.parquet(path)


def generate_synthetic(spark: SparkSession, metadata: GenerationMetadata, *, n_rows: int = 1_000_000,
                       random_state: int = 42, noise_scale: float = 1.0, num_partitions: int | None = None) -> DataFrame:
    """N synthetic customers. The group table, cut into pieces of
    slots, is expanded without a shuffle; a row carries its group's parameters
    as columns, so neither the plan nor the time per row grows with the number
    of groups. Discrete draws search their group's cumulative shares, so their
    cost grows with the logarithm of the number of distinct values."""
    if n_rows <= 0:
        raise ValueError("n_rows must be greater than zero.")
    if noise_scale < 0:
        raise ValueError("noise_scale must be non-negative.")
    md = metadata
    parts = num_partitions or max(spark.sparkContext.defaultParallelism, n_rows // 2_000_000 + 1)
    pieces = slot_pieces(md, n_rows, parts)
    if num_partitions:
        pieces = pieces.coalesce(num_partitions)
    params = [*GROUP_COLUMNS, "mean", "std", "p", "cum", "val"]
    slots = pieces.select(*[F.col(c).alias(f"__{c}" if c not in GROUP_COLUMNS else c) for c in params],
                          F.explode(F.sequence("from", "to")).alias("__slot"))
    rng = Permutation(n_rows, random_state).add(slots, "__slot", "__id").withColumn("ID", F.col("__id") + 1)
    params = [*GROUP_COLUMNS, "__mean", "__std", "__p"]
    # stage 1: each md5 once as a column; stage 2: its halves as 64-bit numbers
    # (a conversion from hex costs as much as the md5, so two and not four of
    # them); stage 3: their 32-bit slices as uniforms. The branchy output
    # expressions then only read plain columns.
    draws = sorted({(nm, k) for nm, k0 in NORMAL_DRAWS.values() for k in (k0, k0 + 1)} | set(UNIFORM_DRAWS.values()))
    names = sorted({nm for nm, _ in draws})
    def md5_of(nm: str) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(random_state)), F.col("ID").cast("string"), F.lit(nm)))

    def drawn(c: str, j: int) -> Column:
        """The first value whose cumulative share exceeds u. Drawn here, so that wide arrays go no further."""
        name, k = UNIFORM_DRAWS[c]
        val, below = F.get("__val", F.lit(j)), found_in(F.get("__cum", F.lit(j)), uniform(hex_half(md5_of(name), k // 2), k % 2), md.widths[c] or 1)
        return F.get(val, F.least(below, F.size(val) - 1).cast("int"))
    hashed = rng.select("ID", *params, *[md5_of(nm).alias(f"__h_{nm}") for nm in names],
                        *[drawn(c, j).alias(c) for j, c in enumerate(md.discrete)])
    halves = hashed.select("ID", *params, *md.discrete, *[hex_half(F.col(f"__h_{nm}"), i).alias(f"__l_{nm}_{i}")
                                                          for nm, i in sorted({(nm, k // 2) for nm, k in draws})])
    base = halves.select("ID", *params, *md.discrete, *[uniform(F.col(f"__l_{nm}_{k // 2}"), k % 2).alias(f"__u_{nm}_{k}") for nm, k in draws])

    def u_col(nm: str, k: int) -> Column:
        return F.col(f"__u_{nm}_{k}")
    cols: dict[str, Column] = {c: F.col(c) for c in ("ID", *GROUP_COLUMNS, *md.discrete)}

    def noisy(c: str) -> Column:
        j = F.lit(md.numeric.index(c))
        mean, std = F.get("__mean", j), F.get("__std", j) * noise_scale
        lo, hi = md.bounds[c]
        name, k = NORMAL_DRAWS[c]
        z = F.sqrt(-2.0 * F.log(u_col(name, k))) * F.cos(2.0 * math.pi * u_col(name, k + 1))
        return F.least(F.greatest(mean + std * z, F.lit(lo)), F.lit(hi))

    age = F.rint(noisy("Age")).cast("bigint")
    cols["Year_Birth"] = (F.lit(md.reference_year) - age).cast("bigint")
    span = (md.date_max - md.date_min).days
    u_date = u_col(*UNIFORM_DRAWS["Dt_Customer"])
    cols["Dt_Customer"] = F.date_add(F.lit(md.date_min), F.floor(u_date * (span + 1)).cast("int"))
    for c in FLOAT_NOISE_COLUMNS:
        if c in md.output_columns:
            cols[c] = half_even(noisy(c), 2)
    for c in INTEGER_NOISE_COLUMNS:
        if c in md.output_columns:
            cols[c] = F.rint(noisy(c)).cast("bigint")
    for j, c in enumerate(md.binary):
        cols[c] = F.when(u_col(*UNIFORM_DRAWS[c]) < F.get("__p", F.lit(j)), 1).otherwise(0).cast("bigint")
    return base.select(*[cols[c].alias(c) for c in md.output_columns])


def with_index(df: DataFrame) -> DataFrame:
    """The rows numbered from 0 by ID in a first column ``index``."""
    if "ID" not in df.columns:
        raise ValueError("an index needs the column ID")
    return with_starts(df.withColumn("__one", F.lit(1).cast("bigint")), ["ID"], "__one", "index").select("index", *df.columns)


def write_synthetic_dataset(df: DataFrame, output_path: str, *, file_format: str = "parquet", mode: str = "overwrite") -> dict:
    """Write as parquet or csv (header); other formats → ValueError.
    Returns path, rows and size in MB (rows counted from the written files)."""
    if file_format not in ("parquet", "csv"):
        raise ValueError("file_format must be either 'parquet' or 'csv'.")
    from cohortlens.session import per_expression_codegen
    w = df.write.mode(mode)
    if file_format == "csv":
        with per_expression_codegen(df.sparkSession):
            w.option("header", True).csv(output_path)
        back = df.sparkSession.read.option("header", True).schema(df.schema).csv(output_path)
    else:
        with per_expression_codegen(df.sparkSession):
            w.parquet(output_path)
        back = df.sparkSession.read.parquet(output_path)
    # sizes as Spark lists the files, so any store works
    listed = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(output_path)
    size = listed.agg(F.sum("length")).first()[0] or 0
    return {"path": output_path, "rows": back.count(), "mb": round(size / 1024 / 1024, 2)}


def validate_synthetic(syn: DataFrame, raw: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """The reference's checks as rows (check, value, passed) from one wide
    aggregate over the synthetic table plus column-set tests on metadata."""
    expected = get_synthetic_output_columns(raw.columns)
    cols = syn.columns
    nonneg = [c for c in INTEGER_NOISE_COLUMNS + FLOAT_NOISE_COLUMNS + DISCRETE_EMPIRICAL_COLUMNS if c in cols]
    binary = [c for c in BINARY_COLUMNS if c in cols]
    rd = raw.select(parse_dates_expr(raw, "Dt_Customer").alias("d")).select(F.struct(F.min("d").alias("a"), F.max("d").alias("b"))).scalar()
    sd = parse_dates_expr(syn, "Dt_Customer")
    agg = syn.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.max((F.col(c) < 0).cast("int")).alias(f"neg_{c}") for c in nonneg],
        *[F.max((F.col(c).isNotNull() & ~F.col(c).isin(0, 1)).cast("int")).alias(f"bin_{c}") for c in binary],
        F.min(sd).alias("dmin"), F.max(sd).alias("dmax"),
    )

    def listing(flags: list[tuple[str, str]]) -> Column:
        return F.concat_ws(",", F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(c)) for c, f in flags])))

    derived = sorted(set(cols) & set(DERIVED_COLUMNS))
    excluded = sorted(set(cols) & set(EXCLUDED_RAW_COLUMNS))
    neg = listing([(c, f"neg_{c}") for c in nonneg])
    inv = listing([(c, f"bin_{c}") for c in binary])
    date_ok = (F.col("dmin") >= rd["a"]) & (F.col("dmax") <= rd["b"])
    checks = [
        ("row_count", F.col("n").cast("string"), F.col("n") > 0),
        ("columns_match", F.lit(str(cols == expected).lower()), F.lit(cols == expected)),
        ("unexpected_derived_columns", F.lit(",".join(derived)), F.lit(not derived)),
        ("excluded_raw_columns_present", F.lit(",".join(excluded)), F.lit(not excluded)),
    ]
    if expected_rows is not None:
        ok = F.col("n") == expected_rows
        checks.append(("expected_row_count_match", F.lower(ok.cast("string")), ok))
    checks += [
        ("negative_value_columns", neg, neg == ""),
        ("invalid_binary_columns", inv, inv == ""),
        ("date_range_valid", F.lower(date_ok.cast("string")), date_ok),
    ]
    arr = F.array(*[F.struct(F.lit(k).alias("check"), v.alias("value"), p.alias("passed")) for k, v, p in checks])
    return agg.select(F.posexplode(arr).alias("pos", "c")).select("c.*")


def group_proportions(df: DataFrame) -> DataFrame:
    """Group counts and share of all rows."""
    c = df.groupBy(*GROUP_COLUMNS).agg(F.count(F.lit(1)).alias("count"))
    return c.select(*GROUP_COLUMNS, "count", (F.col("count") / F.sum("count").over(Window.partitionBy())).alias("proportion"))


def proportion_comparison(original: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Full outer join of the two group mixes, gaps as 0, sorted."""
    o = group_proportions(original).select(*GROUP_COLUMNS, F.col("proportion").alias("original_proportion"))
    s = group_proportions(synthetic).select(*GROUP_COLUMNS, F.col("proportion").alias("synthetic_proportion"))
    j = o.join(s, GROUP_COLUMNS, "full_outer").fillna(0.0, ["original_proportion", "synthetic_proportion"])
    return j.select(*GROUP_COLUMNS, "original_proportion", "synthetic_proportion",
                    (F.col("synthetic_proportion") - F.col("original_proportion")).alias("difference")).orderBy(*GROUP_COLUMNS)


def metric_comparison(original: DataFrame, synthetic: DataFrame, columns) -> DataFrame:
    """Means of original vs synthetic, 2 dp (two one-row aggregates)."""
    s = synthetic.agg(*[F.avg(c).alias(c) for c in columns]).select(F.struct("*").alias("s")).scalar()
    o = original.agg(*[F.avg(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), half_even(F.col(c), 2).alias("original_mean"),
                              half_even(s[c], 2).alias("synthetic_mean")) for c in columns])
    return o.select(F.explode(rows).alias("r")).select("r.*")
