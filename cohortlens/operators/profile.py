"""Column and table profiling.

Every profile is ONE wide aggregate over the table (partial aggregation per
partition, one tiny final merge) followed by a narrow unpivot of the single
result row. Quantiles come from functions.quantiles (exact, bounded memory); distributions
(histograms, KDE) aggregate a value histogram, never raw rows on one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.exprs import half_even, unpivot_exprs
from cohortlens.functions.quantiles import GROUPS, SALT, quantile_wide, quantiles_scalar
from cohortlens.session import ensure_checkpoint_dir


def _long(wide: DataFrame, pairs, key: str = "column") -> DataFrame:
    return wide.select(unpivot_exprs(pairs, key, "v").alias("kv")).select(f"kv.{key}", "kv.v.*")


def table_overview(df: DataFrame) -> DataFrame:
    """Rows, columns, total nulls."""
    nulls = sum((F.sum(F.col(c).isNull().cast("bigint")) for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
                  nulls.cast("bigint").alias("n_nulls"))


#: Integer columns up to this range are counted in bitmaps (512 bitmaps of 4 KB).
BITMAP_RANGE = 1 << 24


def _distinct_counts(df: DataFrame, bitmaps: Sequence[str]) -> DataFrame:
    """column, distinct (non-null values), for all columns in one pass.

    Each row gives one (column, value) pair per column. Of the ``bitmaps``
    columns, pairs are added up in bitmaps of 32,768 values before they are
    exchanged; of the others, equal pairs are merged before they are exchanged
    and dealt by column and value, so a large column is not one task's."""
    rest = [c for c in df.columns if c not in bitmaps]
    parts = []
    if bitmaps:
        pair = df.select(unpivot_exprs([(c, F.col(c).cast("bigint")) for c in bitmaps], "column", "v").alias("kv")).select("kv.*").where("v IS NOT NULL")
        cells = pair.groupBy("column", F.bitmap_bucket_number("v").alias("b")).agg(
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("v"))).alias("n"))
        parts.append(cells.groupBy("column").agg(F.sum("n").alias("distinct")))
    if rest:
        pair = df.select(unpivot_exprs([(c, F.col(c).cast("string")) for c in rest], "column", "v").alias("kv")).select("kv.*").where("v IS NOT NULL")
        parts.append(pair.distinct().groupBy("column").agg(F.count("*").alias("distinct")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, distinct non-null values, nulls, % nulls (2 dp) per column.
    ``approx`` swaps the exact distinct count for HyperLogLog++ on very wide
    or high-cardinality tables."""
    types = dict(df.dtypes)
    whole = [] if approx else [c for c in df.columns if types[c] in ("bigint", "int", "smallint", "tinyint")]
    aggs = [F.count(F.lit(1)).alias("__n"), *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"n_{c}") for c in df.columns],
            *[F.approx_count_distinct(c).alias(f"d_{c}") for c in df.columns if approx],
            *[(F.max(c).cast("decimal(20,0)") - F.min(c)).alias(f"r_{c}") for c in whole]]
    wide = df.agg(*aggs)
    if approx:
        distinct = {c: F.col(f"d_{c}") for c in df.columns}
    else:
        one = wide.first()
        wide = df.sparkSession.createDataFrame([one], wide.schema)
        counts = _distinct_counts(df, [c for c in whole if one[f"r_{c}"] is not None and one[f"r_{c}"] < BITMAP_RANGE])
        found = counts.agg(F.map_from_entries(F.collect_list(F.struct("column", "distinct"))).alias("m")).scalar()  # a row per column
        distinct = {c: F.coalesce(found[c], F.lit(0)) for c in df.columns}
    pairs = [(c, F.struct(F.lit(types[c]).alias("Type"), distinct[c].cast("bigint").alias("Unique_Values"),
                          F.col(f"n_{c}").alias("Nulls"),
                          half_even(F.col(f"n_{c}") * 100 / F.col("__n"), 2).alias("Pct_Nulls"))) for c in df.columns]
    return _long(wide, pairs, "Column")


def null_columns(df: DataFrame) -> DataFrame:
    """Columns holding nulls, ascending by count, with their total."""
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in df.columns])
    long = wide.select(unpivot_exprs([(c, F.col(c)) for c in df.columns], "Column", "Nulls").alias("kv")).select("kv.*")
    from pyspark.sql import Window
    nz = long.where(F.col("Nulls") > 0)
    # total over the (≤ column-count) rows with nulls
    return nz.select("Column", "Nulls", F.sum("Nulls").over(Window.partitionBy()).alias("Total")).orderBy("Nulls", "Column")


def constant_columns(df: DataFrame) -> DataFrame:
    """Zero-variance columns (a null counts as a value) and their value."""
    aggs = []
    for c in df.columns:
        nulls = F.count(F.lit(1)) - F.count(c)
        one = (nulls == 0) & F.min(c).eqNullSafe(F.max(c))  # equal, and no null beside it
        aggs += [((one & (F.count(c) > 0)) | ((F.count(c) == 0) & (nulls > 0))).alias(f"k_{c}"), F.min(c).cast("string").alias(f"v_{c}")]
    wide = df.agg(*aggs)
    pairs = [(c, F.struct(F.col(f"k_{c}").alias("k"), F.col(f"v_{c}").alias("Value"))) for c in df.columns]
    return _long(wide, pairs, "Column").where("k").select("Column", "Value")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("bigint", "int", "double", "smallint", "float")]


def _melt(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) rows: a bounded, narrow fan-out used to compute
    per-column quantiles as one grouped job."""
    return df.select(unpivot_exprs([(c, F.col(c).cast("double")) for c in cols], "column", "value").alias("kv")).select("kv.*")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """P5: count, mean, sample std, min, exact quartiles, max per numeric column."""
    cols = list(columns or numeric_columns(df))
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"),
                 F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}")]
    wide = df.agg(*aggs)
    pairs = [(c, F.struct(
        F.col(f"n_{c}").alias("count"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std"),
        F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max"))) for c in cols]
    quart = quantile_wide(_melt(df, cols), "value", [0.25, 0.5, 0.75], ["column"], ["q25", "q50", "q75"])
    return _long(wide, pairs).join(F.broadcast(quart), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def scalar_stats(df: DataFrame, columns: Sequence[str] = ("Age", "Income")) -> DataFrame:
    """Mean / median / std / min / max."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"),
                 F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}")]
    wide = df.agg(*aggs)
    pairs = [(c, F.struct(F.col(f"m_{c}").alias("mean"),
                          F.col(f"s_{c}").alias("std"), F.col(f"lo_{c}").alias("min"),
                          F.col(f"hi_{c}").alias("max"))) for c in columns]
    med = quantile_wide(_melt(df, columns), "value", [0.5], ["column"], ["median"])
    return _long(wide, pairs).join(F.broadcast(med), "column", "left").select(
        "column", "mean", "median", "std", "min", "max")


def _fences(df: DataFrame, c: str):
    """Quartiles as a scalar subquery struct; fences at 1.5·IQR."""
    q1, q2, q3 = quantiles_scalar(df, c, [0.25, 0.5, 0.75])
    iqr = q3 - q1
    return q1, q2, q3, q1 - 1.5 * iqr, q3 + 1.5 * iqr


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences), outlier
    count — all columns in one grouped job over (column, value) rows."""
    return box_stats_by(_melt(df, columns), "value", "column")


def box_outliers(df: DataFrame, column: str, id_col: str = "ID") -> DataFrame:
    """The rows beyond the fences."""
    _, _, _, lf, uf = _fences(df, column)
    v = F.col(column).cast("double")
    return df.where((v < lf) | (v > uf)).select(id_col, v.alias("value"))


def box_stats_by(df: DataFrame, column: str, by: str) -> DataFrame:
    """P7 per group (e.g. Recency by Response). The groups' quartiles are
    counted; up to GROUPS groups are read as one map, so that no row is
    exchanged, more are joined with both sides salted. A null group is left out."""
    ensure_checkpoint_dir(df.sparkSession)
    q = quantile_wide(df, column, [0.25, 0.5, 0.75], [by], ["q1", "median", "q3"])
    names = ["q1", "median", "q3", "lower_fence", "upper_fence"]
    q = q.select(F.col(by).alias("__by"), "q1", "median", "q3", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower_fence"),
                 (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper_fence")).where("__by IS NOT NULL").checkpoint()
    rows = df.select(F.col(by), F.col(column).cast("double").alias("__v"))
    if q.count() <= GROUPS:
        entry = F.struct("__by", F.struct(*names).alias("q"))
        fences = q.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()
        j = rows.where(F.col(by).isNotNull()).withColumn("__q", fences[F.col(by)]).select(by, "__v", *[F.col(f"__q.{n}").alias(n) for n in names])
    else:
        q = q.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALT - 1).cast("bigint"))))
        j = rows.withColumn("__s", F.pmod(F.xxhash64("__v"), F.lit(SALT))).join(q, (F.col(by) == F.col("__by")) & (F.col("__s") == F.col("__salt")))
    v = F.col("__v")
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    return j.groupBy(by, *names).agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(~inside, 1).otherwise(0)).cast("bigint").alias("n_outliers"),
    )


def sturges_bins(n: Column) -> Column:
    """ceil(1 + log2 n) computed exactly as 1 + bit length of n − 1."""
    return F.when(n <= 1, F.lit(1)).otherwise(1 + F.length(F.bin(n - 1))).cast("bigint")


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] with every bin present
    (the top edge falls in the last bin). ``bins=None`` → Sturges."""
    v = F.col(column)
    st = df.where(v.isNotNull()).select(
        F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"))).scalar()
    lo, hi, n = st["lo"], st["hi"], st["n"]
    nb = F.lit(bins).cast("bigint") if bins else sturges_bins(n)
    span = hi - lo
    b = F.when(span == 0, F.lit(0).cast("bigint")).otherwise(
        F.least(F.floor((v - lo) / span * nb).cast("bigint"), nb - 1))
    counts = df.where(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0).cast("bigint"), nb - 1)).alias("bin"))
    j = spine.join(counts, "bin", "left")
    return j.select(
        "bin",
        (lo + span * F.col("bin") / nb).cast("double").alias("bin_start"),
        (lo + span * (F.col("bin") + 1) / nb).cast("double").alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


KDE_POINTS = 64
#: Bandwidths beyond which a kernel counts as 0: exp(-9.2²/2) < 1e-18.
CUTOFF = 9.2


def kde_grid(df: DataFrame, column: str, points: int = KDE_POINTS) -> DataFrame:
    """P10: Gaussian KDE evaluated on a fixed grid over [min, max]; Scott
    bandwidth σ·n^(−1/5). Exact: every row adds to the points of the grid
    within CUTOFF bandwidths (beyond it a kernel is below 1e-18 of its peak),
    and the tasks' partial sums, ``points`` numbers each, are all that is
    exchanged."""
    v = F.col(column).cast("double")
    st = df.where(v.isNotNull()).select(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"),
                                                 F.stddev_samp(v).alias("sd"))).scalar()
    lo, hi, n, sd = st["lo"], st["hi"], st["n"], st["sd"]
    h = sd * F.pow(n, F.lit(-0.2))
    step = (hi - lo) / (points - 1)
    first = F.greatest(F.ceil((v - lo - CUTOFF * h) / step), F.lit(0).cast("bigint"))
    last = F.least(F.floor((v - lo + CUTOFF * h) / step), F.lit(points - 1).cast("bigint"))
    near = F.when(step > 0, F.when(first <= last, F.sequence(first, last))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint")))
    ex = df.where(v.isNotNull()).select(v.alias("v"), F.explode(near).alias("point"))
    xj = lo + (hi - lo) * F.col("point") / (points - 1)
    some = ex.groupBy("point").agg(F.sum(F.exp(-0.5 * F.pow((xj - F.col("v")) / h, 2))).alias("k"))
    spine = df.sparkSession.range(points).select(F.col("id").alias("point"))  # points far from every value
    agg = spine.join(some, "point", "left").select("point", F.coalesce("k", F.lit(0.0)).alias("k"))
    x = lo + (hi - lo) * F.col("point") / (points - 1)
    return agg.select(
        F.col("point").cast("bigint").alias("point"), x.alias("x"),
        F.col("k").alias("kernel_sum"),
        (F.col("k") / (n * h * F.sqrt(F.lit(2 * 3.141592653589793)))).alias("density"),
    )


def regression(df: DataFrame, y: str = "Age", x: str = "Income") -> DataFrame:
    """Least-squares line y ~ x, Pearson r and R²."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.corr(y, x).alias("corr"), F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )
