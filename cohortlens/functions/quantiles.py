"""Exact quantiles without buffering a whole group in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which breaks on a high-cardinality column of a group that
holds a large share of the rows. Here:

1. a Greenwald–Khanna sketch (``percentile_approx``, bounded memory) gives,
   per group and quantile, a bracket ``[a, b]`` that provably contains the
   target ranks (rank error ≤ n / accuracy, bracket is ±2 / accuracy);
2. one pass counts, per (group, quantile), the values below ``a`` and the
   distinct values inside the bracket (partial aggregation; a hot value is
   one row with a count, never a pile of rows);
3. the bracket is cut into SLICES slices of equal width; their counts, then a
   running count within each slice, locate the ranks ⌊q(n−1)⌋ and ⌈q(n−1)⌉,
   interpolated linearly as lo + d·(hi − lo). No task sorts a whole bracket.

The values themselves are never exchanged: brackets of up to GROUPS groups are
counted and broadcast, more are joined with both sides salted.

Everything is lazy DataFrame code; the result can be joined back (one row per
group) or read as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir

ACCURACY = 10_000
SLICES = 1024
#: Groups whose brackets are broadcast; and the salt of the join beyond that.
GROUPS, SALT = 10_000, 32


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                    accuracy: int = ACCURACY) -> DataFrame:
    """Long result: ``group_cols..., qi (int), quantile (double)``; null when
    the group has no non-null value."""
    out_g = list(group_cols)
    g = out_g or ["__g"]  # a constant key keeps the single-group case an equi-join
    v = F.col(value).cast("double")
    base = df.select(*(out_g or [F.lit(0).alias("__g")]), v.alias("__v")).where(F.col("__v").isNotNull())
    # ladder of bracket half-widths; per group the narrowest one that covers
    # both interpolation ranks (needs e·n ≥ 3 + 2n/accuracy) is chosen at run time
    ladder = sorted({2.0 / accuracy, 1e-3, 1e-2, 1e-1, 1.0})
    levels: list[float] = []
    index: dict[float, int] = {}

    def lvl(x: float) -> int:
        x = min(max(x, 0.0), 1.0)
        if x not in index:
            index[x] = len(levels)
            levels.append(x)
        return index[x]

    slots = [[(lvl(q - e), lvl(q + e)) for e in ladder] for q in qs]
    st = base.groupBy(*g).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__mn"), F.max("__v").alias("__mx"),
        F.percentile_approx("__v", levels, accuracy).alias("__p"),
    )

    def at(i: int) -> Column:
        x = levels[i]
        return F.col("__mn") if x == 0.0 else F.col("__mx") if x == 1.0 else F.col("__p")[i]

    need = 3.0 / F.col("__n") + 2.0 / accuracy
    structs = []
    for qi, q in enumerate(qs):
        a = b = None
        for e, (li, hi) in zip(ladder, slots[qi]):
            ok = F.lit(e) >= need
            a = F.when(ok, at(li)) if a is None else a.when(ok, at(li))
            b = F.when(ok, at(hi)) if b is None else b.when(ok, at(hi))
        structs.append(F.struct(F.lit(qi).alias("qi"), F.lit(float(q)).alias("q"),
                                a.otherwise(F.col("__mn")).alias("a"), b.otherwise(F.col("__mx")).alias("b")))
    if out_g:
        ensure_checkpoint_dir(df.sparkSession)
        brackets = st.select(*[F.col(c).alias(f"__b_{c}") for c in g], "__n", F.array(*structs).alias("brs")).checkpoint()
        cond = [F.col(c) == F.col(f"__b_{c}") for c in g]
        if brackets.count() <= GROUPS:
            joined = base.join(F.broadcast(brackets), cond)
        else:
            salt = F.pmod(F.xxhash64("__v"), F.lit(SALT))
            brackets = brackets.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
            joined = base.withColumn("__s", salt).join(brackets, cond + [F.col("__s") == F.col("__salt")])
        joined = joined.select(*g, "__v", "__n", F.explode("brs").alias("br")).select(*g, "__v", "__n", "br.*")
    else:
        # a single group: the brackets are one scalar-subquery row, fanned out
        # per value over the (few) quantiles — no join at all
        br = st.select(F.struct(F.col("__n").alias("n"), F.array(*structs).alias("arr")).alias("s")).scalar()
        joined = base.select("__g", "__v", br["n"].alias("__n"), F.explode(br["arr"]).alias("br")).select(
            "__g", "__v", "__n", "br.*")
    key = F.when(F.col("__v") >= F.col("a"), F.col("__v"))  # null = below the bracket
    place = F.least(F.floor(F.try_divide(F.col("__v") - F.col("a"), F.col("b") - F.col("a")) * SLICES), F.lit(SLICES - 1).cast("long"))
    piece = F.when(F.col("__v") < F.col("a"), F.lit(-1).cast("long")).otherwise(F.coalesce(place, F.lit(0).cast("long")))
    hist = (
        joined.where(F.col("__v") <= F.col("b"))
        .groupBy(*g, "qi", "q", "__n", piece.alias("slice"), key.alias("k"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    prior = Window.partitionBy(*g, "qi").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    pieces = hist.groupBy(*g, "qi", "slice").agg(F.sum("c").alias("sc"))  # SLICES + 1 rows per group and quantile
    pieces = pieces.select(*[F.col(c).alias(f"__p_{c}") for c in g], F.col("qi").alias("__p_qi"), F.col("slice").alias("__p_slice"),
                           F.coalesce(F.sum("sc").over(prior), F.lit(0)).alias("start"))
    hist = hist.join(pieces, [F.col(c) == F.col(f"__p_{c}") for c in [*g, "qi", "slice"]])
    w = Window.partitionBy(*g, "qi", "slice").orderBy(F.col("k").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.select("*", (F.col("start") + F.coalesce(F.sum("c").over(w), F.lit(0))).alias("before"))
    pos = F.col("q") * (F.col("__n") - 1)
    r_lo, r_hi = F.floor(pos), F.ceil(pos)
    covers = lambda r: F.col("k").isNotNull() & (F.col("before") <= r) & (r < F.col("before") + F.col("c"))
    picked = ranked.groupBy(*g, "qi", "q", "__n").agg(
        F.max(F.when(covers(r_lo), F.col("k"))).alias("lo"),
        F.max(F.when(covers(r_hi), F.col("k"))).alias("hi"),
    )
    d = pos - r_lo
    return picked.select(*out_g, F.col("qi").cast("int").alias("qi"),
                         (F.col("lo") + d * (F.col("hi") - F.col("lo"))).alias("quantile"))


def quantile_wide(df: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                  names: Sequence[str] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """One row per group, one column per quantile (``names``)."""
    names = list(names or [f"q{i}" for i in range(len(qs))])
    long = exact_quantiles(df, value, qs, group_cols, accuracy)
    return long.groupBy(*group_cols).agg(*[
        F.max(F.when(F.col("qi") == i, F.col("quantile"))).alias(n) for i, n in enumerate(names)
    ])


def quantile_scalar(df: DataFrame, value: str, q: float, accuracy: int = ACCURACY) -> Column:
    """Exact quantile of a column as a scalar-subquery Column."""
    return exact_quantiles(df, value, [q], (), accuracy).select("quantile").scalar()


def quantiles_scalar(df: DataFrame, value: str, qs: Sequence[float], accuracy: int = ACCURACY) -> list[Column]:
    """Several exact quantiles from one scalar subquery (one struct)."""
    wide = quantile_wide(df, value, qs, (), [f"q{i}" for i in range(len(qs))], accuracy)
    s = wide.select(F.struct(*[F.col(f"q{i}") for i in range(len(qs))]).alias("s")).scalar()
    return [s[f"q{i}"] for i in range(len(qs))]
