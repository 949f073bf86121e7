"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen (no Python UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.config import SEGMENT_LOWER_BOUNDS, SEGMENT_ORDER, product_label


def null_safe_sum(cols: Sequence[str]) -> Column:
    """Row-wise sum that skips nulls like pandas ``sum(axis=1)``."""
    expr = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0))
        expr = term if expr is None else expr + term
    return expr


def first_argmax_label(cols: Sequence[str], labels: Sequence[str] | None = None) -> Column:
    """Label of the first column holding the row maximum (idxmax; ties and
    all-equal rows resolve to the earliest column)."""
    labels = list(labels) if labels is not None else [product_label(c) for c in cols]
    values = F.array(*[F.col(c) for c in cols])
    pos = F.array_position(values, F.array_max(values))
    return F.element_at(F.array(*[F.lit(x) for x in labels]), pos.cast("int"))


def half_even(x: Column, digits: int) -> Column:
    """Round a double half to even, as nearest integer of x × 10^digits."""
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def nearest(x: Column) -> Column:
    """``round(x)`` of a double, half away from zero, without the decimal text
    that Spark's own ``round`` makes of every value."""
    whole = F.rint(x)
    return F.when(F.abs(x - whole) == 0.5, x + F.signum(x) * 0.5).otherwise(whole)


def round_half_up(x: Column) -> Column:
    """Nearest integer with .5 going up: ``ceil`` when ``ceil(x) - x <= 0.5``."""
    return F.when(F.ceil(x) - x <= 0.5, F.ceil(x)).otherwise(F.floor(x))


def segment_label(score: Column) -> Column:
    """RMF_Score → segment name by the lower bounds of SEGMENT_ORDER."""
    expr = None
    for bound, name in reversed(list(zip(SEGMENT_LOWER_BOUNDS, SEGMENT_ORDER))):
        expr = F.when(score >= bound, name) if expr is None else expr.when(score >= bound, name)
    return expr


def segment_code(seg: Column) -> Column:
    """Segment name → ordinal 0..4 in SEGMENT_ORDER."""
    return (F.array_position(F.array(*[F.lit(s) for s in SEGMENT_ORDER]), seg) - 1).cast("bigint")


def unpivot_exprs(pairs: Sequence[tuple[str, Column]], key: str, value: str) -> Column:
    """``explode(array(struct(k, v), ...))`` — a narrow, shuffle-free unpivot
    that keeps a per-key expression (used where ``DataFrame.unpivot`` cannot
    carry different expressions per key)."""
    return F.explode(
        F.array(*[F.struct(F.lit(k).alias(key), v.alias(value)) for k, v in pairs])
    )
