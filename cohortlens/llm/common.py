"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir

#: ASCII white space, as the word rules of all operators define it (Java regex class body).
SPACE = "\\x20\\x09-\\x0D"
#: A side of a join is broadcast only after its rows were counted and are no more than this.
BROADCAST_ROWS = 20_000
#: Copies of a small side (and slices of the large one) when it is not broadcast.
SALT = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_of(col: str) -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def join_small(left: DataFrame, small: DataFrame, keys: list[str], spread: Column, how: str = "left") -> DataFrame:
    """Null-safe join of many rows with a checkpointed table of few rows per
    key. Up to BROADCAST_ROWS rows (counted) it is broadcast. Beyond that both
    sides are shuffled on the keys and a salt taken from ``spread``, so that a
    key holding a third of all rows still goes to SALT tasks."""
    names = [f"__k{i}" for i in range(len(keys))]
    s = small.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in small.columns if c not in keys])
    if s.count() <= BROADCAST_ROWS:
        cond = [same(left[k], s[n]) for k, n in zip(keys, names)]
        return left.join(F.broadcast(s), cond, how).drop(*names)
    left = left.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALT)))
    s = s.withColumn("__salt_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    cond = [same(left[k], s[n]) for k, n in zip(keys, names)] + [left["__salt"] == s["__salt_s"]]
    return left.join(s, cond, how).drop("__salt", "__salt_s", *names)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ..., so that no name can clash
    with an operator's own, and the new name of each."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def row_keys(id_col: str, text_col: str) -> list[Column]:
    """Columns that identify a row of a documents table: its id and a hash of
    its text (ids may repeat)."""
    return [F.col(id_col).alias("__id"), F.xxhash64(text_of(text_col)).alias("__text")]


def keep_rows(docs: DataFrame, keep: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (id, text hash) is in ``keep`` (columns
    ``__id``, ``__text``), all columns kept, once each: of rows that repeat
    both, one stays. The small side is hashed, so the texts are shuffled but
    not sorted; only ids that really repeat are de-duplicated."""
    rows, names = numbered(docs)
    keys = row_keys(names[id_col], names[text_col])
    keyed = rows.select("*", *keys)
    keep = keep.select(F.col("__id").alias("__kid"), F.col("__text").alias("__ktext")).distinct()
    kept = keyed.join(keep.hint("shuffle_hash"), [same(F.col("__id"), F.col("__kid")), F.col("__text") == F.col("__ktext")], "left_semi")
    repeated = cut(rows.select(*keys).groupBy("__id", "__text").agg(F.count("*").alias("__n"))
                   .where("__n > 1").select(F.col("__id").alias("__rid"), F.col("__text").alias("__rtext")))
    if not repeated.isEmpty():
        cond = [same(F.col("__id"), F.col("__rid")), F.col("__text") == F.col("__rtext")]
        many = kept.join(repeated, cond, "left_semi").dropDuplicates(["__id", "__text"])
        kept = kept.join(repeated, cond, "left_anti").unionByName(many)
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
