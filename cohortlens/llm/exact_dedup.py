"""Exact de-duplication: tree-merge of sorted digest runs.

Documents are dealt to R runs by a hash of their id. A run is the list of its
distinct digests in order, each with its smallest id and its number of rows. In
every round the runs whose numbers share all but the last four bits come
together: one exchange on run // 16 and digest, a sort by digest, in which the
entries of the 16 runs merge, and one pass over neighbours that keeps the
smallest id of each digest. It ends with one run per digest. The result goes
down the same tree: each level takes the winner from the level above, so no key
of a join ever has more rows than 16 runs, or one run's share of a digest, can
hold. A group with a third of all rows is spread over all R runs.

A digest is verified at each level: entries merge only if the SHA-256, an
independent 64-bit hash and the length of the normalised text all agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACE, cut, keep_rows, row_keys, same, text_of

#: Runs merged into one in a round, as a power of two.
FAN_BITS = 4
KEY = ["sha", "chk", "len"]


def _levels(docs: DataFrame) -> int:
    """Rounds so that there are at least as many first runs as shuffle partitions."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while (1 << (FAN_BITS * rounds)) < parts:
        rounds += 1
    return rounds


def _merged(rows: DataFrame) -> DataFrame:
    """One sorted run per ``run`` of its entries: rows sorted by digest and id,
    of neighbours with the same digest the first stays, with the sum of their sizes."""
    order = Window.partitionBy("run", *KEY).orderBy(F.col("keep").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (rows.select(*KEY, "run", "keep", F.sum("size").over(whole).alias("size"), F.row_number().over(order).alias("place"))
            .where("place = 1").drop("place"))


def group_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept,
    text_sha256, text_hash (smallest xxhash64 of the raw texts of that id).

    Texts are equal when identical after each run of ASCII white space became
    one space; a null text is the empty text. The smallest id stays; null ids
    sort last (a group of null ids only has a null keep_id and one kept row).
    Rows that repeat an id and its text count in group_size, and only one of
    them is kept. Other columns of the input are ignored, so their names can't
    clash. An empty table gives an empty result."""
    norm = F.regexp_replace(text_of(text_col), f"[{SPACE}]+", " ")
    base = (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"), norm.alias("t"))
            .select("doc_id", "text_hash", F.sha2("t", 256).alias("sha"), F.xxhash64("t").alias("chk"),
                    F.octet_length("t").alias("len")))
    rounds = _levels(docs)
    run = F.pmod(F.xxhash64("doc_id"), F.lit(1 << (FAN_BITS * rounds)))
    base = cut(base.groupBy("doc_id", *KEY).agg(F.count("*").alias("m"), F.min("text_hash").alias("text_hash")).withColumn("run", run))

    levels = [cut(_merged(base.select(*KEY, "run", F.col("doc_id").alias("keep"), F.col("m").alias("size"))))]
    for _ in range(rounds):  # up: binomial rounds, 16 runs into one
        levels.append(cut(_merged(levels[-1].withColumn("run", F.shiftrightunsigned("run", FAN_BITS)))))
    won = levels.pop()
    while levels:  # down: each run learns the winner
        won = _from_above(levels.pop().select(*KEY, "run"), won, FAN_BITS)
    out = _from_above(base, won, 0)
    stays = same(F.col("doc_id"), F.col("keep"))
    return (out.select("doc_id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), stays.alias("s"),
                       F.col("sha").alias("text_sha256"), "text_hash",
                       F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("i"))
            .select("doc_id", "keep_id", "group_size", (F.col("s") & (F.col("i") == 1)).alias("kept"), "text_sha256",
                    "text_hash"))


def _from_above(rows: DataFrame, won: DataFrame, bits: int) -> DataFrame:
    w = won.select(*[F.col(k).alias(f"w_{k}") for k in KEY], F.col("run").alias("w_run"), "keep", "size")
    cond = [rows[k] == w[f"w_{k}"] for k in KEY] + [F.shiftrightunsigned(rows["run"], bits) == w["w_run"]]
    return rows.join(w, cond, "inner").select(*rows.columns, "keep", "size")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = (group_copies(docs, id_col, text_col).where("kept")
            .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text")))
    return keep_rows(docs, kept, id_col, text_col)


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
h AS (SELECT doc_id, t, sha256(t) AS text_sha256 FROM n)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM h
"""
