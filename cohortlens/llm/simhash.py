"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into fewer segments than a plain pigeonhole needs:
two segments of 32 bits for a distance of 3, so that one of them differs by at
most one bit. Each segment is indexed under its one-wildcard variants (one bit
deleted, 32 of them): two segments that differ by at most one bit share a
variant. Equal variants are joined and the full distance is verified.

Only distinct fingerprints are indexed, so exact copies cost one entry. A
variant shared by two fingerprints yields its pair from the aggregate itself;
small buckets are joined; buckets over BUCKET fingerprints are cut again by
wildcard variants of the other half, after which at most 18 bits are free.
No bucket is capped. A fingerprint has a bounded number of others within the
distance, so the links never grow with the square of a group.

Components come from alternating large-star and small-star rounds. Nodes,
roots and fingerprints of very many rows are counted and joined apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, join_small, keep_rows, same, text_of

SEED = 42
#: Distance the two-segment, one-wildcard scheme covers.
MAX_BITS = 3
#: Buckets with more distinct fingerprints are refined before pairs are made.
BUCKET = 32
#: Keys of more rows than this are joined by broadcast or salt, not in one task.
HOT = 500_000
#: Shingle hashes turned into bits at a time.
BLOCK = 1 << 15


def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of one text: A-Z lower-cased, words between ASCII white space,
    shingles of ``words`` words with repeats (all words if there are fewer), a
    bit is set if set in over half the hashes; 0 without words."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    n = max(1, len(w) - words + 1)
    ends = list(accumulate(len(x) + 1 for x in w))
    starts = [0, *ends[:n - 1]]
    ends = ends[min(words, len(w)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts[i:i + BLOCK], ends[i:i + BLOCK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                      text_of(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def _half(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * i).bitwiseAND(F.lit(0xFFFFFFFF))


def _variants(half: Column, bits: int, tag: int) -> Column:
    """Keys of a segment with one bit deleted: (tag, place of the bit, the other bits)."""
    return F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda j: F.shiftleft((F.lit(tag * bits) + j).cast("long"), bits)
                       .bitwiseOR(half.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), j)))))


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a < b) of the distinct values of column ``fp`` that differ in at
    most ``max_bits`` bits (up to 3)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"two segments with one wildcard cover up to {MAX_BITS} bits")
    # 64 variants for each: many tasks, however few the fingerprints' own bytes take
    fps = cut(fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp"))
    keys = fps.select("fp", F.explode(F.concat(_variants(_half(F.col("fp"), 0), 32, 0),
                                               _variants(_half(F.col("fp"), 1), 32, 1))).alias("key"))
    shared = cut(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
    pairs = shared.where("n = 2").select("a", "b").where(_near(F.col("a"), F.col("b"), max_bits))
    more = shared.where("n > 2").select(F.col("key").alias("k"), "n")
    rest = cut(keys.join(more, F.col("key") == F.col("k"), "inner").select("key", "fp", "n"))
    small = rest.where(F.col("n") <= BUCKET).select("key", "fp")
    pairs = pairs.union(_join_equal(small, ["key"], max_bits))
    large = rest.where(F.col("n") > BUCKET)
    if not large.isEmpty():
        # the half that is not shared, cut into two segments of 16 bits with one wildcard each
        other = F.when(F.col("key") < F.lit(32 << 32), _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0))
        lo, hi = other.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(other, 16)
        large = large.select("key", "fp", F.explode(F.concat(_variants(lo, 16, 0), _variants(hi, 16, 1))).alias("sub"))
        pairs = pairs.union(_join_equal(large, ["key", "sub"], max_bits))
    return pairs.distinct()


def _join_equal(rows: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    a, b = rows.alias("l"), rows.alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    cond += [F.col("l.fp") < F.col("r.fp"), _near(F.col("l.fp"), F.col("r.fp"), max_bits)]
    return a.join(b, cond).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def _join_hot(rows: DataFrame, side: DataFrame, key: str, spread: Column) -> DataFrame:
    """``rows`` with the columns of ``side``: one row per ``key``, with ``n``,
    how many of ``rows`` have it. Keys of more than HOT rows are broadcast or
    salted by ``spread``; the rest are joined by a shuffle."""
    hot = side.where(F.col("n") > HOT).drop("n").withColumn("__hot", F.lit(True))
    if hot.isEmpty():
        return rows.join(side.drop("n"), key)
    found = join_small(rows, cut(hot), [key], spread)
    rest = found.where("__hot IS NULL").select(*rows.columns).join(side.where(F.col("n") <= HOT).drop("n"), key)
    return found.where("__hot").drop("__hot").unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of the pairs (a, b), by large-star
    and small-star rounds until the edges are stars around the smallest nodes,
    which neither step changes; each step is written to the checkpoint folder."""
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        down = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        near = cut(edges.union(down).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n"),
                                                      F.count_if(F.col("v") < F.col("u")).alias("below")))
        if near.where("below > 1 OR (below = 1 AND n > 0)").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        large = _join_hot(down, near.where("n > 0").drop("below"), "u", F.col("v"))
        large = cut(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = _join_hot(large, near, "u", F.col("v"))
        edges = cut(small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits),
    component_id (smallest doc_id reachable over links), text_hash.

    A null text is empty; texts without words have fingerprint zero and are
    linked like any other. Null ids are ignored by the minimum; a component of
    null ids only has a null component_id. Rows may repeat. Other columns of
    the input are ignored. An empty table gives an empty result."""
    rows = cut(fingerprints(docs, words, id_col, text_col))
    least = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    root = components(links(least.select("fp"), max_bits))
    labelled = cut(least.join(root, F.col("fp") == F.col("node"), "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")))
    comp = cut(labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    label = cut(_join_hot(labelled.select("fp", "rows", "root"), comp, "root", F.col("fp")).select("fp", "component_id", F.col("rows").alias("n")))
    return (_join_hot(rows, label, "fp", F.xxhash64("doc_id", "text_hash"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash"))


def deduplicate(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all
    columns kept; of rows that repeat that id, one with the smallest text hash."""
    kept = (near_duplicates(docs, words, max_bits, id_col, text_col).where(same(F.col("doc_id"), F.col("component_id")))
            .groupBy("doc_id", "component_id").agg(F.min("text_hash").alias("__text")))
    return keep_rows(docs, kept.select(F.col("doc_id").alias("__id"), "__text"), id_col, text_col)
