"""Document fingerprints by a homomorphic multiset hash.

A paragraph is a line with anything but white space. It is hashed to a wide
vector of two parts: 8 lanes that are uniform modulo 2**64, and 256 lanes
modulo 2**16, the sum of a +1/-1 vector per phrase of the paragraph. A text's
fingerprint is the sum of its paragraphs' vectors, each lane modulo its power
of two. So it does not depend on the order of the paragraphs, equal multisets
have equal fingerprints, two fingerprints add up to that of both texts, and a
paragraph is inserted or deleted by adding or subtracting its vector.

The uniform lanes tell multisets apart (512 bits). The sign lanes tell how much
two texts share: the mean product of two texts' lanes estimates the number of
common phrases, the mean square that of a text's own (both counted with
multiplicity), with a standard error of about 1 / 16 of the geometric mean.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, join_small, text_of

WIDE, SIGNS = 8, 256
#: A phrase ends at a word that ends with one of these, or after so many words.
PHRASE_END, PHRASE_WORDS = ".,;:!?", 16
#: Rows of an output batch.
ROWS_OUT = 512
#: Ranges of ids per shuffle partition; with several, partitions come out even.
BUCKETS = 4
#: Sums that a task of ``merged`` holds before it passes them on.
GROUPS_HELD = 4096


def _phrases(paragraph: str) -> list[bytes]:
    out, start, words = [], 0, paragraph.split()
    for i, w in enumerate(words, 1):
        if w[-1] in PHRASE_END or i - start == PHRASE_WORDS:
            out.append(" ".join(words[start:i]).encode("utf-8", "surrogatepass"))
            start = i
    if start < len(words):
        out.append(" ".join(words[start:]).encode("utf-8", "surrogatepass"))
    return out


class Fingerprint:
    """Lanes of a multiset of paragraphs; ``+`` and ``-`` are those of the multisets."""

    __slots__ = ("wide", "signs")

    def __init__(self, wide: np.ndarray, signs: np.ndarray):
        self.wide, self.signs = wide, signs

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        """All paragraphs of a text (none: all lanes zero)."""
        paragraphs = [p for p in text.split("\n") if p and not p.isspace()]
        wide = b"".join(hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=8 * WIDE).digest() for p in paragraphs)
        bits = b"".join([hashlib.blake2b(x, digest_size=SIGNS // 8).digest() for p in paragraphs for x in _phrases(p)])
        rows = np.unpackbits(np.frombuffer(bits, dtype=np.uint8).reshape(-1, SIGNS // 8), axis=1)
        signs = 2 * rows.sum(axis=0, dtype=np.int64) - len(rows)
        return cls(np.frombuffer(wide, dtype="<u8").reshape(-1, WIDE).sum(axis=0, dtype=np.uint64), signs.astype(np.uint16))

    @classmethod
    def parse(cls, name: str) -> Fingerprint:
        raw = bytes.fromhex(name)
        return cls(np.frombuffer(raw[:8 * WIDE], dtype="<u8").astype(np.uint64), np.frombuffer(raw[8 * WIDE:], dtype="<u2").astype(np.uint16))

    def __str__(self) -> str:
        return self.wide.astype("<u8").tobytes().hex() + self.signs.astype("<u2").tobytes().hex()

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.signs + other.signs)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.signs - other.signs)

    def likeness(self, other: Fingerprint) -> float:
        """Estimated common phrases over phrases of either, 0 to 1; 1 if and
        only if the fingerprints are equal, 0 if just one is empty."""
        if (self.wide == other.wide).all() and (self.signs == other.signs).all():
            return 1.0
        a, b = self.signs.astype(np.int16).astype(np.float64), other.signs.astype(np.int16).astype(np.float64)
        common = float(a @ b)
        either = float(a @ a) + float(b @ b) - common
        return min(max(common / either, 0.0), 1.0 - 2**-53) if either > 0 else 0.0


def insert(fingerprint: str, paragraphs: str) -> str:
    """The fingerprint with the paragraphs of a text added, without the rest of the text."""
    return str(Fingerprint.parse(fingerprint) + Fingerprint.of(paragraphs))


def delete(fingerprint: str, paragraphs: str) -> str:
    """The fingerprint with the paragraphs of a text taken out."""
    return str(Fingerprint.parse(fingerprint) - Fingerprint.of(paragraphs))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint of every row. A null text is empty; an
    empty text, or one of white space, has the fingerprint zero."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([str(Fingerprint.of(t)) for t in texts], pa.string())],
                                             names=["doc_id", "n_chars", "fingerprint"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def merged(rows: DataFrame, by: str, fingerprint_col: str = "fingerprint") -> DataFrame:
    """``by``, fingerprint: the fingerprint of all texts of a group together,
    from their fingerprints alone (a null one is left out). Tasks add up their own rows by group, and
    the partial sums of the tasks are added in rounds of 16 to 1, so a group of
    any size is never in one task."""
    kind = rows.schema[by].dataType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}

        def batch(sums: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(sums, group_type), pa.array(map(str, sums.values()), pa.string())], names=["g", "f"])

        for b in batches:
            group_type = b.schema.field("g").type
            for g, f in zip(b.column("g").to_pylist(), b.column("f").to_pylist()):
                one = Fingerprint.parse(f)
                total[g] = total[g] + one if g in total else one
            if len(total) > GROUPS_HELD:  # all but the group being read, where rows come sorted
                rest = {g: total.pop(g)}
                yield batch(total)
                total = rest
        if total:
            yield batch(total)

    part = rows.select(F.col(by).alias("g"), F.col(fingerprint_col).alias("f")).where("f IS NOT NULL").mapInArrow(add, f"g {kind}, f string")
    while True:
        part = cut(part.withColumn("p", F.spark_partition_id()))
        most = part.groupBy("g").count().agg(F.max("count").alias("m")).first()["m"] or 1
        if most == 1:
            return part.select(F.col("g").alias(by), F.col("f").alias(fingerprint_col))
        slots = -(-most // 16)
        part = part.withColumn("s", F.pmod(F.xxhash64("p"), F.lit(slots))).repartition("g", "s").sortWithinPartitions("g").select("g", "f").mapInArrow(add, f"g {kind}, f string")


def _in_order(src: DataFrame) -> DataFrame | None:
    """bucket, tail, doc_id, text, h, n of ``src`` (doc_id, text, h), sorted within partitions by bucket.

    Buckets are ranges of (doc_id, h), nulls first; each also holds, as its
    last row, a copy of the first row of the next bucket (``tail``; the last
    bucket that of the first). So a bucket read in order shows every row with
    its successor, texts are shuffled once, and no bucket need fit in memory.
    Rows equal in id and text are one row with a count."""
    spark = src.sparkSession
    keys = cut(src.groupBy("doc_id", "h").agg(F.count("*").alias("n")))
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = (keys.repartitionByRange(buckets, "doc_id", "h").groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min(F.struct("doc_id", "h")).alias("first")).collect())  # a row per bucket
    bounds = sorted((r["first"]["doc_id"] is not None, r["first"]["doc_id"], r["first"]["h"]) for r in firsts)
    if not bounds:
        return None
    repeated = cut(keys.where("n > 1"))
    if repeated.isEmpty():
        once = src.withColumn("n", F.lit(1).cast("long"))
    else:
        found = join_small(src, repeated, ["doc_id", "h"], F.monotonically_increasing_id())
        once = (found.where("n IS NULL").withColumn("n", F.lit(1).cast("long"))
                .unionByName(found.where("n IS NOT NULL").dropDuplicates(["doc_id", "h"])))

    @F.arrow_udf("struct<bucket: int, first: boolean>")
    def place(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        keys = [(i is not None, i, h) for i, h in zip(ids.to_pylist(), hashes.to_pylist())]
        at = [bisect_right(bounds, k) - 1 for k in keys]
        return pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array([bounds[i] == k for i, k in zip(at, keys)], pa.bool_())],
                                          names=["bucket", "first"])

    last = len(bounds) - 1
    own = F.struct(F.col("place.bucket").alias("bucket"), F.lit(False).alias("tail"))
    before = F.struct(F.when(F.col("place.bucket") == 0, last).otherwise(F.col("place.bucket") - 1).alias("bucket"), F.lit(True).alias("tail"))
    at = F.explode(F.when(F.col("place.first"), F.array(own, before)).otherwise(F.array(own)))
    return (once.withColumn("place", place("doc_id", "h")).select(at.alias("at"), "doc_id", "text", "h", "n")
            .select("at.bucket", "at.tail", "doc_id", "text", "h", "n")
            .repartition("bucket").sortWithinPartitions("bucket", "tail", "doc_id", "h"))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first half-length of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row, the next row being that of the next
    larger id.

    A null text is empty. Null ids come first; rows with the same id follow a
    64-bit hash of their texts, and rows equal in both follow each other. The
    last row's next is the first one (a single row's: itself). Other columns
    are ignored; an empty table gives an empty result."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    schema = (f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    rows = _in_order(src)
    if rows is None:
        return docs.sparkSession.createDataFrame([], schema)

    def pair(doc_id, text: str, own: Fingerprint, following: str, other: Fingerprint) -> tuple:
        new = edited(text, following)
        after = own if new == text else Fingerprint.of(new)
        return (doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), str(own), str(after),
                own.likeness(after), own.likeness(other))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind, names = None, None, [x.split()[0] for x in schema.split(", ")]
        types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t or kind) for c, t in zip(zip(*out), types)], names=names)

        for b in batches:
            kind, out = b.schema.field("doc_id").type, []
            cols = [b.column(c) for c in ("tail", "doc_id", "text", "n")]
            for i in range(b.num_rows):
                tail, doc_id, text, n = (c[i].as_py() for c in cols)
                own = Fingerprint.of(text)
                if held is not None:
                    out.append(pair(*held, text, own))
                held = None if tail else (doc_id, text, own)
                if n > 1 and not tail:  # equal rows: each but the last is followed by its copy
                    one = pair(*held, text, own)
                    for start in range(0, n - 1, ROWS_OUT):
                        yield batch([one] * min(ROWS_OUT, n - 1 - start))
                if len(out) >= ROWS_OUT:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

    return rows.select("tail", "doc_id", "text", "n").mapInArrow(run, schema)
