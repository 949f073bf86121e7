"""Token ids packed into fixed-length rows by best fit decreasing.

Documents are encoded to ids with an end mark, and cut losslessly into parts
of at most one row. Parts are dealt by a hash to shards of a bounded size;
within a shard they come longest first (Spark's sort) and each goes to the row
with the least room that still holds it. A segment tree over the room left
finds that row in logarithmic time. Each packed row carries its ids, the
cumulative lengths of its segments and positions that start again at 0 with
each segment.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import text_of

ROW = 2048
#: Bytes of text dealt to a shard: some million ids, which a task holds while it packs.
SHARD_BYTES = 8 << 20
#: The id after each document; the rank files leave it free.
END_ID = 50256
SCHEMA = ("shard long, row long, n_tokens int, doc_ids array<{id}>, parts array<int>, cu_seqlens array<int>, "
          "ids binary, positions binary, text_hashes array<long>")


class Room:
    """Rows by the room they have left: the number of rows of each room in the
    leaves of a segment tree, sums above."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room that is at least ``need``."""
        at, count = need + self.leaves, self.count
        if not count[at]:
            # up until a right neighbour has rows, then down its left edge
            while at & 1 or not count[at + 1]:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.leaves:
                at <<= 1
                if not count[at]:
                    at += 1
        room = at - self.leaves
        row = self.rows[room].pop()
        self._change(room, -1)
        return room, row


def best_fit(lengths: list[int], size: int) -> list[int]:
    """Row number of each length, for lengths in decreasing order."""
    room, rows, out = Room(size), 0, []
    for n in lengths:
        found = room.take(n)
        if found is None:
            left, row = size, rows
            rows += 1
        else:
            left, row = found
        out.append(row)
        if left > n:
            room.put(left - n, row)
    return out


def default_ranks() -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import public_tokenizers
    import tiktoken
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def _ids(values: list[int], wide: bool) -> bytes:
    return np.array(values, dtype="<u4" if wide else "<u2").tobytes()


def token_parts(docs: DataFrame, ranks: bytes, row: int = ROW, end_id: int = END_ID, wide: bool = False, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, part, n, ids (little-endian unsigned, 2 bytes or with
    ``wide`` 4): the ids of each document and the end mark, in parts of at most
    ``row`` ids."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(ranks)
        for b in batches:
            at, part, n, out = [], [], [], []
            for i, t in enumerate(b.column(2)):
                ids = enc.encode_ordinary(t.as_py())
                ids.append(end_id)
                for k in range(0, len(ids), row):
                    piece = ids[k:k + row]
                    at.append(i)
                    part.append(k // row)
                    n.append(len(piece))
                    out.append(_ids(piece, wide))
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(where), b.column(1).take(where), pa.array(part, pa.int32()), pa.array(n, pa.int32()),
                                              pa.array(out, pa.binary())], names=["doc_id", "text_hash", "part", "n", "ids"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text_hash long, part int, n int, ids binary")


def pack(docs: DataFrame, ranks: bytes | None = None, row: int = ROW, end_id: int = END_ID, pad_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", shard_bytes: int = SHARD_BYTES, wide: bool = False) -> DataFrame:
    """One row per packed row: shard, row, n_tokens (without padding),
    doc_ids and parts of its segments, cu_seqlens (0, then the end of each
    segment), ids (``row`` ids, padded with ``pad_id``), positions (4 bytes
    each as ids with ``wide``, else 2), text_hashes of its segments.

    Nothing is dropped: a null or empty text is its end mark; every part of a
    long text is a segment, and parts by number join to the whole. Ids of
    documents may be null or repeat; ties of length go by id, text hash and
    part, so reruns agree. Other columns are ignored. An empty table gives an
    empty result."""
    if row < 1 or row > 1 << (32 if wide else 16):
        raise ValueError("a row must fit the width of positions")
    ranks = ranks if ranks is not None else default_ranks()
    size = docs.agg(F.sum(F.octet_length(text_of(text_col)) + 1)).first()[0] or 0
    shards = int(size // shard_bytes) + 1
    parts = token_parts(docs, ranks, row, end_id, wide, id_col, text_col)
    parts = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash", "part"), F.lit(shards).cast("long")))
    # as many reducers as the session has shuffle partitions, each with some shards
    parts = parts.repartition("shard").sortWithinPartitions("shard", F.desc("n"), "doc_id", "text_hash", "part")
    parts = parts.select("shard", "doc_id", "part", "n", "ids", "text_hash")
    id_type = parts.schema["doc_id"].dataType
    kind = "<u4" if wide else "<u2"
    names = ["shard", "row", "n_tokens", "doc_ids", "parts", "cu_seqlens", "ids", "positions", "text_hashes"]

    def packed(shard: int, items: list[tuple], arrow_id: pa.DataType) -> pa.RecordBatch:
        rows: dict[int, list[tuple]] = {}
        for item, r in zip(items, best_fit([x[2] for x in items], row)):
            rows.setdefault(r, []).append(item)
        total, doc_ids, numbers, ends, ids, positions, hashes = [], [], [], [], [], [], []
        pad = np.array([pad_id], dtype=kind).tobytes()
        for segments in rows.values():
            lengths = [x[2] for x in segments]
            cu = np.concatenate([[0], np.cumsum(lengths)])
            n = int(cu[-1])
            total.append(n)
            doc_ids.append([x[0] for x in segments])
            numbers.append([x[1] for x in segments])
            hashes.append([x[4] for x in segments])
            ends.append(cu.tolist())
            ids.append(b"".join(x[3] for x in segments) + pad * (row - n))
            place = np.arange(row)
            place[:n] -= np.repeat(cu[:-1], lengths)
            place[n:] = 0
            positions.append(place.astype(kind).tobytes())
        k = len(total)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard] * k, pa.int64()), pa.array(list(rows), pa.int64()), pa.array(total, pa.int32()), pa.array(doc_ids, pa.list_(arrow_id)),
             pa.array(numbers, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(ids, pa.binary()), pa.array(positions, pa.binary()),
             pa.array(hashes, pa.list_(pa.int64()))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, items, arrow_id = None, [], None
        for b in batches:
            arrow_id = b.schema.field("doc_id").type
            for s, *item in zip(*(c.to_pylist() for c in b.columns)):
                if s != shard:
                    if items:
                        yield packed(shard, items, arrow_id)
                    shard, items = s, []
                items.append(tuple(item))
        if items:
            yield packed(shard, items, arrow_id)

    return parts.mapInArrow(run, SCHEMA.format(id=id_type.simpleString()))


def write_packed(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the packed rows as Parquet (one id matrix per file, a row of ids
    per record) and return them as written."""
    pack(docs, **options).write.mode("error").parquet(path)
    return docs.sparkSession.read.parquet(path)


def unpack(rows: DataFrame, wide: bool = False) -> DataFrame:
    """doc_id, text_hash, ids (array): the documents back from packed rows,
    with end marks; a row per input row, also for ids that repeat or are null.
    Rows that repeat an id and its text are equal in every part, so a part found
    n times belongs to n of them."""
    kind, unit = ("<u4", 4) if wide else ("<u2", 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [], [])
            for doc_ids, parts, cu, ids, hashes in zip(*(c.to_pylist() for c in b.columns)):
                for d, h, p, s, e in zip(doc_ids, hashes, parts, cu, cu[1:]):
                    out[0].append(d)
                    out[1].append(h)
                    out[2].append(p)
                    out[3].append(np.frombuffer(ids[s * unit:e * unit], dtype=kind).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.column(0).type.value_type), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int32()))],
                                             names=["doc_id", "text_hash", "part", "ids"])

    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()
    segments = rows.select("doc_ids", "parts", "cu_seqlens", "ids", "text_hashes").mapInArrow(
        run, f"doc_id {id_type}, text_hash long, part int, ids array<int>")
    parts = segments.groupBy("doc_id", "text_hash", "part").agg(F.first("ids").alias("ids"), F.count("*").alias("n"))
    whole = parts.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("p"), F.max("n").alias("n"))
    return whole.select("doc_id", "text_hash", F.flatten(F.col("p.ids")).alias("ids"),
                        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i")).drop("i")
