"""Conversation structure repair by an auction shortest-path algorithm.

A conversation's rows in order and four states (nothing yet, after system,
after user, after assistant) span a lattice: node (i, q) means that i rows are
done and the output so far ends in state q. Arcs are edits with integer costs;
a shortest path to the accepting end is a cheapest repair.

The auction keeps a price per node, at most the cost of any arc plus the price
of its end, and a path from the origin along which both are equal. The path's
last node either bids: its price rises to its cheapest arc and the path
contracts by one node, or, at that price, the path extends along the arc. When
it reaches the end, the origin's price is the least cost. Every cheapest path
then consists of tight arcs (price = cost + price of the end) from which tight
arcs lead on to the end, so following the smallest label gives the least audit.

Long conversations are solved in blocks of rows from the last one back; the
prices that a block's auctions leave on its four entry nodes are those of its
predecessor's exits, so work and memory grow with the number of rows.

Rows are shuffled and sorted once by conversation. Each is there twice: first
all rows of the conversation without text, from which the audit is found, then
those with their texts, which are edited and hashed one by one. So a task holds
a byte per row of one conversation, and never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Costs of the edits; TRUNCATED is added to a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Rows of a block.
BLOCK = 64
#: Results of blocks that a task remembers (a few hundred bytes each).
REMEMBER = 50_000
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled row leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Classes of rows: initial of the role (o: another one), upper case if
#: truncated, x: blank or duplicate; $ is the end of the conversation.
CLASSES = "suaoSUAOx$"
ROWS_OUT = 4096


def arcs(kind: str, state: int) -> list[tuple[str, int, int, int]]:
    """(label, cost, rows done, next state), by label."""
    insert = ("I", INSERT, 0, NEXT[state])
    if kind == "$":
        return ([("", 0, 1, state)] if state in (START, ASSISTANT) else []) + [insert]
    out = [("D", DELETE, 1, state), insert]
    if kind == "x":
        return out
    extra, own = (TRUNCATED if kind.isupper() else 0), {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(kind.lower())
    if own == NEXT[state] or (own == SYSTEM and state == START):
        out.append(("K", extra, 1, own))
    if own != NEXT[state]:
        out.append(("R", REROLE + extra, 1, NEXT[state]))
    return out


_ARCS = {k: [arcs(k, q) for q in range(4)] for k in CLASSES}


class Block:
    """The lattice of some rows, with known prices of its four exits."""

    def __init__(self, kinds: str, exits: tuple[int, ...]):
        self.end = 4 * len(kinds)
        self.arcs = [[(label, cost, 4 * (i + done) + to) for label, cost, done, to in _ARCS[k][q]]
                     for i, k in enumerate(kinds) for q in range(4)]
        self.prices = [min(exits)] * self.end + list(exits)

    def price(self, origin: int) -> int:
        """Least cost from the node to the end, by auction."""
        p, path = self.prices, [origin]
        while True:
            node = path[-1]
            cost, to = min((cost + p[to], to) for _, cost, to in self.arcs[node])
            if p[node] < cost:
                p[node] = cost
                if len(path) > 1:
                    path.pop()
            elif to >= self.end:
                return p[origin]
            else:
                path.append(to)

    def trace(self, state: int) -> tuple[str, int]:
        """Labels of the least cheapest path from an entry whose price is known, and its exit state."""
        tight = [[(label, to) for label, cost, to in out if self.prices[i] == cost + self.prices[to]] for i, out in enumerate(self.arcs)]
        leads = [False] * self.end + [True] * 4
        for first in range(self.end - 4, -1, -4):
            for _ in range(3):  # inserts stay on the level
                for i in range(first, first + 4):
                    leads[i] = leads[i] or any(leads[to] for _, to in tight[i])
        node, labels = state, []
        while node < self.end:
            label, node = min(x for x in tight[node] if leads[x[1]])
            labels.append(label)
        return "".join(labels), node - self.end


@lru_cache(maxsize=REMEMBER)
def _entries(kinds: str, exits: tuple[int, ...]) -> tuple[int, ...]:
    block = Block(kinds, exits)
    return tuple(block.price(q) for q in range(4))


@lru_cache(maxsize=REMEMBER)
def _trace(kinds: str, exits: tuple[int, ...], state: int) -> tuple[int, str, int]:
    block = Block(kinds, exits)
    return block.price(state), *block.trace(state)


def least_repair(kinds: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows of these classes."""
    kinds += "$"
    parts = [kinds[i:i + BLOCK] for i in range(0, len(kinds), BLOCK)]
    exits, base, known = (0, 0, 0, 0), 0, []
    for part in reversed(parts):
        known.append(exits)
        if len(known) < len(parts):
            prices = _entries(part, exits)
            base += min(prices)
            exits = tuple(p - min(prices) for p in prices)
    first, state, audit = None, START, []
    for part, exits in zip(parts, reversed(known)):
        price, labels, state = _trace(part, exits, state)
        first = price if first is None else first
        audit.append(labels)
    return base + first, "".join(audit)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, live: the rows with the contract's damage.
    A dropped row stays with ``live`` false, so that its conversation does."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in (conv_col, turn_col))
    role, text = F.coalesce(F.col(role_col), space), F.coalesce(F.col(text_col), space)
    code = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    return rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (code != 0).alias("live"),
        F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def plain(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, live of rows as they are (null role and text: one space)."""
    return rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), F.lit(True).alias("live"))


def _last(text: Column) -> Column:
    """The last character that isn't ASCII white space ('' if none)."""
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows twice (``full`` false, then true) in the order in which a task
    reads a conversation, with their class (null if not live)."""
    from pyspark.sql import Window
    letter = F.substring("role", 1, 1)
    blank, cut_short = _last(F.col("text")) == "", ~_last(F.col("text")).isin(".", "!", "?")
    kind = F.when(letter.isin("s", "u", "a"), letter).otherwise("o")
    rows = rows.select("conv_id", "turn", "role", "text", "live", F.md5("text").alias("h"), blank.alias("blank"), cut_short.alias("cut_short"), kind.alias("kind"))
    twice = F.explode(F.when(F.col("live"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    rows = rows.select("*", twice.alias("full")).withColumn("text", F.when(F.col("full"), F.col("text"))).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "full", "live", "role", "h").orderBy("turn")) > 1
    fault = F.when(F.col("blank"), "b").when(F.col("seen"), "d").when(F.col("cut_short"), "t").otherwise("")
    return (rows.withColumn("seen", seen).withColumn("fault", fault)
            .withColumn("kind", F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper("kind")).otherwise(F.col("kind")))
            .sortWithinPartitions("conv_id", "full", "turn", "role", "h", "seen"))


class _Conversation:
    """What a task keeps of the conversation it reads."""

    def __init__(self, conv_id):
        self.conv_id, self.kinds, self.letter, self.audit, self.cost = conv_id, bytearray(), None, None, 0
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal, self.turns, self.first, self.last = 0, 0, None, None
        self.state, self.at, self.done = START, 0, 0

    def note(self, turn, role: str, kind: str, fault: str) -> None:
        """A row without its text."""
        self.kinds += kind.encode()
        if fault:
            self.faults[fault] += 1
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        if self.letter is not None and self.letter + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.letter = role[:1]

    def solve(self) -> None:
        if self.audit is None:
            self.cost, self.audit = least_repair(self.kinds.decode()) if self.kinds else (0, "")

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield "I", ROLES[self.state], ""

    def edit(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(label, role, text) of the rows that the next row becomes."""
        yield from self.inserted()
        label, kind = self.audit[self.at], chr(self.kinds[self.done])
        self.at, self.done = self.at + 1, self.done + 1
        if label != "D":
            _, _, _, self.state = next(a for a in _ARCS[kind][self.state] if a[0] == label)
            yield label, ROLES[self.state] if label == "R" else role, text

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, str | None, str, str]]:
    """(conversation, label, role, text) of each repaired row, and once with
    label None when a conversation is over."""
    conv = None
    for b in batches:
        for conv_id, full, live, turn, role, text, kind, fault in zip(*(b.column(c).to_pylist() for c in _COLUMNS)):
            if conv is None or conv.conv_id != conv_id:
                if conv is not None:
                    yield from _finish(conv)
                conv = _Conversation(conv_id)
            if not live:
                continue
            if not full:
                conv.note(turn, role, kind, fault)
            else:
                conv.solve()
                for out in conv.edit(role, text):
                    yield conv, *out
    if conv is not None:
        yield from _finish(conv)


def _finish(conv: _Conversation) -> Iterator[tuple[_Conversation, str | None, str, str]]:
    conv.solve()
    for out in conv.inserted():
        yield conv, *out
    yield conv, None, "", ""


_COLUMNS = ["conv_id", "full", "live", "turn", "role", "text", "kind", "fault"]


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, position (from 0), edit (K, R or I), role, text of the repaired
    rows of :func:`plain` or :func:`damage`."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, id_type = [None, pa.int64(), pa.string(), pa.string(), pa.string()], None

        def typed(it):
            nonlocal id_type
            for b in it:
                id_type = b.schema.field("conv_id").type
                yield b

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(zip(*out), types)],
                                              names=["conv_id", "position", "edit", "role", "text"])
        out, position = [], 0
        for conv, label, role, text in _read(typed(batches)):
            if label is None:
                position = 0
                continue
            out.append((conv.conv_id, position, label, role, text))
            position += 1
            if len(out) >= ROWS_OUT:
                yield batch(out)
                out = []
        if out:
            yield batch(out)
    return _sorted(rows).select(*_COLUMNS).mapInArrow(run, f"conv_id {kind}, position long, edit string, role string, text string")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of :func:`plain` or :func:`damage`: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, nulls first; equal turns by role, then by a hash of the
    text. Null role and text count as one space, so such a row is blank, or has
    no fitting role; an empty role fits nowhere. A null conv_id is a
    conversation of its own. A conversation whose rows were all dropped has
    zeros, an empty audit and the hash of the empty string. Repeated rows are
    duplicates; other columns are ignored; an empty table gives an empty result."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, id_type = [None, *[pa.int64()] * 6, pa.string(), pa.string()], None

        def typed(it):
            nonlocal id_type
            for b in it:
                id_type = b.schema.field("conv_id").type
                yield b

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(zip(*out), types)], names=names)
        out, sha, started = [], hashlib.sha256(), False
        for conv, label, role, text in _read(typed(batches)):
            if label is not None:
                sha.update(f"{chr(10) if started else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                started = True
                continue
            f = conv.faults
            out.append((conv.conv_id, conv.gaps, f["b"], f["d"], f["t"], conv.illegal, conv.cost, conv.audit, sha.hexdigest()))
            sha, started = hashlib.sha256(), False
            if len(out) >= ROWS_OUT:
                yield batch(out)
                out = []
        if out:
            yield batch(out)
    longs = ", ".join(f"{n} long" for n in names[1:7])
    return _sorted(rows).select(*_COLUMNS).mapInArrow(run, f"conv_id {kind}, {longs}, audit string, repaired_sha256 string")
