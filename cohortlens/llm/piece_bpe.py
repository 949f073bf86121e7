"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

For every prefix of a text there is exactly one token that the BPE encoding
of that prefix ends with. The table holds it per prefix: an automaton gives
all pieces that end at a place; such a piece is the last token iff it and the
last token of the prefix before it are compatible, that is, BPE on the two
joined gives just the two. The ids are read backwards from the end.

BPE never merges across a place where no piece has both characters, so the
text is first cut before each space that follows another character and around
line feeds. The tables of short parts are kept for the next rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from cohortlens.llm.common import text_of

SPACE_MARK = "▁"
#: Parts up to this many characters are remembered, so many of them at most.
SHORT, REMEMBER = 48, 300_000
NORMAL, BYTE = 1, 6


class PrefixEncoder:
    """Encoder for one model file. ``encode`` gives all ids of a text."""

    def __init__(self, model: str | bytes):
        data = model if isinstance(model, bytes) else open(model, "rb").read()
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(data)
        norm, train = spec.normalizer_spec, spec.trainer_spec
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or train.treat_whitespace_as_suffix or train.model_type != 2 or not train.byte_fallback):
            raise ValueError("needs a BPE model with identity normalisation, kept white space and byte fallback")
        kinds = {p.type for p in spec.pieces}
        if kinds - {1, 2, 3, 6}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = SPACE_MARK if norm.add_dummy_prefix else ""
        self.id = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        self.piece = [p.piece for p in spec.pieces]
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        inner = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.id)
        feeds = any("\n" in p for p in self.id)
        # parts that no merge crosses
        self.parts = re.compile(r"(?s).+" if inner else f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+" if feeds else f"\n|{SPACE_MARK}*[^{SPACE_MARK}\n]+|{SPACE_MARK}+")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            if len(p) > 1 and self._merge(p) == [p]:  # others are never reached
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.single = {p: i for p, i in self.id.items() if len(p) == 1}
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)

    def _merge(self, text: str) -> list[str]:
        """Plain BPE by the model's scores: the best pair first, the leftmost of equals."""
        out, score = list(text), self.score
        while len(out) > 1:
            best, at = None, -1
            for k in range(len(out) - 1):
                s = score.get(out[k] + out[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            out[at:at + 2] = [out[at] + out[at + 1]]
        return out

    def _compatible(self, left: int, right: int) -> bool:
        a, b = self.piece[left], self.piece[right]
        return self._merge(a + b) == [a, b]

    def _table(self, part: str) -> tuple[int, ...]:
        """Ids of a part: last token and its length for each prefix, then backwards."""
        n = len(part)
        single, fits, vocabulary = self.single, self.fits, len(self.piece)
        last, width = [-1] * (n + 1), [0] * (n + 1)
        ends: dict[int, list[tuple[int, int]]] = {}
        for end, token in self.automaton.iter(part):
            ends.setdefault(end + 1, []).append(token)
        for i in range(1, n + 1):
            for size, token in ends.get(i, ()):
                before = last[i - size]
                if before >= 0:
                    key = before * vocabulary + token
                    ok = fits.get(key)
                    if ok is None:
                        if len(fits) > 4 * REMEMBER:
                            fits.clear()
                        ok = fits[key] = self._compatible(before, token)
                    if not ok:
                        continue
                last[i], width[i] = token, size
                break
            else:  # one character; -2 if it is no piece, then nothing merges with it
                last[i], width[i] = single.get(part[i - 1], -2), 1
        out: list[int] = []
        i = n
        while i:
            if last[i] >= 0:
                out.append(last[i])
            else:
                out.extend(self.byte[x] for x in reversed(part[i - 1].encode("utf-8", "surrogatepass")))
            i -= width[i]
        out.reverse()
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        known, out = self.known, []
        for part in self.parts.findall(self.prefix + text.replace(" ", SPACE_MARK)):
            ids = known.get(part)
            if ids is None:
                ids = self._table(part)
                if len(part) <= SHORT:
                    if len(known) >= REMEMBER:
                        known.clear()
                    known[part] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The library's own decode(ids)."""
        return self.library.decode(ids) if ids else ""


@lru_cache(maxsize=2)
def encoder(model: bytes) -> PrefixEncoder:
    """One encoder per worker process and model."""
    return PrefixEncoder(model)


def default_model() -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes | None = None, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256, and
    with ``with_ids`` the ids and the decoded text.

    The model file (half a megabyte; its bytes, read on the driver) goes with
    the tasks. A null text is empty and has no ids; ids of rows may be null or
    repeat; other columns are ignored. An empty table gives an empty result."""
    data = model if model is not None else default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sha = encoder(data), hashlib.sha256
        for b in batches:
            n, ids_sha, text_sha, all_ids, texts = [], [], [], [], []
            for t in b.column(1):
                ids = enc.encode(t.as_py() or "")
                text = enc.decode(ids)
                n.append(len(ids))
                ids_sha.append(sha(",".join(map(str, ids)).encode()).hexdigest())
                text_sha.append(sha(text.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
                    texts.append(text)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    src = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return src.mapInArrow(run, schema + (", ids array<int>, decoded string" if with_ids else ""))
