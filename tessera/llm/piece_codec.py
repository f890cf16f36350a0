"""SentencePiece (BPE) encoding by a last-token table, and decoding.

For every prefix of a text exactly one token can be the last of that prefix's
encoding.  The table is filled left to right: the tokens that end at a place
come from an Aho-Corasick automaton over the pieces, and the right one is the
one that is compatible with the last token of what precedes it.  Two adjacent
tokens are compatible if merging their joined text yields just these two.  The
ids are then read backwards from the end.  Work is linear in the text.

No piece has the space mark inside or at its end after another character, so
texts are cut before each run of marks and each distinct short unit is encoded
once per worker.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .common import per_batch

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Units up to this many characters are remembered, and this many units and
#: verdicts on pairs at once; the rest is encoded again. Bounds memory, not results.
UNIT_CHARS, UNITS, PAIRS = 48, 300_000, 400_000


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceTable:
    """Pieces of a BPE model, with encoding of units by the prefix table."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.rank: dict[str, int] = {}
        self.bytes: list[int] = [0] * 256
        self.surface: list[bytes] = []
        scores = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.surface.append(piece.replace(MARK, " ").encode())
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif model.is_control(i):
                self.surface[i] = b""
            elif model.is_unknown(i):
                self.surface[i] = " \u2047 ".encode()
            elif not model.is_unused(i):
                self.ids[piece] = i
                scores[piece] = model.get_score(i)
        # one rank per score: equal scores merge leftmost first
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in scores.items()}
        self.chars = {p for p in self.ids if len(p) == 1}
        self.inner_mark = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.known: dict[str, tuple[str, bytes]] = {}
        self.pairs = 0
        # a piece whose own text merges otherwise is never a token; each entry
        # holds the verdicts on the tokens met on the piece's left
        self.entries = [(len(p), p, i, {}) for p, i in self.ids.items() if self.merge(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for entry in self.entries:
            self.automaton.add_word(entry[1], entry)
        self.automaton.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short text, used to judge a pair of tokens."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str, verdicts: dict[str, bool]) -> bool:
        if self.pairs >= PAIRS:
            self.pairs = 0
            for entry in self.entries:
                entry[3].clear()
        self.pairs += 1
        ok = verdicts[left] = self.merge(left + right) == [left, right]
        return ok

    def tokens(self, run: str) -> list[int]:
        """Encoding of a run of characters that are all pieces."""
        last: list = [None] * len(run)  # the entry of the last token up to each place
        for end, entry in self.automaton.iter(run):
            if last[end] is None:
                before = end - entry[0]
                if before < 0:
                    last[end] = entry
                elif (left := last[before]) is not None:
                    ok = entry[3].get(left[1])
                    if ok or ok is None and self.compatible(left[1], entry[1], entry[3]):
                        last[end] = entry
        out, at = [], len(run) - 1
        while at >= 0:
            entry = last[at]
            out.append(entry[2])
            at -= entry[0]
        out.reverse()
        return out

    def unit(self, text: str) -> list[int]:
        """Ids of a unit; characters without a piece become byte tokens."""
        known, out, at = self.ids, [], 0
        if self.chars.issuperset(text):
            return self.tokens(text)
        for k, ch in enumerate(text):
            if ch not in known:
                if at < k:
                    out += self.tokens(text[at:k])
                out += [self.bytes[b] for b in ch.encode()]
                at = k + 1
        if at < len(text):
            out += self.tokens(text[at:])
        return out

    def units(self, text: str) -> list[str]:
        """Cuts that no piece crosses; the text gets its leading mark here."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self.inner_mark else UNIT.findall(marked)

    def new_unit(self, unit: str) -> tuple[str, bytes]:
        """Comma-joined ids of a unit and what they decode to, remembered if
        the unit is short."""
        ids = self.unit(unit)
        found = ",".join(map(str, ids)), b"".join([self.surface[i] for i in ids])
        if len(unit) <= UNIT_CHARS:
            if len(self.known) >= UNITS:
                self.known.clear()
            self.known[unit] = found
        return found

    def round_trip(self, text: str) -> tuple[str, str]:
        """Comma-joined ids of a text, and the text that those ids give."""
        known, new = self.known.get, self.new_unit
        found = [known(unit) or new(unit) for unit in self.units(text)]
        raw = b"".join([raw for _, raw in found])
        return ",".join([line for line, _ in found]), raw[1:].decode("utf-8", "one-mark-a-byte")

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self.unit(unit)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, marks as spaces, without the leading one."""
        raw = b"".join([self.surface[i] for i in ids])
        if ids and raw[:1] == b" " and ids[0] not in self.bytes:
            raw = raw[1:]
        return raw.decode("utf-8", "one-mark-a-byte")


# byte tokens that form no character decode to one replacement mark a byte
codecs.register_error("one-mark-a-byte", lambda e: ("\ufffd", e.start + 1))

UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``(id, ids array<int>, decoded)`` per row.

    A null text is empty: no ids and an empty decoded text.  Rows repeat as
    they come; other columns are ignored.
    """
    path = model or model_path()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = piece_table(path)
        ids = [table.encode(t or "") for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([table.decode(i) for i in ids], pa.string())],
            ["id", "ids", "decoded"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(per_batch(run), "id long, ids array<int>, decoded string"))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: like ``encode``, but only
    digests of the ids (decimal, joined by commas) and the decoded text leave a
    task.  Ids are decoded unit by unit: every encoding starts with the leading
    mark, whose space is dropped once from the joined bytes."""
    path = model or model_path()

    def one(table: PieceTable, text: str) -> tuple[int, str, str]:
        line, decoded = table.round_trip(text)
        return (line.count(",") + bool(line), hashlib.sha256(line.encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [one(piece_table(path), t or "") for t in batch.column(1).to_pylist()]
        n, a, b = zip(*rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                          ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def task(batches):
        yield from per_batch(run)(batches)
        piece_table(path).known.clear()  # a worker that other stages use again holds no units

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(task, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def op8(docs: DataFrame) -> DataFrame:
    """Ids and decoded text of every ``documents`` row as digests, in the
    contract's columns; a null text is empty, rows repeat as they come, texts of
    any length are read whole, other columns are ignored, an empty table gives
    an empty one."""
    return digests(docs).withColumnRenamed("id", "doc_id")
