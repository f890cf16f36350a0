"""SpotSigs fingerprints.

A signature is a common word (the anchor) with the chain of the next
``CHAIN`` content words after it.  A text's fingerprint is one set, of the same
kind at every size: its signatures, the words and symbols that no chain spans,
and its ``FEW`` words of least hash.  An edit of one word changes the chains it
stands in and a few words, never the whole set of a longer text.  The likeness
of two texts is the Jaccard index of their sets; given a threshold, ``likeness``
skips pairs whose lengths alone rule it out.  Each text is compared with its
edit and with the next text; there is no match of all texts.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

CHAIN = 3
FEW = 8
#: Common words of the four languages (fixed values).
ANCHORS = frozenset("""
the of and to in a is that was for it on are as with be by this from or at an he his have not
der die das und zu von den mit ist des im dem nicht ein eine für auf sich er als auch es an werden aus
le la les de des et un une du en que qui dans est pour sur au pas par il avec ce se plus ne
el los las del y que en un una por con no para se al lo como más su es ha
""".split())
TOKEN = re.compile(r"\w+|[^\w\s]")
WORDS_KEPT = 500_000


@lru_cache(maxsize=WORDS_KEPT)
def _hash(token: str) -> int:
    """62 bits of the token's digest; the lowest bit marks an anchor, the next
    one a symbol."""
    h = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little")
    symbol = len(token) == 1 and not (token.isalnum() or token == "_")
    return (h & ~3) | symbol << 1 | (token in ANCHORS)


_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _fold(acc: np.ndarray, x: np.ndarray) -> np.ndarray:
    acc = (acc ^ x) * _MIX[0]
    acc ^= acc >> np.uint64(29)
    acc *= _MIX[1]
    return acc ^ (acc >> np.uint64(32))


def signatures(text: str, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct members of a text's set as 64-bit numbers.

    An anchor with fewer than ``chain`` content words after it gives no
    signature.  What stands outside every span from an anchor to the end of its
    chain counts word by word and symbol by symbol, so a text without anchors
    is the set of its words.  The ``FEW`` words of least hash are a sample that
    an edit of one word changes in one place; they keep a short text, whose few
    chains one edit can change all at once, comparable.  White space alone
    gives an empty set.
    """
    return members(_hashes(text), chain)


def _hashes(text: str) -> np.ndarray:
    return np.array(list(map(_hash, TOKEN.findall(text.lower()))), np.uint64)


def members(h: np.ndarray, chain: int = CHAIN) -> np.ndarray:
    """``signatures`` of a text given by its tokens' hashes."""
    anchors = np.flatnonzero(h & np.uint64(1))
    contents = np.flatnonzero((h & np.uint64(3)) == 0)
    after = np.searchsorted(contents, anchors)  # content words before each anchor
    keep = after + chain <= len(contents)
    at, starts = after[keep], anchors[keep]
    content, sig = h[contents], h[starts]
    for k in range(chain):
        sig = _fold(sig, content[at + k])
    ends = contents[at + chain - 1] + 1 if chain else starts + 1
    n = len(h) + 1
    spans = np.cumsum(np.bincount(starts, minlength=n) - np.bincount(ends, minlength=n))[:-1]
    sample = np.unique(h[(h & np.uint64(2)) == 0])[:FEW]
    return np.unique(np.concatenate([sig, h[spans == 0], sample]))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard index of two sorted sets; 1 for two empty ones.  Where the
    lengths alone rule out ``least``, 0 without a look at the members."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def as_text(sig: np.ndarray) -> str:
    """A set as a short string: its length and a digest of its members."""
    return f"{len(sig)}:{hashlib.blake2b(sig.tobytes(), digest_size=16).hexdigest()}"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """``(id, sigs array<long>)`` per row; a null text is empty."""
    def run(batches):
        for batch in batches:
            sigs = [signatures(t or "", chain).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.list_(pa.int64()))], ["id", "sigs"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, sigs array<long>"))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the start of the next one."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_EDGE = RESULT + ", part int, place string, text string"


def _head(text: str) -> int:
    """End of the part that a text shares with its edit, at white space: no
    token reaches across it."""
    return max(text.rfind(" ", 0, len(text) - len(text) // 4), 0)


def _read(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shared head's tokens, and a text's set."""
    head = _hashes(text[:_head(text)])
    return head, members(np.concatenate([head, _hashes(text[_head(text):])]))


def _row(doc_id, text: str, following: str, head: np.ndarray, sig: np.ndarray, next_sig: np.ndarray) -> tuple:
    other = edited(text, following)
    other_sig = sig if other == text else members(np.concatenate([head, _hashes(other[_head(text):])]))
    return (doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), as_text(sig), as_text(other_sig),
            likeness(sig, other_sig), likeness(sig, next_sig))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``RESULT`` columns: each row's fingerprint, that of its edited text, and
    its likeness to the edited text and to the next row by id (after the last
    comes the first).

    One range exchange brings the rows into id order; neighbours inside a
    partition meet there, and only the first and last row of each partition
    are matched across partitions.  A null text is empty; null ids come first;
    rows with equal ids follow each other by text; a single row is its own
    next; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
               .repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    names = [f.split()[0] for f in _EDGE.split(", ")]
    types = pa.schema([(f.split()[0], {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}[f.split()[1]])
                       for f in _EDGE.split(", ")])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)

    def inside(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last = None
        rows: list[tuple] = []
        edge = lambda doc_id, text, place: (doc_id,) + (None,) * 6 + (part, place, text)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                head, sig = _read(text)
                if last is None:
                    rows.append(edge(doc_id, text, "first"))
                else:
                    rows.append(_row(*last[:2], text, *last[2:], sig) + (part, None, None))
                last = doc_id, text, head, sig
                if len(rows) >= 512:
                    yield batch_of(rows)
                    rows = []
        if last is not None:
            rows.append(edge(*last[:2], "last"))
        if rows:
            yield batch_of(rows)

    found = written(ordered.mapInArrow(inside, _EDGE), "neighbours")
    # two rows per partition, paired around the circle of partitions
    edges = found.where("place is not null").select("part", "place", "doc_id", "text")
    first = edges.where("place = 'first'").select("part", F.col("text").alias("next_text"))
    circle = Window.orderBy("part")
    order = (first.select("part").withColumn("following", F.lead("part").over(circle))
             .withColumn("start", F.min("part").over(circle))
             .select("part", F.coalesce("following", "start").alias("next_part")))
    across = (edges.where("place = 'last'").join(order, "part")
              .join(first.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "next_text"))

    def outside(batches):
        for batch in batches:
            rows = [_row(i, t, n, *_read(t), signatures(n)) + (None,) * 3
                    for i, t, n in zip(*(batch.column(k).to_pylist() for k in range(3)))]
            if rows:
                yield batch_of(rows).select(names[:-3])

    return found.where("place is null").drop("part", "place", "text").unionByName(across.mapInArrow(outside, RESULT))


def op9(docs: DataFrame) -> DataFrame:
    """Fingerprints of every ``documents`` row, its edit and its neighbour, in the
    contract's columns; see ``with_next`` for nulls, repeated rows and empty tables."""
    return with_next(docs)
