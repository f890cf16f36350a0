"""Token counts from distinct pre-tokens.

Documents are cut into blocks.  A block keeps, per document, which of the
block's distinct pre-tokens occur how often (written once, packed).  The
blocks' vocabularies meet by hash range, where each distinct pre-token's pieces
are counted once with the tokenizer.  The counts join the blocks' vocabularies
again and are summed against the documents' frequencies.  Token ids are never
kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .blocks import NOTE_SCHEMA, PART_SCHEMA, dicts, first_block_number, range_edges, rows_of, with_notes
from .common import written

TOKENIZER = "byte_bpe_50k.json"
#: Characters of text per block; a longer document is a block of its own.
BLOCK_CHARS = 24 << 20
#: Packed vocabulary per hash range.
RANGE_BYTES = 16 << 20
LIMIT = 512
#: The tokenizer's own split pattern (a fixed value of its file format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Characters of blocks in which the tables of letters and digits of ``regex``
#: and of the tokenizer agree (tested over all code points).  Text with any
#: other goes through the tokenizer's own split, which is slower.
PLAIN = ("\u0000-\u0557\u2000-\u206F\u20A0-\u2BFF\u3000-\u9FFF\uAC00-\uD7A3\uFB00-\uFFFF"
         "\U0001F000-\U0001FAFF")
NOT_PLAIN = regex.compile(f"[^{PLAIN}]")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    specials = sorted((a.content for a in t.get_added_tokens_decoder().values()), key=len, reverse=True)
    # special strings are cut out first, then the split pattern applies to what is between
    cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
    return t, regex.compile(SPLIT), cut, frozenset(specials)


def _split(text: str, path: str) -> list[str]:
    tokenizer, split, _, _ = _tokenizer(path)
    if NOT_PLAIN.search(text):
        return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    return split.findall(text)


def pre_tokens(text: str, path: str) -> list[str]:
    """Pre-tokens of a text; a special string is one of its own."""
    _, _, cut, specials = _tokenizer(path)
    if cut is None or not cut.search(text):
        return _split(text, path)
    out = []
    for part in cut.split(text):
        out += [part] if part in specials else _split(part, path)
    return out


def count_pieces(words: list[str], path: str) -> np.ndarray:
    """Number of pieces of each pre-token."""
    t = _tokenizer(path)[0]
    return np.fromiter((len(e.ids) for e in t.encode_batch_fast(words, add_special_tokens=False)), np.int32, len(words))


BLOCK_SCHEMA = "block long, ids binary, n_bytes binary, ends binary, places binary, times binary, words binary"
NO_ID = np.iinfo(np.int64).min


def _pack(raw: bytes) -> bytes:
    return zstandard.compress(raw, 3)


def _unpack(blob: bytes) -> bytes:
    return zstandard.decompress(blob)


def _pack_words(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), np.int32, len(words))
    return _pack(np.int32(len(words)).tobytes() + sizes.tobytes() + b"".join(words))


def _unpack_words(blob: bytes) -> list[bytes]:
    raw = _unpack(blob)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    ends = (np.cumsum(np.frombuffer(raw, np.int32, n, 4)) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _block(number: int, ids: list, texts: list[str], path: str) -> pa.RecordBatch:
    """Documents as (place of pre-token, times); a block's distinct pre-tokens
    are numbered by their hash, so that ranges of hashes are ranges of places."""
    seen: dict[str, int] = {}
    found_in, n_bytes = [], []
    for text in texts:
        found: dict[str, int] = {}
        for w in pre_tokens(text, path):
            found[w] = found.get(w, 0) + 1
        found_in.append((np.fromiter((seen.setdefault(w, len(seen)) for w in found), np.int32, len(found)),
                         np.fromiter(found.values(), np.int32, len(found))))
        n_bytes.append(len(text.encode()))
    words = [w.encode() for w in seen]
    order = np.argsort(_hashes(words), kind="stable")
    place = np.empty(len(words), np.int32)
    place[order] = np.arange(len(words), dtype=np.int32)
    places, times = [], []
    for word, n in found_in:
        p = place[word]
        o = np.argsort(p)
        places.append(np.diff(p[o], prepend=0).astype(np.int32))  # steps are small
        times.append(n[o])
    out = (np.array([NO_ID if i is None else i for i in ids], np.int64), np.array(n_bytes, np.int64),
           np.cumsum(list(map(len, places))), np.concatenate(places), np.concatenate(times).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), *(pa.array([_pack(x.tobytes())]) for x in out), pa.array([_pack_words([words[i] for i in order])])],
        [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` per row.  A null text is empty and has no
    tokens; rows repeat as they come, with null ids too; other columns are
    ignored; an empty table gives an empty one."""
    path = tokenizer or tokenizer_path()

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = first_block_number(), [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = t or ""
                if texts and size + len(t) > BLOCK_CHARS:
                    yield _block(number, ids, texts, path)
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t) + 16
        if texts:
            yield _block(number, ids, texts, path)

    blocks = written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                     .mapInArrow(block, BLOCK_SCHEMA), "blocks")
    size = blocks.agg(F.sum(F.length("words"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    edges = np.array(range_edges(parts), np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in dicts(batches):
            words = _unpack_words(row["words"])
            cut = [0, *np.searchsorted(_hashes(words), edges).tolist(), len(words)]
            yield from rows_of(PART_SCHEMA, [(p, 0, row["block"], _pack_words(words[a:b]))
                                             for p, (a, b) in enumerate(zip(cut, cut[1:])) if a < b])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # each distinct pre-token of the range gets a number, then its pieces are counted once
        seen: dict[bytes, int] = {}
        asked = []
        for row in dicts(batches):
            words = _unpack_words(row["blob"])
            asked.append((row["block"], row["part"], np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))))
        if asked:
            pieces = count_pieces([w.decode() for w in seen], path)
            yield from rows_of(NOTE_SCHEMA, [(b, p, _pack(pieces[at].tobytes())) for b, p, at in asked])

    notes = (blocks.select("block", "words").mapInArrow(send, PART_SCHEMA)
             .repartitionById(parts, F.col("part")).mapInArrow(count, NOTE_SCHEMA))

    def total(row: dict, found: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        get = lambda name, kind: np.frombuffer(_unpack(row[name]), kind)
        pieces = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(_unpack(blob), np.int32) for _, blob in sorted(found))])
        ends, steps = get("ends", np.int64), get("places", np.int32)
        starts = np.concatenate([[0], ends[:-1]])
        run = np.cumsum(steps, dtype=np.int64)
        before = np.repeat(np.concatenate([[0], run])[starts], ends - starts)  # steps start anew with each document
        sums = np.concatenate([[0], np.cumsum(pieces[run - before] * get("times", np.int32), dtype=np.int64)])
        ids = [None if i == NO_ID else i for i in get("ids", np.int64).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(get("n_bytes", np.int64)),
                                          pa.array(sums[ends] - sums[starts])], ["id", "n_bytes", "n_tokens"])

    return with_notes(blocks.drop("words"), notes, parts, total, "id long, n_bytes long, n_tokens long")


def op4(docs: DataFrame) -> DataFrame:
    """Token counts of every ``documents`` text, in the contract's columns; see
    ``token_counts`` for nulls, repeated rows and empty tables.  Texts of any
    length are read whole."""
    return token_counts(docs).select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                                     (F.col("n_tokens") > LIMIT).alias("over_limit"))
