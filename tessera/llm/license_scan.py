"""License scan: an exact containment join of text blocks with templates.

A document's words are covered by blocks of ``SPAN`` words, one every
``STEP``, so that ``SPAN - STEP`` consecutive words always stand whole in a
block.  Templates and blocks are sets of words.  A block meets a template when
it holds at least ``THRESHOLD`` of the template's words, hence at least
``need`` of them.

The words of the templates are ordered by how often they stand in the whole
corpus, the rarest first.  A block that holds ``need`` words of a template
holds one of its first ``size - need + 1`` (prefix filter), has as many
template words at all (length filter), and from the first shared word on
enough words are left in both (positional filter).  What passes is counted in
full, so no block is missed and none is reported wrongly.  Where a block meets
two templates and one has all words of the other, the smaller says nothing.

Documents are read once, into packed blocks that keep the places of template
words and the counts behind the order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import read_blob, text_parts, written

SPAN, STEP = 32, 16
THRESHOLD = 0.9
#: Documents in one packed block, at most, and their words.
PACK_DOCS = 1 << 14
PACK_WORDS = 1 << 22
NULL_ID = np.iinfo(np.int64).max

# The phrases whose places are counted, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Sentences of well-known license notices, and their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used", "bsd"),
    ("licensed under the bsd license", "bsd"),
    ("to use copy modify and or distribute this software for any purpose with or without fee", "isc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("all rights reserved no part of this publication may be reproduced", "proprietary"),
)

#: 0-9, a-z, A-Z (as a-z) and bytes above 7F make words; all else parts them.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Index:
    """Templates over a vocabulary whose words are numbered by rising count."""

    def __init__(self, phrases, templates, threshold: float):
        texts = [(words_of(t.encode()), label, True) for t, label in phrases]
        texts += [(words_of(t.encode()), label, False) for t, label in templates]
        longest = max(len(words) for words, _, _ in texts)
        if longest > SPAN - STEP:
            raise ValueError(f"a template has {longest} words; blocks cover {SPAN - STEP} in a row")
        self.texts = texts
        self.labels = [label for _, label, _ in texts]
        self.exact = np.array([phrase for _, _, phrase in texts])
        sets = [set(words) for words, _, _ in texts]
        self.inside = [(a, b) for a, (_, _, phrase) in enumerate(texts) for b in range(len(texts)) if not phrase and sets[a] < sets[b]]
        self.vocabulary = sorted({w for words, _, _ in texts for w in words})
        self.number = {w: k for k, w in enumerate(self.vocabulary)}
        self.sizes = np.array([len(set(words)) for words, _, _ in texts])
        # a phrase has to be there whole; rounding must not ask for one word more
        self.need = np.array([size if phrase else math.ceil(size * threshold - 1e-9)
                              for size, (_, _, phrase) in zip(self.sizes.tolist(), texts)])

    def order(self, counts: np.ndarray) -> None:
        """Number the words by count (rarest first, ties by spelling)."""
        ranks = np.empty(len(counts), np.int64)
        ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts))
        self.ranks = ranks
        self.has = np.zeros((len(self.texts), len(counts)), bool)  # by rank
        prefix = []
        for t, (words, _, _) in enumerate(self.texts):
            mine = np.sort(ranks[[self.number[w] for w in set(words)]])
            self.has[t, mine] = True
            prefix += [(int(r), t, at) for at, r in enumerate(mine[:self.sizes[t] - self.need[t] + 1])]
        prefix.sort()
        self.prefix = np.array(prefix, np.int64).reshape(-1, 3)
        self.phrases = [(t, ranks[[self.number[w] for w in words]]) for t, (words, _, phrase) in enumerate(self.texts) if phrase]


PACK_SCHEMA = "ids binary, lengths binary, starts binary, places binary, words binary, counts binary"
TABLES = ("ids", "lengths", "starts", "places", "words")


def pack_documents(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str, most: int = PACK_DOCS) -> DataFrame:
    """Packed blocks of at most ``most`` documents: per document its id and length, and the places and
    numbers of its template words; ``counts`` sums those numbers."""
    def pack(ids, lengths, places, words) -> pa.RecordBatch:
        starts = np.cumsum([0, *map(len, places)])
        flat = np.concatenate([*words, np.zeros(0, np.int32)])
        blobs = [np.array(ids, np.int64), np.array(lengths, np.int64), starts.astype(np.int64),
                 np.concatenate([*places, np.zeros(0, np.int64)]), flat.astype(np.int32), np.bincount(flat, minlength=len(number)).astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in blobs], [*TABLES, "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, places, words, size = [], [], [], [], 0
        get = number.get
        for batch in batches:
            raw, at = text_parts(batch.column(1))
            data, at = raw.tobytes(), at.tolist()
            for doc, a, b in zip(batch.column(0).to_pylist(), at, at[1:]):
                mine = words_of(data[a:b])
                found = np.fromiter(map(get, mine, repeat(-1)), np.int32, len(mine))
                hits = np.flatnonzero(found >= 0)
                ids.append(NULL_ID if doc is None else doc)
                lengths.append(len(mine))
                places.append(hits)
                words.append(found[hits])
                size += len(hits)
                if len(ids) >= most or size >= PACK_WORDS:
                    yield pack(ids, lengths, places, words)
                    ids, lengths, places, words, size = [], [], [], [], 0
        if ids:
            yield pack(ids, lengths, places, words)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, PACK_SCHEMA)


def candidates(key: np.ndarray, rank: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(block, template, shared words)`` of every block that meets a template.

    ``key`` and ``rank`` list each block's distinct template words, sorted by
    block, then rank.
    """
    none = np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else none
    block = np.zeros(len(key), np.int64)
    block[new] = 1
    block = np.cumsum(block) - 1
    size = np.diff(np.append(new, len(key)))
    at = np.arange(len(key)) - new[block] if len(key) else none
    # prefix filter: each word meets the templates that have it in their prefix
    lo = np.searchsorted(index.prefix[:, 0], rank, side="left")
    hi = np.searchsorted(index.prefix[:, 0], rank, side="right")
    word = np.repeat(np.arange(len(key)), hi - lo)
    if not len(word):
        return none, none, none
    entry = np.arange(len(word)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[word]
    _, template, place = index.prefix[entry].T
    held, need = block[word], index.need[template]
    # length filter, then positional filter: the first shared word and what is left in both; a word that
    # is not the first one shared leaves less, but then the first one passes for the same pair
    keep = size[held] >= need
    keep &= np.minimum(size[held] - at[word], index.sizes[template] - place) >= need - _before(place, at[word])
    pairs = np.unique(held[keep] * len(index.sizes) + template[keep])
    held, template = np.divmod(pairs, len(index.sizes))
    shared = np.zeros(len(pairs), np.int64)
    for k in range(int(size.max())):  # at most the words of a block
        inside = np.flatnonzero(size[held] > k)
        shared[inside] += index.has[template[inside], rank[new[held[inside]] + k]]
    keep = shared >= index.need[template]
    for a, b in index.inside:
        keep &= (template != a) | ~np.isin(held, held[keep & (template == b)])
    return key[new[held[keep]]], template[keep], shared[keep]


def _before(place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Most words that a pair can share before this one."""
    return np.minimum(place, at)


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text", pack_docs: int = PACK_DOCS) -> DataFrame:
    """Per row of ``docs``: ``(id, n_words, places, place_labels, blocks,
    block_labels, shares)``.

    ``places`` are the first words of every place of a phrase, ascending, with
    their labels; ``blocks`` the first words of the blocks that meet a
    template, with its label and the share of its words that is there.  Phrases
    are found through the same join, as templates that have to be there whole,
    and then read word by word.

    A null text is empty and has no rows of either kind; rows may repeat; a
    null id stays null; an empty table gives no rows.
    """
    index = Index(phrases, templates, threshold)
    packed = written(pack_documents(docs, index.number, id_col, text_col, pack_docs), "places")
    index.order(_counts(packed, len(index.vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, lengths, starts, places = (read_blob(batch.column(n)[at].as_py(), np.int64) for n in TABLES[:4])
                yield from _rows(ids, lengths, starts, places, index.ranks[read_blob(batch.column("words")[at].as_py(), np.int32)], index)

    return packed.select(*TABLES).mapInArrow(run, SCAN_SCHEMA)


SCAN_SCHEMA = ("id long, n_words long, places array<long>, place_labels array<string>, blocks array<long>, "
               "block_labels array<string>, shares array<double>")


def _counts(packed: DataFrame, size: int) -> np.ndarray:
    """How often each template word stands in the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += read_blob(blob, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["word", "n"])

    out = np.zeros(size, np.int64)
    for row in packed.select("counts").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[row["word"]] = row["n"]  # one row a word of the templates
    return out


def _rows(ids, lengths, starts, places, ranks, index: Index) -> Iterator[pa.RecordBatch]:
    doc = np.repeat(np.arange(len(ids)), np.diff(starts))
    # a word at place p is in the blocks p // STEP and the ones before that still reach it
    last = places // STEP
    reach = SPAN // STEP
    base = np.concatenate([[0], np.cumsum(lengths // STEP + 1)])  # number of a document's first block
    key = np.concatenate([base[doc] + last - back for back in range(reach)])
    word = np.tile(ranks, reach)
    inside = np.concatenate([last >= back for back in range(reach)])
    pairs = np.unique(key[inside] * len(index.vocabulary) + word[inside])
    block, template, shared = candidates(*np.divmod(pairs, len(index.vocabulary)), index)
    owner = np.searchsorted(base, block, side="right") - 1
    start = (block - base[owner]) * STEP

    exact = index.exact[template]
    found = _phrase_places(owner[exact], start[exact], template[exact], starts, places, ranks, index)
    hits = owner[~exact], start[~exact], template[~exact], (shared / index.sizes[template])[~exact]
    n = len(ids)
    lists = [_lists(found[0], n, found[1], pa.int64()), _lists(found[0], n, [index.labels[t] for t in found[2]], pa.string()),
             _lists(hits[0], n, hits[1], pa.int64()), _lists(hits[0], n, [index.labels[t] for t in hits[2]], pa.string()),
             _lists(hits[0], n, hits[3], pa.float64())]
    names = ["id", "n_words", "places", "place_labels", "blocks", "block_labels", "shares"]
    yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NULL_ID), pa.array(lengths), *lists], names)


def _phrase_places(owner, start, template, starts, places, ranks, index: Index):
    """Places of phrases in their candidate blocks: ``(document, first word, template)``, each once."""
    out: set[tuple[int, int, int]] = set()
    words = dict(index.phrases)
    for doc, first, t in zip(owner.tolist(), start.tolist(), template.tolist()):
        a, b = starts[doc], starts[doc + 1]
        lo, hi = a + np.searchsorted(places[a:b], [first, first + SPAN])
        at, seen, phrase = places[lo:hi], ranks[lo:hi], words[t]
        m = len(phrase)
        if len(at) >= m:
            ok = np.ones(len(at) - m + 1, bool)
            for k in range(m):
                ok &= (seen[k:len(at) - m + 1 + k] == phrase[k]) & (at[k:len(at) - m + 1 + k] == at[:len(at) - m + 1] + k)
            out.update((doc, int(p), t) for p in at[:len(ok)][ok])
    cols = np.array(sorted(out), np.int64).reshape(-1, 3)
    return cols[:, 0], cols[:, 1], cols[:, 2]


def _lists(owner: np.ndarray, n: int, values, kind: pa.DataType) -> pa.ListArray:
    """Values as one list per document; ``owner`` ascends."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def op13(docs: DataFrame, pack_docs: int = PACK_DOCS) -> DataFrame:
    """License scan of whole ``documents`` in the contract's columns.

    ``score`` is the greatest share of a template's words in one block (1.0
    for a phrase's place), 0.0 where nothing is found; see ``scan`` for nulls,
    repeated rows and empty tables.  Other columns do not count.
    """
    found = scan(docs, pack_docs=pack_docs)
    base = F.array_sort(F.array_distinct("place_labels"))
    every = F.array_sort(F.array_distinct(F.concat("place_labels", "block_labels")))
    whole = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
                        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                        F.greatest(whole, F.coalesce(F.array_max("shares"), F.lit(0.0))).alias("score"))
