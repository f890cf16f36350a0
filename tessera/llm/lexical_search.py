"""Ranked lexical search by presence masks.

Documents are read once: each task turns them into packed blocks that hold,
for the terms of the queries only, which documents hold a term and how often,
and the sums behind N, L and df.  A second pass takes one block at a time.  For
a query, the bitmaps of its terms are joined into one mask a document, which
says which of its terms the document holds.  Documents with the same mask form
a group, whose highest possible score follows from the mask, the most often
that a term stands in any of the block's documents, and the group's shortest
document.  Groups are scored by descending maximum, until the ``k``-th best
score so far is above the next maximum.  The best ``k`` of the blocks meet in two ranked
steps.

Queries are taken in blocks of at most ``QUERY_BYTES`` of text, so what tasks
hold of them is bounded; every block of queries is a pass over the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import read_blob, text_parts, written

#: Text of the queries that one pass holds in each task.
QUERY_BYTES = 32 << 20
#: Documents in one packed block, at most, and their text.
BLOCK_DOCS = 1 << 14
BLOCK_TEXT = 64 << 20
#: Everything but 0-9, A-Z, a-z and bytes above 7F parts terms; A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
NULL_ID = np.iinfo(np.int64).max
BLOCK_SCHEMA = "docs long, words long, seen binary, ids binary, lengths binary, terms binary, starts binary, rows binary, times binary"
TABLES = ("ids", "lengths", "terms", "starts", "rows", "times")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def pack_documents(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str, most: int = BLOCK_DOCS) -> DataFrame:
    """Packed blocks of at most ``most`` of ``docs`` for the terms in ``vocabulary``."""
    number = {t: k for k, t in enumerate(vocabulary)}

    def pack(ids: list[int], lengths: list[int], held: list[tuple[list[int], list[int]]], docs: int, words: int) -> pa.RecordBatch:
        sizes = [len(t) for t, _ in held]
        rows = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
        terms = np.fromiter((t for ts, _ in held for t in ts), np.int32, len(rows))
        times = np.fromiter((n for _, ns in held for n in ns), np.int32, len(rows))
        order = np.argsort(terms, kind="stable")
        found, starts, counts = np.unique(terms[order], return_index=True, return_counts=True)
        seen = np.stack([found.astype(np.int64), counts]).tobytes()
        blobs = [np.array(ids, np.int64), np.array(lengths, np.int64), found, np.append(starts, len(rows)).astype(np.int32), rows[order], times[order]]
        values = [docs, words, seen, *(b.tobytes() for b in blobs)]
        kinds = [pa.int64()] * 2 + [pa.binary()] * 7
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["docs", "words", "seen", *TABLES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, held, docs, words, size = [], [], [], 0, 0, 0
        for batch in batches:
            raw, at = text_parts(batch.column(1))
            data, at = raw.tobytes(), at.tolist()
            for doc, a, b in zip(batch.column(0).to_pylist(), at, at[1:]):
                mine = terms_of(data[a:b])
                if mine:
                    docs, words, size = docs + 1, words + len(mine), size + b - a
                    counts = Counter(mine)
                    hits = number.keys() & counts.keys()
                    if hits:
                        ids.append(NULL_ID if doc is None else doc)
                        lengths.append(len(mine))
                        held.append(([number[t] for t in hits], [counts[t] for t in hits]))
                if docs >= most or size >= BLOCK_TEXT:
                    yield pack(ids, lengths, held, docs, words)
                    ids, lengths, held, docs, words, size = [], [], [], 0, 0, 0
        if docs:
            yield pack(ids, lengths, held, docs, words)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, BLOCK_SCHEMA)


def _mask_words(k: int) -> int:
    return -(-k // 63)


class Block:
    """One packed block, asked for one query after the other."""

    def __init__(self, row: dict, weights: dict[int, int], share: tuple[int, int]):
        self.ids, self.lengths = read_blob(row["ids"], np.int64), read_blob(row["lengths"], np.int64)
        self.starts, self.rows, self.times = (read_blob(row[n], np.int32) for n in ("starts", "rows", "times"))
        self.place = {t: k for k, t in enumerate(read_blob(row["terms"], np.int32).tolist())}
        self.weights = weights
        documents, words = share
        #: the contract's m of each document
        self.norm = 50 + (50 * self.lengths * documents) // words
        #: a document's number among those of a group's choice; -1 outside
        self.chosen = np.full(len(self.ids), -1, np.int64)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.place[term]
        a, b = self.starts[k], self.starts[k + 1]
        return self.rows[a:b], self.times[a:b].astype(np.int64)

    def groups(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(documents, group of each, masks)``: documents with a term, by the mask of their terms."""
        masks = np.zeros((_mask_words(len(terms)), len(self.ids)), np.int64)
        for j, term in enumerate(terms):
            masks[j // 63, self.postings(term)[0]] |= 1 << (j % 63)
        docs = np.flatnonzero(masks.any(axis=0))
        held = masks[:, docs]
        if len(held) == 1:
            distinct, group = np.unique(held[0], return_inverse=True)
            return docs, group, distinct[None, :]
        order = np.lexsort(held)
        turned = held[:, order]
        new = np.concatenate([[True], (turned[:, 1:] != turned[:, :-1]).any(axis=0)]) if len(docs) else np.zeros(0, bool)
        group = np.empty(len(docs), np.int64)
        group[order] = np.cumsum(new) - 1
        return docs, group, turned[:, new]

    def most(self, terms: list[int], masks: np.ndarray, shortest: np.ndarray) -> np.ndarray:
        """No document of a mask scores above this."""
        out = np.zeros(masks.shape[1], np.int64)
        for j, term in enumerate(terms):
            weight = self.weights[term]
            if weight > 0:  # a term in over half of the documents may weigh below 0 and cannot add
                often = int(self.postings(term)[1].max())
                has = (masks[j // 63] >> (j % 63)) & 1
                out += has * (weight * ((1000000000 * often) // (1000 * often + 20 * shortest)))
        return out

    def scores(self, terms: list[int], docs: np.ndarray) -> np.ndarray:
        self.chosen[docs] = np.arange(len(docs))
        out = np.zeros(len(docs), np.int64)
        for term in terms:
            rows, times = self.postings(term)
            at = self.chosen[rows]
            mine = at >= 0
            at, rows, times = at[mine], rows[mine], times[mine]
            out[at] += self.weights[term] * ((1000000000 * times) // (1000 * times + 20 * self.norm[rows]))
        self.chosen[docs] = -1
        return out

    def best(self, query: list[int], k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """``(ids, scores, groups scored)`` of the ``k`` best documents with a score of ``least`` or more."""
        terms = [t for t in query if t in self.place]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not any(self.weights[t] > 0 for t in terms):
            return best_ids, best, 0
        docs, group, masks = self.groups(terms)
        shortest = np.full(masks.shape[1], np.iinfo(np.int64).max)
        np.minimum.at(shortest, group, self.norm[docs])
        limit = self.most(terms, masks, shortest)
        order = np.argsort(-limit, kind="stable")
        turn = np.empty(len(order), np.int64)  # when a group's turn comes
        turn[order] = np.arange(len(order))
        by_turn = np.argsort(turn[group], kind="stable")
        ends = np.cumsum(np.bincount(turn[group], minlength=len(order)))
        limit, done, step = limit[order], 0, k
        while done < len(order) and limit[done] >= least:
            # the next groups that hold about ``step`` documents and can reach ``least``
            begin = int(ends[done - 1]) if done else 0
            stop = int(np.searchsorted(ends, begin + step)) + 1
            stop = min(stop, int(np.searchsorted(-limit, -least, side="right")), len(order))
            stop = max(stop, done + 1)
            mine = docs[by_turn[begin:int(ends[stop - 1])]]
            got = self.scores(terms, mine)
            keep = got >= least
            best_ids, best = np.concatenate([best_ids, self.ids[mine[keep]]]), np.concatenate([best, got[keep]])
            if len(best) > k:
                first = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[first], best[first]
            if len(best) == k:
                least = max(least, int(best.min()))
            done, step = stop, step * 4
        return best_ids, best, done


def _search(blocks: DataFrame, queries: list[tuple[int, list[int]]], weights: dict[int, int], share: tuple[int, int], k: int) -> DataFrame:
    """``(query, id, score)``: the best ``k`` of every task, which carries each
    query's ``k``-th best score from block to block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block({n: batch.column(n)[at].as_py() for n in TABLES}, weights, share)
                for number, query in queries:
                    ids, scores = held.get(number, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    least = max(1, int(scores.min())) if len(scores) == k else 1
                    more, got, _ = block.best(query, k, least)
                    if len(more):
                        ids, scores = np.concatenate([ids, more]), np.concatenate([scores, got])
                        first = np.lexsort((ids, -scores))[:k]
                        held[number] = ids[first], scores[first]
        for number, (ids, scores) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number, np.int64)), pa.array(ids), pa.array(scores)], ["query", "id", "score"])

    return blocks.select(*TABLES).mapInArrow(run, "query long, id long, score long")


def _query_blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Rows ``(number, item_id, text)`` in runs of at most ``most`` bytes of text."""
    held, size = [], 0
    for row in items.toLocalIterator():
        text = (row["text"] or "").encode()
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append((row["item"], text))
        size += len(text)
    if held:
        yield held


def search(items: DataFrame, docs: DataFrame, k: int = 50, item_id: str = "item_id", item_text: str = "text",
           id_col: str = "doc_id", text_col: str = "text",
           query_bytes: int = QUERY_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(item, rank, id, score)``: the ``k`` best documents of every item.

    Each row of ``items`` is a query of its own, so repeated rows repeat their
    results; a null or empty text finds nothing; a null item id stays null.
    Rows of ``docs`` that repeat count and are found one by one; a null id
    comes last among equal scores.  Without documents there are no rows.
    """
    spark = docs.sparkSession
    queries = written(items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")), "queries")
    out, number = [], 0
    for held in _query_blocks(queries, query_bytes):
        per_item = [(item, sorted(set(terms_of(text)))) for item, text in held]
        vocabulary = sorted({t for _, ts in per_item for t in ts})
        blocks = written(pack_documents(docs, vocabulary, id_col, text_col, block_docs), "packed")
        total = blocks.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
        if total["docs"]:
            weights = _weights(blocks, len(vocabulary), total["docs"])
            place = {t: n for n, t in enumerate(vocabulary)}
            numbered = [(number + n, [place[t] for t in ts]) for n, (_, ts) in enumerate(per_item)]
            names = spark.createDataFrame([(number + n, item) for n, (item, _) in enumerate(per_item)], "query long, item long")
            found = _search(blocks, numbered, weights, (total["docs"], total["words"]), k)
            out.append(_merged(found, k).join(F.broadcast(names), "query"))  # no more rows than this block of queries
        number += len(held)
    if not out:
        return spark.createDataFrame([], "item long, rank int, id long, score long")
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every.select("item", "rank", F.when(F.col("id") != NULL_ID, F.col("id")).alias("id"), "score")


def _weights(blocks: DataFrame, size: int, documents: int) -> dict[int, int]:
    """Weight of each query term that a document holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                terms, counts = read_blob(blob, np.int64).reshape(2, -1)
                total[terms] += counts
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], ["term", "df"])

    counts = blocks.select("seen").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    # one row a query term of this block of queries
    return {r["term"]: math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1))) for r in counts.collect()}


#: Parts in which a query's candidates are ranked before they meet.
MERGE_PARTS = 64


def _merged(found: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.asc("id")]
    spread = found.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(MERGE_PARTS)))
    some = (spread.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
            .where(F.col("rank") <= k).select("query", "id", "score"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
            .where(F.col("rank") <= k).select("query", F.col("rank").cast("int").alias("rank"), "id", "score"))


def op12(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 50 best of whole ``documents`` for each ``benchmark`` item, in the
    contract's columns; see ``search`` for nulls, repeated rows and empty tables."""
    found = search(items, docs)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH toks AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM len),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, tot),
scored AS (SELECT i.item_id, tf.doc_id,
                  sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * len.n * docs) // words))))::BIGINT AS score
           FROM items i JOIN tf USING (term) JOIN w USING (term) JOIN len USING (doc_id), tot
           GROUP BY i.item_id, tf.doc_id),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
          FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranks WHERE rank <= 50"""
