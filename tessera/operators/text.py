"""Text statistics: term counts, document frequency, IDF, TF-IDF, top terms
and cosine similarity.

Terms come from splitting on whitespace, lower-casing and dropping every
non-letter; empty results are discarded.  Operators are lazy DataFrame
transformations, but for ``doc_tfidf``, which stores the IDF (and what it
packs), and ``pairwise_cosine``, which stores its pairs; nothing is collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import normalize_term, plain_words, split_words
from ..plans import joins
from ..plans.grid import CHUNK_ENTRIES, SparseGrid, grid_side
from ..plans.iterate import Materializer
from ..plans.joins import broadcast_if_bounded, measured
from ..plans.layout import spread, text_parts
from ..session import share_code


def tokenize(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per non-empty term occurrence: ``(*keep, term)``.

    Words are normalised and empty results dropped inside the array, before
    the explode, so each word is normalised exactly once (a filter after the
    explode would be pushed below the projection and evaluate it twice).
    """
    terms = F.filter(F.transform(split_words(text), normalize_term), lambda t: t != "")
    return spread(df.select(*keep, text)).select(*keep, F.explode(terms).alias("term"))


def term_frequency(df: DataFrame, text: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """Raw occurrence count per term, optionally per ``by`` key (e.g. doc id).

    Without keys ``groupBy`` runs a partial aggregate before the shuffle, so a
    term that makes up a large share of all tokens costs one row per map task.
    With keys the normalised words move once, a row per text, and are counted
    where they meet (see ``term_lists``); the counts stay dealt by key.
    """
    if by:
        return counted_terms(term_lists(df, text, by), by).drop("n_terms")
    return tokenize(df, text).groupBy("term").agg(F.count(F.lit(1)).alias("tf"))


def term_lists(df: DataFrame, text: str = "text", by: tuple[str, ...] = ("doc_id",), parts: int | None = None) -> DataFrame:
    """``(*by, words)``: per key the terms of all its texts, joined by spaces
    (terms hold letters only); empty where there are none."""
    own = df.select(*by, text)
    words = spread(own).select(*by, plain_words(text).alias("words"))
    met = words.repartition(parts or text_parts(own), *by).groupBy(*by)
    return met.agg(F.concat_ws(" ", F.collect_list(F.when(F.col("words") != "", F.col("words")))).alias("words"))


def counted_terms(lists: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``(*keep, n_terms, term, tf)``, one row per list and distinct term;
    ``n_terms`` counts all terms of the list.  No row leaves its task: a list
    is sorted, and each run of equal terms is its term's count."""
    terms = lists.where("words != ''").select(*keep, F.sort_array(F.split("words", " ")).alias("_t"))
    new = F.filter(F.sequence(F.lit(0), F.size("_t") - 1), lambda i: (i == 0) | (F.get("_t", i - 1) != F.get("_t", i)))
    runs = terms.select(*keep, "_t", F.size("_t").alias("_n"), new.alias("_at"))
    tf = F.transform("_at", lambda i, k: F.struct(
        F.get("_t", i).alias("term"), (F.coalesce(F.get("_at", k + 1), F.col("_n")) - i).cast("long").alias("tf")))
    return runs.select(*keep, F.col("_n").cast("long").alias("n_terms"), F.inline(tf))


def document_frequency(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of documents containing each term: ``(term, df)``.

    Counted from the per-document term counts (one row per document and
    term), so a query that also needs those counts shares one tokenising
    pass: identical sub-plans reuse the same shuffle.
    """
    return term_stats(term_frequency(docs, text, by=(doc,))).select("term", "df")


def term_stats(doc_tf: DataFrame) -> DataFrame:
    """``(term, tf, df)`` -- corpus-wide count and document count per term --
    in one aggregate over per-document counts ``(doc, term, tf)``."""
    # df counts documents whose term count is positive (all rows here); it
    # reads tf so that the per-document counts keep one shape in every
    # branch of a query and their shuffle is reused
    return doc_tf.groupBy("term").agg(F.sum("tf").alias("tf"), F.count_if(F.col("tf") > 0).alias("df"))


def corpus_size(docs: DataFrame) -> DataFrame:
    """Number of documents, including those without any term."""
    return docs.agg(F.count(F.lit(1)).alias("n_docs"))


def inverse_document_frequency(docs: DataFrame, doc: str = "doc_id",
                               text: str = "text") -> DataFrame:
    """``(term, idf)`` with ``idf = ln(N / df)``; N counts every document.

    N enters as a scalar subquery (computed once, inlined as a literal), so
    no join with a one-row frame is planned.
    """
    n = corpus_size(docs).scalar()
    dfreq = document_frequency(docs, doc, text)
    return dfreq.select("term", F.ln(n.cast("double") / F.col("df")).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame, tf_col: str = "tf", idf_col: str = "idf",
          keys: tuple[str, ...] = ()) -> DataFrame:
    """``tf * idf`` over the inner join on term (terms without IDF drop out).

    The join is planned by AQE: the IDF side becomes a broadcast only when
    its measured shuffle size is small; otherwise a sort-merge join whose
    skewed partitions (very common terms) are split.
    """
    return (tf.join(idf, "term")
            .select(*keys, "term", (F.col(tf_col) * F.col(idf_col)).alias("tfidf")))


#: Measured bytes of a broadcast IDF row beside its term and value.
IDF_ROW_BYTES = 24


def doc_tfidf(docs: DataFrame, doc: str = "doc_id", text: str = "text", packed: Materializer | None = None) -> DataFrame:
    """``(doc_id, term, tfidf)`` for every document.

    The IDF of each term is stored first and counted: while it is bounded it
    is broadcast, and the documents' terms stay where they were counted.

    With ``packed`` the same vectors come in rows of many entries, ``(doc_id,
    n_docs, *PACKED)``, for ``pairwise_cosine``; a vector may have several rows
    (see ``_vector_parts``).  Words are counted once and ``packed`` stores the
    counts; terms are numbered, the most frequent first.  These, as many as are
    bounded, are broadcast, and only the entries of the other terms move."""
    if packed:
        return _packed_tfidf(docs, doc, text, packed)
    tf = term_frequency(docs, text, by=(doc,))
    idf = Materializer(docs.sparkSession)(inverse_document_frequency(docs, doc, text))
    n, width = measured(idf)
    return tfidf(tf, broadcast_if_bounded(idf, n, row_bytes=width + IDF_ROW_BYTES), keys=(doc,))


def counted_texts(docs: DataFrame, mat: Materializer, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, term, tf)`` as ``term_frequency`` counts them by document, but a
    text whose key comes once is counted where it is read; only texts of
    repeated keys, which ``mat`` stores, move to be counted together."""
    own = docs.select(doc, text)
    again = own.groupBy(doc).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = mat.table(again.select(F.col(doc).alias("_again")), "repeated")
    n, width = measured(again)
    few = broadcast_if_bounded(again, n, row_bytes=width + IDF_ROW_BYTES)
    if few is again:
        return counted_terms(term_lists(own, text, (doc,)), (doc,)).drop("n_terms")
    lists = spread(own)
    if n:
        lists = lists.join(few, lists[doc].eqNullSafe(few["_again"]), "left_anti")
    lists = lists.select(doc, plain_words(text).alias("words"))
    if n:
        lists = lists.unionByName(term_lists(own.join(few, own[doc].eqNullSafe(few["_again"]), "left_semi"), text, (doc,)))
    return counted_terms(lists, (doc,)).drop("n_terms")


#: Measured bytes of a broadcast term beside its characters, number and count.
TERM_ROW_BYTES = 128


def least_bounded_df(terms: DataFrame) -> int | None:
    """The least document count from which on all of ``(no, term, df)`` may be
    broadcast; none if not even the most frequent terms may."""
    width = F.octet_length("term") + F.lit(16 + TERM_ROW_BYTES)
    # few rows: n different counts take n * n / 2 entries at least
    upto = Window.orderBy(F.desc("df")).rowsBetween(Window.unboundedPreceding, 0)
    per_df = terms.groupBy("df").agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"))
    every = per_df.select("df", F.sum("n").over(upto).alias("n"), F.sum("b").over(upto).alias("b"))
    return every.where((F.col("n") <= joins.MAX_BROADCAST_ROWS) & (F.col("b") <= joins.MAX_BROADCAST_BYTES)).agg(F.min("df")).first()[0]


#: Columns of a packed vector's rows: what ``_vector_parts`` makes of the numbers, counts and document counts of its terms.
PACKED = ("nos", "tfs", "dfs")


def _packed_tfidf(docs: DataFrame, doc: str, text: str, mat: Materializer) -> DataFrame:
    share_code(docs.sparkSession)
    texts = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    counts = mat.table(counted_texts(texts, mat, "doc"), "counts", codec="zstd")
    stats = term_stats(counts).select("term", "df").orderBy(F.desc("df"), "term")
    terms = mat.table(stats.select(F.monotonically_increasing_id().alias("no"), "term", "df"), "terms")
    least = least_bounded_df(terms)
    kind = counts.schema["doc"].dataType.simpleString()

    def parts(entries: DataFrame) -> DataFrame:
        return entries.select("doc", "no", "tf", "df").mapInArrow(_vector_parts, f"doc {kind}, nos binary, tfs binary, dfs binary")

    if least is None:
        every = parts(counts.join(terms, "term").select("doc", "no", "tf", "df").repartition("doc"))
    else:
        known = counts.join(F.broadcast(terms.where(F.col("df") >= least)), "term", "left")
        every = parts(known.where("no is not null"))
        if least > 1:
            rare = known.where("no is null").select(*counts.columns).join(terms.where(F.col("df") < least), "term")
            every = every.unionByName(parts(rare.select("doc", "no", "tf", "df").repartition("doc")))
    n = corpus_size(docs).first()["n_docs"]
    return every.select(F.col("doc").alias(doc), F.lit(n).cast("long").alias("n_docs"), *PACKED)


def _packed_numbers(v: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column of numbers from 0 on, row by row between places ``at``:
    seven bits a byte, the lowest first, with the eighth bit where more follow."""
    v = v.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        if not len(more := np.flatnonzero(v >> np.uint64(7 * k))):
            break
        size[more] = k + 1
    ends = np.append(0, np.cumsum(size))
    out = np.empty(ends[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        mine = np.flatnonzero(size > k)
        byte = (v[mine] >> np.uint64(7 * k)).astype(np.uint8) & 127
        out[ends[mine] + k] = byte | np.where(size[mine] > k + 1, 128, 0).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(ends[at].astype(np.int32)), pa.py_buffer(out)])


def _unpacked_numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column, and the places between which each row's lie."""
    rows = column.to_pylist()
    b = np.frombuffer(b"".join(rows), np.uint8)
    ends = np.flatnonzero(b < 128) + 1
    starts = np.append(0, ends[:-1])[:len(ends)]
    size = ends - starts
    v = np.zeros(len(ends), np.int64)
    for k in range(int(size.max(initial=0))):
        mine = np.flatnonzero(size > k)
        v[mine] |= (b[starts[mine] + k] & 127).astype(np.int64) << (7 * k)
    return v, np.searchsorted(ends, np.append(0, np.cumsum([len(r) for r in rows], dtype=np.int64)), side="right")


def _vector_parts(batches):
    """Entries ``(doc, no, tf, df)``, some ``CHUNK_ENTRIES`` at a time, as a row
    per document: the numbers of its terms upwards, each as what it adds to the
    one before, their counts, and their document counts, each as what it takes
    off the one before (terms are numbered by falling document count)."""
    held: list[pa.RecordBatch] = []
    n = 0

    def packed() -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        keys = t["doc"].combine_chunks().dictionary_encode(null_encoding="encode")
        doc, (no, tf, df) = keys.indices.to_numpy(), (t[c].to_numpy() for c in ("no", "tf", "df"))
        order = np.lexsort((no, doc))
        doc, no, tf, df = (c[order] for c in (doc, no, tf, df))
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        gaps, falls = np.append(0, no[1:] - no[:-1]), np.append(0, df[:-1] - df[1:])
        gaps[first], falls[first] = no[first], df[first]
        at = np.append(first, len(doc))
        return pa.RecordBatch.from_arrays(
            [keys.dictionary.take(pa.array(doc[first])), *(_packed_numbers(v, at) for v in (gaps, tf, falls))], ["doc", *PACKED])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK_ENTRIES:
                yield packed()
                held.clear()
                n = 0
    if held:
        yield packed()


def _scores_of_parts(parts: pa.Table) -> pa.Table:
    """One row per entry ``(id, t, s)`` of packed vectors: ``t`` is the term's number."""
    (gaps, at), (tf, _), (falls, _) = (_unpacked_numbers(parts[c]) for c in PACKED)
    sizes = np.diff(at)

    def summed(v: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(v))
        return total[1:] - np.repeat(total[at[:-1]], sizes)

    df = 2 * np.repeat(falls[at[:-1]], sizes) - summed(falls)
    idf = np.log(np.repeat(parts["n_docs"].to_numpy(), sizes) / df)
    return pa.table({"id": parts["id"].combine_chunks().take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), "t": summed(gaps), "s": tf * idf})


def corpus_tfidf(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Corpus-wide ``(term, tfidf)``: count * ln(N / df) from one aggregate."""
    n = corpus_size(docs).scalar()
    stats = term_stats(term_frequency(docs, text, by=(doc,)))
    return stats.select("term", (F.col("tf") * F.ln(n.cast("double") / F.col("df"))).alias("tfidf"))


def ranked_scores(scores: DataFrame, score: str, term: str = "term") -> DataFrame:
    """All rows, the largest score first, ties by term (a range-partitioned sort)."""
    return scores.orderBy(F.desc(score), F.asc(term))


def top_terms(scores: DataFrame, score: str, k: int = 20, term: str = "term") -> DataFrame:
    """The ``k`` rows with the largest score; ties broken by term.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k and only those reach the final merge.
    """
    return scores.orderBy(F.desc(score), F.asc(term)).limit(k)


def cosine_similarity(a: DataFrame, b: DataFrame, score: str = "score",
                      term: str = "term") -> DataFrame:
    """One row ``cosine``: dot over shared terms / (|a| |b|).

    No shared term gives 0.0; a zero norm gives NULL.  Both vectors meet in
    one aggregate per term, from which the dot product and both norms are
    summed in one pass.
    """
    none = F.lit(None).cast("double")
    both = (a.select(F.col(term).alias("_t"), F.col(score).cast("double").alias("_a"), none.alias("_b"))
            .unionByName(b.select(F.col(term).alias("_t"), none.alias("_a"), F.col(score).cast("double").alias("_b")))
            .groupBy("_t").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")))
    sums = both.agg(F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0.0)).alias("_dot"),
                    F.sum(F.col("_a") * F.col("_a")).alias("_na"), F.sum(F.col("_b") * F.col("_b")).alias("_nb"))
    denom = F.sqrt(F.col("_na") * F.col("_nb"))
    return sums.select(F.when(denom > 0, F.col("_dot") / denom).alias("cosine"))


#: Pairs of one cell, on average: a task holds the vectors of one cell's pairs.
CELL_PAIRS = 4096


def pairwise_cosine(vectors: DataFrame, pairs: DataFrame, key: str = "doc_id",
                    score: str = "tfidf", term: str = "term",
                    left: str = "doc_a", right: str = "doc_b", side: int | None = None,
                    hot_pairs: int | None = None) -> DataFrame:
    """Cosine similarity for every ``(left, right)`` pair of vector keys.

    Vectors are long form ``(key, term, score)``, a term once per key, or what
    ``doc_tfidf`` packs, which takes far fewer bytes to send.  The pairs are dealt into a grid of blocks of left and right keys; a vector is
    sent once, as one row, to every cell that holds one of its pairs, however
    many those are, and a key in very many pairs has them dealt over all cells.
    By default only right keys make blocks: a right vector goes to one cell and
    a left one to those of its partners.  Cells multiply and give norms and dot
    products.  Pairs without shared terms get
    0.0, pairs with a missing or zero-norm vector or a null key get NULL;
    repeated pairs stay.  What the cells give is stored: the vectors are read
    no more.  ``side`` and ``hot_pairs`` set the grid's shape.
    """
    spark = pairs.sparkSession
    mat = Materializer(spark, columnar=True)
    p = pairs.select(F.col(left).alias("row"), F.col(right).alias("col"))
    entries = mat(p.groupBy("row", "col").agg(F.count(F.lit(1)).alias("times")))
    known = entries.where("row is not null and col is not null")
    n = known.count()
    blocks = None if side else (1, grid_side(spark, n, CELL_PAIRS) ** 2)
    grid = SparseGrid(known, n, side, hot_pairs, blocks)
    cells = grid.entries
    routes = cells.select(F.col("row").alias("id"), "cell").union(cells.select(F.col("col").alias("id"), "cell")).distinct()
    if set(PACKED) <= set(vectors.columns):
        v = vectors.select(F.col(key).alias("id"), "n_docs", *PACKED)
    else:
        entry = F.struct(_packed(F.col(term)).alias("t"), F.col(score).cast("double").alias("s"))
        v = (vectors.groupBy(F.col(key).alias("id")).agg(F.collect_list(entry).alias("_v"))
             .select("id", F.concat_ws(BETWEEN, F.transform("_v", lambda e: e["t"])).alias("t"), F.transform("_v", lambda e: e["s"]).alias("s")))
    kinds = {f.name: f.dataType.simpleString() for f in p.schema.fields}
    found = mat(grid.answer(v.join(routes, "id").select("cell", *v.columns), _cell_cosines,
                            f"row {kinds['row']}, col {kinds['col']}, times long, dot double, a double, b double"))
    grid.close()
    none = F.lit(None).cast("double")
    rest = entries.where("row is null or col is null").select("row", "col", "times", *[none.alias(c) for c in ("dot", "a", "b")])
    every = found.unionByName(rest).withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    denom = F.sqrt(F.col("a") * F.col("b"))
    return every.select(F.col("row").alias(left), F.col("col").alias(right), F.when(denom > 0, F.col("dot") / denom).alias("cosine"))


#: A vector's terms are sent as one string: this stands between them, and what starts with ``ESCAPE`` for other things.
BETWEEN, ESCAPE = "\x1e", "\x1f"
ESCAPED = ((ESCAPE, ESCAPE + "e"), (BETWEEN, ESCAPE + "b"))
NO_TERM = ESCAPE + "n"


def _packed(term: Column) -> Column:
    out = term.cast("string")
    for plain, coded in ESCAPED:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return F.coalesce(out, F.lit(NO_TERM))


def _unpacked(vectors: pa.Table) -> pa.Table:
    """One row per entry ``(id, t, s)`` of the vectors sent to a cell."""
    scores = vectors["s"].combine_chunks()
    terms = pc.list_flatten(pc.split_pattern(vectors["t"].combine_chunks(), BETWEEN))
    if pc.any(pc.match_substring(terms, ESCAPE)).as_py():
        terms = pc.if_else(pc.equal(terms, NO_TERM), None, terms)
        for plain, coded in reversed(ESCAPED):
            terms = pc.replace_substring(terms, coded, plain)
    return pa.table({"id": vectors["id"].combine_chunks().take(pc.list_parent_indices(scores)), "t": terms, "s": pc.list_flatten(scores)})


def _cell_cosines(entries: pa.Table, values: pa.Table) -> pa.Table:
    """Dot product and squared norms of one cell's pairs; a missing vector's norm is null."""
    if not entries.num_rows:
        return pa.table({"row": entries["row"], "col": entries["col"], "times": entries["times"],
                         **{c: pa.array([], pa.float64()) for c in ("dot", "a", "b")}})
    values = _scores_of_parts(values) if "n_docs" in values.column_names else _unpacked(values)
    ids = pc.unique(values["id"])
    doc = pc.index_in(values["id"], ids).to_numpy()
    terms = pc.index_in(values["t"], pc.unique(values["t"])).to_numpy()
    s = values["s"].fill_null(0.0).to_numpy()
    order = np.argsort(doc, kind="stable")
    doc, terms, s = doc[order], terms[order], s[order]
    at = np.searchsorted(doc, np.arange(len(ids) + 1))
    norm = np.bincount(doc, s * s, len(ids))
    a, b = (pc.fill_null(pc.index_in(entries[c], ids), -1).to_numpy() for c in ("row", "col"))
    dots = np.zeros(len(a))
    whole = np.flatnonzero((a >= 0) & (b >= 0))
    whole = whole[np.argsort(a[whole], kind="stable")]
    x = np.zeros(int(terms.max()) + 1 if len(terms) else 1)
    for mine in np.split(whole, np.flatnonzero(np.diff(a[whole])) + 1):
        if len(mine):
            own = slice(at[a[mine[0]]], at[a[mine[0]] + 1])
            x[terms[own]] = s[own]  # one left vector, spread over the cell's terms
            sizes = at[b[mine] + 1] - at[b[mine]]
            place = np.arange(sizes.sum()) + np.repeat(at[b[mine]] - (np.cumsum(sizes) - sizes), sizes)
            dots[mine] = np.bincount(np.repeat(np.arange(len(mine)), sizes), x[terms[place]] * s[place], len(mine))
            x[terms[own]] = 0.0
    norms = [pa.array(np.where(k >= 0, norm[k] if len(ids) else 0.0, 0.0), mask=k < 0) for k in (a, b)]
    return pa.table({"row": entries["row"], "col": entries["col"], "times": entries["times"], "dot": dots, "a": norms[0], "b": norms[1]})
