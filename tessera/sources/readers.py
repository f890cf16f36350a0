"""Readers for the reference's file formats, built from Spark column
functions (never ``eval``).

Every reader returns a lazy DataFrame and refuses lines that it does not
understand; paths may be files, directories or
globs, as with ``spark.read``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir
from .listing import empty_files, list_files, reachable, read_files

# Line patterns of the tuple text formats.
#   scores  (u'term', 3)           -> term, value
#   edges   (1, 2) or ('a', 'b')   -> src, dst
#   sparse  ({"f": 1.0, ...}, -1)  -> map text, label
SCORE_LINE = r"""^\(u?['"](.*)['"],\s*(.*)\)$"""
_ITEM = r"""(?:u?'([^'\\]*(?:\\.[^'\\]*)*)'|u?"([^"\\]*(?:\\.[^"\\]*)*)"|([^,'"()]+?))"""
EDGE_LINE = rf"""^\s*\(\s*{_ITEM}\s*,\s*{_ITEM}\s*\)\s*$"""
SPARSE_LINE = r"""^\s*\(\s*\{(.*)\}\s*,\s*\+?(-?\d+)(?:\.0*)?\s*\)\s*$"""
_QUOTED = r"""(?:u?'([^'\\]*(?:\\.[^'\\]*)*)'|u?"([^"\\]*(?:\\.[^"\\]*)*)")"""
SPARSE_ITEM = rf"""\s*{_QUOTED}\s*:\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s*"""
RATING_LINE = r"""^\s*[-+]?\d+\s*,\s*[-+]?\d+\s*,\s*[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\s*$"""


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line."""
    return spark.read.text(path)


def _or_error(ok, value, what: str):
    """``value`` where ``ok``, else an error that shows it."""
    return F.when(ok, value).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(value, F.lit("null")))))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``: ``(doc_id = file path, text)``.

    Tasks list the directories and read the files whole.  An empty file is a
    document with an empty text (it counts in N for IDF); names that start
    with ``_`` or ``.`` are no documents.  Storage that Arrow has no file
    system for is read with Spark's file source, which skips empty files; there
    the driver looks for those.
    """
    if reachable(path):
        files = read_files(list_files(spark, path))
    else:
        empty = spark.createDataFrame([(f, b"") for f in empty_files(spark, path)], "path string, content binary")
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .select("path", "content").unionByName(empty))
    return files.select(F.col("path").alias("doc_id"), F.col("content").cast("string").alias("text"))


# The escapes of a Python string literal that its repr writes.
_PIECE = r"(?:\\u[0-9a-fA-F]{4})+|\\x[0-9a-fA-F]{2}|\\U[0-9a-fA-F]{8}|\\.|[^\\]+"
_PLAIN_ESCAPES = {"\\n": "\n", "\\r": "\r", "\\t": "\t", "\\a": "\a", "\\b": "\b", "\\f": "\f", "\\v": "\v"}


def _piece(p):
    """One escape of a Python string literal, or a run without any, decoded.
    Neighbouring ``\\u`` escapes go together: they may be a surrogate pair."""
    def bytes_of(hexed, charset):
        return F.decode(F.unhex(hexed), charset)

    out = (F.when(p.rlike(r"^\\u[0-9a-fA-F]{4}"), bytes_of(F.replace(p, F.lit("\\u"), F.lit("")), "UTF-16BE"))
           .when(p.rlike(r"^\\x[0-9a-fA-F]{2}"), bytes_of(p.substr(F.lit(3), F.lit(2)), "ISO-8859-1"))
           .when(p.rlike(r"^\\U[0-9a-fA-F]{8}"), bytes_of(p.substr(F.lit(3), F.lit(8)), "UTF-32")))
    for written, char in _PLAIN_ESCAPES.items():
        out = out.when(p == written, F.lit(char))
    return out.when(p.startswith("\\"), p.substr(F.lit(2), F.lit(1))).otherwise(p)


def _py_string(raw):
    """Decode a Python string literal body (``\\xNN``, ``\\uNNNN``, ``\\'``, ...)."""
    pieces = F.regexp_extract_all(raw, F.lit(_PIECE), F.lit(0))
    return F.when(F.contains(raw, F.lit("\\")), F.array_join(F.transform(pieces, _piece), "")).otherwise(raw)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """``parse_scores`` of a text file."""
    return parse_scores(spark.read.text(path))


def parse_scores(lines: DataFrame) -> DataFrame:
    """``(term, score)`` from ``(u'term', value)`` lines; blank lines are
    skipped, any other line is an error."""
    lines = lines.where(F.length(F.trim("value")) > 0)
    line = lines.select(_or_error(F.col("value").rlike(SCORE_LINE), F.col("value"), "not a score").alias("value"))
    return line.select(_py_string(F.regexp_extract("value", SCORE_LINE, 1)).alias("term"),
                       F.regexp_extract("value", SCORE_LINE, 2).cast("double").alias("score"))


def read_edges(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``parse_edges`` of a text file."""
    return parse_edges(spark.read.text(path), id_type)


def parse_edges(lines: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``(src, dst)`` from ``(a, b)`` lines; duplicates kept, blank lines
    skipped, any other line is an error."""
    lines = lines.where(F.length(F.trim("value")) > 0).select(
        F.when(F.col("value").rlike(EDGE_LINE), F.col("value"))
        .otherwise(F.raise_error(F.concat(F.lit("not an edge: "), F.col("value")))).alias("value"))

    def item(first: int):
        # one of the three forms matched; the others are empty
        return _py_string(F.concat(*[F.regexp_extract("value", EDGE_LINE, first + k) for k in range(3)]))

    return lines.select(item(1).cast(id_type).alias("src"), item(4).cast(id_type).alias("dst"))


def read_dense(spark: SparkSession, path: str, d: int | None = None) -> DataFrame:
    """``parse_dense`` of a text file."""
    return parse_dense(spark.read.text(path), d)


def parse_dense(lines: DataFrame, d: int | None = None) -> DataFrame:
    """CSV lines ``x1,...,xd,y`` -> ``(x0 .. x{d-1}, y)`` doubles.

    ``d`` is taken from the first line when not given (one row is read).
    """
    parts = lines.where(F.length(F.trim("value")) > 0).select(
        F.split(F.trim("value"), ",").alias("_p"))
    if d is None:
        d = parts.select(F.size("_p")).first()[0] - 1
    whole = F.when(F.size("_p") == d + 1, F.col("_p")).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {d + 1} values: "), F.array_join("_p", ","))))
    rows = parts.select(whole.alias("_p"))
    return rows.select(*[F.col("_p")[i].cast("double").alias(f"x{i}") for i in range(d)],
                       F.col("_p")[d].cast("double").alias("y"))


def read_sparse(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``parse_sparse`` of a text file."""
    return parse_sparse(spark.read.text(path))


def parse_sparse(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``({"f": v, ...}, y)`` lines -> (long data, rows).

    Long data is ``(row_id, label, feature, value)``, rows is
    ``(row_id, label)`` so that examples without features still count.  Keys
    are Python strings of either kind with their escapes; a label may be
    written as a float.  Blank lines are skipped; any other line, and a label
    other than -1/+1, is an error.

    ``row_id`` numbers the lines of one materialised read, so both results
    carry the same ids whatever the splits.
    """
    v = F.col("value")
    lines = lines.where(F.length(F.trim(v)) > 0)
    body = F.regexp_extract(v, SPARSE_LINE, 1)
    # what is left without the items: commas, one fewer than items
    item = F.lit(SPARSE_ITEM)
    rest, n = F.regexp_replace(body, item, F.lit("")), F.size(F.regexp_extract_all(body, item, F.lit(3)))
    whole = v.rlike(SPARSE_LINE) & (F.trim(rest) == F.repeat(F.lit(","), F.greatest(n - 1, F.lit(0))))
    line = lines.select(_or_error(whole, v, "not a sparse example").alias("value"))
    values = [F.regexp_extract_all(body, item, F.lit(k)) for k in (1, 2, 3)]
    parsed = line.select(F.monotonically_increasing_id().alias("row_id"),
                         F.regexp_extract(v, SPARSE_LINE, 2).cast("int").alias("label"),
                         F.arrays_zip(values[0].alias("a"), values[1].alias("b"), values[2].alias("x")).alias("_x"))
    checked = parsed.select("row_id", F.when(F.col("label").isin(-1, 1), F.col("label"))
                            .otherwise(F.raise_error(F.lit("label must be -1 or +1"))).alias("label"), "_x")
    ensure_checkpoint_dir(lines.sparkSession)
    checked = checked.checkpoint(eager=False)
    rows = checked.select("row_id", "label")
    items = checked.select("row_id", "label", F.explode("_x").alias("_i"))
    # one of the two quoted forms matched; the other is empty
    data = items.select("row_id", "label", _py_string(F.concat(F.col("_i")["a"], F.col("_i")["b"])).alias("feature"),
                        F.col("_i")["x"].cast("double").alias("value"))
    return data, rows


RATING_SCHEMA = "user_id long, item_id long, rating double"


def parse_ratings(lines: DataFrame, *keep: str) -> DataFrame:
    """``i,j,r`` lines -> ratings; blank lines skipped, any other is an error."""
    v = F.col("value")
    lines = lines.where(F.length(F.trim(v)) > 0)
    parts = lines.select(F.split(_or_error(v.rlike(RATING_LINE), v, "not a rating"), ",").alias("_p"), *keep)
    return parts.select(F.trim(F.col("_p")[0]).cast("long").alias("user_id"), F.trim(F.col("_p")[1]).cast("long").alias("item_id"),
                        F.trim(F.col("_p")[2]).cast("double").alias("rating"), *keep)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """CSV ``i,j,r`` -> ``(user_id, item_id, rating)``."""
    return parse_ratings(spark.read.text(path))


def read_folds(spark: SparkSession, directory: str, k: int) -> DataFrame:
    """Files ``fold0 .. fold{k-1}`` of a directory -> ratings with ``fold``."""
    lines = spark.read.text([f"{directory.rstrip('/')}/fold{i}" for i in range(k)])
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/fold(\d+)(/[^/]*)?$", 1)
    return parse_ratings(lines.select("value", name.cast("int").alias("fold")), "fold")


def load_dense_model(spark: SparkSession, path: str) -> list[float]:
    """A saved dense model ``(idx, value)`` as a short driver-side vector."""
    rows = spark.read.parquet(path).orderBy("idx").collect()
    return [r["value"] for r in rows]


def load_sparse_model(spark: SparkSession, path: str) -> DataFrame:
    """A saved sparse model ``(feature, value)``."""
    return spark.read.parquet(path)
