"""Writers: typed parquet by default, the reference's tuple text on request."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import share_code
from .listing import open_path

#: Files in a folder of a corpus, about.
FOLDER_FILES = 1000


def _repr(c: Column, dtype: str) -> Column:
    if dtype == "string":
        esc = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "'", r"\\'")
        for char, escape in (("\n", "\\n"), ("\r", "\\r")):  # a row stays on its line
            esc = F.replace(esc, F.lit(char), F.lit(escape))
        return F.concat(F.lit("'"), esc, F.lit("'"))
    return c.cast("string")


def tuple_lines(df: DataFrame) -> DataFrame:
    """One ``value`` line per row: ``(a, b, ...)`` with quoted strings."""
    parts = [F.coalesce(_repr(F.col(f.name), f.dataType.simpleString()), F.lit("None")) for f in df.schema.fields]
    sep = []
    for i, p in enumerate(parts):
        if i:
            sep.append(F.lit(", "))
        sep.append(p)
    return df.select(F.concat(F.lit("("), *sep, F.lit(")")).alias("value"))


def write_tuples(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result; ``fmt='text'`` gives the reference's tuple lines, one
    file per partition."""
    if fmt == "text":
        tuple_lines(df).write.mode(mode).text(path)
    elif fmt == "csv":
        df.write.mode(mode).csv(path)
    else:
        df.write.mode(mode).parquet(path)


def write_small(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a small result (a scalar or a top-k list) as a single file."""
    write_tuples(df.coalesce(1), path, fmt, mode)


def write_corpus(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> int:
    """A file ``{folder}/{doc}.txt`` per document below ``path``; returns their number.

    The tasks write the files where they belong: a commit that lists and moves
    a file per document would be the driver's work.  A file appears under its
    name when it is whole, so a repeated task replaces it by the same.  Texts
    of one id share its file, in order and parted by a zero character; a null
    text is an empty one, a null id is called ``null``, other ids are URL-encoded.
    The storage is one that Arrow has a file system for.
    """
    share_code(docs.sparkSession)
    root, below, _ = open_path(path)
    root.create_dir(below)
    folders = -(-docs.count() // FOLDER_FILES)
    placed = docs.select(F.pmod(F.xxhash64(doc), F.lit(max(1, folders))).cast("string").alias("folder"),
                         F.coalesce(F.url_encode(F.col(doc).cast("string")), F.lit("null")).alias("name"),
                         F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = placed.repartition("folder", "name").sortWithinPartitions("folder", "name", "text")

    def write(batches):
        system, inner, _ = open_path(path)
        made, at, stream, n = set(), None, None, 0
        part = f"{inner}/.{uuid.uuid4().hex}"

        def close() -> None:
            stream.close()
            system.move(part, f"{inner}/{at[0]}/{at[1]}.txt")

        for batch in batches:
            for folder, name, body in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (folder, name) == at:
                    stream.write(b"\0")
                else:
                    if at:
                        close()
                    if folder not in made:
                        system.create_dir(f"{inner}/{folder}")
                        made.add(folder)
                    at, n = (folder, name), n + 1
                    stream = system.open_output_stream(part, compression=None)
                stream.write(body.encode())
        if at:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return ordered.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def save_dense_model(spark, beta, path: str, mode: str = "overwrite") -> None:
    rows = [(i, float(b)) for i, b in enumerate(beta)]
    spark.createDataFrame(rows, "idx int, value double").coalesce(1).write.mode(mode).parquet(path)


def save_sparse_model(beta: DataFrame, path: str, mode: str = "overwrite") -> None:
    beta.select("feature", "value").write.mode(mode).parquet(path)


def save_history(history: DataFrame, path: str, mode: str = "overwrite") -> None:
    history.coalesce(1).write.mode(mode).parquet(path)
