"""A training corpus from ``documents`` in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's result as Parquet below the shared checkpoint folder and
reads it again as the next stage's ``docs``.  All stages but the last return
the columns of ``documents``.

A null text is treated as empty by every stage, rows may repeat, extra columns
are carried through, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import mixing, piece_codec, quality, simhash, suffix_dedup
from tessera.llm.common import read_table, share_package, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier, fitted on the labelled
    ones among ``docs``, scores below 0.5."""
    share_package(spark)
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each SimHash group (3-word shingles, 3 bits);
    of repeated rows of that id, one.  A document without an id stays where no
    document of its group has one."""
    share_package(spark)
    return simhash.keep_first(docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every byte covered by a 100-byte string that starts earlier, and
    what is left of a character cut in two; ``n_chars`` follows the new text."""
    share_package(spark)
    return suffix_dedup.cut_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their targets."""
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes each text: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    share_package(spark)
    return piece_codec.op8(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeated_passage_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece codec", encoding_stage),
]

#: The classifier, the suffix sort and the tokenizer have no SQL form; the
#: stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
