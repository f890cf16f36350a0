"""Registered queries of the package and their DuckDB twins."""

from __future__ import annotations

from . import (embedding_dedup, html_extract, lexical_search, license_scan, merkle, mixing, piece_codec, quality,
               simhash, spotsigs, suffix_dedup, token_counts, url_filter)
from .common import read_table, share_package


def _over(name, table, fn):
    def run(spark, sf_dir):
        share_package(spark)
        return fn(read_table(spark, sf_dir, table))
    run.__name__ = name
    run.__doc__ = fn.__doc__
    return run


TABLES = {
    "op1_html_extraction": ("pages", html_extract.op1),
    "op2_suffix_dedup": ("documents", suffix_dedup.op2),
    "op3_embedding_dedup": ("embeddings", embedding_dedup.op3),
    "op4_token_counts": ("documents", token_counts.op4),
    "op6_mixing": ("documents", mixing.op6),
    "op7_url_filter": ("pages", url_filter.op7),
    "op8_piece_codec": ("documents", piece_codec.op8),
    "op9_spotsigs": ("documents", spotsigs.op9),
    "op10_simhash": ("documents", simhash.op10),
    "op11_merkle_manifest": ("documents", merkle.op11),
    "op13_license_scan": ("documents", license_scan.op13),
}


def op5_quality(spark, sf_dir):
    """Quality score of every document, learnt from the labelled ones."""
    share_package(spark)
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_lexical_search(spark, sf_dir):
    """The 50 best documents of every benchmark item, by weighted terms."""
    share_package(spark)
    return lexical_search.op12(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    own = {"op5_quality": op5_quality, "op12_lexical_search": op12_lexical_search}
    return {name: _over(name, table, fn) for name, (table, fn) in TABLES.items()} | own


def oracle_sql() -> dict[str, str]:
    return {"op6_mixing": mixing.ORACLE, "op12_lexical_search": lexical_search.ORACLE}
