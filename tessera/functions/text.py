"""Column expressions for term handling (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The whitespace class that matches Python's str.split() with
# no argument (ASCII controls \t \n \v \f \r, the file/group/record/unit
# separators U+001C-U+001F, NEXT LINE U+0085 and every Unicode space,
# line and paragraph separator), and "letter" = Unicode category L,
# which is what str.isalpha() accepts.
WHITESPACE_RUN = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}]+"
NON_LETTER = r"[^\p{L}]"
NEITHER = r"[^\p{L}" + WHITESPACE_RUN[1:-2] + "]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_term(c) -> Column:
    """Lower-case, then drop every character that is not a letter."""
    return F.regexp_replace(F.lower(_col(c)), NON_LETTER, "")


def split_words(c) -> Column:
    """Array of whitespace-separated words (may contain empty strings)."""
    return F.split(_col(c), WHITESPACE_RUN)


def plain_words(c) -> Column:
    """The normalised words of a text, joined by one space; empty without any.

    The same as to normalise each word alone, since neither step reads or
    makes white space, but the text is read as a whole; a null text is empty.
    """
    letters = F.regexp_replace(F.lower(_col(c)), NEITHER, "")
    return F.coalesce(F.trim(F.regexp_replace(letters, WHITESPACE_RUN, " ")), F.lit(""))
