"""Hash expressions shared by Spark code and its SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A colour is hashed into this many parts of six hex digits: 120 bits.
COLOR_PARTS = 5


def md5_parts(c: Column) -> list[Column]:
    """Five 24-bit numbers from the first 120 bits of ``md5(c)``.

    Summing each part over a multiset gives an order-independent multiset
    hash that Spark aggregates partially with plain ``bigint`` sums (exact
    for fewer than 2^39 elements), so no group ever gathers a list.
    """
    m = F.md5(c.cast("string"))
    return [F.conv(F.substring(m, 1 + 6 * k, 6), 16, 10).cast("bigint") for k in range(COLOR_PARTS)]


def multiset_color(sums: list[Column]) -> Column:
    """New colour from the summed parts."""
    return F.md5(F.concat_ws(":", *[s.cast("string") for s in sums]))
