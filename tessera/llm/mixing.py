"""Mixing sources to target weights.

Tokens are summed per source, each source's target follows from its weight
(water filling below ``cap`` times its size), and each document is emitted
``floor(rate)`` times plus one copy with probability equal to the fraction,
drawn from a hash of seed and id.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
FRACTION_BITS = 52


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_col: str, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) from md5 of seed and id; a null id hashes as empty."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << FRACTION_BITS)


def source_targets(sized: DataFrame, source: str = "source", size: str = "size",
                   weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)``: weights repeat over the sources by
    code point (null last) and share the total of all sizes; a target stops at
    ``cap`` times its source's size and the excess is shared again by weight.

    The sources that stop are those with the least ``cap / weight``, so one
    pass over the per-source totals in that order gives the common level.
    """
    totals = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.asc_nulls_last("source"))
    everything = Window.partitionBy(F.lit(0))
    stop = F.col("source_size") * cap
    filled = (weighted
              .withColumn("place", F.row_number().over(order))
              .withColumn("before", F.coalesce(F.sum(stop).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("left_weight", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("all", F.sum("source_size").over(everything))
              .withColumn("level", (F.col("all") - F.col("before")).cast("double") / F.col("left_weight")))
    fits = F.when(F.col("level") * F.col("weight") <= stop, F.struct("place", "level"))
    return (filled.withColumn("first", F.min(fits).over(everything))
            .select("source", "source_size",
                    F.least(stop.cast("double"), F.col("weight") * F.col("first.level")).alias("target")))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``(id, source, size, source_size, target, copies)`` per row of ``docs``.

    A null text has size 0; a null source is a source of its own; a source of
    size 0 gets no copies.  Rows that share an id share their draw; reruns agree.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"))
    targets = source_targets(sized, weights=weights, cap=cap).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (draw("id", seed) < rate - F.floor(rate)).cast("long")
    return (sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
            .select("id", "source", "size", "source_size", "target", copies.cast("long").alias("copies")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` as many times as the mix takes it, all columns kept.

    A null text has size 0, a null source is a source of its own, and rows that
    share an id share their draw; texts of any length are counted whole; a
    column may have any name; an empty table gives an empty one.
    """
    cols = docs.columns
    name, rate, copy = (unused(n, cols) for n in ("source_of", "rate_of", "copy_of"))
    sized = docs.select(F.col(source_col).alias("source"), size_of(text_col).alias("size"))
    targets = source_targets(sized, weights=weights, cap=cap).select(
        F.col("source").alias(name),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias(rate))
    copies = (F.floor(rate) + (draw(id_col, seed) < F.col(rate) - F.floor(rate)).cast("long")).cast("int")
    return (docs.join(targets, F.col(source_col).eqNullSafe(F.col(name)))
            .withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies))).select(*cols))


def op6(docs: DataFrame) -> DataFrame:
    """How often the mix takes every ``documents`` row, in the contract's columns;
    see ``mix_plan`` for nulls and repeated rows; an empty table gives an empty one."""
    return mix_plan(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                                 (F.col("size") * F.col("copies")).alias("taken"))


def target_sql(table: str) -> str:
    """DuckDB twin of ``source_targets``/``mix_plan`` as CTEs over ``table``:
    ``mixed(doc_id, source, size, source_size, target, copies)``."""
    values = ", ".join(map(str, WEIGHTS))
    return f"""
sized AS (SELECT *, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size FROM {table}),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, ([{values}])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight FROM totals),
levels AS (SELECT *, row_number() OVER o AS place, {CAP} * source_size AS stop,
    (sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
filled AS (SELECT source, source_size, least(stop::DOUBLE, weight * (SELECT arg_min(level, place) FROM levels WHERE level * weight <= stop)) AS target FROM levels),
mixed AS (SELECT s.* EXCLUDE (source), s.source, f.source_size, f.target,
    (CASE WHEN f.source_size > 0 THEN floor(f.target / f.source_size)
       + (('0x' || substr(md5('{SEED}:' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / {float(1 << FRACTION_BITS)!r}
          < f.target / f.source_size - floor(f.target / f.source_size))::INT ELSE 0 END)::BIGINT AS copies
  FROM sized s JOIN filled f ON s.source IS NOT DISTINCT FROM f.source)"""


ORACLE = f"WITH {target_sql('documents')} SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"
