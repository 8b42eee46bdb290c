"""Checked broadcasts, and joins that hold when one key has a third of all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from passagerank.operators.workspace import cut

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 2_000_000


@dataclass(frozen=True)
class Size:
    rows: int
    nbytes: int
    extra: Row

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.nbytes <= BROADCAST_BYTES


def measure(df: DataFrame, *extra) -> Size:
    """Rows and approximate bytes of ``df``, with optional further aggregates, in one partial aggregate.

    Tasks send one row each, so asking costs one evaluation of ``df`` and nothing more.
    """
    width = F.lit(0)
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind == "string":
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        width = width + 8
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b"), *extra).first()
    return Size(row["n"], row["b"] or 0, row)


def hot_keys(
    df: DataFrame, keys: list[str], hot_rows: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Keys with more rows than one task should hold, with the pieces ``__salts`` that they fill.

    All of them: there is one key per ``hot_rows`` rows at most.
    ``counts(keys, count)`` may be given where an index knows them already.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counts = df.groupBy(*keys).count() if counts is None else counts
    salts = F.ceil(F.col("count") / hot_rows).cast("bigint").alias("__salts")
    return counts.filter(F.col("count") > hot_rows).select(*keys, salts)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot_rows: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join in which the rows of a hot left key are spread over as many tasks as they fill.

    Only the right rows of hot keys are replicated.  ``left`` keeps every row,
    so ``how`` may be inner, left, left_semi or left_anti.
    """
    hot = cut(hot_keys(left, keys, hot_rows, counts))
    size = measure(hot)
    if not size.rows:
        return left.join(right, keys, how)
    marks = F.broadcast(hot) if size.small else hot
    hashable = [f.name for f in left.schema.fields if not f.dataType.simpleString().startswith("map")]
    salt = F.coalesce(F.pmod(F.xxhash64(*hashable), F.col("__salts")), F.lit(0))
    a = left.join(marks, keys, "left").withColumn("__salt", salt).drop("__salts")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("__salts", F.lit(1).cast("bigint")) - 1)
    b = right.join(marks, keys, "left").withColumn("__salt", F.explode(copies)).drop("__salts")
    return a.join(b, [*keys, "__salt"], how).drop("__salt")


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a right side that is broadcast when measured small, salted otherwise."""
    if measure(right).small:
        return left.join(F.broadcast(right), keys, how)
    return skew_join(left, right, keys, how)
