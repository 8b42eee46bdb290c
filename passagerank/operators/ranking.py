"""Ranks, running sums and top-k inside groups, safe for a group of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagerank.operators.sizing import lookup_join
from passagerank.operators.workspace import cut

GROUP_ROWS = 1_000_000
# Catalyst cuts a row_number filter before and after the exchange up to this depth.
WINDOW_LIMIT = 1_000
MERGE_ROWS = 4_000_000


def running_in_group(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    sums: dict[str, Column],
    bounded: bool = False,
    group_rows: int = GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add inclusive running sums over ``order`` inside every group of ``keys``.

    ``order`` must be a total order.  Groups that fit a task (``bounded`` says
    so by construction, otherwise they are counted) are one window.  Bigger ones, and one
    group of everything, are range-partitioned on the full order, summed per range, and every
    range gets the totals of the ranges before it.  ``counted`` has the same groups and is
    cheaper to count.
    """
    if not keys:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return _running_by_range(df, keys, order, sums, partitions)
    largest, total = (0, 0) if bounded else _group_sizes(df if counted is None else counted, keys)
    if largest <= group_rows:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(e).over(window).alias(n) for n, e in sums.items()])
    return _running_by_range(df, keys, order, sums, max(2, -(-2 * total // group_rows)))


def _group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    row = df.groupBy(*keys).count().agg(F.max("count").alias("m"), F.sum("count").alias("t")).first()
    return row["m"] or 0, row["t"] or 0


def _running_by_range(df, keys, order, sums, ranges):
    inputs = {f"__in_{n}": e for n, e in sums.items()}
    ranged = df.select("*", *[e.alias(n) for n, e in inputs.items()])
    ranged = ranged.repartitionByRange(ranges, *[F.col(k) for k in keys], *order)
    # the range of a row is fixed by writing it: a second evaluation could sample other bounds
    ranged = cut(ranged.withColumn("__range", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "__range").agg(
        *[F.sum(f"__in_{n}").alias(f"__tot_{n}") for n in sums]
    )
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "__range",
        *[F.coalesce(F.sum(f"__tot_{n}").over(before), F.lit(0)).alias(f"__pre_{n}") for n in sums],
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    local = ranged.select("*", *[F.sum(f"__in_{n}").over(inside).alias(n) for n in sums])
    joined = lookup_join(local, carried, [*keys, "__range"])
    return joined.select(
        *df.columns, *[(F.col(n) + F.col(f"__pre_{n}")).alias(n) for n in sums]
    )


def row_numbers(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    bounded: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """1-based position of every row in its group."""
    out = running_in_group(df, keys, order, {name: F.lit(1)}, bounded, group_rows)
    return out.withColumn(name, F.col(name).cast("bigint"))


def top_k(
    df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank", tasks: int = 0
) -> DataFrame:
    """The first ``k`` rows of every group with a 0-based position.

    Each task keeps at most ``k`` rows per group before the exchange.  Where
    ``tasks`` of them would still send one group millions of rows, they are
    merged in two rounds.  Deeper cuts than Catalyst prunes inside a task are
    first made in 256 slices of a group.
    """
    slot = None
    if k > WINDOW_LIMIT:
        slot = F.pmod(F.xxhash64(*df.columns), F.lit(256))
    elif k * tasks > MERGE_ROWS:
        slot = F.spark_partition_id() % math.isqrt(tasks)
    if slot is not None:
        inner = Window.partitionBy(*keys, "__slot").orderBy(*order)
        df = (
            df.withColumn("__slot", slot)
            .withColumn("__n", F.row_number().over(inner))
            .filter(F.col("__n") <= k)
            .drop("__slot", "__n")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(name, F.row_number().over(window))
        .filter(F.col(name) <= k)
        .withColumn(name, (F.col(name) - 1).cast("int"))
    )
