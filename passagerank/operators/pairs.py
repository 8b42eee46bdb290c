"""Pairwise ranking gradients of queries of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagerank.functions.lambdas import GRADIENT_SCHEMA, block_gradients
from passagerank.operators.ranking import GROUP_ROWS, row_numbers
from passagerank.operators.sizing import lookup_join

BLOCK_ROWS = 1024


def lambda_gradients(
    scored: DataFrame,
    block_rows: int = BLOCK_ROWS,
    depth: int | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``grad`` and ``hess`` of every row of ``scored(qid, doc_id, label, score)``.

    All pairs of differing labels count.  They are never rows: the hits of a
    query are cut into blocks of at most ``block_rows`` by rank, a task gets two
    blocks and sums their pairs as a matrix.  A usual query is one block; a huge
    one becomes many tasks of equal, bounded size.
    """
    rows = scored.select("qid", "doc_id", "label", "score")
    summed = _gradients(with_ideal(rows, depth, group_rows), block_rows, depth, group_rows)
    out = rows.select("qid", "doc_id").join(summed, ["qid", "doc_id"], "left")
    return out.select(
        "qid", "doc_id",
        F.coalesce("grad", F.lit(0.0)).alias("grad"),
        F.coalesce("hess", F.lit(0.0)).alias("hess"),
    )


def with_ideal(rows: DataFrame, depth: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add what depends on the labels alone: size and best DCG of the query.

    Queries without a relevant row have no pair and fall out.
    """
    bounded = depth is not None and depth <= group_rows
    gained = rows.select("qid", "doc_id", "label").filter(F.col("label") > 0)
    best = row_numbers(gained, ["qid"], [F.col("label").desc(), F.col("doc_id")], "place", bounded, group_rows)
    gain = F.pow(F.lit(2.0), F.col("label")) - 1
    ideal = best.groupBy("qid").agg(F.sum(gain / F.log2(F.col("place") + 1)).alias("max_dcg"))
    sizes = rows.groupBy("qid").agg(F.count(F.lit(1)).alias("n_rows")).join(ideal, "qid")
    return lookup_join(rows, sizes, ["qid"])


def _gradients(rows: DataFrame, block_rows: int, depth: int | None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Gradients of the rows of ``with_ideal`` that stand in a pair."""
    bounded = depth is not None and depth <= group_rows
    wanted = rows.select("qid", "doc_id", "label", "score", "n_rows", "max_dcg")
    placed = row_numbers(wanted, ["qid"], [F.col("score").desc(), F.col("doc_id")], "pos", bounded, group_rows)
    blocks = F.floor((F.col("n_rows") - 1) / block_rows)
    pairs = (
        placed.withColumn("rank", F.col("pos") - 1)
        .withColumn("block", F.floor(F.col("rank") / block_rows))
        .withColumn("__other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks)))
        .withColumn("lo", F.least("block", "__other"))
        .withColumn("hi", F.greatest("block", "__other"))
        .select("qid", "doc_id", "label", "score", "rank", "block", "lo", "hi", "max_dcg")
    )
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = GRADIENT_SCHEMA.format(qid=types["qid"], doc=types["doc_id"])
    partial = pairs.groupBy("qid", "lo", "hi").applyInPandas(block_gradients, schema)
    return partial.groupBy("qid", "doc_id").agg(F.sum("grad").alias("grad"), F.sum("hess").alias("hess"))
