"""Re-ranking a candidate run with any scorer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.functions.text import tokens
from passagerank.operators.ltr import RankModel
from passagerank.operators.ranking import GROUP_ROWS, row_numbers
from passagerank.operators.scoring import BatchScorer

Scorer = Column | RankModel | BatchScorer | Callable[[DataFrame], Column]


def rerank(
    candidates: DataFrame,
    scorer: Scorer,
    depth: int | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Score every candidate and number the ranks anew from 0; equal scores keep candidate order.

    ``scorer`` is a trained model, a column, or a function of the candidates
    that returns one, for instance an Arrow ``pandas_udf(query, text) -> double``
    that loads a neural model once per worker.  A ``BatchScorer`` does that in batches by length and keeps
    what it has finished.  The old rank stays as ``prior_rank``.
    """
    before = candidates.withColumnRenamed("rank", "prior_rank")
    if isinstance(scorer, (RankModel, BatchScorer)):
        scored = scorer.transform(before, "__new")
    else:
        scored = before.withColumn("__new", scorer if isinstance(scorer, Column) else scorer(before))
    scored = scored.drop("score").withColumnRenamed("__new", "score")
    bounded = depth is not None and depth <= group_rows
    order = [F.col("score").desc(), F.col("prior_rank")]
    placed = row_numbers(scored, ["qid"], order, "rank", bounded, group_rows)
    return placed.withColumn("rank", (F.col("rank") - 1).cast("int"))


def term_coverage(query: str = "query", terms: str = "terms", stemmer: str | None = None) -> Column:
    """As ``coverage``, for passages whose distinct terms are at hand (an index keeps them): nothing is analyzed anew."""
    wanted = F.array_distinct(tokens(query, stemmer))
    return F.when(F.size(wanted) > 0, F.size(F.array_intersect(wanted, F.col(terms))) / F.size(wanted)).otherwise(0.0)


def coverage(query: str = "query", text: str = "text", stemmer: str | None = "porter") -> Column:
    """A scorer in native expressions: share of the distinct query terms found in the passage."""
    wanted = F.array_distinct(tokens(query, stemmer))
    found = F.array_intersect(wanted, tokens(text, stemmer))
    return F.when(F.size(wanted) > 0, F.size(found) / F.size(wanted)).otherwise(0.0)
