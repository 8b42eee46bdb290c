"""Error analysis: which judged documents were found, missed, or wrongly ranked high."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagerank.operators.index import Index, select_docs, top_terms
from passagerank.operators.ranking import GROUP_ROWS, row_numbers, running_in_group
from passagerank.operators.sizing import lookup_join, measure, skew_join
from passagerank.operators.workspace import cut

# Error analysis counts ratings of 2 and more as relevant.
MIN_RATING = 2


def relevant(qrels: DataFrame, min_rating: int = MIN_RATING) -> DataFrame:
    return qrels.filter(F.col("rating") >= min_rating)


def non_relevant(qrels: DataFrame, min_rating: int = MIN_RATING) -> DataFrame:
    return qrels.filter(F.col("rating") < min_rating)


def _hits(run: DataFrame) -> DataFrame:
    return run.select("qid", "doc_id")


def relevant_retrieved(qrels: DataFrame, run: DataFrame, min_rating: int = MIN_RATING) -> DataFrame:
    return relevant(qrels, min_rating).join(_hits(run), ["qid", "doc_id"], "left_semi")


def relevant_not_retrieved(qrels: DataFrame, run: DataFrame, min_rating: int = MIN_RATING) -> DataFrame:
    return relevant(qrels, min_rating).join(_hits(run), ["qid", "doc_id"], "left_anti")


def non_relevant_retrieved(qrels: DataFrame, run: DataFrame, min_rating: int = MIN_RATING) -> DataFrame:
    return non_relevant(qrels, min_rating).join(_hits(run), ["qid", "doc_id"], "left_semi")


def recall_count_at(qrels: DataFrame, run: DataFrame, n: int, min_rating: int = MIN_RATING) -> DataFrame:
    """Relevant documents among the first ``n`` hits of every judged query, 0 where there are none."""
    first = run.filter(F.col("rank") < n).select("qid", "doc_id", F.lit(1).alias("hit"))
    found = qrels.join(first, ["qid", "doc_id"], "left")
    counted = F.count(F.when((F.col("hit") == 1) & (F.col("rating") >= min_rating), 1))
    return found.groupBy("qid").agg(counted.alias("recall_count"))


def worst_queries(
    qrels: DataFrame,
    run: DataFrame,
    topics: DataFrame,
    index: Index,
    n: int = 5,
    pick: int | None = None,
    count: int = 1,
    min_rating: int = MIN_RATING,
) -> DataFrame:
    """Judged queries with the fewest relevant hits in the first ``n``, with text and tokens.

    ``pick`` skips that many; equal counts keep the order of the judgements
    (``seq`` where there is one, else ``qid``).
    """
    counts = recall_count_at(qrels, run, n, min_rating)
    order = "qid"
    if "seq" in qrels.columns:
        counts = counts.join(qrels.groupBy("qid").agg(F.min("seq").alias("first_seq")), "qid")
        order = "first_seq"
    chosen = counts.orderBy("recall_count", order).offset(pick or 0).limit(count)
    named = lookup_join(topics.select("qid", "query"), chosen, ["qid"])
    return named.select("qid", "query", "recall_count", index.analyze("query").alias("tokens"))


def rating_histogram(qrels: DataFrame, run: DataFrame, min_rating: int | None = None) -> DataFrame:
    """Retrieved documents per rating 0..max, zeros included; ``min_rating`` counts only ratings from there."""
    top = F.max("rating").alias("m")
    scale = qrels.agg(top).select(F.explode(F.sequence(F.lit(0), F.col("m"))).alias("rating"))
    found = qrels.join(_hits(run), ["qid", "doc_id"], "left_semi")
    if min_rating is not None:
        found = found.filter(F.col("rating") >= min_rating)
    counts = found.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    # both sides hold one row per rating value
    return scale.join(counts, "rating", "left").select(
        "rating", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def annotate_ranking(
    run: DataFrame,
    qrels: DataFrame,
    index: Index,
    min_rating: int = MIN_RATING,
    n_terms: int = 10,
    depth: int | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Every hit with its rating (0 if unjudged), the relevant hits so far and its most frequent terms."""
    hits = run.join(qrels.select("qid", "doc_id", "rating"), ["qid", "doc_id"], "left").withColumn(
        "rating", F.coalesce("rating", F.lit(0))
    )
    flag = (F.col("rating") >= min_rating).cast("int")
    bounded = depth is not None and depth <= group_rows
    walked = running_in_group(hits, ["qid"], [F.col("rank"), F.col("doc_id")], {"relevant_so_far": flag}, bounded, group_rows)
    # read three times below: sized, for its ids, and joined
    walked = cut(walked)
    small = measure(walked).small
    terms = top_terms(select_docs(index.docs, walked) if small else index.docs, n_terms)
    if small:
        return terms.join(F.broadcast(walked), "doc_id").select(*walked.columns, "top_terms")
    return skew_join(walked, terms, ["doc_id"])


def judged_per_query(qrels: DataFrame) -> DataFrame:
    counts = qrels.groupBy("qid").count()
    return counts.agg(
        F.sum("count").alias("n_judged"),
        F.count(F.lit(1)).alias("n_queries"),
        (F.sum("count") / F.count(F.lit(1))).alias("judged_per_query"),
    )


def queries_containing(qrels: DataFrame, topics: DataFrame, text: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Judged queries whose text contains ``text``, with their 0-based place among the judged queries."""
    first = F.min("seq") if "seq" in qrels.columns else F.min("qid")
    judged = qrels.groupBy("qid").agg(first.alias("__first"))
    placed = row_numbers(judged, [], [F.col("__first"), F.col("qid")], "ordinal", group_rows=group_rows)
    matching = topics.filter(F.contains(F.col("query"), F.lit(text))).select("qid", "query")
    return lookup_join(placed.drop("__first"), matching, ["qid"]).withColumn(
        "ordinal", F.col("ordinal") - 1
    )
