"""Query expansion by relevance weights of the terms of retrieved documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.functions.weighting import fixed
from passagerank.operators.index import Index, index_terms, select_docs
from passagerank.operators.ranking import top_k
from passagerank.operators.search import search
from passagerank.operators.sizing import lookup_join, measure, skew_join
from passagerank.operators.workspace import cut


def feedback_terms(run: DataFrame, index: Index) -> DataFrame:
    """``(qid, term, r)``: in how many of its retrieved documents a query's term occurs.

    Documents are bucketed by id: the run moves to them, never the vectors.
    """
    hits = cut(run.select("qid", "doc_id"))
    vectors = index.docs.select("doc_id", F.col("terms.term").alias("vector"))
    size = measure(hits)
    if size.small:
        joined = select_docs(vectors, hits, size.rows).join(F.broadcast(hits), "doc_id")
    else:
        joined = skew_join(hits, vectors, ["doc_id"])
    flat = joined.select("qid", F.explode("vector").alias("term"))
    return flat.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("r"))


def first_word_terms(topics: DataFrame, index: Index) -> DataFrame:
    """``(qid, term)``: the first analyzed token of every space-separated query word."""
    words = topics.select("qid", F.posexplode_outer(F.split("query", " ")).alias("nth", "word"))
    if index.stemmer is None:
        terms = words.select("qid", F.get(index.analyze("word"), F.lit(0)).alias("term"))
        return terms.filter(F.col("term").isNotNull()).distinct()
    return index_terms(words, "word", index).filter("position = 0").select("qid", "term").distinct()


def drop_query_terms(feedback: DataFrame, topics: DataFrame, index: Index) -> DataFrame:
    """Feedback terms that the query does not have yet."""
    own = first_word_terms(topics, index)
    right = F.broadcast(own) if measure(own).small else own
    return feedback.join(right, ["qid", "term"], "left_anti")


def offer_weight(r: Column, big_r: Column, n: Column, big_n: Column) -> Column:
    """Robertson's offer weight; an odds ratio below zero counts as 0.001."""
    odds = ((r + 0.5) * (big_n - n - big_r + r + 0.5)) / ((n - r + 0.5) * (big_r - r + 0.5))
    # fixed value: what stands for an odds ratio below zero
    return r * F.log(F.when(odds < 0, F.lit(0.001)).otherwise(odds))


def offer_weights(feedback: DataFrame, index: Index, feedback_k: int) -> DataFrame:
    """``(qid, term, r, n, weight)``; terms the index does not know fall out."""
    stats = index.term_stats.select("term", F.col("df").alias("n"))
    if measure(stats).small:
        joined = feedback.join(F.broadcast(stats), "term")
    else:
        feedback = cut(feedback)  # measured, then joined: written once instead of worked out again
        small = measure(feedback).small
        joined = stats.join(F.broadcast(feedback), "term") if small else skew_join(feedback, stats, ["term"])
    r, n = F.col("r").cast("double"), F.col("n").cast("double")
    weight = offer_weight(
        r, F.lit(float(feedback_k)), n, F.lit(float(index.collection.n_docs))
    )
    return joined.select("qid", "term", "r", "n", weight.alias("weight"))


def expansion_terms(weights: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best terms per query (all there are, if fewer); equal weights by term.

    Weights are compared to nine decimals, so the last bits of a logarithm decide nothing.
    """
    order = [fixed(F.col("weight")).desc(), F.col("term")]
    return top_k(weights, ["qid"], order, n)


#: Terms, the most frequent ones, that are counted in any case.
FREQUENT_TERMS = 4_096


def best_feedback_terms(
    run: DataFrame, topics: DataFrame, index: Index, n: int = 10, feedback_k: int = 1000, frequent: int | None = None
) -> DataFrame:
    """What ``expansion_terms`` finds among all feedback terms, without counting all of them.

    A term of a few documents occurs in a few retrieved ones at most, which bounds its weight.  The most frequent terms are
    counted first; of the others, only those whose bound reaches the ``n``-th weight that a query has already.
    """
    frequent = FREQUENT_TERMS if frequent is None else frequent
    hits = cut(run.select("qid", "doc_id"))
    stats = index.term_stats.select("term", "df")
    least = stats.orderBy(F.col("df").desc()).limit(frequent).agg(F.min("df")).first()[0]
    if least is None:
        return expansion_terms(offer_weights(feedback_terms(hits, index), index, feedback_k), n)
    common = stats.filter(F.col("df") >= least).select("term", F.lit(0.0).alias("bound"))
    everywhere = hits.withColumn("reached", F.lit(0.0))
    first = cut(offer_weights(drop_query_terms(_counted(everywhere, index, common), topics, index), index, feedback_k))
    best = expansion_terms(first, n)
    # no bound holds for a query that has fewer terms yet
    reached = best.filter(F.col("rank") == n - 1).select("qid", F.col("weight").alias("reached"))
    reached = hits.select("qid").distinct().join(reached, "qid", "left").fillna(float("-inf"), ["reached"])
    lowest = reached.agg(F.min("reached")).first()[0]
    r = F.least(F.col("df").cast("double"), F.lit(float(feedback_k)))
    most = offer_weight(r, F.lit(float(feedback_k)), F.col("df").cast("double"), F.lit(float(index.collection.n_docs)))
    # weights are compared to nine decimals
    rest = stats.filter(F.col("df") < least).select("term", (F.greatest(most, F.lit(0.0)) + 1e-8).alias("bound"))
    rest = cut(rest.filter(F.col("bound") >= F.lit(lowest)))
    if rest.isEmpty():
        return best
    more = _counted(lookup_join(hits, reached, ["qid"]), index, rest)
    second = offer_weights(drop_query_terms(more, topics, index), index, feedback_k)
    return expansion_terms(first.union(second.select(*first.columns)), n)


def _counted(hits: DataFrame, index: Index, terms: DataFrame) -> DataFrame:
    """As ``feedback_terms``, for ``terms(term, bound)`` and the hits whose ``reached`` the bound reaches.

    Terms are chosen while a document stands once, before its rankings multiply it; of documents that nobody retrieved
    no term is listed.
    """
    hits, vectors = cut(hits), index.docs.select("doc_id", F.col("terms.term").alias("vector"))
    small = measure(hits).small
    if small:
        vectors = vectors.join(F.broadcast(hits.select("doc_id").distinct()), "doc_id", "left_semi")
    flat = vectors.select("doc_id", F.explode("vector").alias("term"))
    flat = lookup_join(flat, terms, ["term"])
    joined = flat.join(F.broadcast(hits), "doc_id") if small else skew_join(flat, hits, ["doc_id"])
    kept = joined.filter(F.col("bound") >= F.col("reached"))
    return kept.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("r"))


def expand_queries(
    topics: DataFrame,
    index: Index,
    n: int = 10,
    feedback_k: int = 1000,
    **search_options,
) -> DataFrame:
    """Topics with the best feedback terms appended to the query text.

    As in the original procedure R is the feedback depth, even where fewer documents were found.
    """
    run = cut(search(topics, index, k=feedback_k, **search_options))
    best = best_feedback_terms(run, topics, index, n, feedback_k)
    tails = best.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("ts")
    ).select("qid", F.transform("ts", lambda t: t["term"]).alias("extra"))
    joined = topics.join(tails, "qid", "left")
    text = F.concat_ws(" ", F.col("query"), F.array_join("extra", " "))
    return joined.select(
        *[c for c in topics.columns if c != "query"],
        F.when(F.col("extra").isNull(), F.col("query")).otherwise(text).alias("query"),
    )
