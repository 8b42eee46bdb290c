"""BM25 retrieval for a whole file of queries in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank.functions import weighting as wm
from passagerank.functions.text import with_term_groups
from passagerank.operators.blocks import best_by_blocks, many_matches
from passagerank.operators.index import LITERAL_TERMS, Index, fetch_docs, index_terms, term_slot
from passagerank.operators.ranking import top_k
from passagerank.operators.sizing import measure, skew_join
from passagerank.operators.workspace import cut


def query_terms(topics: DataFrame, index: Index) -> DataFrame:
    """``(qid, term, qtf)`` of every topic: grouped inside the topic row, or after its words are looked up in the index."""
    if index.stemmer is not None:
        flat = index_terms(topics.select("qid", "query"), "query", index)
        return flat.groupBy("qid", "term").agg(F.count(F.lit(1)).cast("int").alias("qtf"))
    analyzed = topics.select("qid", index.analyze("query").alias("__tokens"))
    grouped = with_term_groups(analyzed, "__tokens", "terms")
    exploded = grouped.select("qid", F.inline_outer("terms")).filter(F.col("term").isNotNull())
    return exploded.select("qid", "term", F.col("tf").alias("qtf"))


def matches(topics: DataFrame, index: Index) -> DataFrame:
    """Every posting of every query term, with ``qtf, df, cf`` beside ``tf, dl``.

    Query terms are measured first.  If small they are broadcast and only the
    term slots they fall in are read; postings never move.  Few distinct terms
    also stand as literals in the scan: files are sorted by term, so pages of
    other terms are skipped.  Too many query terms for a broadcast are joined
    by a shuffle whose hot terms are salted.
    """
    wanted = query_terms(topics, index).withColumn("term_slot", term_slot("term", index.term_slots))
    size = measure(wanted, F.collect_set("term_slot").alias("slots"))
    postings = index.postings.select("term_slot", "term", "doc_id", "tf", "dl")
    stats = index.term_stats
    if size.small:
        chosen = F.col("term_slot").isin(*(size.extra["slots"] or [-1]))
        literals = _few_terms(wanted) if size.rows <= 10 * LITERAL_TERMS else None
        if literals is not None:
            chosen = chosen & F.col("term").isin(*literals)
        stats = stats.filter(chosen).drop("term_slot")
        terms = stats.join(F.broadcast(wanted.drop("term_slot")), "term")
        return postings.filter(chosen).drop("term_slot").join(F.broadcast(terms), "term")
    keys = ["term_slot", "term"]
    distinct = wanted.select("term").distinct()
    if measure(distinct).small:
        postings = postings.join(F.broadcast(distinct), "term", "left_semi")
    terms = skew_join(wanted, stats, keys)
    known = stats.select(*keys, F.col("df").alias("count"))
    return skew_join(postings, terms, keys, counts=known).drop("term_slot")


def _few_terms(wanted: DataFrame) -> list[str] | None:
    few = wanted.select("term").distinct().limit(LITERAL_TERMS + 1).collect()
    return [r["term"] for r in few] if len(few) <= LITERAL_TERMS else None


@dataclass(frozen=True)
class Score:
    """A sum of per-term weights as an exact integer."""

    name: str
    weight: Column

    def total(self) -> Column:
        return F.sum(wm.fixed(self.weight)).alias(self.name)


def scored(topics: DataFrame, index: Index, scores: list[Score]) -> DataFrame:
    """One row per (query, document) with a fixed-point total per score.

    Postings are bucketed by document, so this aggregate needs no exchange.
    """
    return matches(topics, index).groupBy("qid", "doc_id").agg(*[s.total() for s in scores])


def search_with_scores(
    topics: DataFrame,
    index: Index,
    k1: float = 0.9,
    b: float = 0.4,
    k: int = 1000,
    length_norm: str = "byte",
) -> DataFrame:
    """Top ``k`` documents per topic: ``qid, doc_id, rank, score``; ties by document id.

    ``length_norm='byte'`` keeps document lengths as coarse as a one-byte norm
    does, 'exact' uses the true length.
    """
    weight = wm.bm25_search(index.collection, k1, b, length_norm)
    wanted = query_terms(topics, index).withColumn("term_slot", term_slot("term", index.term_slots))
    size = measure(wanted)
    if size.rows > 10 * LITERAL_TERMS and (not size.small or many_matches(wanted, index)):
        best = best_by_blocks(wanted, index, weight, k)
    else:
        totals = scored(topics, index, [Score("total", weight)])
        best = top_k(totals, ["qid"], [F.col("total").desc(), F.col("doc_id")], k, tasks=index.shards)
    return best.select("qid", "doc_id", "rank", wm.unfixed(F.col("total")).alias("score"))


def search(topics: DataFrame, index: Index, k1: float = 0.9, b: float = 0.4, k: int = 1000,
           length_norm: str = "byte") -> DataFrame:
    """Ranked document ids without scores."""
    return search_with_scores(topics, index, k1, b, k, length_norm).select("qid", "doc_id", "rank")


def search_one(spark: SparkSession, query: str, index: Index, k: int = 10, **options) -> DataFrame:
    """One ad-hoc query."""
    topic = spark.range(1).select(F.lit("q").alias("qid"), F.lit(query).alias("query"))
    return search_with_scores(topic, index, k=k, **options).drop("qid")


def rank_cutoff(run: DataFrame, k: int, keys: tuple[str, ...] = ("qid",)) -> DataFrame:
    """First ``k`` hits per query.  ``rank`` is dense, so the cut is a filter the scan can take."""
    return run.filter(F.col("rank") < k)


def candidates_with_text(run: DataFrame, corpus: DataFrame, topics: DataFrame, k: int = 100) -> DataFrame:
    """(query, text, doc_id, score) records for a re-ranker."""
    hits = fetch_docs(rank_cutoff(run, k), corpus)
    size = measure(topics)
    if size.small:
        return hits.join(F.broadcast(topics.select("qid", "query")), "qid")
    return skew_join(hits, topics.select("qid", "query"), ["qid"])


def candidates_with_terms(run: DataFrame, index: Index, topics: DataFrame, k: int = 100) -> DataFrame:
    """As ``candidates_with_text``, with the distinct terms of a passage, as the index keeps them, in place of its text."""
    vectors = index.docs.select("doc_id", F.col("terms.term").alias("terms"))
    hits = cut(rank_cutoff(run, k))
    joined = vectors.join(F.broadcast(hits), "doc_id") if measure(hits).small else skew_join(hits, vectors, ["doc_id"])
    asked = topics.select("qid", "query")
    found = joined.join(F.broadcast(asked), "qid") if measure(topics).small else skew_join(joined, asked, ["qid"])
    return found.select(*run.columns, "terms", "query")


def ranking_arrays(run: DataFrame, depth: int) -> DataFrame:
    """The document ids of the first ``depth`` hits of every query, in order: one list per query.

    Ranks are dense, so ``depth`` bounds a list.
    """
    lists = rank_cutoff(run, depth).groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("hits")
    )
    return lists.select("qid", F.transform("hits", lambda h: h["doc_id"]).alias("doc_ids"))
