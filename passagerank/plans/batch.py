"""Batch procedures over files: what a retrieval script does, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from passagerank.operators.evaluate import judge, report
from passagerank.operators.expand import expand_queries
from passagerank.operators.features import DEFAULT_FEATURES, attach_labels, features, filter_qrels, head_topics
from passagerank.operators.index import Index
from passagerank.operators.ltr import RankModel, model_name, train_lambdamart, train_random_forest
from passagerank.operators.rerank import Scorer, rerank
from passagerank.operators.search import candidates_with_text, search_with_scores
from passagerank.operators.spelling import spell_correct
from passagerank.operators.workspace import cut
from passagerank.sources.writers import RERANKED_RUN, write_run_ltr, write_run_plain, write_run_reranked, write_run_trec


def bm25_batch(
    topics: DataFrame,
    index: Index,
    out: str | None = None,
    k: int = 1000,
    k1: float = 0.9,
    b: float = 0.4,
    trec: bool = False,
    relevance_weighing: bool = False,
    spell_checking: bool = False,
    n_extra_terms: int = 10,
    **options,
) -> DataFrame:
    """Optional spelling and expansion, then BM25 for every topic; written to ``out`` if given."""
    if spell_checking:
        fixed = spell_correct(topics, index.words)
        topics = fixed.drop("query", "changed").withColumnRenamed("corrected", "query")
    if relevance_weighing:
        topics = expand_queries(topics, index, n_extra_terms, feedback_k=k, k1=k1, b=b, **options)
    if spell_checking or relevance_weighing:
        topics = cut(topics)
    run = search_with_scores(topics, index, k1, b, k, **options)
    if out is not None:
        run = cut(run)  # written, and returned to a caller who goes on with it
        write = write_run_trec if trec else write_run_plain
        write(run, out)
    return run


def ltr_batch(
    spark: SparkSession,
    index: Index,
    train: tuple[DataFrame, DataFrame],
    valid: tuple[DataFrame, DataFrame],
    test_topics: DataFrame,
    algorithm: str = "LAMBDAMART",
    k: int = 1000,
    top_n_train: int = 200,
    top_n_valid: int = 200,
    run_id: str = "00",
    names: tuple[str, ...] = DEFAULT_FEATURES,
    model_folder: str | None = None,
    out: str | None = None,
    judged_only: bool = False,
    order: str = "seq",
    **training,
) -> tuple[RankModel, DataFrame]:
    """Features, training and re-ranking; returns the model and the learned run.

    ``train`` and ``valid`` are (topics, qrels).  ``judged_only`` takes the first
    topics among those that have judgements.
    """

    def rows(topics: DataFrame, qrels: DataFrame, n: int) -> DataFrame:
        if judged_only:
            topics = topics.join(qrels.select("qid").distinct(), "qid", "left_semi")
        subset = head_topics(topics, n, order)
        return cut(attach_labels(features(subset, index, names, k), filter_qrels(qrels, subset)))

    learn = rows(*train, top_n_train)
    check = rows(*valid, top_n_valid)
    kind = algorithm.upper()
    if kind == "LAMBDAMART":
        model = train_lambdamart(learn, check, list(names), depth=k, **training)
    elif kind == "RANDOMFOREST":
        model = train_random_forest(learn, list(names), **training)
    else:
        raise ValueError(f"algorithm is LAMBDAMART or RANDOMFOREST, not {algorithm!r}")
    if model_folder is not None:
        model.save(spark, f"{model_folder.rstrip('/')}/{model_name(kind, top_n_train, top_n_valid, run_id)}")
    run = rerank(features(test_topics, index, names, k), model, depth=k)
    if out is not None:
        run = cut(run)
        write_run_ltr(run, out)
    return model, run


def rerank_batch(
    topics: DataFrame,
    index: Index,
    scorer: Scorer,
    out: str | None = None,
    name: str = RERANKED_RUN,
    k: int = 100,
    **options,
) -> DataFrame:
    """BM25 candidates with their text, scored by ``scorer``, ranked anew, written by file form."""
    run = cut(search_with_scores(topics, index, k=k, **options))
    hits = candidates_with_text(run, index.docs, topics, k)
    ranked = rerank(hits, scorer, depth=k)
    if out is not None:
        ranked = cut(ranked)
        write_run_reranked(ranked, out, name)
    return ranked


def evaluate_run(run: DataFrame, qrels: DataFrame, min_rating: int = 1) -> DataFrame:
    """Official measures and recall of a run file."""
    return report(judge(run, qrels, min_rating=min_rating))
