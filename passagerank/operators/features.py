"""Learning-to-rank rows: weighting-model features of a candidate set, in one retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagerank.functions import weighting as wm
from passagerank.operators.index import Index
from passagerank.operators.ranking import top_k
from passagerank.operators.search import Score, scored
from passagerank.operators.sizing import lookup_join

DEFAULT_FEATURES = ("f_sample", "f_tf", "f_pl2", "f_tf_idf", "f_dlh13", "f_hiemstra_lm")


def head_topics(topics: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """First ``n`` topics in file order; ``n <= 0`` is all of them."""
    return topics if n <= 0 else topics.orderBy(order).limit(n)


def filter_qrels(qrels: DataFrame, topics: DataFrame) -> DataFrame:
    """Judgements of the given topics."""
    return lookup_join(qrels, topics.select("qid"), ["qid"], "left_semi")


def features(
    topics: DataFrame,
    index: Index,
    names: tuple[str, ...] = DEFAULT_FEATURES,
    k: int = 1000,
    first_stage: str = "f_sample",
) -> DataFrame:
    """Top ``k`` per topic by the first-stage model, with every feature: one postings read, one aggregate."""
    wanted = list(dict.fromkeys([first_stage, *names]))
    scores = [Score(name, wm.FEATURES[name](index.collection)) for name in wanted]
    totals = scored(topics, index, scores)
    best = top_k(totals, ["qid"], [F.col(first_stage).desc(), F.col("doc_id")], k, tasks=index.shards)
    return best.select(
        "qid", "doc_id", "rank",
        wm.unfixed(F.col(first_stage)).alias("score"),
        *[wm.unfixed(F.col(n)).alias(n) for n in names],
    )


def attach_labels(candidates: DataFrame, qrels: DataFrame) -> DataFrame:
    """Add ``label``: the rating, 0 where unjudged."""
    rated = qrels.select("qid", "doc_id", F.col("rating").alias("label"))
    return candidates.join(rated, ["qid", "doc_id"], "left").withColumn(
        "label", F.coalesce("label", F.lit(0)).cast("int")
    )
