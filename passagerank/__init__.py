"""Passage retrieval, re-ranking and ranking evaluation on Spark DataFrames."""

from passagerank.operators.evaluate import experiment, judge, per_query, report, summary
from passagerank.operators.expand import expand_queries
from passagerank.operators.features import attach_labels, features
from passagerank.operators.index import Index, build_index, open_index, open_or_build
from passagerank.operators.ltr import load_model, save_model, train_lambdamart, train_random_forest
from passagerank.operators.rerank import rerank
from passagerank.operators.search import search, search_one, search_with_scores
from passagerank.operators.spelling import spell_correct

__all__ = [
    "Index",
    "attach_labels",
    "build_index",
    "expand_queries",
    "experiment",
    "features",
    "judge",
    "load_model",
    "open_index",
    "open_or_build",
    "per_query",
    "report",
    "rerank",
    "save_model",
    "search",
    "search_one",
    "search_with_scores",
    "spell_correct",
    "summary",
    "train_lambdamart",
    "train_random_forest",
]
