"""Whole procedures: batch BM25, learning to rank, re-ranking, evaluation."""

from passagerank.plans.batch import bm25_batch, evaluate_run, ltr_batch, rerank_batch

__all__ = ["bm25_batch", "evaluate_run", "ltr_batch", "rerank_batch"]
