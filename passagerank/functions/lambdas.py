"""Pairwise ranking gradients of one block pair, as dense arithmetic on an Arrow batch."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRADIENT_SCHEMA = "qid {qid}, doc_id {doc}, grad DOUBLE, hess DOUBLE"


def block_gradients(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum over the pairs (better, worse) between the two blocks of a query.

    Columns: block, lo, hi, label, score, rank (0-based by score), max_dcg.
    """
    same = pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
    label = pdf["label"].to_numpy(float)
    score = pdf["score"].to_numpy(float)
    gain = np.exp2(label) - 1.0
    discount = 1.0 / np.log2(2.0 + pdf["rank"].to_numpy(float))
    better = label[:, None] > label[None, :]
    if not same:
        block = pdf["block"].to_numpy()
        better &= block[:, None] != block[None, :]
    apart = np.clip(score[:, None] - score[None, :], -500, 500)
    rho = 1.0 / (1.0 + np.exp(apart))
    swap = np.abs(gain[:, None] - gain[None, :]) * np.abs(discount[:, None] - discount[None, :])
    swap = np.where(better, swap, 0.0) / pdf["max_dcg"].iloc[0]
    pull = rho * swap
    # rho * (1 - rho) without cancellation where rho is near 1
    bend = rho / (1.0 + np.exp(-apart)) * swap
    return pd.DataFrame(
        {
            "qid": pdf["qid"],
            "doc_id": pdf["doc_id"],
            "grad": pull.sum(axis=1) - pull.sum(axis=0),
            "hess": bend.sum(axis=1) + bend.sum(axis=0),
        }
    )
