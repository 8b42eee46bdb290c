"""Training rankers on labelled feature rows, and keeping them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank.operators.boosting import fit_leaves, train_lambdamart
from passagerank.operators.evaluate import judge, summary
from passagerank.operators.forest import train_random_forest
from passagerank.operators.pairs import lambda_gradients
from passagerank.operators.trees import RankModel

__all__ = [
    "RankModel", "fit_leaves", "lambda_gradients", "load_model", "model_name", "save_model", "train_lambdamart", "train_random_forest",
]


def model_name(algorithm: str, n_train: int, n_valid: int, run_id: str = "00") -> str:
    """Folder name of a stored model."""
    # fixed values: names of the algorithms in stored models
    label = {"lambdamart": "LambdaRANK", "randomforest": "RandomForest"}[algorithm.lower()]
    return f"{label}_model_{n_train}_{n_valid}_{run_id}"


def save_model(model: RankModel, spark: SparkSession, path: str) -> None:
    model.save(spark, path)


def load_model(spark: SparkSession, path: str) -> RankModel:
    return RankModel.load(spark, path)


def _ndcg(rows: DataFrame, cutoffs: tuple[int, ...], depth: int | None) -> dict[str, float]:
    qrels = rows.select("qid", "doc_id", F.col("label").alias("rating"))
    run = rows.select("qid", "doc_id", "score")
    row = summary(judge(run, qrels, depth=depth, ndcg_cutoffs=cutoffs), ("ndcg",), cutoffs).first()
    return row.asDict()
