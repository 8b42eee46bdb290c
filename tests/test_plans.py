import pytest
from pyspark.sql import functions as F

from passagerank.operators.rerank import coverage
from passagerank.plans import bm25_batch, evaluate_run, ltr_batch, rerank_batch
from passagerank.sources.readers import read_run_trec


@pytest.fixture(scope="module")
def qrels(spark):
    rows = [(1, 3, 2), (1, 2, 1), (2, 7, 2), (2, 1, 1), (6, 6, 1)]
    return spark.createDataFrame(rows, "qid BIGINT, doc_id BIGINT, rating INT")


def test_batch_writes_a_run(spark, index, topics, tmp_path):
    out = str(tmp_path / "run")
    run = bm25_batch(topics, index, out, k=5, trec=True)
    assert read_run_trec(spark, out).count() == run.count() > 0


def test_batch_with_spelling_and_expansion(spark, index):
    topics = spark.createDataFrame([(1, "exampl mat"), (2, "zzzzzzzzzz")], "qid BIGINT, query STRING")
    plain = {r.doc_id for r in bm25_batch(topics, index, k=10).collect()}
    fixed = bm25_batch(topics.withColumn("query", F.lit("buss maat")), index, k=10, spell_checking=True)
    assert plain == {1, 6} and {r.doc_id for r in fixed.collect()} == {1, 2, 6}
    more = bm25_batch(topics, index, k=10, relevance_weighing=True, n_extra_terms=3)
    assert {r.doc_id for r in more.filter("qid = 1").collect()} > plain


@pytest.mark.parametrize("algorithm", ["LAMBDAMART", "RANDOMFOREST"])
def test_ltr_batch(spark, index, topics, qrels, tmp_path, algorithm):
    ordered = topics.withColumn("seq", F.col("qid"))
    options = {"rounds": 1, "min_rows_in_leaf": 1} if algorithm == "LAMBDAMART" else {"n_trees": 2, "max_depth": 3}
    model, run = ltr_batch(
        spark, index, (ordered, qrels), (ordered, qrels), ordered, algorithm, k=10,
        model_folder=str(tmp_path / "models"), out=str(tmp_path / "run"), judged_only=True, **options,
    )
    assert len(model.trees) == (1 if algorithm == "LAMBDAMART" else 2) and run.count() > 0
    lines = [r.value for r in spark.read.text(str(tmp_path / "run")).collect()]
    assert len(lines) == run.count() and lines[0].endswith(" pyterrier")
    assert list((tmp_path / "models").glob("*_model_200_200_00"))


def test_unknown_algorithm(spark, index, topics, qrels):
    ordered = topics.withColumn("seq", F.col("qid"))
    with pytest.raises(ValueError, match="LAMBDAMART or RANDOMFOREST"):
        ltr_batch(spark, index, (ordered, qrels), (ordered, qrels), ordered, "SVM", k=2)


def test_rerank_and_evaluate(spark, index, topics, qrels, tmp_path):
    run = rerank_batch(topics, index, coverage(stemmer=None), str(tmp_path / "r.tsv"), k=5)
    report = {r.measure: r.value for r in evaluate_run(run, qrels).collect()}
    assert report["num_q"] == 3 and 0 < report["map"] <= 1
    assert spark.read.text(str(tmp_path / "r.tsv")).count() == run.count()
