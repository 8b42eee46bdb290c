import sys

import pytest
from pyspark import cloudpickle

from passagerank.operators.rerank import rerank
from passagerank.operators.scoring import BatchScorer, cut_by_length

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows(spark, n=60):
    data = [(i % 4, i, i // 4, 1.0, f"q{i % 4}", "x" * (i * 7 % 50) if i % 9 else None) for i in range(n)]
    return spark.createDataFrame(data, "qid INT, doc_id INT, rank INT, score DOUBLE, query STRING, text STRING").repartition(3)


def lengths():
    return lambda queries, texts: [float(len(t)) for t in texts]


def test_batches_hold_all_rows_in_order_of_length():
    lengths = [5, 900, 3, 3, 40, 0, 41]
    found = list(cut_by_length(lengths, 90))
    assert [i for b in found for i in b] == sorted(range(7), key=lambda i: (lengths[i], i))
    assert all(len(b) == 1 or max(lengths[i] for i in b) * len(b) <= 90 for b in found) and [1] in found
    assert list(cut_by_length([], 5)) == []


def test_scores_and_ranks(spark, tmp_path):
    given = rows(spark)
    ranked = rerank(given, BatchScorer(lengths, str(tmp_path / "a"), slices=3, chars=60, rows=7), depth=20).collect()
    assert len(ranked) == 60 and all(r["score"] == len(r["text"] or "") for r in ranked)
    for q in range(4):
        mine = sorted((r for r in ranked if r["qid"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(15))
        assert [(-r["score"], r["prior_rank"]) for r in mine] == sorted((-r["score"], r["prior_rank"]) for r in mine)


def test_a_restart_scores_only_what_is_not_finished(spark, tmp_path):
    path, given = tmp_path / "b", rows(spark)
    log = tmp_path / "scored.txt"

    def failing():
        def score(queries, texts):
            with open(log, "a") as out:
                out.write("x" * len(texts))
            if log.stat().st_size > 30:
                raise RuntimeError("the model broke")
            return [1.0] * len(texts)

        return score

    scorer = BatchScorer(failing, str(path), slices=10)
    with pytest.raises(Exception, match="the model broke"):
        scorer.transform(given, "new")
    finished = len(list(path.glob("scored-*-whole")))
    assert 0 < finished < 10
    found = BatchScorer(lengths, str(path), slices=10).transform(given, "new").collect()
    assert sorted(r["doc_id"] for r in found) == list(range(60))
    kept = [r for r in found if r["new"] == 1.0 and len(r["text"] or "") != 1]
    assert 0 < len(kept) <= 30 and any(r["new"] == len(r["text"] or "") > 1 for r in found)


def test_the_model_is_loaded_once_per_worker(spark, tmp_path):
    log = tmp_path / "loads.txt"

    def load():
        with open(log, "a") as out:
            out.write("x")
        return lambda queries, texts: [0.0] * len(texts)

    BatchScorer(load, str(tmp_path / "c"), slices=1, rows=2).transform(rows(spark).repartition(20), "new").count()
    assert 1 <= log.stat().st_size <= spark.sparkContext.defaultParallelism


def test_no_candidates(spark, tmp_path):
    assert BatchScorer(lengths, str(tmp_path / "d")).transform(rows(spark).limit(0), "new").count() == 0
