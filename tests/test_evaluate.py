import math
import random

import pytest

from passagerank.operators import errors, evaluate as ev

QRELS = [
    (1, 10, 3), (1, 11, 0), (1, 12, 1), (1, 13, 2), (1, 14, 0),
    (2, 20, 0), (2, 21, 0),
    (3, 30, 2), (3, 31, 1),
]
RUN = [
    (1, 10, 0, 9.0), (1, 11, 1, 8.0), (1, 99, 2, 7.0), (1, 13, 3, 6.0),
    (2, 20, 0, 1.0), (2, 98, 1, 0.5),
    (7, 70, 0, 1.0),
]


@pytest.fixture(scope="module")
def qrels(spark):
    return spark.createDataFrame(QRELS, "qid INT, doc_id INT, rating INT").cache()


@pytest.fixture(scope="module")
def run(spark):
    return spark.createDataFrame(RUN, "qid INT, doc_id INT, rank INT, score DOUBLE").cache()


def rows(df, key="qid"):
    return {r[key]: r for r in df.collect()}


def test_by_hand(run, qrels):
    judged = ev.judge(run, qrels)
    got = rows(ev.per_query(judged, (*ev.OFFICIAL, "ndcg", "counts")))
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert one["map"] == pytest.approx((1 / 1 + 2 / 4) / 3)
    assert one["rprec"] == pytest.approx(1 / 3)
    assert one["bpref"] == pytest.approx((1 + (1 - 1 / 2)) / 3)
    assert one["recip_rank"] == 1.0
    assert [one[f"iprec_{p // 10}_{p % 10}"] for p in range(11)] == pytest.approx([1.0] * 4 + [0.5] * 3 + [0.0] * 4)
    assert one["p_5"] == pytest.approx(2 / 5) and one["p_1000"] == pytest.approx(2 / 1000)
    assert one["recall_5"] == pytest.approx(2 / 3)
    ideal = 7 + 3 / math.log2(3) + 1 / math.log2(4)
    assert one["ndcg_5"] == pytest.approx((7 + 3 / math.log2(5)) / ideal)
    assert one["ndcg_1"] == 1.0
    assert (one["num_ret"], one["num_rel_ret"], one["R"], one["M"]) == (4, 2, 3, 2)
    for qid in (2, 3):
        assert got[qid]["map"] == got[qid]["bpref"] == got[qid]["recip_rank"] == got[qid]["ndcg_10"] == 0.0
    assert got[3]["num_ret"] == 0


def test_summary_counts_and_report(run, qrels):
    judged = ev.judge(run, qrels)
    mean = ((1 / 1 + 2 / 4) / 3) / 3
    assert ev.summary(judged, ("map",)).first()["map"] == pytest.approx(mean)
    c = ev.eval_counts(judged).first()
    assert (c.num_q, c.num_ret, c.num_rel, c.num_rel_ret) == (3, 6, 5, 2)
    gm = math.exp((math.log(0.5) + 2 * math.log(1e-5)) / 3)
    assert ev.eval_gm_map(judged).first()["gm_map"] == pytest.approx(gm)
    report = {r.measure: r.value for r in ev.report(judged).collect()}
    assert report["map"] == pytest.approx(mean) and report["num_q"] == 3 and report["gm_map"] == pytest.approx(gm)
    assert {f"p_{k}" for k in ev.CUTOFFS} | {f"recall_{k}" for k in ev.CUTOFFS} <= set(report)


def test_min_rating(run, qrels):
    strict = rows(ev.per_query(ev.judge(run, qrels, min_rating=2), ("map",)))
    assert strict[1]["map"] == pytest.approx((1 + 2 / 4) / 2) and strict[1]["R"] == 2


def test_order_breaks_ties_by_text_of_id(spark):
    tied = spark.createDataFrame([(1, 9, 0, 0.0), (1, 10, 1, 0.0), (1, 100, 2, 1.0)], "qid INT, doc_id INT, rank INT, score DOUBLE")
    assert [r.doc_id for r in ev.trec_order(tied).orderBy("pos").collect()] == [100, 9, 10]


@pytest.fixture(scope="module")
def random_data(spark):
    rng = random.Random(3)
    qrels, run = [], []
    for q in range(12):
        docs = rng.sample(range(1000), 80)
        qrels += [(q, d, rng.randrange(4)) for d in docs[:50]]
        run += [(q, d, i, float(rng.randrange(20))) for i, d in enumerate(docs[20:])]
    run += [(0, 5000 + i, 60 + i, 3.0) for i in range(600)]
    return (
        spark.createDataFrame(run, "qid INT, doc_id INT, rank INT, score DOUBLE").cache(),
        spark.createDataFrame(qrels, "qid INT, doc_id INT, rating INT").cache(),
    )


def test_properties_and_hot_query(random_data):
    run, qrels = random_data
    names = (*ev.OFFICIAL, "ndcg", "counts")
    window = rows(ev.per_query(ev.judge(run, qrels), names))
    ranges = rows(ev.per_query(ev.judge(run, qrels, group_rows=40), names))
    for qid, row in window.items():
        assert row.asDict() == pytest.approx(ranges[qid].asDict())
        assert 0 <= row["map"] <= 1 and 0 <= row["bpref"] <= 1
        recalls = [row[f"recall_{k}"] for k in ev.CUTOFFS]
        assert recalls == sorted(recalls)
        iprec = [row[f"iprec_{p // 10}_{p % 10}"] for p in range(11)]
        assert iprec == sorted(iprec, reverse=True)


def test_ideal_run_has_ndcg_one(random_data):
    _, qrels = random_data
    ideal = qrels.selectExpr("qid", "doc_id", "cast(rating as double) as score")
    for row in ev.eval_ndcg(ev.judge(ideal, qrels)).collect():
        assert [row[f"ndcg_{k}"] for k in ev.NDCG_CUTOFFS] == pytest.approx([1.0] * 4)


def test_experiment(run, qrels, spark):
    perfect = qrels.selectExpr("qid", "doc_id", "cast(rating as double) as score")
    table = rows(ev.experiment({"a": run, "b": perfect}, qrels, ("map", "ndcg")), "name")
    assert set(table) == {"a", "b"}
    assert table["a"]["map"] == pytest.approx(0.5 / 3)
    assert table["b"]["map"] == pytest.approx(2 / 3)
    some = spark.createDataFrame([(1, "x")], "qid INT, query STRING")
    only = rows(ev.experiment({"a": run}, qrels, ("map",), topics=some), "name")
    assert only["a"]["map"] == pytest.approx(0.5)


# ------------------------------------------------------------ error analysis


def pairs(df):
    return {(r.qid, r.doc_id) for r in df.collect()}


def test_relevant_sets(run, qrels):
    found, missed = pairs(errors.relevant_retrieved(qrels, run)), pairs(errors.relevant_not_retrieved(qrels, run))
    assert found == {(1, 10), (1, 13)} and missed == {(3, 30)}
    assert found | missed == pairs(errors.relevant(qrels)) and not found & missed
    assert pairs(errors.non_relevant_retrieved(qrels, run)) == {(1, 11), (2, 20)}
    assert pairs(errors.non_relevant(qrels)) == pairs(qrels) - pairs(errors.relevant(qrels))


def test_counts_histogram_judged(run, qrels):
    assert {r.qid: r.recall_count for r in errors.recall_count_at(qrels, run, 3).collect()} == {1: 1, 2: 0, 3: 0}
    assert {r.rating: r.n for r in errors.rating_histogram(qrels, run).collect()} == {0: 2, 1: 0, 2: 1, 3: 1}
    assert {r.rating: r.n for r in errors.rating_histogram(qrels, run, 2).collect()} == {0: 0, 1: 0, 2: 1, 3: 1}
    assert errors.judged_per_query(qrels).first()["judged_per_query"] == 3.0


def test_worst_and_containing(spark, run, qrels, index):
    topics = spark.createDataFrame([(1, "red law"), (2, "the cat's law"), (3, "bus"), (4, "law")], "qid INT, query STRING")
    first = errors.worst_queries(qrels, run, topics, index, n=3).collect()
    assert [(r.qid, r.recall_count, r.tokens) for r in first] == [(2, 0, ["cat", "law"])]
    assert [r.qid for r in errors.worst_queries(qrels, run, topics, index, n=3, pick=2).collect()] == [1]
    for limit in (1_000_000, 1):
        got = {r.qid: r.ordinal for r in errors.queries_containing(qrels, topics, "law", group_rows=limit).collect()}
        assert got == {1: 0, 2: 1}


def test_annotated(spark, index):
    run = spark.createDataFrame([(1, 7, 0), (1, 2, 1), (1, 1, 2)], "qid INT, doc_id BIGINT, rank INT")
    judged = spark.createDataFrame([(1, 7, 2), (1, 1, 3)], "qid INT, doc_id BIGINT, rating INT")
    for limit in (1_000_000, 1):
        got = {r["rank"]: r for r in errors.annotate_ranking(run, judged, index, n_terms=1, group_rows=limit).collect()}
        assert [(got[i].rating, got[i].relevant_so_far, got[i].top_terms) for i in range(3)] == [
            (2, 1, ["cat"]), (0, 1, ["red"]), (3, 2, ["cat"]),
        ]
