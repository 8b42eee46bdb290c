import math

import pytest
from pyspark.sql import functions as F

from passagerank.operators import expand, sizing
from passagerank.operators.search import search_with_scores
from passagerank.operators.spelling import changed_queries, corrections, spell_correct


def test_offer_weight_by_hand(spark):
    df = spark.createDataFrame([(3.0, 10.0, 5.0, 100.0), (5.0, 5.0, 1.0, 8.0)], "r DOUBLE, depth DOUBLE, n DOUBLE, docs DOUBLE")
    got = [r[0] for r in df.select(expand.offer_weight(df.r, df.depth, df.n, df.docs)).collect()]
    assert got[0] == pytest.approx(8.4137, abs=1e-4)
    assert got[1] == pytest.approx(5 * math.log(0.001))


def test_feedback_counts_documents(spark, index):
    run = spark.createDataFrame([(1, 1), (1, 7), (2, 2)], "qid BIGINT, doc_id BIGINT")
    got = {(r.qid, r.term): r.r for r in expand.feedback_terms(run, index).collect()}
    assert got[(1, "cat")] == 2 and got[(1, "hat")] == 1 and got[(2, "bus")] == 1 and (2, "cat") not in got


def test_drop_uses_the_first_token_of_a_word(spark, index):
    topics = spark.createDataFrame([(1, "red-car the cat's")], "qid BIGINT, query STRING")
    assert {r.term for r in expand.first_word_terms(topics, index).collect()} == {"red", "cat"}


def test_expansion(index, topics, monkeypatch):
    expanded = {r.qid: r["query"] for r in expand.expand_queries(topics, index, n=2, feedback_k=3).collect()}
    assert set(expanded) == {1, 2, 3, 4, 5, 6}
    assert expanded[3] == "" and expanded[5] == "zebra"
    for qid, text in ((1, "red car"), (2, "cat cat mat")):
        assert expanded[qid].startswith(text + " ")
        extra = expanded[qid][len(text) + 1:].split(" ")
        assert len(extra) == 2 and not set(extra) & set(text.split())
    many = {r.qid: r["query"] for r in expand.expand_queries(topics, index, n=1000, feedback_k=3).collect()}
    assert len(many[1].split()) > 2  # fewer candidates than asked for is no error
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    again = {r.qid: r["query"] for r in expand.expand_queries(topics, index, n=2, feedback_k=3).collect()}
    assert again == expanded


def test_expanded_search_counts_repeats(spark, index):
    two = spark.createDataFrame([(1, "red"), (2, "red red")], "qid BIGINT, query STRING")
    got = {}
    for r in search_with_scores(two, index).collect():
        got.setdefault(r.qid, {})[r.doc_id] = r.score
    assert got[2] == pytest.approx({d: 2 * s for d, s in got[1].items()}, abs=1e-8)


def test_only_retrieved_documents_are_taken_apart(spark, index, monkeypatch):
    hits = spark.createDataFrame([(1, 7, 0.0), (2, 7, 0.0), (2, None, 0.0)], "qid BIGINT, doc_id BIGINT, reached DOUBLE")
    terms = spark.createDataFrame([("cat", 1.0), ("red", 1.0), ("hat", 1.0)], "term STRING, bound DOUBLE")
    seen, join = [], expand.lookup_join

    def told(left, *rest):
        seen.extend(r.doc_id for r in left.collect())
        return join(left, *rest)

    monkeypatch.setattr(expand, "lookup_join", told)
    assert sorted(map(tuple, expand._counted(hits, index, terms).collect())) == [(1, "cat", 1), (2, "cat", 1)]
    assert set(seen) == {7}


# ------------------------------------------------------------------ spelling


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_corrections_against_all_pairs(spark, monkeypatch, limit):
    import random

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", limit)
    rng = random.Random(11)
    vocabulary = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))) for _ in range(400)})
    queries = sorted({"".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 11))) for _ in range(120)} - set(vocabulary))
    stats = [(t, 1 + i % 7) for i, t in enumerate(vocabulary)]
    got = {
        r.word: r.term
        for r in corrections(
            spark.createDataFrame([(q,) for q in queries], "word STRING"),
            spark.createDataFrame(stats, "term STRING, df BIGINT"),
        ).collect()
    }
    want = {}
    for q in queries:
        near = [(edits(q, t), -df, t) for t, df in stats]
        near = [n for n in near if n[0] <= 2]
        if near:
            want[q] = min(near)[2]
    assert got == want


def test_spell_correct(spark):
    stats = spark.createDataFrame([("military", 5), ("suicide", 3), ("causes", 9), ("of", 20)], "word STRING, df BIGINT")
    topics = spark.createDataFrame(
        [(1, "causes of miltary suicid"), (2, "Military causes,"), (3, ""), (4, "xxxxxxxxxx"), (5, "(miltary), 'suicid'?")],
        "qid INT, query STRING",
    )
    out = spell_correct(topics, stats)
    got = {r.qid: (r.corrected, r.changed) for r in out.collect()}
    assert got == {
        1: ("causes of military suicide", True), 2: ("Military causes,", False), 3: ("", False), 4: ("xxxxxxxxxx", False),
        5: ("(military), 'suicide'?", True),
    }
    assert changed_queries(out).first()["n_changed"] == 2


@pytest.mark.parametrize("stemmer", [None, "porter"])
def test_words_of_the_collection_stay(spark, tmp_path, stemmer):
    from passagerank.operators.index import build_index

    texts = [(1, "The causes of running an engine"), (2, "He ran two queries off to it"), (3, "cause run engines query")]
    index = build_index(spark.createDataFrame(texts, "doc_id INT, text STRING"), str(tmp_path / "index"), stemmer=stemmer)
    topics = spark.createDataFrame([(1, "the causes of running queries to an engine"), (2, "enginne")], "qid INT, query STRING")
    got = {r.qid: r.corrected for r in spell_correct(topics, index.words).collect()}
    assert got == {1: "the causes of running queries to an engine", 2: "engine"}


@pytest.mark.parametrize("frequent", [1, 2, 5, 4096])
@pytest.mark.parametrize("n", [1, 3, 50])
def test_best_terms_without_counting_all(spark, index, topics, frequent, n):
    from passagerank.operators.search import search

    run = search(topics, index, k=4)
    every = expand.offer_weights(expand.drop_query_terms(expand.feedback_terms(run, index), topics, index), index, 4)
    wanted = expand.expansion_terms(every, n).select("qid", "term", "rank", "weight").collect()
    found = expand.best_feedback_terms(run, topics, index, n, 4, frequent).select("qid", "term", "rank", "weight").collect()
    assert sorted(found) == sorted(wanted)


def test_no_run_has_no_best_terms(index, topics):
    from passagerank.operators.search import search

    assert expand.best_feedback_terms(search(topics.limit(0), index, k=4), topics, index, 3, 4).count() == 0
