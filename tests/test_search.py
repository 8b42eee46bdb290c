import math
from collections import Counter, defaultdict

import pytest
from corpus_rows import DOCS

from passagerank.operators import search as se
from passagerank.operators import sizing

STOP = set(
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this "
    "to was will with".split()
)


def words(text):
    import re

    found = re.findall(r"[^\W_]+(?:[.'’][^\W_]+)*", text.lower())
    bare = [w[:-2] if w.endswith(("'s", "’s")) else w for w in found]
    return [w for w in bare if w not in STOP]


def brute(topics, k1=0.9, b=0.4, k=1000):
    vectors = {d: Counter(words(t)) for d, t in DOCS}
    full = [v for v in vectors.values() if v]
    n, avg = len(full), sum(map(lambda v: sum(v.values()), full)) / len(full)
    df = Counter(t for v in full for t in v)
    out = {}
    for qid, query in topics:
        scores = defaultdict(float)
        for term, qtf in Counter(words(query)).items():
            for doc, v in vectors.items():
                if v[term]:
                    idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
                    scores[doc] += qtf * idf * v[term] / (v[term] + k1 * (1 - b + b * sum(v.values()) / avg))
        ranked = sorted(scores.items(), key=lambda x: (-round(x[1], 8), x[0]))[:k]
        if ranked:
            out[qid] = ranked
    return out


def as_dict(run):
    out = defaultdict(list)
    for r in sorted(run.collect(), key=lambda r: (r.qid, r.rank)):
        out[r.qid].append((r.doc_id, r.score))
    return dict(out)


def check(run, topics, **options):
    got, want = as_dict(run), brute([tuple(r) for r in topics.collect()], **options)
    assert got.keys() == want.keys()
    for qid in want:
        assert [d for d, _ in got[qid]] == [d for d, _ in want[qid]]
        for (_, a), (_, b) in zip(got[qid], want[qid]):
            assert a == pytest.approx(b, abs=1e-6)


def test_bm25_against_brute_force(index, topics):
    check(se.search_with_scores(topics, index), topics)
    check(se.search_with_scores(topics, index, k1=1.2, b=0.75, k=2), topics, k1=1.2, b=0.75, k=2)


def test_no_hits_for_empty_stop_and_unknown(index, topics):
    found = {r.qid for r in se.search(topics, index).collect()}
    assert found == {1, 2, 6}


def test_ranks_are_dense_from_zero(index, topics):
    for qid, rows in as_dict(se.search_with_scores(topics, index)).items():
        assert rows == sorted(rows, key=lambda x: (-x[1], x[0])), qid
    ranks = [r.rank for r in se.search(topics, index).filter("qid = 1").orderBy("rank").collect()]
    assert ranks == list(range(len(ranks)))


def test_prefix_property(index, topics):
    deep = as_dict(se.search_with_scores(topics, index, k=100))
    for k in (1, 2, 3):
        assert as_dict(se.search_with_scores(topics, index, k=k)) == {q: r[:k] for q, r in deep.items()}


def test_many_queries_take_the_shuffle_path(index, topics, monkeypatch):
    small = as_dict(se.search_with_scores(topics, index))
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    assert as_dict(se.search_with_scores(topics, index)) == small
    monkeypatch.setattr(sizing, "HOT_ROWS", 1)
    assert as_dict(se.search_with_scores(topics, index)) == small


def test_deep_and_merged_cuts(index, topics, monkeypatch):
    from passagerank.operators import ranking

    whole = as_dict(se.search_with_scores(topics, index))
    assert as_dict(se.search_with_scores(topics, index, k=5000)) == whole
    monkeypatch.setattr(ranking, "MERGE_ROWS", 1)
    assert as_dict(se.search_with_scores(topics, index, k=2)) == {q: r[:2] for q, r in whole.items()}


def test_search_plan(index, topics):
    """No Python, no exchange of postings: the only shuffle carries the top k of every task."""
    run = se.search_with_scores(topics, index, k=10)
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("WindowGroupLimit") == 2
    assert "PartitionFilters: [term_slot" in plan


def test_terms_are_literals_only_while_few(index, topics, monkeypatch):
    def plan():
        return se.search_with_scores(topics, index)._jdf.queryExecution().executedPlan().toString()

    assert "In(term" in plan()
    monkeypatch.setattr(se, "LITERAL_TERMS", 2)
    assert "In(term" not in plan()
    check(se.search_with_scores(topics, index), topics)


def test_search_one_and_arrays(spark, index, topics):
    top = se.search_one(spark, "red car", index, k=1).collect()
    assert [(r.doc_id, r.rank) for r in top] == [(brute([(1, "red car")])[1][0][0], 0)]
    run = se.search_with_scores(topics, index)
    for depth in (2, 1000):
        lists = {r.qid: r.doc_ids for r in se.ranking_arrays(run, depth).collect()}
        assert lists == {q: [d for d, _ in rows][:depth] for q, rows in as_dict(run).items()}


def test_candidates(index, topics):
    run = se.search_with_scores(topics, index)
    rows = se.candidates_with_text(run, index.docs, topics, k=1).collect()
    best = {q: dict(DOCS)[hits[0][0]] for q, hits in brute([tuple(r) for r in topics.collect()]).items()}
    assert {r.qid: r.text for r in rows} == best
    assert {r.qid: r.query for r in rows} == {r.qid: r.query for r in topics.collect() if r.qid in best}
    assert all(r["rank"] == 0 for r in rows)


def test_byte_length():
    """Short lengths are exact, longer ones keep four leading bits."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from passagerank.functions.weighting import stored_length

    df = SparkSession.getActiveSession().range(0, 3000).select(F.col("id").cast("int").alias("dl"))
    got = {r.dl: r.n for r in df.select("dl", stored_length(F.col("dl")).alias("n")).collect()}
    for dl, n in got.items():
        rest = dl - 24
        bits = max(rest, 0).bit_length()
        want = dl if dl < 24 else 24 + ((rest >> max(bits - 4, 0)) << max(bits - 4, 0))
        assert n == want


def test_a_batch_of_many_matches_is_scored_in_blocks(spark, index, topics, monkeypatch):
    """Same rows as the aggregate, with repeated and null query ids, whatever the blocks; no row per match is shuffled."""
    from passagerank.operators import blocks

    more = topics.union(spark.createDataFrame([(1, "cat"), (None, "car bus"), (8, "near near mat red")], topics.schema))

    def rows(k):
        return sorted(map(str, se.search_with_scores(more, index, k=k).collect()))

    wanted = {k: rows(k) for k in (2, 1000)}
    monkeypatch.setattr(se, "LITERAL_TERMS", 0)
    monkeypatch.setattr(blocks, "MANY_MATCHES", 0)
    monkeypatch.setattr(blocks, "MANY_QUERIES", 0)
    for postings, terms, hits in ((1 << 20, 1 << 20, 1 << 20), (5, 3, 4)):
        for name, value in (("BLOCK_POSTINGS", postings), ("BLOCK_TERMS", terms), ("BLOCK_HITS", hits)):
            monkeypatch.setattr(blocks, name, value)
        assert {k: rows(k) for k in wanted} == wanted
    assert "FlatMapCoGroupsInArrow" in se.search_with_scores(more, index)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    assert {k: rows(k) for k in wanted} == wanted


def test_block_hits_merge_shared_ids_and_count_weights_of_nothing():
    import pyarrow as pa

    from passagerank.operators.blocks import block_hits

    weighed = pa.table({"pair": [3, 3, 9, 3, 9], "doc_id": pa.array(["b", "b", "b", None, "a"]), "w": [2, 5, 0, 7, 0]})
    marked = pa.table({"query": [1, 1, 2, 2, 4], "pair": [3, 9, 9, 9, 5]})
    assert block_hits(weighed, marked, 5).to_pylist() == [
        {"query": 1, "doc_id": None, "total": 7}, {"query": 1, "doc_id": "a", "total": 0}, {"query": 1, "doc_id": "b", "total": 7},
        {"query": 2, "doc_id": "a", "total": 0}, {"query": 2, "doc_id": "b", "total": 0},
    ]
    assert block_hits(weighed, marked, 1).to_pylist() == [
        {"query": 1, "doc_id": None, "total": 7}, {"query": 2, "doc_id": "a", "total": 0},
    ]


def test_stored_length_needs_no_text(spark):
    """A length is coarsened by comparisons and a remainder: it is worked out for every match of a search."""
    from pyspark.sql import functions as F

    from passagerank.functions.weighting import stored_length

    lengths = sorted({*range(0, 3000), *(24 + (1 << b) + d for b in range(4, 31) for d in (-1, 0, 1)), (1 << 31) - 1})
    df = spark.createDataFrame([(n,) for n in lengths], "dl INT").select("dl", stored_length(F.col("dl")).alias("n"))
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "bin(" not in plan and "pow" not in plan
    for dl, n in df.collect():
        step = 1 << max((dl - 24).bit_length() - 4, 0) if dl >= 24 else 1
        assert n == (dl if dl < 24 else 24 + (dl - 24) // step * step), dl


def test_blocks_give_only_hits_that_reach_a_score(spark, monkeypatch, tmp_path):
    """Same rows as the aggregate where few documents are looked at first; a query whose score was set too high is scored again."""
    import random

    from passagerank.operators import blocks
    from passagerank.operators.index import build_index

    drawn = random.Random(5)
    texts = [" ".join(drawn.choices("ant bee cow dog elk fox gnu hen".split(), k=drawn.randint(1, 12))) for _ in range(300)]
    corpus = spark.createDataFrame([*enumerate(texts), (7, "ant bee"), (None, "cow cow dog")], "doc_id BIGINT, text STRING")
    index = build_index(corpus, str(tmp_path / "many"), stemmer=None, shards=3, term_slots=2)
    asked = [(f"q{i}", t) for i, t in enumerate([*texts[:20], "ant", "hen zebra", "zebra"])] + [("q1", "ant"), (None, "bee elk")]
    topics = spark.createDataFrame(asked, "qid STRING, query STRING")

    def rows():
        return sorted(map(str, se.search_with_scores(topics, index, k=20).collect()))

    wanted = rows()
    monkeypatch.setattr(se, "LITERAL_TERMS", 0)
    for name, value in (("MANY_MATCHES", 0), ("MANY_QUERIES", 0), ("LEAST_POSTINGS", 50), ("MANY_HITS", 0), ("CHUNK_TERMS", 20)):
        monkeypatch.setattr(blocks, name, value)
    given, block_hits = [], blocks._block_hits
    monkeypatch.setattr(blocks, "_block_hits", lambda k: given.append(k) or block_hits(k))
    assert rows() == wanted and len(given) == 1
    folder = max((f for f in _folders(spark) if f.name.startswith("hits-")), key=lambda f: f.stat().st_mtime)
    assert spark.read.parquet(str(folder)).groupBy("query").count().agg({"count": "max"}).first()[0] < 25 * 20
    monkeypatch.setattr(blocks, "_reach", lambda k: 2)  # far too few: hits are lacking
    assert rows() == wanted and len(given) == 3
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    assert rows() == wanted and len(given) == 5


def _folders(spark):
    from pathlib import Path

    from passagerank.operators.workspace import workspace

    return Path(workspace(spark).removeprefix("file:")).iterdir()
