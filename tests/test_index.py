import re

import pytest
from corpus_rows import DOCS
from pyspark.sql import functions as F

from passagerank.operators import index as ix


def test_statistics(index):
    c = index.coll_stats.first()
    total = sum(r.dl for r in index.doc_stats.collect())
    assert (c.n_docs, c.n_nonempty, c.total_terms) == (7, 5, total)
    assert index.postings.agg({"tf": "sum"}).first()[0] == total
    assert {r.doc_id: r.dl for r in index.doc_stats.collect()}[4] == 0


def test_postings_and_counts(spark, corpus, index):
    rows = {(r.term, r.doc_id): (r.tf, r.positions, r.dl) for r in index.postings.collect()}
    assert rows[("cat", 1)] == (2, [0, 3], 6)
    assert rows[("cat", 7)] == (4, [0, 1, 2, 3], 4)
    direct = ix.build_postings(corpus, stemmer=None)
    assert {(r.term, r.doc_id): (r.tf, r.positions, r.dl) for r in direct.collect()} == rows
    counts = {r.term: (r.df, r.cf) for r in ix.term_counts(index.postings).collect()}
    assert counts["cat"] == (3, 7)
    assert counts == {r.term: (r.df, r.cf) for r in index.term_stats.collect()}
    assert ix.term_counts(index.postings, "zebra").collect() == []
    assert [tuple(r) for r in ix.term_counts(index.postings, "red").collect()] == [("red", 3, 4)]
    lengths = {r.doc_id: r.dl for r in ix.doc_lengths(index.postings).collect()}
    assert lengths == {r.doc_id: r.dl for r in index.doc_stats.collect() if r.dl}


def test_vectors_and_top_terms(spark, index):
    ids = spark.createDataFrame([("1",), ("7",)], "doc_id STRING")
    vectors = {r.doc_id: r.vector for r in ix.doc_vector(index.docs, ids).collect()}
    assert vectors == {1: {"cat": 2, "sat": 1, "mat": 1, "hat": 1, "red": 1}, 7: {"cat": 4}}
    tops = {r.doc_id: r.top_terms for r in ix.top_terms(index.docs, 2).collect()}
    assert tops[1] == ["cat", "hat"] and tops[4] == [] and tops[2] == ["red", "bus"]


def test_fetch_docs(spark, index):
    run = spark.createDataFrame([(1, 7, 0), (1, 2, 1)], "qid BIGINT, doc_id BIGINT, rank INT")
    assert {r.doc_id: r.text for r in ix.fetch_docs(run, index.docs).collect()} == {7: DOCS[6][1], 2: DOCS[1][1]}


def test_open_or_build_reuses(spark, corpus, tmp_path):
    path = str(tmp_path / "i")
    first = ix.open_or_build(corpus, path, shards=2, term_slots=2)
    again = ix.open_or_build(corpus.limit(1), path)
    assert again.collection == first.collection and again.stemmer == "porter" and again.shards == 2
    with pytest.raises(FileExistsError):
        ix.build_index(corpus, path, shards=2)


def test_a_broken_build_is_no_obstacle(spark, corpus, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    with monkeypatch.context() as m:
        m.setattr(ix, "collection_stats", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ix.build_index(corpus, path, stemmer=None, shards=2, term_slots=2)
    assert not ix._committed(spark, path)
    assert ix.open_or_build(corpus, path, stemmer=None, shards=2, term_slots=2).collection.n_docs == 7


def test_one_sorted_file_per_slot_and_bucket(spark, corpus, tmp_path):
    ix.build_index(corpus, str(tmp_path / "f"), stemmer=None, shards=2, term_slots=3)
    files = list((tmp_path / "f").glob("data-*/postings/term_slot=*/*.parquet"))
    assert 3 <= len(files) <= 6
    for file in files:
        terms = [r.term for r in spark.read.parquet(str(file)).collect()]
        assert terms == sorted(terms)


def test_few_ids_are_literals_of_the_scan(spark, index, monkeypatch):
    ids = spark.createDataFrame([(1,), (7,)], "doc_id BIGINT")
    counted = ix.select_docs(index.docs, ids).groupBy("doc_id").count()
    plan = counted._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PushedFilters: [In(doc_id, [1,7])]" in plan
    assert re.search("SelectedBucketsCount: [12] out of 3", plan)
    monkeypatch.setattr(ix, "LITERAL_IDS", 1)
    assert ix.select_docs(index.docs, ids) is index.docs


def test_string_ids_and_no_text(spark, corpus, tmp_path):
    named = corpus.selectExpr("concat('d', doc_id) AS doc_id", "text")
    built = ix.build_index(named, str(tmp_path / "s"), stemmer=None, shards=2, term_slots=2, keep_text=False)
    assert "text" not in built.docs.columns
    assert built.postings.filter("term = 'bus'").count() == 2
    assert built.docs.schema["doc_id"].dataType.simpleString() == "string"


def test_build_shuffles_the_corpus_once(spark, corpus):
    docs = ix.document_terms(corpus.repartition(3, "doc_id"), None)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_large_corpus_gets_more_shards(spark, corpus, monkeypatch):
    few = ix._default_shards(corpus)
    monkeypatch.setattr(ix, "SHARD_BYTES", 8)
    assert 1 <= few <= 8 < ix._default_shards(corpus) <= ix.MAX_SHARDS


@pytest.fixture(scope="module")
def stemmed(corpus, tmp_path_factory):
    return ix.build_index(corpus, str(tmp_path_factory.mktemp("index") / "stemmed"), shards=3, term_slots=4)


def test_stemmed_index_equals_analysis_in_the_row(corpus, stemmed):
    key = lambda r: (r["term"], r["doc_id"])
    wanted = sorted(ix.build_postings(corpus).collect(), key=key)
    found = stemmed.postings.select("term", "doc_id", "tf", "dl", "positions").collect()
    assert sorted(found, key=key) == wanted and {"cat", "car", "sat"} <= {r["term"] for r in wanted}
    assert stemmed.docs.count() == corpus.count() and stemmed.docs.filter("doc_id = 4").first()["terms"] == []


def test_stems_come_from_the_dictionary_without_another_exchange(spark, corpus, stemmed, monkeypatch):
    docs = ix.stemmed_documents(corpus.repartition(3, "doc_id"), stemmed.stems)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert plan.count("Exchange hashpartitioning(doc_id") <= 2  # one of them reused
    from passagerank.operators import sizing

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    by_shuffle = ix.stemmed_documents(corpus.repartition(3, "doc_id"), stemmed.stems).select("doc_id", "terms", "dl")
    assert sorted(by_shuffle.collect()) == sorted(docs.select("doc_id", "terms", "dl").collect())


def test_query_words_are_looked_up_or_stemmed(spark, stemmed):
    words = spark.createDataFrame([("cats",), ("walking",), ("cats",), ("the",)], "word STRING")
    found = {r["word"]: r["stem"] for r in ix.stems_for(words, stemmed).collect()}
    assert found == {"cats": "cat", "walking": "walk", "the": "the"}
    topics = spark.createDataFrame([(1, "Cars' cats walking cats")], "qid INT, query STRING")
    from passagerank.operators.search import query_terms

    rows = query_terms(topics, stemmed)
    assert sorted((r["term"], r["qtf"]) for r in rows.collect()) == [("car", 1), ("cat", 2), ("walk", 1)]
    assert "ArrowEvalPython" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_large_run_moves_to_the_documents(spark, index, monkeypatch):
    """Documents are bucketed by id: beyond the broadcast limit only the hits are exchanged, never the texts."""
    from passagerank.operators import sizing

    run = spark.createDataFrame([(1, 1, 0), (1, 7, 1), (2, 2, 0), (3, 99, 0)], "qid INT, doc_id BIGINT, rank INT")
    wanted = sorted(ix.fetch_docs(run, index.docs).collect())
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ix.fetch_docs(run, index.docs)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(found.collect()) == wanted and len(wanted) == 3
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_shards_follow_the_corpus_and_not_the_cores(spark, monkeypatch):
    """A task of a build or a search holds as much text whatever the size of the corpus."""
    def of(n):
        return spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))

    monkeypatch.setattr(ix, "SHARD_BYTES", 1 << 10)
    cores = spark.sparkContext.defaultParallelism
    few, many = ix._default_shards(of(2_000)), ix._default_shards(of(20_000))
    assert many > 8 * cores and 9 * few <= many <= 11 * few


def test_frequent_words_are_known_before_the_corpus_meets_its_stems(corpus, stemmed, monkeypatch):
    """The corpus is analyzed once, not once more to count its words; frequent ones are salted all the same."""
    from passagerank.operators import sizing

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(sizing, "HOT_ROWS", 2)
    asked = []
    hot = sizing.hot_keys
    monkeypatch.setattr(sizing, "hot_keys", lambda left, keys, n, counts: asked.append(counts) or hot(left, keys, n, counts))
    docs = ix.stemmed_documents(corpus.repartition(3, "doc_id"), stemmed.stems, words=stemmed.words)
    assert asked[0] is not None and {"cat", "red"} <= {r["word"] for r in asked[0].filter("count > 2").collect()}
    columns = ("doc_id", "terms", "dl")
    assert sorted(docs.select(*columns).collect()) == sorted(stemmed.docs.select(*columns).collect())


def test_postings_are_sorted_by_their_term_alone(spark, corpus, tmp_path, monkeypatch):
    """The first bytes of the term decide most comparisons of the sort, not the slot that thousands of rows share."""
    plans, write, key = {}, ix._write_bucketed, "spark.sql.maxConcurrentOutputFileWriters"

    def told(df, path, *rest):
        plans[path.rsplit("/", 1)[1]] = (df._jdf.queryExecution().executedPlan().toString(), spark.conf.get(key))
        write(df, path, *rest)

    before = spark.conf.get(key)
    monkeypatch.setattr(ix, "_write_bucketed", told)
    built = ix.build_index(corpus, str(tmp_path / "alone"), stemmer=None, shards=2, term_slots=3)
    plan, writers = plans["postings"]
    assert re.findall(r"Sort \[(.*?)\], (true|false)", plan) == [(re.search(r"term#\d+", plan).group() + " ASC NULLS FIRST", "false")]
    assert int(writers) > 3 and spark.conf.get(key) == before
    assert {r.term for r in built.postings.filter("doc_id = 7").collect()} == {"cat"}


def test_only_distinct_words_of_a_shard_move_to_a_large_dictionary(spark, corpus, tmp_path, monkeypatch):
    """The groups of a document, with their positions, stay where the document is; ids may repeat or be null."""
    from passagerank.operators import sizing

    more = corpus.union(spark.createDataFrame([(1, "Cats walking, cars' cats"), (None, "a lost cat")], corpus.schema))
    wanted = ix.build_index(more, str(tmp_path / "small"), shards=3, term_slots=2)
    plans, write, key = {}, ix._write_bucketed, "spark.sql.autoBroadcastJoinThreshold"

    def told(df, path, *rest):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().executedPlan().toString()
        write(df, path, *rest)

    monkeypatch.setattr(ix, "_write_bucketed", told)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        built = ix.build_index(more, str(tmp_path / "large"), shards=3, term_slots=2)
    finally:
        spark.conf.set(key, before)
    columns = ("doc_id", "terms", "dl")
    found = sorted(map(str, built.docs.select(*columns).collect()))
    assert found == sorted(map(str, wanted.docs.select(*columns).collect())) and len(found) == 9
    dealt = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*), \d+\), ", plans["docs"])]
    texts = [x for x in dealt if "hash(doc_id" in x]
    assert len(texts) == 3 and len(set(texts)) == 1  # one of them runs, the others use it again
    assert sorted(x for x in dealt if x not in texts) == ["__shard", "word", "word"]
    assert len(list((tmp_path / "large").glob("data-*/docs/*.parquet"))) <= 3
