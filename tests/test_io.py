import pytest
from pyspark.sql import functions as F

from passagerank.sources import readers, writers

RUN = [("108", "d1", 0, 0.127), ("108", "d2", 1, 0.08), ("9", "d9", 0, 12.0)]


@pytest.fixture()
def run(spark):
    return spark.createDataFrame(RUN, "qid STRING, doc_id STRING, rank INT, score DOUBLE")


def lines(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_topics(spark, tmp_path):
    path = put(tmp_path, "q.tsv", "10\twhat's a-b?\n9\tthe \"quoted\n011\tlast\n")
    topics = readers.read_topics(spark, path).orderBy("seq")
    assert [(r.qid, r["query"]) for r in topics.collect()] == [
        ("10", "what's a-b?"), ("9", 'the "quoted'), ("011", "last"),
    ]
    assert [r["query"] for r in readers.read_topics(spark, path, clean=True).orderBy("seq").collect()] == [
        "whats ab", "the quoted", "last",
    ]


def test_file_order_over_splits(spark, tmp_path):
    path = put(tmp_path, "big.tsv", "".join(f"{i * 7919 % 5000}\tquery number {i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        topics = readers.read_topics(spark, path)
        assert topics.rdd.getNumPartitions() > 1
        got = [r["query"] for r in topics.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"query number {i}" for i in range(5000)]


@pytest.mark.parametrize("sep", ["\t", " "])
def test_qrels_and_runs(spark, tmp_path, sep):
    qrels = readers.read_qrels(spark, put(tmp_path, "q", sep.join(["19", "0", "77", "3"]) + "\n"), sep)
    assert [(r.qid, r.doc_id, r.rating) for r in qrels.collect()] == [("19", "77", 3)]
    trec = readers.read_run_trec(spark, put(tmp_path, "r", sep.join(["108", "Q0", "77", "0", "0.13", "x"]) + "\n"), sep)
    assert [tuple(r) for r in trec.collect()] == [("108", "77", 0, 0.13)]
    plain = readers.read_run_plain(spark, put(tmp_path, "p", sep.join(["108", "77", "0", "0.13"]) + "\n"), sep)
    assert [tuple(r) for r in plain.collect()] == [("108", "77", 0, 0.13)]


def test_malformed_number_fails(spark, tmp_path):
    path = put(tmp_path, "bad", "19 0 77 three\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_qrels(spark, path, " ").collect()


def test_corpus(spark, tmp_path):
    text = "x" * 5000
    path = put(tmp_path, "c.tsv", f"1\thello world\n2\t{text}\n")
    corpus = readers.read_corpus(spark, path, meta_lengths=readers.META_LENGTHS)
    rows = {r.doc_id: r for r in corpus.collect()}
    assert rows["2"].text == text and len(rows["2"].meta_text) == 4096 and rows["1"].meta_text == "hello world"
    bad = put(tmp_path, "bad.tsv", "1\ta\tb\n")
    with pytest.raises(Exception, match="two tab-separated"):
        readers.read_corpus(spark, bad).collect()


def test_jsonl_round_trip(spark, tmp_path):
    corpus = spark.createDataFrame([("1", 'a "b"\nc'), ("2", "é")], "doc_id STRING, text STRING")
    writers.corpus_to_jsonl(corpus, str(tmp_path / "j"))
    assert sorted(map(tuple, readers.read_corpus_jsonl(spark, str(tmp_path / "j")).collect())) == [
        ("1", 'a "b"\nc'), ("2", "é"),
    ]


def test_trec_round_trip(spark, run, tmp_path):
    path = str(tmp_path / "t")
    writers.write_run_trec(run, path)
    assert lines(spark, path) == ["108 Q0 d1 0 0.13 bm25", "108 Q0 d2 1 0.08 bm25", "9 Q0 d9 0 12.0 bm25"]
    assert sorted(map(tuple, readers.read_run_trec(spark, path).collect())) == sorted(
        (q, d, r, round(s, 2)) for q, d, r, s in RUN
    )
    with pytest.raises(Exception, match="(?i)exist"):
        writers.write_run_trec(run, path)


def test_plain_round_trip(spark, run, tmp_path):
    path = str(tmp_path / "p")
    writers.write_run_plain(run, path)
    assert sorted(map(tuple, readers.read_run_plain(spark, path).collect())) == sorted(RUN)


def test_reranked_forms(spark, run, tmp_path):
    one = run.filter("qid = '9'")
    writers.write_run_reranked(one, str(tmp_path / "a.csv"), "M")
    writers.write_run_reranked(one, str(tmp_path / "a.tsv"), "M")
    writers.write_run_reranked(one, str(tmp_path / "b.tsv"), "M", compat=True)
    assert lines(spark, str(tmp_path / "a.csv")) == ["9,Q0,d9,0,12.0,M"]
    assert lines(spark, str(tmp_path / "a.tsv")) == ["9\tQ0\td9\t0\t12.0\tM"]
    assert lines(spark, str(tmp_path / "b.tsv")) == ["9\tQ0\td9\t0 12.0\tM"]
    with pytest.raises(ValueError, match="csv or .tsv"):
        writers.write_run_reranked(one, str(tmp_path / "a.txt"))


def test_notebook_forms(spark, run, tmp_path):
    one = run.filter("qid = '9'")
    writers.write_run_nb(one, str(tmp_path / "n.csv"))
    writers.write_run_nb(one, str(tmp_path / "n.tsv"))
    assert lines(spark, str(tmp_path / "n.csv")) == ["9 d9 0 12.0"]
    assert lines(spark, str(tmp_path / "n.tsv")) == ["9\td9\t0 12.0"]


def test_ltr_keeps_candidate_order(spark, tmp_path):
    rows = [("1", "a", 0, 0, 0.13), ("1", "b", 1, 2, 0.0), ("1", "c", 2, 1, 0.08)]
    learned = spark.createDataFrame(rows, "qid STRING, doc_id STRING, prior_rank INT, rank INT, score DOUBLE")
    writers.write_run_ltr(learned, str(tmp_path / "l"))
    assert lines(spark, str(tmp_path / "l")) == [
        "1 Q0 a 0 0.13 pyterrier", "1 Q0 b 2 0.0 pyterrier", "1 Q0 c 1 0.08 pyterrier",
    ]


def test_long_ranking_spans_files(spark, tmp_path):
    big = spark.range(20_000).select(
        F.lit("1").alias("qid"), F.col("id").alias("doc_id"), F.col("id").cast("int").alias("rank"), F.lit(1.0).alias("score")
    )
    path = tmp_path / "big"
    writers.write_run_plain(big, str(path))
    ranks = [int(line.split(" ")[2]) for f in sorted(path.glob("part-*")) for line in f.read_text().splitlines()]
    assert ranks == list(range(20_000))


BODIES = 'Body ID,articleBody\n1,"line one\nline ""two"", three"\n2,plain\n'
STANCES = 'Headline,Body ID,Stance\n"A, b",1,agree\nC,2,unrelated\nD,2,discuss\n'


@pytest.fixture()
def folder(tmp_path):
    for split in ("train", "competition_test"):
        put(tmp_path, f"{split}_bodies.csv", BODIES)
        put(tmp_path, f"{split}_stances.csv", STANCES)
    put(tmp_path, "test_bodies.csv", BODIES)
    put(tmp_path, "test_stances_unlabeled.csv", "Headline,Body ID\nX,1\n")
    return str(tmp_path)


@pytest.mark.parametrize("split", ["train", "competition"])
def test_stances(spark, folder, split):
    bodies, stances = readers.read_stances(spark, folder + "/", split)
    assert {r.body_id: r.article_body for r in bodies.collect()} == {1: 'line one\nline "two", three', 2: "plain"}
    assert [(r.headline, r.body_id, r.stance, r.label) for r in stances.orderBy("seq").collect()] == [
        ("A, b", 1, "agree", 1), ("C", 2, "unrelated", 4), ("D", 2, "discuss", 3),
    ]


def test_stances_compat_and_unlabelled(spark, folder):
    bodies, stances = readers.read_stances(spark, folder, compat_skip_first=True)
    assert bodies.count() == 1 and [r.headline for r in stances.orderBy("seq").collect()] == ["C", "D"]
    bodies, pairs = readers.read_stances_unlabelled(spark, folder)
    assert [(r.headline, r.body_id) for r in pairs.collect()] == [("X", 1)] and bodies.count() == 2
    with pytest.raises(ValueError):
        readers.read_stances(spark, folder, "test")


def test_empty_and_unknown_stances(spark, tmp_path):
    put(tmp_path, "train_bodies.csv", BODIES)
    put(tmp_path, "train_stances.csv", "Headline,Body ID,Stance\n")
    with pytest.raises(ValueError, match="no stances"):
        readers.read_stances(spark, str(tmp_path))
    put(tmp_path, "train_stances.csv", "Headline,Body ID,Stance\nA,1,maybe\n")
    with pytest.raises(Exception, match="Stance does not exist: maybe"):
        readers.read_stances(spark, str(tmp_path))[1].collect()


def test_quoted_records_at_any_split_size(spark, tmp_path):
    import csv
    import random

    draw = random.Random(5)
    bits = ['"', "\n", "\r\n", ",", "word", "é", " ", "x" * 30, "\n\n"]
    rows = [(i, "".join(draw.choice(bits) for _ in range(draw.randint(0, 12)))) for i in range(300)]
    rows[7] = (7, "long\n" * 500)  # fills several splits
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\r\n" if name == "a" else "\n")
            writer.writerow(("Body ID", "articleBody"))
            writer.writerows(rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "64", "500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for name in ("a", "b"):
                found = readers.read_quoted(spark, str(tmp_path / f"{name}.csv"), readers.schemas.BODIES)
                got = {r["body_id"]: r["article_body"] or "" for r in found.collect()}
                assert got == dict(rows), (size, name)
                assert [r["body_id"] for r in found.orderBy("seq").collect()] == [i for i, _ in rows]
                if size == "500":
                    assert found.select("seq.block").distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_malformed_quoted_records_fail(spark, tmp_path):
    put(tmp_path, "bad.csv", "Body ID,articleBody\nnot a number,x\n")
    with pytest.raises(Exception):
        readers.read_quoted(spark, str(tmp_path / "bad.csv"), readers.schemas.BODIES).collect()
