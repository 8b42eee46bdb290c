from passagerank.testbed import Testbed


def test_judgements_pair_neighbouring_words(spark, tmp_path):
    """Word pairs come from two slices side by side, not from a look-up beside every word."""
    topics = [(1, "One two, three!"), (2, "lone"), (3, ""), (4, None)]
    docs = [(10, "one two three"), (10, "two three four"), (11, "TWO\nthree one"), (12, "lone"), (13, None), (14, ""), (None, "one two")]
    spark.createDataFrame(topics, "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    made = Testbed(spark, str(tmp_path))._make_qrels()
    assert sorted(map(tuple, made.collect()), key=str) == [(1, 10, 3), (1, 11, 2), (1, None, 2)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" in plan and "concat_ws" not in plan
