import pytest
from pyspark.sql import functions as F

from passagerank.operators import stance as st


@pytest.fixture(scope="module")
def rows(spark):
    names = list(st.LABELS)
    data = [(i, f"h{i}", i % 5, names[i % 4]) for i in range(23)]
    df = spark.createDataFrame(data, "row_id INT, headline STRING, body_id INT, stance STRING")
    return df.withColumn("label", st.stance_to_label(F.col("stance"))).cache()


def test_labels(rows, spark):
    assert {r.stance: r.label for r in rows.collect()} == st.LABELS
    for bad in ("maybe", None):
        df = spark.createDataFrame([(bad,)], "stance STRING")
        with pytest.raises(Exception, match="Stance does not exist"):
            df.select(st.stance_to_label(F.col("stance"))).collect()


@pytest.mark.parametrize(("actual", "predicted", "score"), [(1, 1, 1.0), (4, 4, 0.25), (1, 2, 0.25), (1, 4, 0.0), (4, 1, 0.0)])
def test_score(spark, actual, predicted, score):
    df = spark.createDataFrame([(actual, predicted)], "a INT, p INT")
    assert df.select(st.fnc_score(F.col("a"), F.col("p"))).first()[0] == score


@pytest.mark.parametrize("bad", [0, 5, None])
def test_label_out_of_range_fails(spark, bad):
    df = spark.createDataFrame([(1, bad)], "a INT, p INT")
    with pytest.raises(Exception, match="label not in 1..4"):
        df.select(st.fnc_score(F.col("a"), F.col("p"))).collect()


def test_pair_bodies_takes_the_first(spark, rows):
    bodies = spark.createDataFrame([(0, "second", 2), (0, "first", 1), (1, "b", 3)], "body_id INT, article_body STRING, seq INT")
    got = {r.row_id: r.article_body for r in st.pair_bodies(rows, bodies).collect()}
    assert got[0] == got[5] == "first" and got[1] == "b" and 2 not in got


def test_folds(rows):
    from math import ceil

    whole = {r.row_id: r.fold for r in st.kfold(rows, 10, 1).collect()}
    sizes = [list(whole.values()).count(i) for i in range(10)]
    assert sizes == [ceil((i + 1) / 10 * 23) - ceil(i / 10 * 23) for i in range(10)] and sum(sizes) == 23
    assert {r.row_id: r.fold for r in st.kfold(rows, 10, 1, cut_keys=1).collect()} == whole
    assert {r.row_id: r.fold for r in st.kfold(rows, 10, 2).collect()} != whole
    kept = {r.row_id: r.fold for r in st.kfold(rows, 10, 1, compat=True).collect()}
    assert kept == {k: v for k, v in whole.items() if v < 9}


def test_evaluate(rows, spark):
    perfect = rows.select("row_id", F.col("label").alias("predicted"))
    want = sum(0.25 if r.label == 4 else 1.0 for r in rows.collect())
    assert tuple(st.evaluate_fold(rows, perfect).first()) == (23, want)
    assert tuple(st.evaluate_comp(rows, perfect).first()) == (23, want)
    named = rows.select("row_id", F.col("stance").alias("predicted"))
    assert tuple(st.evaluate_comp(rows, named).first()) == (23, want)
    with pytest.raises(TypeError, match="Bad labels format"):
        st.evaluate_comp(rows, perfect.withColumn("predicted", F.lit(1.5)))
    folds = st.evaluate_fold(st.kfold(rows, 4, 1), perfect, by=("fold",)).collect()
    assert sum(r.score for r in folds) == want and len(folds) == 4


def test_missing_partner_fails(rows):
    perfect = rows.select("row_id", F.col("label").alias("predicted"))
    for a, b in ((rows, perfect.filter("row_id < 22")), (rows.filter("row_id < 22"), perfect)):
        with pytest.raises(Exception, match="rows without a partner"):
            st.evaluate_fold(a, b).collect()


def test_random_baseline(rows, spark):
    many = spark.range(4000).select(F.col("id").alias("row_id"))
    counts = {r.predicted: r["count"] for r in st.random_baseline(many, 1).groupBy("predicted").count().collect()}
    assert set(counts) == {1, 2, 3, 4} and min(counts.values()) > 850
    again = st.random_baseline(many, 1).exceptAll(st.random_baseline(many, 1))
    assert again.count() == 0


def test_folds_do_not_move_rows(spark, rows):
    from math import ceil

    plan = st.kfold(rows.select("row_id", "headline"), 10, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    few = spark.createDataFrame([(i,) for i in range(3)], "row_id INT")
    assert sorted(r.fold for r in st.kfold(few, 10, 1).collect()) == sorted(i * 10 // 3 for i in range(3))
    assert st.kfold(few.limit(0), 4).count() == 0
    many = spark.range(5000).withColumnRenamed("id", "row_id")
    sizes = {r["fold"]: r["count"] for r in st.kfold(many, 7, 3, cut_keys=3).groupBy("fold").count().collect()}
    assert sizes == {i: ceil((i + 1) * 5000 / 7) - ceil(i * 5000 / 7) for i in range(7)}


def test_order_statistics(spark):
    rows = [(f"{(i * 7919) % 500:032x}", i % 3) for i in range(2000)]
    found = st.order_statistics(spark.createDataFrame(rows, "key STRING, id INT"), [0, 17, 1000, 1999], 2)
    wanted = sorted(rows)
    assert {at: key[0] for at, key in found.items()} == {at: wanted[at][0] for at in (0, 17, 1000, 1999)}
