import random

import pytest
from pyspark.sql import functions as F

from passagerank.operators.ranking import row_numbers, running_in_group
from passagerank.operators.sizing import hot_keys, measure, skew_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, many equal scores."""
    rng = random.Random(7)
    rows = [(0 if i % 3 == 0 else rng.randrange(1, 40), i, float(rng.randrange(5)), rng.randrange(3)) for i in range(3000)]
    return spark.createDataFrame(rows, "k INT, id INT, score DOUBLE, v INT").cache()


@pytest.mark.parametrize("keys", [["k"], []])
def test_range_path_equals_window(skewed, keys):
    order = [F.col("score").desc(), F.col("id").desc()]
    sums = {"n": F.lit(1), "total": F.col("v")}
    window = running_in_group(skewed, keys, order, sums, bounded=True)
    ranges = running_in_group(skewed, keys, order, sums, group_rows=50)
    assert sorted(map(tuple, window.collect())) == sorted(map(tuple, ranges.collect()))


def test_small_groups_use_one_window(skewed):
    out = row_numbers(skewed, ["k"], [F.col("id")], "n", group_rows=10_000)
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, skewed, how):
    right = spark.createDataFrame([(k, f"r{k}-{c}") for k in range(0, 30) for c in range(2)], "k INT, r STRING")
    plain = skewed.join(right, ["k"], how)
    salted = skew_join(skewed, right, ["k"], how, hot_rows=100)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.select(*plain.columns).collect()))


def test_null_keys_survive_a_salted_left_join(spark):
    left = spark.createDataFrame([(None, i) for i in range(5)] + [(1, i) for i in range(50)], "k INT, id INT")
    right = spark.createDataFrame([(1, "x")], "k INT, r STRING")
    out = skew_join(left, right, ["k"], "left", hot_rows=10)
    assert out.count() == 55 and out.filter("r IS NULL").count() == 5


def test_hot_keys(skewed):
    assert [r["k"] for r in hot_keys(skewed, ["k"], 500).collect()] == [0]
    assert hot_keys(skewed, ["k"], 5000).count() == 0


def test_many_hot_keys_and_few_partitions(spark):
    left = spark.range(12_000).select((F.col("id") % 3000).alias("k"), "id")
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    assert hot_keys(left, ["k"], 3).count() == 3000
    joined = skew_join(left, right, ["k"], hot_rows=1)
    assert joined.count() == 12_000 and joined.filter("twice <> 2 * k").count() == 0
    one = spark.range(5000).select(F.lit(0).alias("k"), "id")
    assert [r["__salts"] for r in hot_keys(one, ["k"], 10).collect()] == [500]


def test_measure(spark):
    size = measure(spark.range(1_200_000))
    assert not size.small and size.rows == 1_200_000
    plan = spark.range(10).agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan
    assert measure(spark.range(10)).small
    wide = spark.range(80).select(F.repeat(F.lit("x"), 1 << 20).alias("s"))
    assert not measure(wide).small
