import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from passagerank.operators import boosting, forest, ltr, trees
from passagerank.operators import features as ft
from passagerank.operators.evaluate import judge, summary
from passagerank.operators.rerank import coverage, rerank


def brute_gradients(rows):
    out = {}
    for q in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[3], r[1]))
        best = sum((2**l - 1) / math.log2(2 + i) for i, l in enumerate(sorted((r[2] for r in mine), reverse=True)))
        grad, hess = dict.fromkeys((r[1] for r in mine), 0.0), dict.fromkeys((r[1] for r in mine), 0.0)
        for i, a in enumerate(mine):
            for j, b in enumerate(mine):
                if a[2] > b[2]:
                    rho = 1 / (1 + math.exp(a[3] - b[3]))
                    swap = abs(2 ** a[2] - 2 ** b[2]) * abs(1 / math.log2(2 + i) - 1 / math.log2(2 + j)) / best
                    grad[a[1]] += rho * swap
                    grad[b[1]] -= rho * swap
                    hess[a[1]] += rho * (1 - rho) * swap
                    hess[b[1]] += rho * (1 - rho) * swap
        out.update({(q, d): (grad[d], hess[d]) for d in grad})
    return out


@pytest.mark.parametrize(("block", "group_rows"), [(1024, 1_000_000), (7, 1_000_000), (5, 10)])
def test_gradients_in_any_blocks(spark, block, group_rows):
    rng = random.Random(5)
    rows = [(q, d, rng.randrange(4) if q else 0, float(rng.randrange(6))) for q in range(4) for d in range(30)]
    rows += [(1, 100 + d, rng.randrange(3), rng.random()) for d in range(60)]
    df = spark.createDataFrame(rows, "qid INT, doc_id INT, label INT, score DOUBLE")
    got = {
        (r.qid, r.doc_id): (r.grad, r.hess)
        for r in ltr.lambda_gradients(df, block_rows=block, group_rows=group_rows).collect()
    }
    want = brute_gradients(rows)
    assert got.keys() == want.keys()
    for key, (g, h) in want.items():
        assert got[key] == (pytest.approx(g, abs=1e-9), pytest.approx(h, abs=1e-9))
    assert sum(g for g, _ in got.values()) == pytest.approx(0, abs=1e-9)


@pytest.fixture(scope="module")
def rows(spark):
    """Labels depend on f_b, candidates come in the order of f_a."""
    rng = random.Random(9)
    data = []
    for q in range(30):
        docs = sorted(((rng.random(), rng.random()) for _ in range(20)), reverse=True)
        for d, (a, b) in enumerate(docs):
            data.append((q, q * 100 + d, d, a, a, b, int(b > 0.5) + int(b > 0.8)))
    schema = "qid INT, doc_id INT, rank INT, score DOUBLE, f_a DOUBLE, f_b DOUBLE, label INT"
    return spark.createDataFrame(data, schema).cache()


def ndcg(run, rows):
    qrels = rows.select("qid", "doc_id", F.col("label").alias("rating"))
    return summary(judge(run, qrels, depth=100), ("ndcg",)).first()["ndcg_10"]


def test_lambdamart_learns_saves_and_loads(spark, rows, tmp_path):
    model = ltr.train_lambdamart(rows, rows, ["f_a", "f_b"], rounds=3, min_rows_in_leaf=5, depth=20)
    before, after = ndcg(rows, rows), ndcg(rerank(rows, model, depth=20), rows)
    assert after > before + 0.2
    assert len(model.history) == 3 and model.history[-1]["ndcg_10"] == pytest.approx(after)
    importance = model.feature_importance()
    assert importance["f_b"] > importance["f_a"]
    ltr.save_model(model, spark, str(tmp_path / "m"))
    again = ltr.load_model(spark, str(tmp_path / "m"))
    same = rerank(rows, again, depth=20).select("qid", "doc_id", "rank", "score")
    assert sorted(map(tuple, same.collect())) == sorted(
        map(tuple, rerank(rows, model, depth=20).select("qid", "doc_id", "rank", "score").collect())
    )


def test_random_forest(spark, rows, tmp_path):
    model = ltr.train_random_forest(rows, ["f_a", "f_b"], n_trees=5, max_depth=5)
    assert ndcg(rerank(rows, model, depth=20), rows) > ndcg(rows, rows) + 0.2
    assert sum(model.feature_importance().values()) == pytest.approx(1)
    path = str(tmp_path / ltr.model_name("RANDOMFOREST", 30, 30))
    ltr.save_model(model, spark, path)
    assert ltr.load_model(spark, path).kind == "randomforest" and path.endswith("RandomForest_model_30_30_00")


def test_ties_keep_candidate_order(rows):
    flat = rerank(rows, F.lit(0.0))
    assert flat.filter("rank <> prior_rank").count() == 0
    assert {r["rank"] for r in flat.filter("qid = 3").collect()} == set(range(20))


def test_rerank_with_a_pandas_scorer(spark, rows):
    @F.pandas_udf("double")
    def scorer(a: pd.Series, b: pd.Series) -> pd.Series:
        return b - a

    ranked = rerank(rows, lambda df: scorer(df.f_a, df.f_b), group_rows=5)
    for q in (0, 7):
        got = [r.score for r in ranked.filter(F.col("qid") == q).orderBy("rank").collect()]
        assert got == sorted(got, reverse=True)


def test_coverage(spark):
    df = spark.createDataFrame([("red cars red", "A car is red"), ("the", "x"), ("a b", "b")], "query STRING, text STRING")
    assert [r[0] for r in df.select(coverage()).collect()] == [1.0, 0.0, 1.0]


def test_head_and_filter(spark):
    topics = spark.createDataFrame([("c", 2), ("a", 1), ("b", 3)], "qid STRING, seq INT")
    assert [r.qid for r in ft.head_topics(topics, 2).collect()] == ["a", "c"]
    assert ft.head_topics(topics, 0).count() == 3
    qrels = spark.createDataFrame([("a", 1, 1), ("z", 2, 1)], "qid STRING, doc_id INT, rating INT")
    assert [r.qid for r in ft.filter_qrels(qrels, topics).collect()] == ["a"]


def test_features(spark, index, topics):
    rows = ft.features(topics, index, tuple(ft.wm.FEATURES), k=2)
    got = {(r.qid, r.doc_id): r for r in rows.collect()}
    assert max(r["rank"] for r in got.values()) == 1
    r = got[(2, 7)]
    n, total = 7, index.collection.total_terms
    avg, tf, qtf, dl, df, cf = total / n, 4, 2, 4, 3, 7
    k = 1.2 * (0.25 + 0.75 * dl / avg) + tf
    assert r.f_sample == pytest.approx(tf * 9 * qtf / ((8 + qtf) * k) * math.log2((n - df + 0.5) / (df + 0.5)), abs=1e-8)
    assert r.f_bm25 == r.f_sample == r.score and r.f_tf == 4
    assert r.f_tf_idf == pytest.approx(qtf * 1.2 * tf / k * math.log2(n / df + 1), abs=1e-8)
    assert r.f_hiemstra_lm == pytest.approx(math.log2(1 + 0.15 * tf * total / (0.85 * cf * dl)), abs=1e-8)
    assert r.f_dlh13 == pytest.approx(qtf * tf * math.log2(tf * avg / dl * n / cf) / (tf + 0.5), abs=1e-8)
    tfn, mean = tf * math.log2(1 + avg / dl), cf / n
    assert r.f_pl2 == pytest.approx(
        qtf / (tfn + 1) * (tfn * math.log2(tfn / mean) + (mean - tfn) * math.log2(math.e) + 0.5 * math.log2(2 * math.pi * tfn)),
        abs=1e-8,
    )


def test_labels(spark, index, topics):
    qrels = spark.createDataFrame([(1, 3, 2)], "qid BIGINT, doc_id BIGINT, rating INT")
    got = {(r.qid, r.doc_id): r.label for r in ft.attach_labels(ft.features(topics, index), qrels).collect()}
    assert got[(1, 3)] == 2 and set(got.values()) == {0, 2}


# trees


def best_tree(rows, target, weight):
    """Brute force: the tree of least squares as nested (feature, threshold, left, right) or a value."""
    total = sum(weight)
    mean = sum(w * y for w, y in zip(weight, target, strict=True)) / total
    if len(set(target)) == 1:
        return mean
    best = None
    for f in range(len(rows[0])):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values[:-1], values[1:], strict=True):
            left = [i for i, r in enumerate(rows) if r[f] <= a]
            right = [i for i, r in enumerate(rows) if r[f] > a]
            gain = -(sum(w * y for w, y in zip(weight, target, strict=True)) ** 2) / total
            for side in (left, right):
                gain += sum(weight[i] * target[i] for i in side) ** 2 / sum(weight[i] for i in side)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-8):
                best = (gain, f, a + (b - a) / 2, left, right)
    if best is None:
        return mean
    _, f, t, left, right = best
    return f, t, *(best_tree(*([c[i] for i in side] for c in (rows, target, weight))) for side in (left, right))


def nested(nodes, i=0):
    r = nodes.iloc[i]
    return r["value"] if r["feature"] < 0 else (int(r["feature"]), r["threshold"], nested(nodes, int(r["left"])), nested(nodes, int(r["right"])))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return a == pytest.approx(b)
    return a[0] == b[0] and a[1] == pytest.approx(b[1]) and same(a[2], b[2]) and same(a[3], b[3])


def test_exact_tree_equals_brute_force():
    draw = random.Random(3)
    for n in (1, 2, 7, 40):
        for _ in range(8):
            rows = [[float(draw.randrange(6)), draw.random(), float(draw.randrange(2))] for _ in range(n)]
            target = [float(draw.randrange(4)) for _ in range(n)]
            weight = [draw.randrange(4) for _ in range(n)]
            weight[0] = 1
            some = [i for i in range(n) if weight[i]]
            found = forest.grow_exact(np.array(rows), np.array(target), np.array(weight))
            assert same(nested(found), best_tree(*([c[i] for i in some] for c in (rows, target, weight))))


def learning_rows(spark, n=400, seed=2):
    draw = random.Random(seed)
    data = [(q, q * 1000 + d, float(draw.randrange(5)), draw.random(), draw.randrange(4)) for q in range(4) for d in range(n // 4)]
    return data, spark.createDataFrame(data, "qid INT, doc_id INT, f_a DOUBLE, f_b DOUBLE, label INT")


def test_forest_without_draws_is_the_exact_tree(spark):
    data, df = learning_rows(spark, 120)
    model = ltr.train_random_forest(df, ["f_a", "f_b"], n_trees=2, bootstrap=False)
    wanted = best_tree([list(r[2:4]) for r in data], [float(r[4]) for r in data], [1] * len(data))
    low, high = model.trees[1]
    assert same(nested(model.nodes.iloc[low:high]), wanted)
    scored = {r["doc_id"]: r["model_score"] for r in model.transform(df).collect()}
    assert all(scored[r[1]] == pytest.approx(r[4]) for r in data)


def test_large_nodes_by_histograms(spark):
    """Few values: bins are exact, so that both ways give the same trees."""
    draw = random.Random(8)
    data = [(q, q * 100 + d, float(draw.randrange(12)), float(draw.randrange(9)), draw.randrange(4)) for q in range(5) for d in range(100)]
    df = spark.createDataFrame(data, "qid INT, doc_id INT, f_a DOUBLE, f_b DOUBLE, label INT").repartition(3)
    for options in ({}, {"bootstrap": False}, {"max_depth": 2}, {"min_rows_in_leaf": 9}):
        whole = ltr.train_random_forest(df, ["f_a", "f_b"], n_trees=3, **options).transform(df).collect()
        parts = ltr.train_random_forest(df, ["f_a", "f_b"], n_trees=3, task_rows=60, **options).transform(df).collect()
        scores = [{r["doc_id"]: r["model_score"] for r in rows} for rows in (whole, parts)]
        assert scores[0] == pytest.approx(scores[1])


def test_a_large_node_of_one_value_is_a_leaf(spark):
    rows = [(0, d, 1.0, 3) for d in range(200)] + [(1, 500 + d, 2.0, d % 2) for d in range(20)]
    df = spark.createDataFrame(rows, "qid INT, doc_id INT, f_a DOUBLE, label INT")
    model = ltr.train_random_forest(df, ["f_a"], n_trees=2, bootstrap=False, task_rows=50)
    assert model.nodes["value"].tolist()[1:3] == [3.0, 0.5] and len(model.nodes) == 6


def test_draws_are_those_of_a_poisson_law():
    found = forest.draws(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 200_000), 3, 42)
    assert abs(found.mean() - 1) < 0.02 and abs(found.var() - 1) < 0.02 and abs((found == 0).mean() - np.exp(-1)) < 0.01


def test_query_gradients_equal_all_pairs():
    draw = random.Random(6)
    rows = [(0, d, draw.randrange(4), float(draw.randrange(5))) for d in range(60)]
    grad, hess = boosting.query_gradients(
        np.array([r[2] for r in rows], float), np.array([r[3] for r in rows]), boosting._best_dcg(np.array([r[2] for r in rows], float), ())[0]
    )
    want = brute_gradients(rows)
    assert [(g, h) for g, h in zip(grad, hess, strict=True)] == [pytest.approx(want[0, d], abs=1e-9) for d in range(60)]


def naive_boosting(data, rounds, leaves, rate, least):
    """Leaf by leaf over all thresholds, in plain Python."""
    rows = sorted(data)
    score = [0.0] * len(rows)
    for _ in range(rounds):
        pulls = brute_gradients([(r[0], r[1], r[4], s) for r, s in zip(rows, score, strict=True)])
        g, h = zip(*(pulls[r[0], r[1]] for r in rows), strict=True)
        h = [b + boosting.RIDGE if a or b else 0.0 for a, b in zip(g, h, strict=True)]
        value = lambda side: sum(g[i] for i in side) ** 2 / sum(h[i] for i in side) if sum(h[i] for i in side) > 0 else 0.0  # noqa: B023, E731
        parts = [list(range(len(rows)))]
        while len(parts) < leaves:
            best = None
            for p, part in enumerate(parts):
                for f in (2, 3):
                    for t in sorted({rows[i][f] for i in part})[:-1]:
                        left, right = [i for i in part if rows[i][f] <= t], [i for i in part if rows[i][f] > t]
                        if min(len(left), len(right)) < least or any(sum(h[i] for i in s) < 1e-3 for s in (left, right)):
                            continue
                        gain = value(left) + value(right) - value(part)
                        if gain > 0 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, p, left, right)
            if best is None:
                break
            parts[best[1] : best[1] + 1] = best[2:]
        for part in parts:
            total = sum(h[i] for i in part)
            for i in part:
                score[i] += rate * (sum(g[j] for j in part) / total if total > 0 else 0.0)
    return {r[1]: s for r, s in zip(rows, score, strict=True)}


@pytest.mark.parametrize("query_rows", [1 << 18, 30])
def test_boosting_equals_plain_python(spark, monkeypatch, query_rows):
    monkeypatch.setattr(boosting, "QUERY_ROWS", query_rows)
    monkeypatch.setattr(boosting, "CUT_ROUNDS", 2)
    data, df = learning_rows(spark, 160)
    model = ltr.train_lambdamart(df.repartition(3), None, ["f_a", "f_b"], rounds=3, min_rows_in_leaf=4)
    wanted = naive_boosting(data, 3, 7, 0.1, 4)
    assert {r["doc_id"]: r["model_score"] for r in model.transform(df).collect()} == pytest.approx(wanted, abs=1e-6)


def test_early_stopping_keeps_the_best_round(spark, rows):
    model = ltr.train_lambdamart(rows, rows.withColumn("label", (F.col("f_a") > 0.7).cast("int")), ["f_a", "f_b"], rounds=40, min_rows_in_leaf=5, early_stopping=3)
    last = [h["ndcg_10"] for h in model.history]
    assert len(last) < 40 and len(model.trees) == last.index(max(last)) + 1 == len(last) - 3


def test_both_ways_of_scoring_agree(spark, monkeypatch):
    data, df = learning_rows(spark)
    odd = spark.createDataFrame([(9, 1, None, 0.5, 0), (9, 2, float("nan"), None, 0)], df.schema)
    model = ltr.train_random_forest(df, ["f_a", "f_b"], n_trees=4, max_depth=4)
    given = df.union(odd)
    folded = {(r["qid"], r["doc_id"]): r["model_score"] for r in model.transform(given).collect()}
    monkeypatch.setattr(trees, "FOLD_NODES", 0)
    monkeypatch.setattr(trees, "SHIPPED_NODES", 20)
    assert len(list(model._shipments())) > 1
    assert {(r["qid"], r["doc_id"]): r["model_score"] for r in model.transform(given).collect()} == pytest.approx(folded)


def test_many_tasks_exchange_their_histograms(spark, monkeypatch):
    data, df = learning_rows(spark, 160)
    once = ltr.train_lambdamart(df, None, ["f_a", "f_b"], rounds=2, min_rows_in_leaf=4)
    monkeypatch.setattr(boosting, "DIRECT", 0)
    monkeypatch.setattr(boosting, "TASK_ROWS", 40)
    again = ltr.train_lambdamart(df.repartition(5), None, ["f_a", "f_b"], rounds=2, min_rows_in_leaf=4)
    assert again.nodes.equals(once.nodes)


def test_leaves_of_a_given_tree(spark):
    data, df = learning_rows(spark, 80)
    model = ltr.fit_leaves(df, ["f_a", "f_b"], [(0, "f_a", 1.0, 1, 2), (2, "f_b", 0.5, 3, 4)])
    pulls = brute_gradients([(r[0], r[1], r[4], 0.0) for r in data])
    leaf = {r[1]: 1 if r[2] <= 1 else 3 if r[3] <= 0.5 else 4 for r in data}
    for r in model.transform(df).collect():
        mine = [pulls[q, d] for q, d, *_ in data if leaf[d] == leaf[r["doc_id"]]]
        assert r["model_score"] == pytest.approx(0.1 * sum(g for g, _ in mine) / sum(h + boosting.RIDGE for _, h in mine), abs=1e-6)
