import math
from collections import Counter

import duckdb
import pytest

from passagerank.llm import term_pipeline as tp
from passagerank.llm.oracle import SQL
from passagerank.llm.queries import QUERIES


def terms(text):
    out, held = [], ""
    for c in text or "":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c.isascii() and not c.isalnum():
            out.append(held)
            held = ""
        else:
            held += c
    return [t for t in [*out, held] if t]


def brute(docs, items, k):
    """``docs`` and ``items``: rows of id and text."""
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(found)[:k])]
    return out


def rows_of(df):
    return [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()]


def order(row):
    return (row[0] is not None, row[0], row[1])


def test_query_equals_brute_force_and_sql(spark, sf_dir, documents):
    found = sorted(rows_of(QUERIES["op12_ranked_search"](spark, sf_dir)))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert found == sorted(brute(list(documents.items()), items, 20))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert found == sorted(con.execute(SQL["op12_ranked_search"]).fetchall())


@pytest.mark.parametrize(("k", "shard", "bundle", "owners"), [(20, 37, 5, (0.01, 0.1, 0.3)), (3, 8192, 256, (0.05,)), (1, 50, 1, ()), (500, 60, 7, (0.02, 0.5))])
def test_any_shards_bundles_and_owners_agree(spark, sf_dir, documents, monkeypatch, k, shard, bundle, owners):
    monkeypatch.setattr(tp, "SHARD_DOCS", shard)
    monkeypatch.setattr(tp, "BUNDLE", bundle)
    monkeypatch.setattr(tp, "OWNERS", owners)
    monkeypatch.setattr(tp, "PACK_CHARS", 2000)
    docs = list(documents.items())[:150]
    items = [(i, docs[i * 7][1][:200]) for i in range(20)]
    found = tp.rank(
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(3),
        spark.createDataFrame(items, "item_id BIGINT, text STRING"), k,
    )
    assert sorted(rows_of(found)) == sorted(brute(docs, items, k))


def test_accumulators_stop_but_results_stay(spark, documents, monkeypatch):
    """With few hits asked for, later owners get less than all matching documents."""
    sizes = []
    before = tp.reached_by

    def watch(carried, items, k):
        sizes.append(carried.selectExpr("sum(length(doc)) / 4").first()[0])
        return before(carried, items, k)

    monkeypatch.setattr(tp, "reached_by", watch)
    docs = list(documents.items())
    items = [(i, docs[i * 9][1][:300]) for i in range(10) if docs[i * 9][1]]
    given = spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame(items, "item_id BIGINT, text STRING")
    assert sorted(rows_of(tp.rank(*given, k=1))) == sorted(brute(docs, items, 1))
    matching = sum(1 for _, t in items for _, d in docs if set(terms(t)) & set(terms(d)))
    assert sizes[-1] < matching / 2


def test_odd_tables(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    items = [(1, docs[0][1]), (2, None), (3, ""), (4, "nothing known"), (5, "lorem é mail"), (None, "sum river"), (6, "The THE the")]
    schema = "item_id BIGINT, text STRING, doc_id STRING, rank STRING, score STRING"
    asked = spark.createDataFrame([(*i, "x", "x", "x") for i in items], schema)
    found = rows_of(tp.rank(odd_docs, asked, 5))
    assert sorted(found, key=order) == sorted(brute(docs, items, 5), key=order)
    empty = spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert tp.rank(odd_docs, empty).count() == tp.rank(no_docs, asked).count() == tp.rank(no_docs, empty).count() == 0
    assert tp.rank(no_docs, asked).columns == ["item_id", "rank", "doc_id", "score"]
