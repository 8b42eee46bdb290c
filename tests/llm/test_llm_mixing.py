import re

import pytest

from passagerank.llm import mixing
from passagerank.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_rounds(sizes):
    """Targets by resharing the excess until none is above its limit."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        weights = sum(weight[s] for s in order if s not in full)
        above = {s for s in order if s not in full and left * weight[s] / weights > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in full else left * weight[s] / weights for s in order}
        full |= above


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 50, "d": 7, None: 30}, {"é": 5, "z": 5, "Z": 500}, {"only": 10},
    {"a": 0, "b": 10}, {"a": 0},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source STRING, size BIGINT, n BIGINT")
    found = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    wanted = by_rounds(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert found == pytest.approx(wanted)


def test_query(spark, documents, sf_dir):
    rows = QUERIES["op10_mixing"](spark, sf_dir).collect()
    again = QUERIES["op10_mixing"](spark, sf_dir).collect()
    key = lambda r: r["doc_id"]
    assert sorted(rows, key=key) == sorted(again, key=key) and len(rows) == len(documents)
    sources = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["size"] == len(WORD.findall(documents[r["doc_id"]]))
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[s], taken[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    targets = by_rounds(sizes)
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6


def test_many_documents_meet_their_target_through_the_tree(spark):
    rows = [(i, "w " * (1 + i % 17), "a" if i % 3 else "b") for i in range(9000)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"), block=8)
    got = found.groupBy("source").agg({"copies": "count", "target": "max"}).collect()
    taken = {r["source"]: 0 for r in got}
    targets = {r["source"]: r["max(target)"] for r in got}
    for r in mixing.taken(found).join(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"), "doc_id").collect():
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 9 for s in taken)


def test_copies_keep_their_share(spark):
    """Each document is taken with about its source's rate, whatever its size."""
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    totals, rate = {}, {}
    for seed in range(6):
        for r in mixing.mix(docs, seed=seed).collect():
            group = (r["source"], r["size"])
            totals.setdefault(group, []).append(r["copies"])
            rate[r["source"]] = r["target"] / r["source_size"]
    for (source, _), copies in totals.items():
        assert abs(sum(copies) / len(copies) - rate[source]) < 0.15


def test_odd_tables(odd_docs, no_docs):
    mixed = mixing.mix(odd_docs)
    rows = mixing.taken(mixed).collect()
    assert len(rows) == odd_docs.count()
    assert len({r["taken"] for r in rows if r["doc_id"] == 6}) == 1
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (2, 3, 8))
    copies = mixing.copied(odd_docs, mixed)
    assert copies.columns == odd_docs.columns
    words = sum(len(WORD.findall(r["text"] or "")) for r in copies.collect())
    assert words == sum(r["taken"] for r in rows)
    assert mixing.taken(mixing.mix(no_docs)).count() == 0
