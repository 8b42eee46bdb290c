import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagerank.llm import shards
from passagerank.llm.queries import QUERIES


def best_by_all_cuts(sizes, n):
    prefix = [0, *itertools.accumulate(sizes)]
    best = prefix[-1]
    for cuts in itertools.combinations_with_replacement(range(len(sizes) + 1), n - 1):
        ends = [0, *cuts, len(sizes)]
        best = min(best, max(prefix[b] - prefix[a] for a, b in itertools.pairwise(ends)))
    return best


def test_capacity_and_cuts_against_all_cuts():
    draw = random.Random(1)
    for _ in range(150):
        sizes = np.array([draw.choice((1, 2, 3, 9, 40)) for _ in range(draw.randint(1, 8))])
        n = draw.randint(1, 4)
        best = best_by_all_cuts(sizes.tolist(), n)
        assert shards.smallest_capacity(sizes, n) == best
        starts = shards.cut_points(sizes, n)
        assert len(starts) == n + 1 and starts[0] == 0 and starts[-1] == len(sizes) and sorted(starts) == starts
        assert max(sizes[a:b].sum() for a, b in itertools.pairwise(starts)) == best


def test_few_ranges_need_to_be_divided():
    draw = random.Random(5)
    for _ in range(200):
        sizes = np.array([draw.choice((1, 2, 3, 9, 40, 200)) for _ in range(draw.randint(1, 60))])
        n, width = draw.randint(1, 6), draw.randint(2, 9)
        ranges = [list(range(a, min(a + width, len(sizes)))) for a in range(0, len(sizes), width)]
        while True:
            totals = np.array([sizes[r].sum() for r in ranges])
            open_ = shards.undecided(totals, np.array([len(r) == 1 for r in ranges]), n).tolist()
            if not open_:
                break
            ranges = [part for i, r in enumerate(ranges) for part in ([r[: len(r) // 2], r[len(r) // 2 :]] if i in open_ else [r])]
        assert shards.smallest_capacity(totals, n) == shards.smallest_capacity(sizes, n)


def loads_of(rows, n):
    out = [0] * n
    for r in rows:
        out[r["shard"]] += r["size"]
    return out


@pytest.mark.parametrize(("bits", "n"), [(16, 24), (4, 24), (1, 7), (3, 2)])
def test_query_has_the_smallest_capacity_of_all_groups(spark, sf_dir, documents, bits, n):
    """Against the groups of all texts in the order of their hash, more of them than ranges."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = docs.groupBy(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).agg(
        F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 8).alias("b")
    ).collect()
    sizes = [r["b"] for r in sorted(groups, key=lambda r: r["h"] % 2**64)]
    found = shards.assign_shards(docs, n, bucket_bits=bits).collect()
    assert max(loads_of(found, n)) == shards.smallest_capacity(np.array(sizes), n)
    check(found, lambda r: [documents[r["doc_id"]]], n)
    if (bits, n) == (16, 24):
        query = QUERIES["op4_sharding"](spark, sf_dir).collect()
        assert {(r["doc_id"], r["shard"]) for r in query} == {(r["doc_id"], r["shard"]) for r in found}


def test_no_groups_and_one_large_group():
    assert shards.cut_points(np.zeros(0, np.int64), 3) == [0, 0, 0, 0]
    sizes = np.array([1] * 50 + [40] + [1] * 50)
    starts = shards.cut_points(sizes, 5)
    shares = [int(sizes[a:b].sum()) for a, b in itertools.pairwise(starts)]
    assert max(shares) == 40 and min(shares) >= 20


def check(rows, texts_of, n):
    """Sizes, checksums, whole groups and gapless slots."""
    by_shard, by_text = {}, {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        for text in texts_of(r):
            by_text.setdefault(text, set()).add(r["shard"])
    assert set(by_shard) <= set(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values())


def test_query(spark, sf_dir, documents):
    rows = QUERIES["op4_sharding"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    check(rows, lambda r: [documents[r["doc_id"]]], 24)
    for r in rows:
        data = documents[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "bytes")
        assert r["grown_shard"] is None
    loads = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(24)]
    groups = {}
    for r in rows:
        groups[documents[r["doc_id"]]] = groups.get(documents[r["doc_id"]], 0) + r["size"]
    assert max(loads) <= sum(loads) / 24 + max(groups.values())


def test_hot_group_is_numbered_in_pieces(spark):
    rows = [(i, "same text") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 3200)]
    found = shards.assign_shards(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), 4).collect()
    assert len(found) == 3200
    of = dict(rows)
    check(found, lambda r: [of[r["doc_id"]]], 4)


def test_odd_tables(odd_docs, no_docs):
    rows = shards.assign_shards(odd_docs, 5).collect()
    assert len(rows) == odd_docs.count()
    check(rows, lambda r: [], 5)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {8}
    assert len({r["shard"] for r in rows if r["doc_id"] in (1, 6)}) == 1
    assert shards.assign_shards(no_docs, 5).count() == 0
