import random
import re

import numpy as np
import xxhash

import corpus_pipeline
from passagerank.llm import simhash
from passagerank.llm.components import components
from passagerank.llm.queries import QUERIES


def fingerprint(text, words=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + words]).encode(), 42) for i in range(max(1, len(found) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, linked):
    """Least member reachable, for every item."""
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {i: root(i) for i in items}


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = QUERIES["op8_simhash"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    fps = {k: fingerprint(t) for k, t in documents.items()}
    ids = sorted(fps)
    values = np.array([fps[i] for i in ids], np.uint64)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None]) <= 3)
    of = classes(ids, [(ids[a], ids[b]) for a, b in near])
    for r in rows:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}" and r["component_id"] == of[r["doc_id"]]


def test_links_connect_what_all_pairs_connect(spark):
    draw = random.Random(6)
    values = set()
    for _ in range(40):  # families of near values around random centres, and chains of them
        value = draw.getrandbits(64)
        for _ in range(draw.randint(1, 12)):
            values.add(value)
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                value ^= 1 << bit
    hot = draw.getrandbits(32) << 32  # one half shared by many
    values |= {hot | draw.getrandbits(10) for _ in range(400)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp BIGINT")).collect()
    array = np.array(signed).astype(np.uint64)
    near = np.argwhere(np.bitwise_count(array[:, None] ^ array[None]) <= 3)
    assert len(found) < 40 * len(values)
    assert classes(signed, found) == classes(signed, [(signed[a], signed[b]) for a, b in near])


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randint(-40, 40) * 7, draw.randint(-40, 40) * 7) for _ in range(60)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(300)] + [(5, 5)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert found == classes(nodes, edges_without_loops(edges))
    assert components(spark.createDataFrame([], "u BIGINT, v BIGINT")).count() == 0


def edges_without_loops(edges):
    return [e for e in edges if e[0] != e[1]]


def test_spanning_links_in_tiles(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 7)
    random_ = np.random.default_rng(4)
    left, right = random_.integers(-(1 << 11), 1 << 11, 60), random_.integers(-(1 << 11), 1 << 11, 50)
    us, vs = simhash.spanning_links(left, right, 2)
    near = [(int(a), int(b)) for a in left for b in right if bin((int(a) ^ int(b)) & (2**64 - 1)).count("1") <= 2]
    nodes = {n for e in near for n in e}
    assert classes(nodes, list(zip(us, vs, strict=True))) == classes(nodes, near)


def test_odd_tables(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs)
    found = rows.collect()
    assert len(found) == odd_docs.count()
    of = {(r["doc_id"], r["fp"]): r["component_id"] for r in found}
    assert {c for (d, f), c in of.items() if f == 0} == {2}
    assert {c for (d, _), c in of.items() if d in (1, 6)} == {1}
    kept = simhash.keep_one(odd_docs, rows)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({r["component_id"] for r in found})
    assert simhash.near_duplicates(no_docs).count() == simhash.keep_one(no_docs, simhash.near_duplicates(no_docs)).count() == 0


def test_a_full_segment_value_is_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    test_links_connect_what_all_pairs_connect(spark)


def test_pipeline_stage_keeps_the_least_of_each_component(spark):
    draw, rows = random.Random(8), []
    for n in range(120):
        words = [f"w{draw.getrandbits(14)}" for _ in range(draw.randint(3, 400))]
        for _ in range(draw.randint(1, 4)):
            rows.append((len(rows), " ".join(words)))
            words[draw.randrange(len(words))] = f"edit{draw.getrandbits(40)}"
    fps = {i: fingerprint(t) for i, t in rows}
    values = np.array([fps[i] for i in range(len(rows))], np.uint64)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None]) <= 3).tolist()
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    kept = {r["doc_id"] for r in stage(spark, spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), "unused").collect()}
    assert kept == set(classes(range(len(rows)), near).values()) and len(kept) < len(rows)
