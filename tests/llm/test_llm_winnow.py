import hashlib
import random
import re

from passagerank.llm import winnow
from passagerank.llm.queries import QUERIES


def chosen(grams, w=winnow.W):
    """Positions by the definition: least hash of each window, rightmost on ties."""
    out = []
    for i in range(max(1, len(grams) - w + 1) if grams else 0):
        window = [(g, -p) for p, g in list(enumerate(grams))[i : i + w]]
        least = min(window)
        at = (-least[1], least[0])
        if at not in out:
            out.append(at)
    return out


def shown(fingerprint):
    return [(int(p), int(h, 16)) for h, p in (e.split(":") for e in fingerprint.split())]


def test_windows_against_definition(spark):
    draw = random.Random(5)
    rows = [[draw.choice((1, 2, 3, 900)) for _ in range(draw.randint(0, 40))] for _ in range(100)]
    packed = [[(g << 31) + winnow.LAST - p for p, g in enumerate(r)] for r in rows]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(packed)], "i INT, packed ARRAY<BIGINT>")
    found = {r["i"]: r["c"] for r in df.select("i", winnow.chosen_grams(winnow.F.col("packed"), winnow.W).alias("c")).collect()}
    for i, grams in enumerate(rows):
        assert [(winnow.LAST - (c & winnow.LAST), c >> 31) for c in found[i]] == chosen(grams)


def test_query(spark, sf_dir, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op9_winnowing"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    ids = sorted(documents, reverse=True)
    same = {}
    for i, k in enumerate(ids):
        text, after = documents[k], documents[ids[(i + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert same.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        own, other, following = (
            {h for _, h in shown(f)} for f in (r["fingerprint"], r["edited_fingerprint"], rows[ids[(i + 1) % len(ids)]]["fingerprint"])
        )
        assert r["near_edited"] == (len(own & other) / len(own | other) if own | other else 1.0)
        assert r["near_next"] == (len(own & following) / len(own | following) if own | following else 1.0)
        words = re.findall(winnow.TOKEN, text)
        gaps = [b - a for (a, _), (b, _) in zip(shown(r["fingerprint"]), shown(r["fingerprint"])[1:])]
        assert all(0 < g <= winnow.W for g in gaps) and (not words or shown(r["fingerprint"]))


def test_shared_passages_are_found(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(winnow.K + winnow.W - 1))
    rows = [(i, " ".join([*(word() for _ in range(draw.randint(0, 30))), passage, *(word() for _ in range(draw.randint(0, 30)))])) for i in range(40)]
    df = winnow.with_fingerprint(spark.createDataFrame(rows, "i INT, text STRING"), "text", "g")
    sets = [set(r["s"]) for r in df.select(winnow.hash_set(winnow.F.col("g")).alias("s")).collect()]
    assert all(a & b for a in sets for b in sets)


def test_odd_tables(odd_docs, no_docs):
    rows = winnow.compare_with_next(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = [r for r in rows if r["text"] == ""]
    assert all(r["grams"] == [] for r in empty)
    of = {r["doc_id"]: r for r in rows}
    given = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    half = len(given[5]) // 2
    assert of[5]["edited"] == given[5][: len(given[5]) - half] + given[4][:half]
    assert of[1]["edited"] == given[1][: len(given[1]) - len(given[1]) // 2] + ""  # next is null: its least text is empty
    assert winnow.compare_with_next(no_docs).count() == 0


def test_texts_are_dealt_once(spark, sf_dir):
    df = winnow.compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = df.agg(winnow.F.sum("near_edited"))
    rows.collect()
    assert "ReusedExchange" in rows._jdf.queryExecution().executedPlan().toString()
