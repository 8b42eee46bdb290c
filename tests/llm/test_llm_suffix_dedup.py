import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from compare import connect, difference

from passagerank.llm import suffix_dedup as sd
from passagerank.llm.oracle import SQL
from passagerank.llm.queries import QUERIES


def brute(texts, length, keep_first=False):
    """Removed bytes of every text, as a list of flags; texts in order of position."""
    places = defaultdict(list)
    for t, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            places[text[i : i + length]].append((t, i))
    out = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        for t, i in found[1 if keep_first else 0 :] if len(found) > 1 else []:
            out[t][i : i + length] = True
    return out


def expected(text, gone):
    spans = [(a, b) for a, b in zip(np.flatnonzero(np.diff([0, *gone.astype(int)]) == 1), np.flatnonzero(np.diff([*gone.astype(int), 0]) == -1) + 1, strict=True)]
    kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
    return [tuple(map(int, s)) for s in spans], int(gone.sum()), hashlib.sha256(kept).hexdigest()


def shown(row):
    return [(s["start"], s["end"]) for s in row["spans"]], row["n_removed"], row["kept_sha256"]


@pytest.mark.parametrize("dir_", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, dir_):
    rows = spark.read.parquet(f"/root/testdata/{dir_}/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in rows}
    seen = Counter(hashlib.md5(t[i : i + 400]).digest() for t in texts.values() for i in range(len(t) - 399))
    wanted = {}
    for doc_id, t in texts.items():
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 399):
            if seen[hashlib.md5(t[i : i + 400]).digest()] > 1:
                gone[i] += 1
                gone[i + 400] -= 1
        spans, n, kept = expected(t, np.cumsum(gone[:-1]) > 0)
        wanted[doc_id] = (len(t), n, len(spans), kept)
    df = QUERIES["op11_suffix_dedup"](spark, f"/root/testdata/{dir_}")
    found = df.collect()
    assert len(found) == len(rows)
    result = connect(f"/root/testdata/{dir_}").execute(SQL["op11_suffix_dedup"])
    assert difference(found, df.columns, result.fetchall(), [d[0] for d in result.description]) is None
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == wanted
    assert any(0 < r["n_removed"] < r["n_bytes"] for r in found)


def corpus(draw, n):
    """Texts with shared passages, copies, near copies and periods."""
    letter = lambda: draw.choice("abcdé ")
    passages = ["".join(letter() for _ in range(draw.randint(8, 70))) for _ in range(6)]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(draw.randint(0, 4)):
            text += draw.choice([draw.choice(passages), "".join(letter() for _ in range(draw.randint(1, 60))), "ab" * draw.randint(5, 30), "z" * draw.randint(1, 60)])
        texts.append(text)
        if draw.random() < 0.2:
            at = draw.randrange(len(text) + 1)
            texts.append(text[:at] + draw.choice(["", "x"]) + text[at:])
    return texts


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize(("length", "contexts", "segment"), [(16, 2048, 1 << 20), (16, 2, 64), (40, 1, 300), (24, 0, 50)])
def test_any_groups_and_segments_agree(spark, monkeypatch, length, contexts, segment, keep_first):
    monkeypatch.setattr(sd, "GROUP_CONTEXTS", contexts)
    monkeypatch.setattr(sd, "SEGMENT", segment)
    monkeypatch.setattr(sd, "BLOCK", 4)
    monkeypatch.setattr(sd, "SORT_BYTES", 500)
    texts = corpus(random.Random(length + contexts), 90)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(4)
    found = {r["doc_id"]: shown(r) for r in sd.removed(docs, length, keep_first).collect()}
    data = [t.encode() for t in texts]
    # equal texts are one text: the first has it, whatever its hash; so do the bytes that it shares with itself
    wanted = {i: expected(t, g) for i, (t, g) in enumerate(zip(data, brute(data, length, keep_first), strict=True))}
    assert found == wanted
    assert any(0 < n < len(data[i]) for i, (_, n, _) in wanted.items())


def test_factors_equal_brute_force():
    draw = random.Random(5)
    for _ in range(50):
        text = "".join(draw.choice("ab") for _ in range(draw.randint(1, 40)))
        order = sorted(range(len(text)), key=lambda i: text[i:])
        shares = lambda a, b: next((k for k in range(len(text)) if text[a + k : a + k + 1] != text[b + k : b + k + 1] or a + k >= len(text) or b + k >= len(text)), len(text))  # noqa: B023, E731
        common = np.array([0, *(shares(a, b) for a, b in zip(order[:-1], order[1:], strict=True))])
        found = sd.previous_factors(np.array(order), common)
        wanted = [max((shares(i, j) for j in range(i)), default=0) for i in order]
        assert found.tolist() == wanted


def test_ranks_are_those_of_sorted_strings():
    draw = random.Random(6)
    for length in (1, 2, 5, 8, 13, 16, 40):
        text = "".join(draw.choice("ab") for _ in range(200)).encode()
        strings = [text[i : i + length] for i in range(len(text) - length + 1)]
        order = {s: r for r, s in enumerate(sorted(set(strings)))}
        assert sd.prefix_ranks(np.frombuffer(text, np.uint8), length).tolist() == [order[s] for s in strings]


def test_kept_bytes(spark):
    rows = spark.createDataFrame([("abcdef", [(1, 3), (4, 5)]), ("xyz", []), (None, None)], "text STRING, spans ARRAY<STRUCT<start: INT, end: INT>>")
    assert [bytes(r["text"]) for r in sd.kept_bytes(rows).collect()] == [b"adf", b"xyz", b""]


def test_odd_tables(spark, odd_docs, no_docs):
    rows = sd.removed(odd_docs, 40).collect()
    given = [(r["doc_id"], (r["text"] or "").encode()) for r in odd_docs.collect()]
    gone = brute([t for _, t in given], 40)
    assert sorted((r["doc_id"] or -1, *shown(r)) for r in rows) == sorted(
        (d or -1, *expected(t, g)) for (d, t), g in zip(given, gone, strict=True)
    )
    assert sd.removed(no_docs).count() == 0
    first = {(r["doc_id"], r["n_removed"]) for r in sd.removed(odd_docs, 40, keep_first=True).collect()}
    # rows of the same id and text are alike; the periods of texts go all the same
    assert len([f for f in first if f[0] == 6]) == 1
    short = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, None)], "doc_id BIGINT, text STRING")
    assert [r["n_removed"] for r in sd.removed(short).collect()] == [0, 0, 0]
