import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from compare import connect

from passagerank.llm import variants
from passagerank.llm.oracle import SQL
from passagerank.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in map(lower, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def grouped(words):
    """By all pairs of words that lose or replace a letter alike."""
    held = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            held[w[:i] + "*" + w[i + 1 :]].add(w)
            held[w[:i] + w[i + 1 :]].add(w)
        held[w].add(w)
    near = {w: set() for w in words}
    for group in held.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and one_apart(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def as_dict(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("dir_", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, dir_):
    rows = spark.read.parquet(f"/root/testdata/{dir_}/documents.parquet").select("doc_id", "text").collect()
    found = as_dict(QUERIES["op13_variants"](spark, f"/root/testdata/{dir_}"))
    wanted = grouped(counted(rows))
    assert found == wanted and any(v[0] for v in wanted.values())
    result = connect(f"/root/testdata/{dir_}").execute(SQL["op13_variants"])
    names = [d[0] for d in result.description]
    by_sql = {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in (dict(zip(names, row, strict=True)) for row in result.fetchall())}
    assert by_sql == wanted


def random_words(draw, n, letters="abé", least=7, most=12):
    out = set()
    while len(out) < n:
        word = "".join(draw.choice(letters) for _ in range(draw.randint(least, most)))
        out.add(word)
        i = draw.randrange(len(word))
        out.add(draw.choice((word[:i] + word[i + 1 :], word[:i] + draw.choice(letters) + word[i:], word[:i] + draw.choice(letters) + word[i + 1 :])))
    return sorted(w for w in out if len(w) >= least)


def test_pairs_of_a_list_equal_all_pairs():
    draw = random.Random(4)
    for shared in (0, 3):
        lists = [random_words(draw, draw.randint(1, 120), least=4, most=9) for _ in range(5)]
        lists = [sorted({"xyz"[:shared] + w for w in held}) for held in lists]
        words = [w.encode("latin-1") for held in lists for w in held]
        of = np.repeat(np.arange(5), [len(held) for held in lists])
        us, vs = variants.one_edit_apart(words, of, np.full(len(words), shared))
        found = list(zip(us.tolist(), vs.tolist(), strict=True))
        wanted = {
            (i, j) for i in range(len(words)) for j in range(len(words))
            if of[i] == of[j] and one_apart(words[i].decode("latin-1"), words[j].decode("latin-1"))
        }
        assert len(found) == len(set(found)) and set(found) == wanted


@pytest.mark.parametrize("most", [20_000, 30, 2])
def test_cut_lists_lose_and_repeat_nothing(spark, most):
    draw = random.Random(most)
    words = {w: draw.choice((2, 3, 25, 30, 400)) for w in [*random_words(draw, 700), *random_words(draw, 200, "ab", 7, 9)]}
    found = variants.near_words(spark.createDataFrame(list(words.items()), "word STRING, n BIGINT"), most).collect()
    near = {w: [o for o in words if abs(len(w) - len(o)) < 2 and one_apart(w, o)] for w in words}
    assert {r["word"]: (r["n_near"], r["form_n"], r["form"]) for r in found} == {
        w: (len(others), words[best := min(others, key=lambda o: (-words[o], o))], best)
        for w, others in near.items() if others
    }


def test_roots_follow_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(21)] + [(f"v{i}", "w3") for i in range(200)]
    found = {r["word"]: r["root"] for r in variants.roots(spark.createDataFrame(links, "word STRING, form STRING")).collect()}
    assert found == {w: "w21" for w, _ in links}
    assert variants.roots(spark.createDataFrame([], "word STRING, form STRING")).count() == 0


def test_odd_tables(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert as_dict(variants.group_variants(odd_docs)) == grouped(counted(rows))
    assert variants.group_variants(no_docs).count() == 0
    long = "x" * 50_000
    rows = [(1, f"{long} {long} ÀÉÎõüß ÀÉÎõüßa {long}y"), (2, f"{long} {long}y ÀÉÎõüßa b")] * 2
    given = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert as_dict(variants.group_variants(given)) == grouped_long(counted(rows))


def grouped_long(words):
    near = {w: [o for o in words if abs(len(w) - len(o)) < 2 and w != o and (w in o or o in w or one_apart(w, o))] for w in words}
    return {w: (None, w, n, len(near[w]), None) for w, n in words.items()}
