import random
import re
from collections import Counter

import numpy as np
import pytest

from passagerank.llm import quality
from passagerank.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
    }


def failed(counts):
    return counts["n_words"] < 20 or 100 * counts["n_repeat_words"] > 30 * counts["n_words"]


def histograms(text):
    """Both histograms by plain counting."""
    names = sorted({w for words in quality.COMMON.values() for w in words})
    table = quality.class_table()
    classes, words = np.zeros(quality.CLASSES), np.zeros(len(names) + 1)
    for byte in text.encode():
        if table[byte] < quality.CLASSES:
            classes[table[byte]] += 1
    for word in text.encode().split():
        plain = word.lower().strip(b".,;:?!'\"()-").decode()
        words[names.index(plain) if plain in names else len(names)] += 1
    return classes, words


def jensen_shannon(p, q):
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    parts = [x[x > 0] * np.log2(x[x > 0] / m[x > 0]) for x in (p, q)]
    return float(np.sqrt(sum(part.sum() for part in parts) / 2))


def far(counts, a, b):
    limits = quality.Limits()
    one = counts["word_chars"] >= 200 and a > limits.characters[0] + limits.characters[1] / counts["word_chars"] ** 0.5
    return one or (counts["n_words"] >= 60 and b > limits.words[0] + limits.words[1] / counts["n_words"] ** 0.5)


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op6_quality"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counts = {k: base(t) for k, t in documents.items()}
    both = {k: histograms(t) for k, t in documents.items()}
    references = {}
    for _ in range(2):
        fresh = {}
        for lang in sorted(set(langs.values())):
            used = [
                k for k in documents if langs[k] == lang and not failed(counts[k])
                and not (references and far(counts[k], *(jensen_shannon(both[k][i], references[lang][i]) for i in (0, 1))))
            ]
            fresh[lang] = tuple(sum(both[k][i] for k in used) for i in (0, 1))
        references = fresh
    for k, r in rows.items():
        assert {c: r[c] for c in quality.COUNTS} == counts[k]
        assert r["base_failed"] == failed(counts[k])
        if counts[k]["n_words"]:
            found = [jensen_shannon(both[k][i], references[langs[k]][i]) for i in (0, 1)]
            assert [r[a] for a in quality.ADDED] == pytest.approx(found)
            assert r["kept"] == (not failed(counts[k]) and not far(counts[k], *found))


def test_keeps_good_documents_and_drops_bad_ones(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op6_quality"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.15


def test_odd_tables(odd_docs, no_docs):
    rows = quality.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(not r["kept"] for r in rows if r["doc_id"] in (2, 3, 8))
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == sorted(r["doc_id"] for r in rows if r["kept"] and r["doc_id"])
    assert quality.judge(no_docs).count() == quality.keep_good(no_docs).count() == 0


def test_languages_without_a_list_and_rare_tags(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(draw.randint(2, 9)))
    known = "the sum of it is in the end what they had from a day of work and that was for the best on with as are this be or an at by".split()
    english = lambda: " ".join(draw.choice(known) for _ in range(120))
    rows = [(i, english(), "en") for i in range(150)]
    rows += [(1000 + i, " ".join(word() for _ in range(120)), "el") for i in range(150)]
    junk = " ".join("{}[]=+/^~`_"[draw.randrange(11)] * 3 + str(draw.randrange(10**6)) for _ in range(150))
    rows += [(5000, junk, "el"), (5001, junk, "zz"), (5002, junk, None), (5003, english(), "zz"), (5004, english(), None), (5005, junk, "en")]
    found = quality.judge(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")).collect()
    assert not any(r["base_failed"] for r in found)
    assert {r["doc_id"] for r in found if not r["kept"]} == {5000, 5001, 5002, 5005}
