import random
import zlib

import numpy as np
import pytest

from passagerank.llm import toxicity
from passagerank.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    text = b" the idiot and the moron are worthless clown people who said a stupid disgusting thing to a pathetic loser " * 20
    return toxicity.language_model(toxicity.trigram_counts(text)).tolist()


@pytest.mark.parametrize(
    ("shown", "meant"),
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("idiooooot", "idiot"), ("m0r0n", "moron"), ("$tupid", "stupid"),
     ("c l 0 w n", "clown"), ("d!sgust!ng", "disgusting"), ("p@thetic", "pathetic"), ("l.o.s.e.r", "loser"),
     ("!diot", "idiot"), ("id.iot", "idiot"), ("st-upid", "stupid"), ("stuupid", "stupid"), ("1d1ot", "idiot"), ("m0r0n!!", "moron")],
)
def test_restores_disguised_words(model, shown, meant):
    assert toxicity.disguised(shown.encode()) or toxicity.SPACED.search(shown.encode())
    assert toxicity.restore(shown.rstrip("!"), model) == meant


FORMS = {
    "digits": lambda w, d: "".join({"o": "0", "i": "1", "e": "3", "a": "4", "s": "5", "t": "7"}.get(c, c) if d.random() < 0.6 else c for c in w),
    "signs": lambda w, d: "".join({"i": "!", "a": "@", "s": "$"}.get(c, c) for c in w),
    "first sign": lambda w, d: {"i": "!", "a": "@", "s": "$", "t": "+"}.get(w[0], w[0]) + w[1:],
    "repeats": lambda w, d: w[:2] + w[2] * d.randint(2, 5) + w[3:],
    "blanks": lambda w, d: " ".join(w),
    "two blanks": lambda w, d: "  ".join(w),
    "tabs": lambda w, d: "\t".join(w),
    "lines": lambda w, d: "\n".join(w),
    "dots": lambda w, d: ".".join(w),
    "one separator": lambda w, d: w[:3] + d.choice(".-_*") + w[3:],
}


@pytest.mark.parametrize("form", list(FORMS))
def test_held_out_recall_of_every_disguise(spark, learned_plain, form):
    """Words learned undisguised are seen through every form."""
    draw, words = random.Random(form), ["idiot", "moron", "stupid", "loser", "clown", "pathetic"]
    texts = [f"you are really {FORMS[form](draw.choice(words), draw)} and {FORMS[form](draw.choice(words), draw)} again" for _ in range(60)]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    found = toxicity.score(asked, learned_plain).collect()
    assert sum(r["score"] >= 0.5 for r in found) >= 57


@pytest.fixture(scope="module")
def learned_plain(spark):
    draw = random.Random(3)
    bad, fine = ["idiot", "moron", "stupid", "loser", "clown", "pathetic"], ["weather", "river", "evening", "train", "garden", "kettle", "yellow"]
    rest = ["you", "are", "really", "and", "again", "the", "book", "letter", "small", "room", "number", "said"]
    rows = [(i, " ".join([*draw.sample(rest, 6), *draw.sample(bad if i % 2 else fine, 2)])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    return toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id BIGINT, toxic INT"))


def test_viterbi_is_the_best_path(model):
    def every(span, state=(0, 0), score=0.0, made=""):
        if not span:
            yield score + model[state[0]][state[1]][0], made
            return
        sign, rest = span[0], span[1:]
        letters = sign if sign.isalpha() else toxicity.STANDS_FOR.get(sign, "")
        cost = toxicity.AS_IT_IS if sign.isalpha() else toxicity.DISGUISED - np.log(max(1, len(letters)))
        for c in letters:
            n = ord(c) - 96
            yield from every(rest, (state[1], n), score + cost + model[state[0]][state[1]][n], made + c)
            if n == state[1]:
                yield from every(rest, state, score + cost + toxicity.REPEATED, made)
        if sign in toxicity.SEPARATORS or not letters:
            yield from every(rest, state, score + toxicity.SILENT, made)

    for span in ("1d10t", "l-0-5er", "loooser", "6oo|d", "s s t", "%a1"):
        assert toxicity.restore(span, model) == max(every(span))[1]


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op7_toxicity"](spark, sf_dir).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for label, p in held if label == 1]
    clean = [p for label, p in held if label == 0]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.02


def test_scores_depend_on_texts_alone_and_see_through_disguise(spark):
    bad = ["you are an idiot and a moron", "such a stupid loser you are", "this idiot is a loser and stupid", "what a moron idiot"]
    fine = ["the weather is fine today here", "we had a good day by the sea", "they went home in the evening", "a book about old trains"]
    rows = [(i, (bad if i % 2 else fine)[i // 2 % 4] + f" number {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id BIGINT, toxic INT")
    learned = toxicity.train(docs, labels)
    asked = [(1, "you are an 1d10t and a m0r0n number 7"), (2, "the weather is fine today here number 7"), (None, ""), (3, None), (3, None)]
    found = toxicity.score(spark.createDataFrame(asked, "doc_id BIGINT, text STRING"), learned).collect()
    score = [(r["doc_id"], r["score"]) for r in found]
    assert dict(score)[1] > 0.5 > dict(score)[2] and len(score) == 5
    assert len({s for k, s in score if k in (None, 3)}) == 1


def test_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (4, 0, "x"), (5, None, "x"), (None, 1, "x")], "doc_id BIGINT, toxic INT, text STRING")
    learned = toxicity.train(odd_docs, labels)
    assert toxicity.score(odd_docs, learned).count() == odd_docs.count()
    empty = toxicity.train(no_docs, labels.limit(0))
    assert toxicity.score(no_docs, empty).count() == 0
    assert {r["score"] for r in toxicity.score(odd_docs, empty).collect()} == {0.0}


def test_language_model_counts_all_documents(spark):
    texts = [f"common words of document {i}" for i in range(50)] + ["zyxwv qponm"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id BIGINT, toxic INT")
    found = toxicity.train(docs, labels, max_docs=10).language
    wanted = toxicity.language_model(sum(toxicity.trigram_counts(t.encode()) for t in texts))
    assert np.allclose(found, wanted)


def test_texts_without_spelled_words_are_not_searched(monkeypatch):
    spelled = [b"an i d i o t here", b"a b", b"x\ty\n z", b"no\xc3\xa9 a b c\xc3\xa9", b"1 $ ! a", b""]
    wanted = [toxicity.tokens_of(t) for t in spelled]
    assert wanted[0][b"i d i o t"] == 1 and wanted[2][b"x y z"] == 1 and wanted[4][b"1 $ ! a"] == 1

    class Never:
        def finditer(self, text):
            raise AssertionError(text)

    monkeypatch.setattr(toxicity, "SPACED", Never())
    assert toxicity.tokens_of(b"a plain text of a few words") == {b"a": 2, b"plain": 1, b"text": 1, b"of": 1, b"few": 1, b"words": 1}
    assert [toxicity.tokens_of(spelled[i]) for i in (1, 3, 5)] == [wanted[i] for i in (1, 3, 5)]
