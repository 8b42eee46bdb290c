import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from passagerank.llm import token_counts
from passagerank.llm.queries import QUERIES, TOKENIZERS

PATH = f"{TOKENIZERS}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def count():
    return token_counts.batch_counter(token_counts.load_vocabulary(PATH))


def test_query_equals_the_library(spark, sf_dir, documents, library):
    rows = QUERIES["op5_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_any_text_equals_the_library(library, count):
    draw = random.Random(1)
    bits = ["a", "b", "A", "é", "É", "é", "İ", "Σ", "ς", "1", "²", "½", "Ⅷ", " ", "\n", " ", " ", "\x1c", "\x85", "​",
            "'s", "'LL", "'d", "'", "!!", "…", "你好", "あ", "😀", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "ﬁ", "ǅ",
            "aaaa", "\x00", "the", "K", "Å", "ß", "ẞ", "가", "ا", "﻿"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "", "x"]
    assert count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_pair_table():
    random_ = np.random.default_rng(0)
    pairs = np.unique(random_.integers(0, 500, (4000, 2)), axis=0)
    table = token_counts.PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs), dtype=np.int32), bits=13)
    known = {tuple(p): i for i, p in enumerate(pairs.tolist())}
    asked = random_.integers(0, 500, (5000, 2))
    assert table.find(asked[:, 0], asked[:, 1]).tolist() == [known.get(tuple(p), token_counts.NONE) for p in asked.tolist()]


def test_odd_tables(odd_docs, no_docs, library):
    rows = token_counts.count_tokens(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count()
    of = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["n_tokens"] == len(library.encode(of[r["doc_id"]], add_special_tokens=False).ids)
    assert token_counts.count_tokens(no_docs, PATH).count() == 0
