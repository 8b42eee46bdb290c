import re

import pytest

import corpus_pipeline
from passagerank.llm import pieces, pii
from passagerank.llm.queries import TOKENIZERS


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    """What every stage returns, each on what the one before kept."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test-stage")
        out.append((name, docs, docs.collect()))
    return out


def test_stages_return_documents(spark, sf_dir, results):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert [len(corpus_pipeline.STAGES), *[d.columns for _, d, _ in results[:-1]]] == [5, *[columns] * 4]


def test_quality_and_duplicates_only_take_documents_away(results, documents):
    good, single = (rows for _, _, rows in results[:2])
    assert {r["doc_id"] for r in single} <= {r["doc_id"] for r in good} <= set(documents)
    assert all(r["text"] == documents[r["doc_id"]] for r in single)
    texts = [r["text"] for r in single]
    assert len(texts) == len(set(texts))
    assert {r["text"] for r in good if r["doc_id"] not in {s["doc_id"] for s in single}} - set(texts) != {None}


def test_personal_data_is_masked(results):
    before, after = ({r["doc_id"]: r for r in rows} for _, _, rows in results[1:3])
    assert set(before) == set(after)
    for k, r in after.items():
        assert r["n_chars"] == len(r["text"]) and pii.base_spans(r["text"]) == []
        pattern = ".*?".join(map(re.escape, re.split(r"\[(?:EMAIL|IP|CARD|PHONE)\]", r["text"])))
        assert re.fullmatch(pattern, before[k]["text"], re.S)


def test_mixing_repeats_documents(results):
    before, after = (rows for _, _, rows in results[2:4])
    times = {}
    for r in after:
        times[r] = times.get(r, 0) + 1
    assert set(times) <= set(before) and set(times.values()) <= {1, 2}


def test_pieces_decode_to_the_texts(results):
    decoder = pieces.Decoder(pieces.load_model(f"{TOKENIZERS}/piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in results[3][2]}
    rows = results[4][2]
    assert len(rows) == len(results[3][2])
    for r in rows:
        assert decoder.decode(pieces.np.array(r["ids"], "int32")) == texts[r["doc_id"]] and r["n_pieces"] == len(r["ids"])


def test_run_equals_the_stages(spark, sf_dir, results):
    key = lambda r: (r["doc_id"], r["ids"])
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect(), key=key) == sorted(results[-1][2], key=key)


def test_odd_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, "unused"), "test-odd")
        assert docs.columns == odd_docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "unused").count() == docs.count()


def test_copies_are_segmented_each_and_decoded(spark):
    text = "segmentation of the repeated information " * 20
    docs = spark.createDataFrame([(1, text, "en", "a")] * 2, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, "unused").collect()
    assert rows[0]["ids"] != rows[1]["ids"] and all(r["lossless"] for r in rows)
