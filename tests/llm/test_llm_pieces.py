import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from passagerank.llm import pieces
from passagerank.llm.queries import QUERIES, TOKENIZERS

PATH = f"{TOKENIZERS}/piece_bpe_32k.model"
SPACE = chr(0x2581)


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(PATH)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    bits = ["a", "b", "th", "the", " ", "  ", "\n", "é", "你", "😀", "\t", "1", "2024", "in", "ing", "   ", "ß", ".", "\x00", SPACE]
    made = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 25))) for _ in range(1500)]
    return [*made, "", "a" * 500, "hello" * 200, " " * 100, "x " * 5, SPACE * 3]


def encoded(encoder, texts, keys):
    ids, counts, _ = encoder.encode(texts, keys)
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]


def test_without_dropout_equals_the_library(model, texts):
    plain = [t for t in texts if SPACE not in t and "\x00" not in t]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert encoded(pieces.Encoder(model, 1, 0.0, 1), plain, [0] * len(plain)) == library.encode(plain)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_every_segmentation_decodes_to_its_text(model, texts, dropout):
    decoder = pieces.Decoder(model)
    found = encoded(pieces.Encoder(model, 7, dropout), texts, list(range(len(texts))))
    assert [decoder.decode(np.array(i, np.int32)) for i in found] == texts
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert all(library.decode(i) == t for i, t in zip(found, texts, strict=True) if "\x00" not in t)


def test_arrays_and_agenda_agree(model, documents):
    encoder = pieces.Encoder(model, 3, 0.3)
    units = [u for t in list(documents.values())[:40] for u in encoder.units(t) if u != pieces.LITERAL][:2000]
    flat, counts = encoder.encode_short(units, np.full(len(units), 5))
    ends = np.cumsum(counts)
    assert [flat[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [encoder.encode_long(u, 5) for u in units]


def test_seeds_and_occurrences_vary_and_reruns_agree(model):
    text = "segmentation of the repeated information " * 20
    one, two = pieces.Encoder(model, 1, 0.2), pieces.Encoder(model, 2, 0.2)
    a, b = encoded(one, [text, text], [1, 2])
    assert a != b and encoded(one, [text], [1])[0] == a != encoded(two, [text], [1])[0]
    unit = SPACE + "information"
    assert len({tuple(one.encode_long(unit, v)) for v in range(8)}) > 1


def test_dropout_skips_about_its_share(model):
    encoder = pieces.Encoder(model, 9, 0.25)
    n = np.arange(20_000)
    skipped = encoder.skipped(n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), n, n + 1, n + 2)
    assert abs(skipped.mean() - 0.25) < 0.02


def test_every_occurrence_draws_its_own_skips(model):
    encoder, n = pieces.Encoder(model, 5), 4000
    plain = pieces.Encoder(model, 5, 0.0)
    text = "a t s of in the and to information"
    for unit in (SPACE + w for w in text.split()):
        merges = []
        lengths, _, ids = plain.described([unit])
        plain._advance([unit], lengths, ids, None, merges)
        whole = encoded(plain, [unit[1:]], [0])[0]
        found = encoded(encoder, [unit[1:]] * n, list(range(n)))
        kept = sum(f == whole for f in found) / n
        # without a skip the result is that without dropout, which other merges may give as well
        assert 0.9 ** len(merges) - 0.03 < kept < 1, unit
        assert len(merges) > 1 or abs(kept - 0.9) < 0.03, unit
    assert len({tuple(f) for f in encoded(encoder, ["information"] * n, list(range(n)))}) > 8


def test_shared_results_equal_the_agenda(model, documents):
    encoder = pieces.Encoder(model, 3, 0.3)
    text = next(t for t in documents.values() if 500 < len(t) and SPACE not in t)[:3000]
    units = encoder.units(text)
    with np.errstate(over="ignore"):
        nth = np.arange(len(units)).astype(np.uint64)
        variants = pieces._mix(np.uint64(77) * pieces.M1 + nth * pieces.M4 + encoder.seed)
    wanted = [i for u, v in zip(units, variants.tolist(), strict=True) for i in encoder.encode_long(u, v)]
    assert encoded(encoder, [text], [77])[0] == wanted


def test_query(spark, sf_dir, documents):
    rows = QUERIES["op3_pieces"](spark, sf_dir).collect()
    assert len(rows) == len(documents) and all(r["lossless"] for r in rows)


def test_windows_change_nothing(model, texts, documents, monkeypatch):
    encoder, decoder = pieces.Encoder(model, 11), pieces.Decoder(model)
    given = [*texts[-30:], *list(documents.values())[:20], SPACE + " a" + SPACE, "a " + SPACE + " b", "  "]
    ids, counts, same = encoder.encode(given, list(range(len(given))), decoder)
    assert same.all()
    for size in (1, 13, 1000):
        monkeypatch.setattr(pieces, "CHUNK_CHARS", size)
        again = encoder.encode(given, list(range(len(given))), decoder)
        assert again[0].tolist() == ids.tolist() and again[1].tolist() == counts.tolist() and again[2].all()


def test_a_very_long_text_stays_in_bounds():
    code = """
import resource, sys
sys.path.insert(0, sys.argv[1])
from passagerank.llm import pieces
model = pieces.load_model(sys.argv[2])
encoder, decoder = pieces.Encoder(model, 42), pieces.Decoder(model)
words = "the repeated information of segmentation was never in one place for long, é 2024! "
text = (words * (20_000_000 // len(words) + 1))[:20_000_000]
assert encoder.encode([text], [1], decoder)[2].all()
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = Path(pieces.__file__).resolve().parents[2]
    found = subprocess.run([sys.executable, "-c", code, str(root), PATH], capture_output=True, text=True, check=True)
    assert int(found.stdout) < 400


def agenda(model, seed, key, text):
    """Ids of a text by the plainest procedure: always the best candidate that its hash does not skip."""
    encoder, out = pieces.Encoder(model, seed), []
    with np.errstate(over="ignore"):
        for nth, unit in enumerate(encoder.units(text)):
            if unit == pieces.LITERAL:
                out += encoder.literal()
                continue
            variant = pieces._mix(np.array([key % 2**64], np.uint64) * pieces.M1 + np.uint64(nth) * pieces.M4 + encoder.seed)
            drawn = encoder.keyed(encoder.described([unit])[1], variant)
            parts = [(i, i + 1) for i in range(len(unit))]
            while True:
                best = None
                for (a, b), (_, c) in zip(parts[:-1], parts[1:], strict=True):
                    made = encoder.ids.get(unit[a:c])
                    sides = unit[a:b] in encoder.ids and unit[b:c] in encoder.ids
                    if made is None or not sides or encoder.skipped(drawn, *(np.array([v]) for v in (a, b, c)))[0]:
                        continue
                    if best is None or model["scores"][made] > best[0]:
                        best = (model["scores"][made], a, b, c)
                if best is None:
                    break
                at = parts.index((best[1], best[2]))
                parts[at : at + 2] = [(best[1], best[3])]
            for a, b in parts:
                out += [encoder.ids[unit[a:b]]] if unit[a:b] in encoder.ids else encoder.spelled(unit[a:b], [0, b - a], [-1])
    return out


def test_query_equals_the_plain_agenda(spark, sf_dir, documents, model):
    rows = {r["doc_id"]: r for r in QUERIES["op3_pieces"](spark, sf_dir).collect()}
    few = [d for d, t in documents.items() if len(t) < 400][:40]
    keyed = spark.createDataFrame([(d,) for d in few], "doc_id BIGINT").select("doc_id", F.xxhash64("doc_id", F.lit(42)).alias("k"))
    wanted = [(r["doc_id"], agenda(model, 42, r["k"], documents[r["doc_id"]])) for r in keyed.collect()]
    hashed = spark.createDataFrame(wanted, "doc_id BIGINT, ids ARRAY<INT>").select("doc_id", F.size("ids"), F.xxhash64("ids"))
    for doc_id, n, value in hashed.collect():
        assert (rows[doc_id]["n_pieces"], rows[doc_id]["pieces_hash"]) == (n, value)


def test_odd_tables(odd_docs, no_docs):
    with pytest.raises(ValueError, match="ids"):
        pieces.encode(odd_docs, PATH)
    named = odd_docs.withColumnRenamed("n", "__0")
    rows = pieces.decode(pieces.encode(named, PATH, into="found", check="lossless"), PATH, ids="found").collect()
    assert len(rows) == odd_docs.count() and all(r["decoded"] == (r["text"] or "") and r["lossless"] for r in rows)
    same = [r["found"] for r in rows if r["doc_id"] == 6]
    assert same[0] == same[1] and rows[0]["ids"] == rows[0]["__0"] == "x"
    assert pieces.encode(no_docs, PATH, into="found").count() == 0
