"""Quality rules: plain counts, and the divergence of a text from references of its language.

A document's histogram of character classes and its histogram of common words are
compared with those of its language by Jensen-Shannon distance.  The references are sums over
all documents of the language that pass the base rules, taken again without those
far from the first sums.  A distance counts only above a minimum length, as short
texts differ by chance.

The word lists of ``COMMON`` give four languages a reference of words.  Every other language with documents enough has
one of character classes, from its own documents; a tag with few documents is treated like none.

Edge cases: null and empty texts have no words and fail the base rules; a document without a
language, or with a rare one, is compared with the references of the listed languages and keeps the least distance; without any
reference none is rejected; extra columns stay or are not read, whatever their names; repeated rows are judged each; an empty table gives
no rows; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagerank.llm.shared import stored, text_of

#: Fixed values of the base rules: symbols, words of a window, least words, most repeated words in percent.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: Words counted at a time: bounds a task's arrays.
CHUNK_WORDS = 500_000
#: The most frequent function words of each language.
COMMON = {
    "de": "der die das und in zu den von mit ist des ein auch nicht für als dem eine im auf".split(),
    "en": "the of and to in is for by with on that it are as this be from or an at was".split(),
    "es": "el la de que y en un una los del se las por con para su al es lo como".split(),
    "fr": "le la les de des du et en un une que qui dans pour est sur pas avec au elle aux".split(),
}
CLASSES = 9
#: Documents that make a reference of a language that is not listed, and such languages at most (those with most documents).
LEAST_DOCS, MOST_LANGUAGES = 100, 1_000


@dataclass(frozen=True)
class Limits:
    """Greatest distances (0 to 1) and the lengths from which they count.

    A limit is ``floor + by_chance / sqrt(length)``: short texts differ from any reference by chance.
    """

    characters: tuple[float, float] = (0.12, 2.0)
    words: tuple[float, float] = (0.2, 1.6)
    least_characters: int = 200
    least_words: int = 60


def class_table() -> np.ndarray:
    """Class of each byte; bytes that continue a character have none."""
    table = np.full(256, 8, np.uint8)  # control characters and long characters
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[ord(" "), *range(9, 14)]] = 3
    table[list(b".,;:?!'\"()-")] = 4
    table[list(b"#*$%&|<>@[]{}=+/\\^~`_")] = 5
    table[0xC2:0xC4] = 6  # letters and marks of western Europe
    table[0xC4:0xE0] = 7
    table[0x80:0xC0] = CLASSES
    return table


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of every row of counts from a reference of counts."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = (reference / max(reference.sum(), 1))[None, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0.0, 1.0))


def repeated_words(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document the words inside windows that occur twice or more in it, the first included.

    Windows get exact numbers by doubling: pairs, fours, eights of words.
    """
    total, ends = len(ids), np.cumsum(lengths)
    document = np.repeat(np.arange(len(lengths)), lengths)
    code = document * (int(ids.max()) + 1) + ids if total else ids
    span = 1
    while span < WINDOW and total > span:
        follows = np.zeros(total, np.int64)
        follows[:-span] = code[span:] + 1
        code = np.unique(code * (total + 1) + follows, return_inverse=True)[1]
        span *= 2
    whole = np.arange(total) + WINDOW <= ends[document] if total else np.zeros(0, bool)
    starts = np.flatnonzero(whole)
    if not len(starts):
        return np.zeros(len(lengths), np.int64)
    twice = np.bincount(code[starts])[code[starts]] > 1
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts[twice], 1)
    np.add.at(edge, starts[twice] + WINDOW, -1)
    inside = np.cumsum(edge[:-1]) > 0
    return np.bincount(document, weights=inside, minlength=len(lengths)).astype(np.int64)


def measure_texts(texts: list[bytes], common: dict[bytes, int], n_common: int) -> dict[str, np.ndarray]:
    """Counts of a few documents; ``common`` maps a word to its number."""
    table, symbol = class_table(), np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines")}
    classes, words = np.zeros((n, CLASSES), np.int64), np.zeros((n, n_common + 1), np.int64)
    numbers: dict[bytes, int] = {}
    ids: list[int] = []
    for i, text in enumerate(texts):
        found = text.split()
        bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        classes[i] = np.bincount(table, weights=bytes_, minlength=CLASSES + 1)[:CLASSES]
        out["n_words"][i] = len(found)
        out["word_chars"][i] = classes[i].sum() - classes[i, 3]
        out["n_symbols"][i] = (bytes_ * symbol).sum()
        lines = [line for line in text.split(b"\n") if line.strip()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        of = [numbers.setdefault(w, len(numbers)) for w in found]
        ids += of
    lengths = out["n_words"]
    all_ids = np.array(ids, np.int64)
    out["n_repeat_words"] = repeated_words(all_ids, lengths)
    known = np.array([common.get(w.lower().strip(b".,;:?!'\"()-"), n_common) for w in numbers], np.int64)
    if len(all_ids):
        document = np.repeat(np.arange(n), lengths)
        flat = np.bincount(document * (n_common + 1) + known[all_ids], minlength=n * (n_common + 1))
        words = flat.reshape(n, n_common + 1)
    return out | {"classes": classes, "words": words}


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``CHUNK_WORDS`` words."""
    start = words = 0
    for i, text in enumerate(texts):
        words += len(text) // 5
        if words > CHUNK_WORDS:
            yield start, i + 1
            start, words = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _numbers(common: dict[str, list[str]]) -> dict[bytes, int]:
    return {w.encode(): i for i, w in enumerate(sorted({w for words in common.values() for w in words}))}


def measured(docs: DataFrame, doc_id: str, text: str, lang: str, common: dict[str, list[str]]) -> DataFrame:
    """``doc_id, lang``, base counts and both histograms of every document."""
    number = _numbers(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for start, end in _slices(texts):
                found = measure_texts(texts[start:end], number, len(number))
                part = batch.slice(start, end - start)
                columns = [part.column(0), part.column(1), *[pa.array(found[c]) for c in COUNTS]]
                columns += [pa.array(list(found[h]), pa.list_(pa.int64())) for h in ("classes", "words")]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *COUNTS, "classes", "words"])

    columns = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), text_of(text).alias("text"))
    longs = ", ".join(f"{c} bigint" for c in COUNTS)
    more = T.StructType.fromDDL(f"lang string, {longs}, classes array<bigint>, words array<bigint>")
    return columns.mapInArrow(run, T.StructType([columns.schema[0], *more.fields]))


ADDED = ["character_distance", "word_distance"]


def base_failed(found: dict[str, np.ndarray]) -> np.ndarray:
    return (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])


def distances(found: dict[str, np.ndarray], langs: list, references: dict) -> list[np.ndarray]:
    """Both distances of documents from their languages' references; a reference may lack words."""
    names, out = np.array(langs, object), []
    own = np.array([name in references for name in langs], bool)
    for at, kind in enumerate(("classes", "words")):
        counts, least = found[kind].astype(float), np.zeros(len(langs))
        # documents of no known language are held against those that have both references
        some = np.flatnonzero(~own)
        listed = [v[at] for v in references.values() if v[1] is not None]
        if len(some) and listed:
            least[some] = np.min([distance(counts[some], v) for v in listed], axis=0)
        for k in {n for n, known in zip(langs, own.tolist(), strict=True) if known}:
            here = np.flatnonzero(names == k)
            if references[k][at] is not None:
                least[here] = distance(counts[here], references[k][at])
        out.append(least)
    return out


def far(found: dict[str, np.ndarray], both: list[np.ndarray], limits: Limits) -> np.ndarray:
    """Documents that are too far from their language, and long enough to tell."""
    out = np.zeros(len(both[0]), bool)
    for value, length, limit, least in (
        (both[0], found["word_chars"], limits.characters, limits.least_characters),
        (both[1], found["n_words"], limits.words, limits.least_words),
    ):
        out |= (length >= least) & (value > limit[0] + limit[1] / np.sqrt(np.maximum(length, 1)))
    return out


def _judged(rows: DataFrame, references: dict, limits: Limits) -> DataFrame:
    """``rows`` of measures with ``base_failed``, both distances and ``kept``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {c: batch.column(c).to_numpy() for c in COUNTS}
            for kind in ("classes", "words"):
                found[kind] = batch.column(kind).flatten().to_numpy().reshape(batch.num_rows, -1)
            failed, both = base_failed(found), distances(found, batch.column("lang").to_pylist(), references)
            added = [failed, *both, ~failed & ~far(found, both, limits)]
            names = [*batch.schema.names, "base_failed", *ADDED, "kept"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, added)], names)

    more = T.StructType.fromDDL(f"base_failed boolean, {ADDED[0]} double, {ADDED[1]} double, kept boolean")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *more.fields]))


def _sums(rows: DataFrame, n_words: int, known: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray | None]]:
    """Both histograms summed per listed language, character classes for others with documents enough: a bounded number of rows."""
    entries = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(CLASSES)]
    entries += [F.sum(F.get("words", F.lit(i))).alias(f"w{i}") for i in range(n_words)]
    listed = F.col("lang").isin(known)
    summed = rows.filter("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), *entries)
    others = summed.filter(~listed & (F.col("docs") >= LEAST_DOCS)).orderBy(F.col("docs").desc(), "lang").limit(MOST_LANGUAGES)
    found = [*summed.filter(listed).collect(), *others.collect()]
    return {
        r["lang"]: (
            np.array([r[f"c{i}"] for i in range(CLASSES)], float),
            np.array([r[f"w{i}"] for i in range(n_words)], float) if r["lang"] in known else None,
        )
        for r in found
    }


def _references(rows: DataFrame, limits: Limits, common: dict[str, list[str]]) -> dict:
    """References of the languages, summed twice: the second time without what is far from the first."""
    n_words, known = len(_numbers(common)) + 1, sorted(common)
    first = _sums(_judged(rows, {}, limits).filter("not base_failed"), n_words, known)
    return {**first, **_sums(_judged(rows, first, limits).filter("kept"), n_words, known)}


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    limits: Limits | None = None, common: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Per row: ``doc_id``, base counts, ``base_failed``, both distances and ``kept``."""
    limits, common = limits or Limits(), common or COMMON
    rows = stored(measured(docs, doc_id, text, lang, common), "quality")
    return _judged(rows, _references(rows, limits, common), limits).drop("classes", "words", "lang")


def keep_good(
    docs: DataFrame, text: str = "text", lang: str = "lang",
    limits: Limits | None = None, common: dict[str, list[str]] | None = None,
) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they have.

    Documents are measured a second time once the references are known, so no text is shuffled.
    """
    limits, common = limits or Limits(), common or COMMON
    references = _references(stored(measured(docs, lang, text, lang, common).drop("doc_id"), "quality"), limits, common)
    number = _numbers(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(text).cast(pa.binary()).to_pylist()]
            langs = batch.column(lang).to_pylist()
            for start, end in _slices(texts):
                found = measure_texts(texts[start:end], number, len(number))
                both = distances(found, langs[start:end], references)
                good = ~base_failed(found) & ~far(found, both, limits)
                yield batch.slice(start, end - start).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
