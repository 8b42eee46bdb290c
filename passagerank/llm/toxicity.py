"""Toxicity of texts whose words may be disguised.

A noisy channel turns letters into digits and signs, repeats them or spaces them out.
Every distinct token that it may have made becomes a lattice of the letters it may stand for; Viterbi decoding
under a character trigram model, counted over all documents, restores the likeliest word.  Restored and
plain words are scored by word and character-piece log-odds learned from labels.

Learning takes a sample of at most about ``max_docs`` labelled rows, chosen by a hash of the id.  Its
halves are weighed by what the other one taught to calibrate the score.  Everything else reads
all rows.

Edge cases: null and empty texts are scored by their (zero) evidence; rows without a label are scored like
others; without labels of both kinds every score is the share of label 1 (0 without labels);
repeated rows are scored each; an empty table gives no rows; texts are read whole; extra columns are not read,
whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.llm.shared import per_worker, stored, text_of

#: Labelled rows that are learned from, at most about so many.
MAX_DOCS = 20_000
#: Toxic documents a piece must occur in, its least log-odds and their least size in standard errors.
LEAST_DOCS, LEAST_WEIGHT, LEAST_SIGMA = 5, 2.0, 5.0
#: Lengths of a word's beginnings, and of the pieces inside it.
BEGINNINGS, PIECE = range(3, 9), 5
#: Before a piece: it is met in several distinct words of a text.
AGAIN = b"+"
#: Greatest weights that count on their own.
TOP = 4
#: Distinct tokens a worker remembers.
MEMO = 300_000
#: Fixed values of the channel: what a sign may stand for, and signs that only separate.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
SEPARATORS = " ._*~-'"
AS_IT_IS, DISGUISED, REPEATED, SILENT = map(math.log, (0.9, 0.5, 0.05, 0.3))
EDGES = b"".join(bytes([b]) for b in range(33, 127) if not chr(b).isalnum())
#: Letters and their stand-ins one by one with white space between; a letter beside a stand-in; a separator inside a word; a
#: doubled letter: what the channel may have made.  Signs that only close or open a word are not part of it.
SPACED = re.compile(rb"(?<!\S)[a-z0-9@$!|+](?:\s+[a-z0-9@$!|+]){2,}(?!\S)")
SPELLED = frozenset(bytes([b]) for b in b"abcdefghijklmnopqrstuvwxyz0123456789@$!|+")
BESIDE = re.compile(rb"[a-z][0-9@$!|+(]|[0-9@$!|+][a-z]")
PARTED = re.compile(rb"[a-z0-9@$!|+][._*~-]+[a-z]|[a-z][._*~-]+[a-z0-9@$!|+]")
DOUBLED = re.compile(rb"([a-z])\1")
OPENING, CLOSING = b"([{<\"'", b"!.,;:?)]}>\"'"
#: Symbols of the language model: 0 is no letter, 1 to 26 the letters, 27 any other character.
SYMBOLS = 28


def trigram_counts(text: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[128:] = 27
    codes = table[np.frombuffer(b" " + text.lower() + b" ", np.uint8)]
    keys = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
    return np.bincount(keys, minlength=SYMBOLS**3)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log-probability of a symbol after two others, smoothed by the shorter contexts."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 4 * p1) / (two.sum(axis=1, keepdims=True) + 4)
    p3 = (three + 4 * p2[None]) / (three.sum(axis=2, keepdims=True) + 4)
    return np.log(p3)


def _channel(sign: str) -> tuple[list[tuple[int, float]], bool]:
    """The letters that a sign may stand for, with their costs, and whether it may stand for nothing."""
    if "a" <= sign <= "z":
        return [(ord(sign) - 96, AS_IT_IS)], False
    letters = STANDS_FOR.get(sign, "")
    return [(ord(c) - 96, DISGUISED - math.log(len(letters))) for c in letters], sign in SEPARATORS or not letters


CHANNEL = {chr(c): _channel(chr(c)) for c in range(128)}


def restore(span: str, model: list) -> str:
    """The likeliest word behind a disguised span; states are the last two letters."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for sign in span:
        options, silent = CHANNEL.get(sign) or _channel(sign)
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for state, (score, path) in states.items():
            second = state[1]
            row = model[state[0]][second]
            for letter, cost in options:
                made, total = (second, letter), score + cost + row[letter]
                if made not in after or total > after[made][0]:
                    after[made] = (total, (path, letter))
                if letter == second:
                    total = score + cost + REPEATED
                    if state not in after or total > after[state][0]:
                        after[state] = (total, path)
            if silent and (state not in after or score + SILENT > after[state][0]):
                after[state] = (score + SILENT, path)
        states = after
    path = max((score + model[a][b][0], i, path) for i, ((a, b), (score, path)) in enumerate(states.items()))[2]
    letters = []
    while path:
        path, letter = path
        letters.append(chr(letter + 96))
    return "".join(reversed(letters))


def disguised(token: bytes) -> bool:
    """Whether the channel may have made the token of another word."""
    core = token.lstrip(OPENING).rstrip(CLOSING)
    if core.isalpha():  # letters a to z alone: the other two need a sign or a digit
        return bool(DOUBLED.search(core))
    return bool(BESIDE.search(core) or DOUBLED.search(core) or PARTED.search(core))


def pieces(word: bytes) -> list[bytes]:
    """The word, its beginnings and the pieces inside it, with marks at its ends."""
    if word.isascii():
        begun, size = b"^" + word, len(word)
        begins = [begun[: n + 1] for n in range(BEGINNINGS.start, min(BEGINNINGS.stop, size))]
        return [begun + b"$", *begins, *[word[i : i + PIECE] for i in range(1, size - PIECE + 1)]]
    text = word.decode("utf-8", "ignore")
    begins = [b"^" + text[:n].encode() for n in BEGINNINGS if n < len(text)]
    return [b"^" + word + b"$", *begins, *[text[i : i + PIECE].encode() for i in range(1, len(text) - PIECE + 1)]]


def words_of(token: bytes, model: list | None) -> list[bytes]:
    """A token without signs at its ends, and what it restores to if it looks disguised."""
    plain = token.strip(EDGES)
    if model is None or not disguised(token):
        return [plain] if plain else []
    return [plain, restore(token.decode("utf-8", "ignore"), model).encode()]


def tokens_of(text: bytes) -> Counter[bytes]:
    """Tokens of a text and how often they occur, with spaced-out letters as one token each."""
    low = text.lower()
    listed = low.split()
    found = Counter(listed)
    # the pattern needs three such tokens in a row: most texts have none, and are not searched
    if b"\1\1\1" in bytes(map(SPELLED.__contains__, listed)):
        found.update(b" ".join(m.group().split()) for m in SPACED.finditer(low))
    return found


def token_words(token: bytes, model: list | None) -> list[bytes]:
    if b" " in token:
        return [restore(token.decode("utf-8", "ignore"), model).encode()] if model is not None else []
    return words_of(token, model)


@dataclass
class Model:
    language: np.ndarray
    weights: dict[bytes, float]
    calibration: np.ndarray
    prior: float


class Pieces:
    """The distinct pieces of a token's words, remembered while there is room."""

    def __init__(self, language: np.ndarray):
        self.model, self.memo = language.tolist(), {}

    def of(self, token: bytes) -> tuple[bytes, ...]:
        found = self.memo.get(token)
        if found is None:
            found = tuple({p for w in token_words(token, self.model) for p in pieces(w)})
            if len(self.memo) >= MEMO // 10:
                self.memo.clear()
            self.memo[token] = found
        return found


class Scorer:
    """Evidence of a text: its greatest weights, and numbers of weighty and of all words."""

    def __init__(self, language: np.ndarray, weights: dict[bytes, float]):
        self.model, self.weights, self.memo = language.tolist(), weights, {}
        self.known = {p.removeprefix(AGAIN) for p in weights}

    def weighty(self, token: bytes) -> tuple[bytes, ...]:
        """The pieces of a token that may weigh, alone or met in several words."""
        found = self.memo.get(token)
        if found is None:
            listed = [pieces(w) for w in token_words(token, self.model)]
            found = tuple(self.known.intersection(listed[0] if len(listed) == 1 else [p for found in listed for p in found]))
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[token] = found
        return found

    def evidence(self, text: bytes) -> list[float]:
        tokens = tokens_of(text)
        of = {t: found for t in tokens if (found := self.weighty(t))}
        times = Counter(p for found in of.values() for p in found)
        get = self.weights.get
        value = {p: max(get(p, 0.0), get(AGAIN + p, 0.0) if n > 1 else 0.0) for p, n in times.items()}
        weights = {t: w for t, found in of.items() if (w := max(map(value.__getitem__, found)))}
        top = [*sorted(weights.values(), reverse=True)[:TOP], *[0.0] * TOP][:TOP]
        all_words, weighty = sum(tokens.values()), sum(map(tokens.__getitem__, weights))
        share = math.sqrt(weighty / all_words) if all_words else 0.0
        return [*top, math.log1p(len(weights)), math.log1p(weighty), share, math.log1p(all_words)]


def _trigrams(rows: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                counts += trigram_counts(text.as_py())
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["k", "n"])

    found = rows.mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SYMBOLS**3, np.int64)
    for r in found:
        counts[r["k"]] = r["n"]
    return counts


def _piece_counts(rows: DataFrame, language: np.ndarray, among=None) -> DataFrame:
    """``half, piece, n``: documents with each piece (of those in the broadcast set, if one is given)."""
    name = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, only = per_worker("toxic-pieces", name, lambda: Pieces(language)), among.value if among else None
        for batch in batches:
            counts: Counter[tuple[int, bytes]] = Counter()
            texts = batch.column("text").cast(pa.binary())
            for half, text in zip(batch.column("half").to_pylist(), texts, strict=True):
                times: Counter[bytes] = Counter()
                for token in tokens_of(text.as_py()):
                    times.update(held.of(token))
                found = {*times, *(AGAIN + p for p, n in times.items() if n > 1)}
                counts.update((half, p) for p in (found if only is None else found & only))
            columns = [pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["half", "piece", "n"])

    return rows.mapInArrow(run, "half int, piece binary, n bigint").groupBy("half", "piece").agg(F.sum("n").alias("n"))


def weigh(in_toxic: dict, in_clean: dict, toxic: int, clean: int) -> dict[bytes, float]:
    """Log-odds of the pieces that tell toxic texts apart, by a likelihood-ratio test."""
    weights, share = {}, toxic / max(1, toxic + clean)
    for piece, t in in_toxic.items():
        c = in_clean.get(piece, 0)
        weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if t < LEAST_DOCS or weight < LEAST_WEIGHT:
            continue
        expected = (t + c) * share
        ratio = 2 * (t * math.log(t / expected) + (c * math.log(c / (t + c - expected)) if c else 0.0))
        if ratio >= LEAST_SIGMA**2:
            weights[piece] = weight
    return weights


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Intercept and coefficients by Newton steps with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    penalty = np.eye(len(beta)) * ridge * max(1.0, len(x)) / 100
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, design.T @ (y - p) - penalty @ beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    max_docs: int = MAX_DOCS,
) -> Model:
    spark = docs.sparkSession
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    spread = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(11)), 1) / float(1 << 63)
    n = known.count()
    share = min(1.0, max_docs / n) if n else 0.0
    rows = stored(
        docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
        .join(known.filter(spread <= share), "doc_id")
        .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(2)).cast("int")),
        "toxic-sample",
    )
    sizes = {(r["half"], r["label"]): r["count"] for r in rows.groupBy("half", "label").count().collect()}
    every = sum(sizes.values())
    prior = sum(v for k, v in sizes.items() if k[1]) / every if every else 0.0
    language = language_model(_trigrams(docs.select(text_of(text).alias("text"))))
    if not all(sizes.get((half, label)) for half in (0, 1) for label in (0, 1)):
        return Model(language, {}, np.zeros(0), prior)
    pieces_of = _piece_counts(rows.filter("label = 1"), language)
    often = pieces_of.groupBy("piece").agg(F.sum("n").alias("all")).filter(F.col("all") >= LEAST_DOCS)
    in_toxic, in_clean = ({}, {}, {}), ({}, {}, {})
    for r in pieces_of.join(often, "piece").collect():
        in_toxic[r["half"]][bytes(r["piece"])] = r["n"]
    among = spark.sparkContext.broadcast({*in_toxic[0], *in_toxic[1]})
    for r in _piece_counts(rows.filter("label = 0"), language, among).collect():
        in_clean[r["half"]][bytes(r["piece"])] = r["n"]
    for both in (in_toxic, in_clean):
        both[2].update(Counter(both[0]) + Counter(both[1]))
    x, y = [], []
    for half in (0, 1):
        other = weigh(in_toxic[1 - half], in_clean[1 - half], sizes.get((1 - half, 1), 0), sizes.get((1 - half, 0), 0))
        for r in _evidence(rows.filter(F.col("half") == half), language, other, ["label"]).collect():
            x.append(r["evidence"])
            y.append(float(r["label"]))
    toxic, clean = (sum(sizes.get((half, label), 0) for half in (0, 1)) for label in (1, 0))
    weights = weigh(in_toxic[2], in_clean[2], toxic, clean)
    return Model(language, weights, fit_logistic(np.array(x), np.array(y)), prior)


def _evidence(rows: DataFrame, language: np.ndarray, weights: dict, more: list[str]) -> DataFrame:
    """``doc_id``, ``more`` columns and the figures of evidence."""
    shipped, name = rows.sparkSession.sparkContext.broadcast((language, weights)), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_worker("toxic-scorer", name, lambda: Scorer(*shipped.value))
        for batch in batches:
            found = [scorer.evidence(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            kept = [batch.column(c) for c in ("doc_id", *more)]
            figures = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*kept, figures], ["doc_id", *more, "evidence"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", *more))
    return rows.mapInArrow(run, f"{kinds}, evidence array<double>")


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` for every row, from its text alone."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    if not len(model.calibration):
        return rows.select("doc_id", F.lit(float(model.prior)).alias("score"))
    found = _evidence(rows, model.language, model.weights, [])
    first, *rest = [float(v) for v in model.calibration]
    logit = F.lit(first)
    for i, factor in enumerate(rest):
        logit = logit + F.get("evidence", F.lit(i)) * factor
    return found.select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"))
