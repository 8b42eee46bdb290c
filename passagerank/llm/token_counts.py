"""Token counts under a byte-level BPE vocabulary: rank-synchronous merging of ragged arrays.

All distinct pre-tokens of a batch stand in one flat symbol array.  In every round each of them
looks up the ranks of its neighbouring pairs and applies its lowest-ranked pair at all places;
sequences without a pair leave with the number of symbols they have left.

Edge cases: null and empty texts have 0 tokens; the special strings of the vocabulary count as
one token each, as its library counts them; texts are never cut, whatever their length; an
empty table gives no rows; repeated rows are counted each; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagerank.llm.shared import text_of

#: Characters whose distinct pre-tokens are merged at a time: bounds a task's arrays.
CHUNK_CHARS = 3_000_000
NONE = np.iinfo(np.int32).max
#: White space, and how the vocabulary's library splits a text.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """The tables of a word-level BPE file: byte ids, merges in order of rank, special strings."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
    symbols = byte_symbols()
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return {
        "inner": np.array([vocab[s] for s in symbols], np.int32),
        "last": np.array([vocab[s + end] for s in symbols], np.int32),
        "merges": np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], np.int32).reshape(-1, 3),
        "special": [t["content"] for t in spec["added_tokens"]],
    }


class PairTable:
    """Pair of symbols to rank, looked up for whole arrays: open addressing at low load."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray, bits: int = 19):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        slots = self._slot(keys)
        for key, slot, rank in zip(keys, slots.tolist(), ranks.tolist(), strict=True):
            while self.ranks[slot] != NONE and self.keys[slot] != key:
                slot = (slot + 1) & self.mask
            if self.ranks[slot] == NONE:  # the first of equal pairs has the lowest rank
                self.keys[slot], self.ranks[slot] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots = self._slot(keys)
        out = np.where(self.keys[slots] == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((out == NONE) & (self.ranks[slots] != NONE))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            at = slots[open_]
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit & (self.ranks[at] != NONE)]
        return out


class Merger:
    """Counts the symbols that are left of byte strings once all merges are done."""

    def __init__(self, vocabulary: dict):
        self.inner, self.last = vocabulary["inner"], vocabulary["last"]
        merges = vocabulary["merges"]
        self.made = merges[:, 2]
        self.table = PairTable(merges[:, 0], merges[:, 1], np.arange(len(merges), dtype=np.int32))

    def count(self, words: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        some = lengths > 0
        symbols[ends[some] - 1] = self.last[data[ends[some] - 1]]
        out, who = lengths.copy(), np.flatnonzero(some)
        lengths = lengths[some]
        while len(who):
            starts = np.cumsum(lengths) - lengths
            ranks = np.full(len(symbols), NONE, np.int32)
            ranks[:-1] = self.table.find(symbols[:-1], symbols[1:])
            ranks[starts + lengths - 1] = NONE
            lowest = np.minimum.reduceat(ranks, starts)
            out[who] = lengths
            going = lowest != NONE
            if not going.any():
                break
            if not going.all():
                keep = np.repeat(going, lengths)
                symbols, ranks, who = symbols[keep], ranks[keep], who[going]
                lengths, lowest = lengths[going], lowest[going]
            sequence = np.repeat(np.arange(len(who)), lengths)
            at = np.flatnonzero(ranks == lowest[sequence])
            # of places that overlap (a a a) every second one counts, from the left
            follows = np.zeros(len(at), bool)
            follows[1:] = (np.diff(at) == 1) & (symbols[at[1:]] == symbols[at[1:] + 1])
            if follows.any():
                index = np.arange(len(at))
                first = np.maximum.accumulate(np.where(follows, 0, index))
                at = at[(index - first) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            lengths = lengths - np.bincount(sequence[at], minlength=len(who))
            symbols = symbols[keep]
        return out


def pre_tokens():
    """A function from text to its pre-tokens: normalized, lower-cased, split."""
    import unicodedata

    import regex

    split = regex.compile(PRE_TOKEN)
    spaces = re.compile(rf"[{SPACE}]+")
    wide = re.compile(r"[^\x00-\u02af]")

    def run(text: str) -> list[str]:
        if wide.search(text):
            text = spaces.sub(" ", unicodedata.normalize("NFC", text))
            # one character at a time: no rule for the end of words
            text = "".join(map(str.lower, text))
        else:
            text = text.lower()
        return split.findall(text)

    return run


def batch_counter(vocabulary: dict):
    """A function from texts to their token counts."""
    merger, tokens_of = Merger(vocabulary), pre_tokens()
    special = re.compile("|".join(map(re.escape, vocabulary["special"])) or r"(?!)")

    def tokens(text: str) -> tuple[int, list[str]]:
        if not special.search(text):
            return 0, tokens_of(text)
        parts = special.split(text)
        return len(parts) - 1, [t for p in parts for t in tokens_of(p)]

    def counted(found: list[tuple[int, list[str]]]) -> list[int]:
        distinct = list({t: None for _, words in found for t in words})
        of = dict(zip(distinct, merger.count([t.encode() for t in distinct]).tolist(), strict=True))
        return [extra + sum(map(of.__getitem__, words)) for extra, words in found]

    def run(texts: list[str]) -> list[int]:
        out, held, chars = [], [], 0
        for text in texts:
            held.append(tokens(text))
            chars += len(text)
            if chars > CHUNK_CHARS:
                out += counted(held)
                held, chars = [], 0
        return out + counted(held)

    return run


def count_tokens(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row, without begin and end tokens.

    The driver reads the vocabulary and sends its tables along; executors read no file.
    """
    tables = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = batch_counter(tables.value)
        for batch in batches:
            counts = pa.array(count(batch.column(2).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], ["doc_id", "n_bytes", "n_tokens"])

    columns = docs.select(
        F.col(doc_id).alias("doc_id"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"), text_of(text).alias("text")
    )
    kind = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
