"""English suffix stripping (Porter 1980) for Arrow batches.

The rules are data: each step is a list of ``(suffix, replacement)`` pairs
tried longest suffix first.  Words of one or two characters are left alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need no copy of this package: the functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMO_WORDS = 500_000

# The suffix tables of Porter (1980).
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

_BY_LENGTH_2 = sorted(STEP_2, key=lambda rule: -len(rule[0]))
_BY_LENGTH_3 = sorted(STEP_3, key=lambda rule: -len(rule[0]))
_BY_LENGTH_4 = sorted(STEP_4, key=lambda suffix: -len(suffix))


def _shape(word: str) -> str:
    """One ``c`` or ``v`` per character; ``y`` is a vowel after a consonant."""
    out = []
    for ch in word:
        if ch in "aeiou":
            out.append("v")
        elif ch == "y" and out and out[-1] == "c":
            out.append("v")
        else:
            out.append("c")
    return "".join(out)


def _measure(stem: str) -> int:
    """Number of vowel-to-consonant changes."""
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_syllable(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _plural(w: str) -> str:
    if w.endswith(("sses", "ies")):
        return w[:-2]
    if w.endswith("s") and not w.endswith("ss"):
        return w[:-1]
    return w


def _past(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if not _has_vowel(stem):
                return w
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_consonant(stem) and stem[-1] not in "lsz":
                return stem[:-1]
            if _measure(stem) == 1 and _short_syllable(stem):
                return stem + "e"
            return stem
    return w


def _replace_first(w: str, rules) -> str:
    for suffix, replacement in rules:
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            return stem + replacement if _measure(stem) > 0 else w
    return w


def _drop_suffix(w: str) -> str:
    for suffix in _BY_LENGTH_4:
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if suffix == "ion" and not stem.endswith(("s", "t")):
                return w
            return stem if _measure(stem) > 1 else w
    return w


def porter(word: str) -> str:
    """Stem of one lower-case token."""
    if len(word) < 3:
        return word
    w = _past(_plural(word))
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _replace_first(w, _BY_LENGTH_2)
    w = _replace_first(w, _BY_LENGTH_3)
    w = _drop_suffix(w)
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_syllable(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


class _Memo(dict):
    """Stems already worked out by this task, emptied when it grows too big."""

    def __missing__(self, word: str) -> str:
        if len(self) >= MEMO_WORDS:
            self.clear()
        stem = self[word] = porter(word)
        return stem


@F.pandas_udf(T.StringType())
def stem_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for words in batches:
        yield words.map(porter, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_arrays(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    memo = _Memo()
    for arrays in batches:
        yield arrays.map(lambda words: [memo[w] for w in words], na_action="ignore")
