"""Suffix stripping as a chain of SQL projections: written apart from the Python stemmer, to check it.

A word carries its consonant/vowel pattern.  ``m`` of a stem is the number of
``vc`` changes in its pattern.
"""

from __future__ import annotations

# The suffix tables of Porter (1980), longest suffix first.
SECOND = (
    "ational:ate ization:ize iveness:ive fulness:ful ousness:ous tional:tion biliti:ble "
    "entli:ent ousli:ous ation:ate alism:al aliti:al iviti:ive enci:ence anci:ance izer:ize "
    "alli:al ator:ate logi:log bli:ble eli:e"
).split()
THIRD = "icate:ic ative: alize:al iciti:ic ical:ic ness: ful:".split()
FOURTH = (
    "ement ance ence able ible ment ant ent ion ism ate iti ous ive ize al er ic ou"
).split()


def _pattern(word: str) -> str:
    """Consonants c, vowels v.  A y is a vowel exactly after a consonant, and then the next y is not."""
    marked = f"regexp_replace({word}, '[^aeiouy]', 'c', 'g')"
    marked = f"regexp_replace({marked}, '[aeiou]', 'v', 'g')"
    # y-runs: after a consonant they alternate v c v ..., elsewhere c v c ...
    after_c = f"regexp_replace({marked}, '(^|v)y', '\\1c', 'g')"
    once = f"regexp_replace({after_c}, 'cy', 'cv', 'g')"
    twice = f"regexp_replace(regexp_replace({once}, '(^|v)y', '\\1c', 'g'), 'cy', 'cv', 'g')"
    return f"regexp_replace(regexp_replace({twice}, '(^|v)y', '\\1c', 'g'), 'cy', 'cv', 'g')"


def _m(word: str) -> str:
    return f"len(regexp_extract_all({_pattern(word)}, 'v+c'))"


def _cut(word: str, n: int) -> str:
    return f"left({word}, length({word})-{n})"


def _short(word: str) -> str:
    return f"(regexp_matches({_pattern(word)}, 'cvc$') AND NOT regexp_matches({word}, '[wxy]$'))"


def _vowel(word: str) -> str:
    return f"contains({_pattern(word)}, 'v')"


def _double(word: str) -> str:
    return (
        f"(length({word}) > 1 AND right({word},1) = left(right({word},2),1) "
        f"AND right({_pattern(word)},1) = 'c')"
    )


def _table(rules: list[str]) -> str:
    whens = []
    for rule in rules:
        suffix, replacement = rule.split(":")
        stem = _cut("w", len(suffix))
        whens.append(
            f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {_m(stem)} > 0 THEN {stem} || '{replacement}' ELSE w END"
        )
    return f"CASE WHEN length(term) < 3 THEN w {' '.join(whens)} ELSE w END"


def _fourth() -> str:
    whens = []
    for suffix in FOURTH:
        stem = _cut("w", len(suffix))
        condition = f"{_m(stem)} > 1"
        if suffix == "ion":
            condition = f"regexp_matches({stem}, '[st]$') AND {condition}"
        whens.append(f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {condition} THEN {stem} ELSE w END")
    return f"CASE WHEN length(term) < 3 THEN w {' '.join(whens)} ELSE w END"


STEPS = [
    # plural
    "CASE WHEN length(term) < 3 THEN w WHEN w LIKE '%sses' OR w LIKE '%ies' THEN " + _cut("w", 2)
    + " WHEN w LIKE '%ss' THEN w WHEN w LIKE '%s' THEN " + _cut("w", 1) + " ELSE w END",
    # past and progressive: mark what lost a suffix with a final '#'
    "CASE WHEN length(term) < 3 THEN w "
    f"WHEN w LIKE '%eed' THEN CASE WHEN {_m(_cut('w', 3))} > 0 THEN {_cut('w', 1)} ELSE w END "
    f"WHEN w LIKE '%ed' THEN CASE WHEN {_vowel(_cut('w', 2))} THEN {_cut('w', 2)} || '#' ELSE w END "
    f"WHEN w LIKE '%ing' THEN CASE WHEN {_vowel(_cut('w', 3))} THEN {_cut('w', 3)} || '#' ELSE w END "
    "ELSE w END",
    f"CASE WHEN w NOT LIKE '%#' THEN w WHEN regexp_matches({_cut('w', 1)}, '(at|bl|iz)$') THEN {_cut('w', 1)} || 'e' "
    f"WHEN {_double(_cut('w', 1))} AND NOT regexp_matches({_cut('w', 1)}, '[lsz]$') THEN {_cut('w', 2)} "
    f"WHEN {_m(_cut('w', 1))} = 1 AND {_short(_cut('w', 1))} THEN {_cut('w', 1)} || 'e' ELSE {_cut('w', 1)} END",
    # final y
    f"CASE WHEN length(term) > 2 AND w LIKE '%y' AND {_vowel(_cut('w', 1))} THEN {_cut('w', 1)} || 'i' ELSE w END",
    _table(SECOND),
    _table(THIRD),
    _fourth(),
    # final e, final ll
    f"CASE WHEN length(term) > 2 AND w LIKE '%e' AND ({_m(_cut('w', 1))} > 1 OR "
    f"({_m(_cut('w', 1))} = 1 AND NOT {_short(_cut('w', 1))})) THEN {_cut('w', 1)} ELSE w END",
    f"CASE WHEN length(term) > 2 AND w LIKE '%ll' AND {_m(_cut('w', 1))} > 1 THEN {_cut('w', 1)} ELSE w END",
]


def stems_of(vocabulary: str) -> str:
    """SELECT (term, stem) for a relation with a column ``term``."""
    sql = f"SELECT term, term AS w FROM {vocabulary}"
    for step in STEPS:
        sql = f"SELECT term, {step} AS w FROM ({sql})"
    return f"SELECT term, w AS stem FROM ({sql})"
