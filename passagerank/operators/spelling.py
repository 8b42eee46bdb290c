"""Spelling correction of topics against the indexed vocabulary.

A word of edit distance at most two shares, intact, one of three equal pieces
of the right word, shifted by at most two places (pigeonhole partitioning, Li
et al. 2011).  The vocabulary, the big side, therefore carries three keys per
term; the few unknown words carry the substrings.  No signature grows with the
square of the word length, and no pair without a common piece is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.operators.sizing import measure, skew_join
from passagerank.operators.workspace import cut

MAX_EDITS = 2
_PIECES = MAX_EDITS + 1
# Signs before a word, the word, signs after it.
_CORE = r"(?s)^([^\p{L}\p{N}]*)(.*?)([^\p{L}\p{N}]*)$"


def _piece_start(length: Column, i: Column) -> Column:
    """0-based start of piece ``i`` of a word cut into three nearly equal pieces."""
    return F.floor(length * i / _PIECES).cast("int")


def _each(values: range) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values]))


def term_pieces(terms: DataFrame) -> DataFrame:
    """Three rows ``(len, piece, text)`` per term."""
    length = F.length("term")
    start, end = _piece_start(length, F.col("piece")), _piece_start(length, F.col("piece") + 1)
    return terms.withColumn("piece", _each(range(_PIECES))).select(
        "term", "df", length.alias("len"), "piece", F.substring("term", start + 1, end - start).alias("text")
    )


def word_pieces(words: DataFrame) -> DataFrame:
    """Substrings of a word that may equal a piece of a term of near length: at most 75 per word."""
    edits = range(-MAX_EDITS, MAX_EDITS + 1)
    placed = (
        words.withColumn("longer", _each(edits))
        .withColumn("len", F.length("word") + F.col("longer"))
        .filter(F.col("len") > 0)
        .withColumn("piece", _each(range(_PIECES)))
        .withColumn("shift", _each(edits))
        .withColumn("start", _piece_start(F.col("len"), F.col("piece")) + F.col("shift"))
        .withColumn("size", _piece_start(F.col("len"), F.col("piece") + 1) - F.col("start") + F.col("shift"))
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.length("word")))
    )
    cut = F.substring("word", F.col("start") + 1, F.col("size"))
    return placed.select("word", "len", "piece", cut.alias("text")).distinct()


def corrections(words: DataFrame, term_stats: DataFrame) -> DataFrame:
    """``(word, term)``: nearest known spelling by edit distance, then document frequency, then term.

    ``words`` are distinct and unknown to the vocabulary.
    """
    probes = word_pieces(words)
    keys = ["len", "piece", "text"]
    size = measure(probes, F.collect_set("len").alias("lens"))
    if size.small:
        # word lengths present are a handful of numbers: they let the vocabulary scan drop terms early
        near = term_stats.filter(F.length("term").isin(*(size.extra["lens"] or [-1])))
        pairs = term_pieces(near).join(F.broadcast(probes), keys)
    else:
        pairs = skew_join(term_pieces(term_stats), probes, keys)
    distance = F.levenshtein("word", "term", MAX_EDITS)
    near = pairs.select("word", "term", "df", distance.alias("d")).filter(F.col("d") >= 0)
    best = F.min(F.struct("d", (-F.col("df")).alias("rarity"), "term"))
    return near.groupBy("word").agg(best.alias("b")).select("word", F.col("b.term").alias("term"))


def spell_correct(topics: DataFrame, words: DataFrame, prepare=None) -> DataFrame:
    """Add ``corrected`` and ``changed``: every unknown word of the query replaced by its nearest known one.

    ``words(word, df)`` are the surface forms of the collection, stop words and
    inflected forms included; a word that is one of them stays.  Queries are split on
    single spaces and rejoined in place; signs around a word stay where they are.  ``prepare``
    maps a word to the form the table holds (lower case by default).
    """
    prepare = prepare or F.lower
    core = F.regexp_extract("original", _CORE, 2)
    asked = topics.select("qid", F.posexplode(F.split("query", " ")).alias("at", "original")).select(
        "qid", "at", "original", prepare(core).alias("word"),
        F.regexp_extract("original", _CORE, 1).alias("before"), F.regexp_extract("original", _CORE, 3).alias("after"),
    )
    # both are read several times below
    distinct = cut(asked.select("word").filter(F.col("word") != "").distinct())
    small = measure(distinct).small
    if small:
        known = words.join(F.broadcast(distinct), "word", "left_semi").select("word")
    else:
        known = words.select("word")
    unknown = cut(distinct.join(known, "word", "left_anti"))
    fixes = corrections(unknown, words.select(F.col("word").alias("term"), "df"))
    if small:  # no more corrections than distinct words, which were measured
        fixed = asked.join(F.broadcast(fixes), "word", "left")
    else:
        fixed = skew_join(asked, fixes, ["word"], "left")
    spelled = F.coalesce(F.concat("before", "term", "after"), F.col("original"))
    rejoined = fixed.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("at", spelled.alias("w")))).alias("ws"))
    rejoined = rejoined.select("qid", F.array_join(F.transform("ws", lambda w: w["w"]), " ").alias("corrected"))
    out = topics.join(rejoined, "qid")
    return out.withColumn("changed", F.col("corrected") != F.col("query"))


def changed_queries(corrected: DataFrame) -> DataFrame:
    """How many queries the correction changed."""
    return corrected.agg(F.count(F.when(F.col("changed"), 1)).alias("n_changed"))
