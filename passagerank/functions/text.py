"""Text analysis as native column expressions.

Everything here stays in the JVM except the optional stemmer, which is one
Arrow call over token arrays with a bounded memo per Python worker: no shuffle,
whatever the size of the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.functions.porter import stem_arrays

# Letters and digits, joined by single dots or apostrophes.  The possessive
# "*+" keeps the regex engine iterative on long dotted strings.
TOKEN_PATTERN = "[\\p{L}\\p{N}]+(?:[.'’][\\p{L}\\p{N}]+)*+"

# The usual 33 English stop words of full-text search.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def raw_tokens(column: str | Column) -> Column:
    """Lower-cased tokens in text order, nothing removed."""
    return F.regexp_extract_all(F.lower(_col(column)), F.lit(TOKEN_PATTERN), F.lit(0))


def tokens(
    column: str | Column,
    stemmer: str | None = "porter",
    stopwords: tuple[str, ...] = STOPWORDS,
) -> Column:
    """Analyzed terms in text order: tokenise, lower, drop possessive and stop words, stem."""
    bare = F.transform(
        raw_tokens(column),
        lambda t: F.when(
            F.endswith(t, F.lit("'s")) | F.endswith(t, F.lit("’s")),
            F.substring(t, F.lit(1), F.length(t) - 2),
        ).otherwise(t),
    )
    kept = F.filter(bare, lambda t: ~t.isin(*stopwords)) if stopwords else bare
    kept = F.coalesce(kept, F.array().cast("array<string>"))
    if stemmer is None:
        return kept
    if stemmer == "porter":
        return stem_arrays(kept)
    raise ValueError(f"unknown stemmer {stemmer!r}; use 'porter' or None")


def strip_punctuation(column: str | Column) -> Column:
    """Delete (not blank) the 32 ASCII punctuation characters."""
    return F.regexp_replace(_col(column), r"[\p{Punct}]", "")


def with_term_groups(df: DataFrame, token_column: str, out: str) -> DataFrame:
    """Add ``out``: the distinct terms of a token array as ``(term, tf, positions)``.

    A document is one row, so its terms are grouped inside the row by a sort
    and two linear passes over an array, not by a shuffle of every token.  The
    helper columns are separate projections because each is read many times.
    """
    pairs = df.withColumn(
        "__pairs",
        F.sort_array(
            F.transform(token_column, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
        ),
    )
    heads = pairs.withColumn(
        "__heads",
        F.filter(
            F.transform(
                "__pairs",
                lambda p, i: F.when(
                    (i == 0) | (p["term"] != F.get("__pairs", i - 1)["term"]), i
                ),
            ),
            lambda i: i.isNotNull(),
        ),
    )

    def group(head: Column, ordinal: Column) -> Column:
        after = F.coalesce(F.get("__heads", ordinal + 1), F.size("__pairs"))
        return F.struct(
            F.get("__pairs", head)["term"].alias("term"),
            (after - head).cast("int").alias("tf"),
            F.transform(
                F.slice("__pairs", head + 1, after - head), lambda p: p["pos"]
            ).alias("positions"),
        )

    return heads.withColumn(out, F.transform("__heads", group)).drop("__pairs", "__heads")
