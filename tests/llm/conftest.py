from __future__ import annotations

import pytest

LONG = "lorem ipsum " * 3000 + "z" * 3000
SCHEMA = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, "
    "size STRING, fp STRING, `key` STRING, ids STRING, kept STRING, half STRING, row STRING, spans STRING, n STRING"
)
CLASHING = ("size", "fp", "key", "ids", "kept", "half", "row", "spans", "n")
PROSE = (
    "The sum of it is in the end what they had from a day of work and that was for the best. "
    "She is by the river with a boat on her own, as it was this year or the one before. "
) * 3


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *("x",) * len(CLASHING))


ROWS = [
    _row(1, PROSE), _row(2, None), _row(3, ""), _row(4, LONG, None), _row(5, PROSE + "more", "en", None),
    _row(6, PROSE), _row(6, PROSE), _row(7, "one", None, None), _row(8, "   \n\t "), _row(None, PROSE[:200], "xx", "b"),
    _row(None, None, None, None), _row(9, "é▁   mail me: a.b@c.org or +1 (555) 123-4567\n" * 2, "fr", "é"),
    _row(10, PROSE.upper().replace(" ", "%%% "), "en", "b"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """``doc_id`` and text of the smallest table, on the driver."""
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
