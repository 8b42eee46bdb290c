"""Fixed schemas of every file the engine reads.  Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


STR, INT, LONG, DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

CORPUS_JSON = _fields(("id", STR), ("contents", STR))
TOPICS = _fields(("qid", STR), ("query", STR))
QRELS = _fields(("qid", STR), ("q0", STR), ("doc_id", STR), ("rating", INT))
RUN_TREC = _fields(
    ("qid", STR), ("q0", STR), ("doc_id", STR), ("rank", INT), ("score", DBL), ("run_name", STR)
)
RUN_PLAIN = _fields(("qid", STR), ("doc_id", STR), ("rank", INT), ("score", DBL))
BODIES = _fields(("body_id", LONG), ("article_body", STR))
STANCES = _fields(("headline", STR), ("body_id", LONG), ("stance", STR))
STANCES_UNLABELLED = _fields(("headline", STR), ("body_id", LONG))
