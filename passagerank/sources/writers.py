"""Writers of run files.  A file set is range-partitioned by (query, position), so a long ranking may span files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _line(sep: str, *columns: Column) -> Column:
    return F.concat_ws(sep, *[c.cast("string") for c in columns]).alias("value")


def _write(run: DataFrame, line: Column, path: str, order: list[str], mode: str) -> None:
    (
        run.repartitionByRange("qid", *order)
        .sortWithinPartitions("qid", *order)
        .select(line)
        .write.mode(mode)
        .text(path)
    )


# The run names that the original writers use.
BM25_RUN, RERANKED_RUN, LEARNED_RUN = "bm25", "MonoT5", "pyterrier"


def trec_line(name: str = BM25_RUN, round_to: int | None = 2) -> Column:
    score = F.col("score") if round_to is None else F.round("score", round_to)
    return _line(" ", F.col("qid"), F.lit("Q0"), F.col("doc_id"), F.col("rank"), score, F.lit(name))


def reranked_line(form: str, name: str, compat: bool = False) -> Column:
    """Comma form, or tab form; ``compat`` puts a space between rank and score as old files have it."""
    qid, doc, rank, score = (F.col(c) for c in ("qid", "doc_id", "rank", "score"))
    if form == "csv":
        return _line(",", qid, F.lit("Q0"), doc, rank, score, F.lit(name))
    if form == "tsv":
        rank_score = [_line(" ", rank, score)] if compat else [rank, score]
        return _line("\t", qid, F.lit("Q0"), doc, *rank_score, F.lit(name))
    raise ValueError("form is 'csv' or 'tsv'")


def form_of(path: str) -> str:
    """Output form chosen by the path, as run scripts do."""
    for form in ("tsv", "csv"):
        if f".{form}" in path:
            return form
    raise ValueError(f"{path}: use a path with .csv or .tsv")


def write_run_trec(run: DataFrame, path: str, name: str = BM25_RUN, mode: str = "errorifexists") -> None:
    _write(run, trec_line(name), path, ["rank"], mode)


def write_run_plain(run: DataFrame, path: str, sep: str = " ", mode: str = "errorifexists") -> None:
    line = _line(sep, F.col("qid"), F.col("doc_id"), F.col("rank"), F.col("score"))
    _write(run, line, path, ["rank"], mode)


def write_run_reranked(
    run: DataFrame,
    path: str,
    name: str = RERANKED_RUN,
    form: str | None = None,
    compat: bool = False,
    mode: str = "errorifexists",
) -> None:
    _write(run, reranked_line(form or form_of(path), name, compat), path, ["rank"], mode)


def write_run_ltr(run: DataFrame, path: str, name: str = LEARNED_RUN, mode: str = "errorifexists") -> None:
    """Learned run: rows in candidate order (``prior_rank``), ``rank`` by the new score."""
    _write(run, trec_line(name, round_to=None), path, ["prior_rank"], mode)


def write_run_nb(run: DataFrame, path: str, form: str | None = None, mode: str = "errorifexists") -> None:
    """Four fields, space-separated; or tabs with a space before the score."""
    qid, doc, rank, score = (F.col(c) for c in ("qid", "doc_id", "rank", "score"))
    if (form or form_of(path)) == "csv":
        line = _line(" ", qid, doc, rank, score)
    else:
        line = _line("\t", qid, doc, _line(" ", rank, score))
    _write(run, line, path, ["rank"], mode)


def corpus_json() -> Column:
    record = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("contents"))
    return F.to_json(record).alias("value")


def corpus_to_jsonl(corpus: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Collection to JSONL shards, one per input split; no exchange."""
    corpus.select(corpus_json()).write.mode(mode).text(path)
