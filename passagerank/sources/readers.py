"""Readers.  Schemas are fixed, malformed input fails, and every row keeps its place in the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank import schemas
from passagerank.functions.text import strip_punctuation
from passagerank.operators.stance import stance_to_label
from passagerank.sources.quoted import read_quoted

# Stored metadata lengths of the passage index.
META_LENGTHS = (20, 4096)

# File names of the stance splits.
STANCE_FILES = {
    "train": ("train_bodies.csv", "train_stances.csv"),
    "competition": ("competition_test_bodies.csv", "competition_test_stances.csv"),
    "test": ("test_bodies.csv", "test_stances_unlabeled.csv"),
}


def _place() -> Column:
    """Sortable position of a row: file, split, line."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).alias("seq")


def _separated(spark: SparkSession, path: str, schema, sep: str, keep_order: bool) -> DataFrame:
    df = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return df.select("*", _place()) if keep_order else df


def read_topics(spark: SparkSession, path: str, clean: bool = False) -> DataFrame:
    """``qid, query, seq`` from a tab-separated file; ``clean`` deletes punctuation."""
    topics = _separated(spark, path, schemas.TOPICS, "\t", True)
    topics = topics.withColumn("query", F.trim("query"))
    return topics.withColumn("query", strip_punctuation("query")) if clean else topics


def read_qrels(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    return _separated(spark, path, schemas.QRELS, sep, True).drop("q0")


def read_run_trec(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return _separated(spark, path, schemas.RUN_TREC, sep, False).drop("q0", "run_name")


def read_run_plain(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return _separated(spark, path, schemas.RUN_PLAIN, sep, False)


def corpus_fields(line: Column) -> tuple[Column, Column]:
    """Document id and text of one collection line; anything but two fields is an error."""
    parts = F.split(line, "\t")
    checked = F.when(F.size(parts) == 2, parts).otherwise(
        F.raise_error(F.concat(F.lit("expected two tab-separated fields: "), line)).cast("array<string>")
    )
    return F.get(checked, F.lit(0)), F.get(checked, F.lit(1))


def stored_meta(doc_id: Column, text: Column, lengths: tuple[int, int] = META_LENGTHS) -> tuple[Column, Column]:
    """Metadata cut to the stored lengths."""
    return F.substring(doc_id, 1, lengths[0]), F.substring(text, 1, lengths[1])


def read_corpus(spark: SparkSession, path: str, meta_lengths: tuple[int, int] | None = None) -> DataFrame:
    """Passage collection, one ``id <tab> text`` line each.

    Whole texts are kept; ``meta_lengths`` adds the cut copies a metadata store keeps.
    """
    doc_id, text = corpus_fields(F.col("value"))
    corpus = spark.read.text(path).select(doc_id.alias("doc_id"), text.alias("text"))
    if meta_lengths is None:
        return corpus
    meta_id, meta_text = stored_meta(F.col("doc_id"), F.col("text"), meta_lengths)
    return corpus.select("*", meta_id.alias("meta_doc_id"), meta_text.alias("meta_text"))


def read_corpus_jsonl(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(schemas.CORPUS_JSON).option("mode", "FAILFAST").json(path)
    return df.select(F.col("id").alias("doc_id"), F.col("contents").alias("text"))


def _first_skipped(df: DataFrame, skip: bool) -> DataFrame:
    """Compatibility with a loader that takes the first record for a second header line."""
    if not skip:
        return df
    first = df.agg(F.min("seq").alias("s")).first()["s"]
    return df.filter(
        (F.col("seq.file") != first["file"]) | (F.col("seq.block") != first["block"]) | (F.col("seq.line") != first["line"])
    )


def _non_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def read_stances(
    spark: SparkSession, folder: str, split: str = "train", compat_skip_first: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(bodies, stances)`` with a ``label`` column, of 'train' or 'competition'."""
    if split not in ("train", "competition"):
        raise ValueError("labelled splits are 'train' and 'competition'")
    body_file, stance_file = STANCE_FILES[split]
    root = folder.rstrip("/")
    bodies = _first_skipped(read_quoted(spark, f"{root}/{body_file}", schemas.BODIES), compat_skip_first)
    stances = _first_skipped(read_quoted(spark, f"{root}/{stance_file}", schemas.STANCES), compat_skip_first)
    stances = stances.withColumn("label", stance_to_label(F.col("stance")))
    return _non_empty(bodies, "bodies"), _non_empty(stances, "stances")


def read_stances_unlabelled(
    spark: SparkSession, folder: str, files: tuple[str, str] = STANCE_FILES["test"]
) -> tuple[DataFrame, DataFrame]:
    """Headline and body pairs without a label."""
    root = folder.rstrip("/")
    bodies = read_quoted(spark, f"{root}/{files[0]}", schemas.BODIES)
    stances = read_quoted(spark, f"{root}/{files[1]}", schemas.STANCES_UNLABELLED)
    return _non_empty(bodies, "bodies"), _non_empty(stances, "stances")
