"""Pipeline over ``documents``: every stage calls one operator and works on all rows the one before kept.

Edge cases: null and empty texts fail the quality rules; rows of one id and text are one document to the near-copy stage; an empty
table goes through every stage; extra columns stay up to the last stage, which returns its own, but a name that begins with two
underscores is kept for the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passagerank.llm import mixing, pieces, pii, quality, simhash
from passagerank.llm.queries import TOKENIZERS
from passagerank.llm.shared import stored, table, text_of


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are far from their language go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose fingerprints of three-word shingles link at three bits or fewer the smallest id stays."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs, words=3, distance=3))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind; ``n_chars`` follows the text, where there is such a column."""
    found = pii.masked(docs, pii.train_field(pii.labelled_examples(spark)))
    if "n_chars" not in docs.columns:
        return found
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them: not at all, once or twice."""
    return mixing.copied(docs, mixing.mix(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text that is left, segmented with merge-dropout, every copy its own way, and decoded again."""
    given = docs.select("doc_id", "source", "lang", text_of("text").alias("text"))
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang")
    found = pieces.encode(
        given.withColumn("copy", F.row_number().over(same)), f"{TOKENIZERS}/piece_bpe_32k.model", copy="copy", check="lossless"
    )
    return found.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: Learned models and keyed draws: the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
