"""Topics, judgements, runs and stances that Spark derives from the driver's tables.

Everything is a function of whole tables and grows with them.  What several
queries share (index, judgements, runs, files for the readers) is written once
per session under the shared workspace.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank.operators.features import attach_labels, features, filter_qrels
from passagerank.operators.index import Index, open_or_build
from passagerank.operators.ranking import top_k
from passagerank.operators.search import Score, scored, search_with_scores
from passagerank.operators.sizing import lookup_join
from passagerank.operators.workspace import workspace
from passagerank.sources import writers
from passagerank.sources.readers import STANCE_FILES

DEPTH = 1000
SEED = 42
_indexes: dict[tuple[str, int], Index] = {}
_written: set[str] = set()


class Testbed:
    """Derived tables of one data folder in one session."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.root = f"{workspace(spark)}/{self.sf_dir.strip('/').replace('/', '_')}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------- storage

    def _stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        if path not in _written:
            make().write.mode("overwrite").parquet(path)
            _written.add(path)
        return self.spark.read.parquet(path)

    def _files(self, name: str, write: Callable[[str], None]) -> str:
        path = f"{self.root}/files/{name}"
        if path not in _written:
            write(path)
            _written.add(path)
        return path

    # -------------------------------------------------------------- corpus

    @property
    def corpus(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text")

    @property
    def index(self) -> Index:
        """Unstemmed index, so that plain SQL can check every number."""
        path = f"{self.root}/index"
        key = (path, id(self.spark))
        if key not in _indexes:
            _indexes[key] = open_or_build(self.corpus, path, stemmer=None)
        return _indexes[key]

    @property
    def stemmed_index(self) -> Index:
        """The index as it is built by default."""
        path = f"{self.root}/stemmed"
        key = (path, id(self.spark))
        if key not in _indexes:
            _indexes[key] = open_or_build(self.corpus, path)
        return _indexes[key]

    # -------------------------------------------------------------- topics

    @property
    def topics(self) -> DataFrame:
        """Known-item topics: every benchmark passage is a query."""
        return self.table("benchmark").select(
            F.col("item_id").alias("qid"), F.col("text").alias("query"), F.col("item_id").alias("seq")
        )

    @property
    def turns(self) -> DataFrame:
        """Conversational topics: every user turn is a query."""
        return self.table("conversations").filter(F.col("role") == "user").select(
            F.concat_ws("-", "conv_id", "turn").alias("qid"), F.col("text").alias("query")
        )

    @property
    def plain_topics(self) -> DataFrame:
        """Topics in lower case without punctuation, words parted by one space."""
        text = F.regexp_replace(F.lower("query"), r"[\p{Punct}]", "")
        return self.topics.withColumn("query", F.trim(F.regexp_replace(text, r"\s+", " ")))

    @property
    def typo_topics(self) -> DataFrame:
        """Plain topics in which every word of even length from six on lost its third letter."""
        broken = F.transform(
            F.split("query", " "),
            lambda w: F.when(
                (F.length(w) >= 6) & (F.length(w) % 2 == 0),
                F.concat(F.substring(w, 1, 2), F.substring(w, F.lit(4), F.length(w))),
            ).otherwise(w),
        )
        return self.plain_topics.withColumn("query", F.array_join(broken, " "))

    # ---------------------------------------------------------- judgements

    @property
    def qrels(self) -> DataFrame:
        """Graded by the share of a topic's distinct word pairs that a document has."""
        return self._stored("qrels", self._make_qrels)

    def _make_qrels(self) -> DataFrame:
        def pairs(df: DataFrame, text: str) -> DataFrame:
            words = F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))
            listed = df.withColumn("__w", words)
            n = F.greatest(F.size("__w") - 1, F.lit(0))
            both = F.zip_with(
                F.slice("__w", F.lit(1), n), F.slice("__w", F.lit(2), n), lambda w, after: F.concat(w, F.lit(" "), after)
            )
            return listed.withColumn("__pairs", F.array_distinct(both)).drop("__w")

        asked = pairs(self.topics, "query").withColumn("n", F.size("__pairs"))
        asked = asked.select("qid", "n", F.explode_outer("__pairs").alias("pair")).filter("pair is not null")
        held = pairs(self.corpus, "text").select("doc_id", F.explode_outer("__pairs").alias("pair"))
        shared = lookup_join(held.filter("pair is not null"), asked, ["pair"])
        counts = shared.groupBy("qid", "doc_id").agg(F.count(F.lit(1)).alias("s"), F.max("n").alias("n"))
        s, n = F.col("s"), F.col("n")
        rating = F.when(s * 100 >= n * 80, 3).when(s * 10 >= n, 2).when(s * 20 >= n, 1).otherwise(0)
        return counts.select("qid", "doc_id", rating.cast("int").alias("rating"))

    # ---------------------------------------------------------------- runs

    @property
    def run(self) -> DataFrame:
        """BM25, ``DEPTH`` hits per topic."""
        return self._stored("run", lambda: search_with_scores(self.topics, self.index, k=DEPTH))

    @property
    def tied_run(self) -> DataFrame:
        """Hits by the number of distinct topic terms they have: many equal scores."""
        return self._stored("tied_run", self._make_tied)

    def _make_tied(self) -> DataFrame:
        counts = scored(self.topics, self.index, [Score("total", F.lit(1.0))])
        best = top_k(counts, ["qid"], [F.col("total").desc(), F.col("doc_id")], DEPTH)
        return best.select("qid", "doc_id", "rank", (F.col("total") / 1e9).alias("score"))

    @property
    def ltr_rows(self) -> DataFrame:
        return self._stored(
            "ltr_rows",
            lambda: attach_labels(features(self.topics, self.index, k=DEPTH), filter_qrels(self.qrels, self.topics)),
        )

    # -------------------------------------------------------------- stance

    @property
    def stances(self) -> DataFrame:
        """A stance per labelled document, with the document as its body."""
        quality, toxic = F.col("quality"), F.col("toxic")
        stance = (
            F.when((quality == 1) & (toxic == 0), "agree")
            .when((quality == 0) & (toxic == 1), "disagree")
            .when(quality == 1, "discuss")
            .otherwise("unrelated")
        )
        docs = self.table("documents").select("doc_id", "source", "lang")
        return self.table("labels").join(docs, "doc_id").select(
            F.col("doc_id").alias("row_id"),
            F.concat_ws(" ", "source", "lang", "doc_id").alias("headline"),
            F.col("doc_id").alias("body_id"),
            stance.alias("stance"),
            (1 + (F.col("doc_id") * 7 + 3) % 4).cast("int").alias("predicted"),
        )

    @property
    def bodies(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("body_id"), F.col("text").alias("article_body")
        )

    # --------------------------------------------------------------- files

    def _tsv(self, name: str, df: DataFrame) -> str:
        line = F.concat_ws("\t", *[F.regexp_replace(F.col(c).cast("string"), r"\s+", " ") for c in df.columns])
        return self._files(name, lambda path: df.select(line).write.mode("overwrite").text(path))

    @property
    def topics_file(self) -> str:
        return self._tsv("topics.tsv", self.topics.select("qid", "query"))

    @property
    def qrels_file(self) -> str:
        return self._tsv("qrels.tsv", self.qrels.select("qid", F.lit("Q0"), "doc_id", "rating"))

    @property
    def corpus_file(self) -> str:
        return self._tsv("collection.tsv", self.corpus)

    @property
    def jsonl_file(self) -> str:
        return self._files("collection.jsonl", lambda p: writers.corpus_to_jsonl(self.corpus, p, mode="overwrite"))

    @property
    def stance_folder(self) -> str:
        def write(path: str) -> None:
            quoted = {"header": True, "quote": '"', "escape": '"', "quoteAll": True, "mode": "overwrite"}
            bodies = self.bodies.toDF("Body ID", "articleBody")
            stances = self.stances.select("headline", "body_id", "stance").toDF("Headline", "Body ID", "Stance")
            for split, (body_file, stance_file) in STANCE_FILES.items():
                told = stances.drop("Stance") if split == "test" else stances
                bodies.write.csv(f"{path}/{body_file}", **quoted)
                told.write.csv(f"{path}/{stance_file}", **quoted)

        return self._files("stance", write)
