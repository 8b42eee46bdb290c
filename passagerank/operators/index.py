"""Inverted index as Parquet tables, and the statistics read from it.

Layout of a stored index:

* ``docs(doc_id, text, dl, terms)``: hash-bucketed by document and sorted by it.
  ``terms`` is the document vector with positions.
* ``postings(term, doc_id, tf, dl, positions)``: a directory per term slot,
  bucketed by document with the same hash, sorted by term inside a file.
* ``terms(term, df, cf)``: a directory per term slot, sorted by term.
* ``words(word, df)``: the surface forms of the collection; ``stems(word, stem)``: every word of the analyzer once,
  with its stem, if there is a stemmer.
* ``coll``: one row of statistics and settings, written last as the commit mark.

Bucketing postings by document spreads even a term found in every third
document over all tasks, keeps the score sum of a document in the task that
read it, and leaves only the top k of each task to move.  The term slot is a
partition directory, so a search reads the slots of its own terms.  Document
length rides on the posting, so scoring joins no document table.  The build
shuffles the corpus once; postings are derived from the bucketed documents
without another exchange.
"""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank.functions.porter import stem_words
from passagerank.functions.text import STOPWORDS, raw_tokens, tokens, with_term_groups
from passagerank.functions.weighting import Collection
from passagerank.operators.sizing import lookup_join, measure, skew_join
from passagerank.operators.workspace import cut

# One shard holds about this much of the estimated corpus (file bytes, where it is read from files), so that a task of a
# build or a search holds as much whatever the size of the corpus.
SHARD_BYTES = 8 << 20
# A greater estimate is a guess (no statistics, or a product of two inputs): the text is measured instead.
TRUSTED_BYTES = 1 << 50
# Catalyst's own upper limit on buckets.
MAX_SHARDS = 100_000
# So many terms, or ids, may stand as literals in a scan: more cost the planner more than they save.
LITERAL_TERMS = 200
LITERAL_IDS = 200


@dataclass(frozen=True)
class Index:
    """A stored index: its tables and the analyzer settings it was built with.

    ``words`` are the surface forms of the collection with their document frequency: lower case, neither
    stemmed nor stripped of stop words.
    """

    docs: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    words: DataFrame
    coll_stats: DataFrame
    collection: Collection
    stemmer: str | None
    stopwords: bool
    term_slots: int
    shards: int
    stems: DataFrame | None = None

    @property
    def doc_stats(self) -> DataFrame:
        return self.docs.select("doc_id", "dl")

    @property
    def stop_list(self) -> tuple[str, ...]:
        return STOPWORDS if self.stopwords else ()

    def analyze(self, column: str | Column) -> Column:
        return tokens(column, self.stemmer, self.stop_list)


def term_slot(term: str | Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(slots)).cast("int")


# ---------------------------------------------------------------- operators


def analyze(df: DataFrame, column: str, out: str = "tokens", stemmer: str | None = "porter",
            stopwords: tuple[str, ...] = STOPWORDS) -> DataFrame:
    return df.withColumn(out, tokens(column, stemmer, stopwords))


def tokenize_flat(df: DataFrame, column: str, stemmer: str | None = "porter",
                  stopwords: tuple[str, ...] = STOPWORDS) -> DataFrame:
    """One row per token with its position in the analyzed text."""
    rest = [c for c in df.columns if c != column]
    exploded = df.select(
        *rest, F.posexplode_outer(tokens(column, stemmer, stopwords)).alias("position", "term")
    )
    return exploded.filter(F.col("term").isNotNull())


def stem_vocabulary(vocabulary: DataFrame, column: str = "term") -> DataFrame:
    """``(term, stem)`` of a vocabulary: every word is stemmed once."""
    return vocabulary.select(column, stem_words(column).alias("stem"))


def stem_dictionary(words: DataFrame) -> DataFrame:
    """``(word, stem)`` of the analyzer's words among the surface forms ``words``: the possessive goes, every word stands once."""
    return stem_vocabulary(_bare(words).select("word").distinct(), "word")


def _bare(words: DataFrame) -> DataFrame:
    return words.withColumn("word", F.regexp_replace("word", "['’]s$", ""))


def stems_for(words: DataFrame, index: Index) -> DataFrame:
    """``(word, stem)`` of the distinct words of ``words(word)``: looked up in the index, worked out where it does not know them.

    The result is written, so that a plan that goes on with it stems nothing.
    """
    wanted = cut(words.select("word").distinct())
    if measure(wanted).small:
        known = index.stems.join(F.broadcast(wanted), "word")
    else:
        known = wanted.join(index.stems, "word")
    known = cut(known.select("word", "stem"))
    rest = lookup_join(wanted, known.select("word"), ["word"], "left_anti")
    return cut(known.union(stem_vocabulary(rest, "word").select("word", "stem")))


def index_terms(df: DataFrame, column: str, index: Index) -> DataFrame:
    """One row per analyzed token of a text column: its position and its term as the index has it."""
    flat = tokenize_flat(df, column, None, index.stop_list)
    if index.stemmer is None:
        return flat
    flat = flat.withColumnRenamed("term", "word")
    joined = lookup_join(flat, stems_for(flat, index), ["word"])
    return joined.withColumnRenamed("stem", "term").drop("word")


def stemmed_documents(corpus: DataFrame, stems: DataFrame, stopwords: tuple[str, ...] = STOPWORDS,
                      words: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """As ``document_terms``, with the stems of a dictionary: the words of a document are grouped in its row, and only
    these groups meet the dictionary.  Where ``corpus`` is partitioned by document, as ``shards`` has it done here, they come
    back without an exchange.

    A dictionary beyond a broadcast is divided among ``shards`` of the documents: every shard asks for the stems of its own
    distinct words, and only words that a stem shortens come back to it.  Neither the groups nor their positions move.
    ``words(word, df)``, where they are known, bound in how many shards a word stands: the corpus is not analyzed once more
    to count them."""
    if measure(stems).small:
        placed, place = corpus.repartition(shards, "doc_id") if shards else corpus, []
        flat = _word_groups(placed, place, stopwords)
        met = flat.join(F.broadcast(stems), "word")
    else:
        shards = shards or int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shard, place = _shard(corpus.sparkSession, shards), ["__shard"]
        # by the expression and not by the column: all readers then need the same two columns, and one exchange serves them
        placed = corpus.repartition(shards, shard).withColumn("__shard", shard)
        flat = _word_groups(placed, place, stopwords)
        shortened = _shard_stems(placed, stems, stopwords, words, shards)
        met = flat.join(shortened.hint("shuffle_hash"), ["__shard", "word"], "left").withColumn("stem", F.coalesce("stem", "word"))
    merged = met.groupBy(*place, "doc_id", "stem").agg(
        F.sum("tf").cast("int").alias("tf"), F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions")
    )
    vectors = merged.groupBy(*place, "doc_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("stem").alias("term"), "tf", "positions"))).alias("terms")
    )
    # null-safe, as a filter of null ids on one side only would part the exchange that both sides read; a null id has no terms
    named = vectors.select(*[F.col(c).alias(f"__of_{c}") for c in (*place, "doc_id")], "terms")
    same = F.col("doc_id").eqNullSafe(F.col("__of_doc_id"))
    for c in place:
        same = same & (F.col(c) == F.col(f"__of_{c}"))
    joined = placed.join(named, same, "left").drop(*place, *[f"__of_{c}" for c in (*place, "doc_id")])
    none = F.array().cast(_VECTOR)
    joined = joined.withColumn("terms", F.when(F.col("doc_id").isNotNull(), F.coalesce("terms", none)).otherwise(none))
    return joined.withColumn("dl", F.aggregate("terms", F.lit(0), lambda n, t: n + t["tf"]))


def _word_groups(corpus: DataFrame, place: list[str], stopwords: tuple[str, ...]) -> DataFrame:
    given = document_terms(corpus, None, stopwords)
    flat = given.select(*place, "doc_id", F.inline_outer("terms"))
    return flat.filter(F.col("term").isNotNull()).withColumnRenamed("term", "word")


def _shard_stems(placed: DataFrame, stems: DataFrame, stopwords: tuple[str, ...], words: DataFrame | None, shards: int) -> DataFrame:
    """``(__shard, word, stem)`` of the words in every shard that differ from their stem, back at the shard."""
    listed = placed.select("__shard", F.explode_outer(F.array_distinct(tokens("text", None, stopwords))).alias("word"))
    own = listed.filter(F.col("word").isNotNull()).distinct()
    bound = None
    if words is not None:
        bound = _bare(words).groupBy("word").agg(F.least(F.sum("df"), F.lit(shards)).alias("count"))
    met = skew_join(own, stems, ["word"], counts=bound)
    return met.filter(F.col("word") != F.col("stem")).repartition(shards, "__shard")


def _shard(spark: SparkSession, shards: int) -> Column:
    """A number of the document's bucket that Spark's own partitioning sends to the task of just that number: a task then has
    the documents of one bucket, and plans know what is at home there."""
    ids, found = 4 * shards, {}
    while len(found) < shards:
        ids *= 4
        numbered = spark.range(ids).groupBy(F.pmod(F.hash("id"), F.lit(shards)).alias("task")).agg(F.min("id").alias("id"))
        found = {r["task"]: r["id"] for r in numbered.collect()}
    at = F.pmod(F.hash("doc_id"), F.lit(shards)) + 1
    return F.coalesce(F.element_at(F.lit([found[task] for task in range(shards)]), at), F.lit(0)).cast("bigint")


def document_terms(corpus: DataFrame, stemmer: str | None = "porter",
                   stopwords: tuple[str, ...] = STOPWORDS) -> DataFrame:
    """Corpus with ``dl`` and ``terms``; narrow, no exchange."""
    analyzed = corpus.withColumn("__tokens", tokens("text", stemmer, stopwords))
    grouped = with_term_groups(analyzed, "__tokens", "terms")
    return grouped.withColumn("dl", F.size("__tokens")).drop("__tokens")


def surface_words(corpus: DataFrame) -> DataFrame:
    """``(word, df)``: every token as it stands in the texts, lower-cased."""
    distinct = corpus.select(F.explode(F.array_distinct(raw_tokens("text"))).alias("word"))
    return distinct.groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def build_postings(corpus: DataFrame, stemmer: str | None = "porter",
                   stopwords: tuple[str, ...] = STOPWORDS) -> DataFrame:
    """``(term, doc_id, tf, dl, positions)``: grouped inside each document, no exchange."""
    return _explode_postings(document_terms(corpus, stemmer, stopwords))


def _explode_postings(docs: DataFrame) -> DataFrame:
    # the outer form: an inner one makes Catalyst evaluate the analysis twice to drop empty documents early
    exploded = docs.select("doc_id", "dl", F.inline_outer("terms"))
    return exploded.filter(F.col("term").isNotNull()).select("term", "doc_id", "tf", "dl", "positions")


def doc_lengths(postings: DataFrame) -> DataFrame:
    return postings.groupBy("doc_id").agg(F.sum("tf").cast("bigint").alias("dl"))


def term_counts(postings: DataFrame, term: str | None = None) -> DataFrame:
    """Document and collection frequency per term; an unknown term gives no row."""
    if term is not None:
        postings = postings.filter(F.col("term") == term)
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf")
    )


def collection_stats(doc_stats: DataFrame) -> DataFrame:
    """One row: documents, documents with a term, all tokens, mean length."""
    return doc_stats.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count(F.when(F.col("dl") > 0, 1)).alias("n_nonempty"),
        F.coalesce(F.sum("dl"), F.lit(0)).cast("bigint").alias("total_terms"),
    ).withColumn("avgdl", F.col("total_terms") / F.col("n_docs"))


def select_docs(docs: DataFrame, ids: DataFrame, rows: int | None = None) -> DataFrame:
    """``docs`` cut to the ids of ``ids`` where these are few enough to be literals of the scan.

    ``rows`` is the number of ids, repeats included, where it is known: of very many the distinct ones are not asked for.

    Literal ids prune bucket files, and in a file sorted by id also pages.  With
    many ids the scan stays whole; the join that follows does the selection.
    """
    if rows is not None and rows > 50 * LITERAL_IDS:
        return docs
    kind = docs.schema["doc_id"].dataType
    wanted = ids.select(F.col("doc_id").cast(kind).alias("doc_id"))
    few = wanted.distinct().limit(LITERAL_IDS + 1).collect()
    if len(few) > LITERAL_IDS:
        return docs
    return docs.filter(F.col("doc_id").isin([r["doc_id"] for r in few]))


def doc_vector(docs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``(doc_id, vector MAP<term, tf>)`` of the given documents; ids may be of another type."""
    if ids is not None:
        kind = docs.schema["doc_id"].dataType
        wanted = ids.select(F.col("doc_id").cast(kind).alias("doc_id")).distinct()
        docs = lookup_join(select_docs(docs, wanted), wanted, ["doc_id"], "left_semi")
    entries = F.transform(
        "terms", lambda t: F.struct(t["term"].alias("key"), t["tf"].cast("bigint").alias("value"))
    )
    return docs.select("doc_id", F.map_from_entries(entries).alias("vector"))


def top_terms(docs: DataFrame, n: int = 10, out: str = "top_terms") -> DataFrame:
    """The ``n`` most frequent terms of every document vector, ties by term.

    A vector is one row, so its head is a sort of an array and no window.
    """
    ranked = F.sort_array(
        F.transform("terms", lambda t: F.struct((-t["tf"]).alias("k"), t["term"].alias("term")))
    )
    return docs.select(
        "doc_id", F.transform(F.slice(ranked, 1, n), lambda t: t["term"]).alias(out)
    )


def fetch_docs(run: DataFrame, corpus: DataFrame) -> DataFrame:
    """Stored text of every hit.  A small run moves to the documents; a document in very many rankings is salted."""
    texts, run = corpus.select("doc_id", "text"), cut(run)  # measured, listed and joined: worked out once
    size = measure(run)
    if size.small:
        joined = select_docs(texts, run, size.rows).join(F.broadcast(run), "doc_id")
    else:
        joined = skew_join(run, texts, ["doc_id"])
    return joined.select(*run.columns, "text")


# ------------------------------------------------------------------ storage


def build_index(
    corpus: DataFrame,
    path: str,
    stemmer: str | None = "porter",
    stopwords: bool = True,
    shards: int | None = None,
    term_slots: int = 16,
    keep_text: bool = True,
) -> Index:
    """Build and store an index of ``corpus(doc_id, text)`` under ``path``; the path must be new.

    ``shards`` sets the files per term slot and the tasks of a search; by
    default it follows the estimated size of the corpus.
    """
    spark = corpus.sparkSession
    if _committed(spark, path):
        raise FileExistsError(f"{path} holds an index")
    if stemmer not in (None, "porter"):
        raise ValueError(f"unknown stemmer {stemmer!r}; use 'porter' or None")
    corpus = corpus.select("doc_id", "text")
    shards = shards or _default_shards(corpus)
    id_type = corpus.schema["doc_id"].dataType.simpleString()
    # data go to a folder of their own: a build that broke off is no obstacle to the next one
    data = f"data-{uuid.uuid4().hex}"
    root = f"{path}/{data}"
    surface_words(corpus).sortWithinPartitions("word").write.mode("errorifexists").parquet(f"{root}/words")
    stop_list = STOPWORDS if stopwords else ()
    if stemmer is None:
        docs = document_terms(corpus.repartition(shards, "doc_id"), None, stop_list)
    else:
        words = spark.read.schema("word STRING, df BIGINT").parquet(f"{root}/words")
        stems = stem_dictionary(words).sortWithinPartitions("word")
        stems.write.mode("errorifexists").parquet(f"{root}/stems")
        stems = spark.read.schema(_STEMS).parquet(f"{root}/stems")
        docs = stemmed_documents(corpus, stems, stop_list, words, shards)
    columns = ["doc_id", *(["text"] if keep_text else []), "terms", "dl"]
    docs = docs.select(*columns)
    # what is at home in a shard is joined there, whatever else the keys of a join hold
    with _settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        _write_bucketed(docs, f"{root}/docs", shards, "doc_id", "doc_id", None)
    spec = _tables(root, id_type, keep_text, shards)
    stored = _attach(spark, {"docs": spec["docs"]})
    postings = _explode_postings(stored["docs"]).withColumn("term_slot", term_slot("term", term_slots))
    # keep one task per bucket of documents, so that every (slot, bucket) is one sorted file; a task has a file of every slot
    # open and sorts by the term alone, whose first bytes decide most comparisons
    one_task = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    with _settings(spark, one_task | {"spark.sql.maxConcurrentOutputFileWriters": str(term_slots + 1)}):
        _write_bucketed(postings.sortWithinPartitions("term"), f"{root}/postings", shards, "doc_id", None, "term_slot")
    stored = _attach(spark, spec)
    slot = F.col("term_slot")
    counts = (
        stored["postings"].groupBy("term_slot", "term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))
    )
    (
        counts.sortWithinPartitions(slot, "term")
        .write.partitionBy("term_slot").mode("errorifexists").parquet(f"{root}/terms")
    )
    stats = collection_stats(stored["docs"].select("doc_id", "dl"))
    stats = stats.select(
        "*",
        F.lit(data).alias("data"),
        F.lit(stemmer).cast("string").alias("stemmer"),
        F.lit(stopwords).alias("stopwords"),
        F.lit(shards).alias("shards"),
        F.lit(term_slots).alias("term_slots"),
        F.lit(id_type).alias("id_type"),
        F.lit(keep_text).alias("keep_text"),
    )
    stats.coalesce(1).write.mode("errorifexists").parquet(f"{path}/coll")
    return open_index(spark, path)


def _default_shards(corpus: DataFrame) -> int:
    """Shards by estimated size, about ``SHARD_BYTES`` each however few the cores are; up to eight for a small corpus."""
    estimate = int(str(corpus._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate > TRUSTED_BYTES:  # the planner does not know
        estimate = corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    return max(min(cores, 8), min(MAX_SHARDS, -(-estimate // SHARD_BYTES)))


def open_index(spark: SparkSession, path: str) -> Index:
    """Open a stored index; fails when the build never committed.

    Raises ``spark.sql.parquet.pushdown.inFilterThreshold`` of the session, and leaves it so: searches are planned later, and
    literal terms become exact page predicates only up to that many.
    """
    coll = spark.read.parquet(f"{path}/coll")
    row = coll.first()
    root = f"{path}/{row['data']}"
    tables = _attach(spark, _tables(root, row["id_type"], row["keep_text"], row["shards"]))
    terms = spark.read.schema("term STRING, df BIGINT, cf BIGINT, term_slot INT").parquet(f"{root}/terms")
    threshold = "spark.sql.parquet.pushdown.inFilterThreshold"
    if int(spark.conf.get(threshold)) < LITERAL_TERMS:
        spark.conf.set(threshold, str(LITERAL_TERMS))
    return Index(
        docs=tables["docs"],
        postings=tables["postings"],
        term_stats=terms,
        words=spark.read.schema("word STRING, df BIGINT").parquet(f"{root}/words"),
        coll_stats=coll.select("n_docs", "n_nonempty", "total_terms", "avgdl"),
        collection=Collection(row["n_docs"], row["n_nonempty"], row["total_terms"]),
        stemmer=row["stemmer"],
        stopwords=row["stopwords"],
        term_slots=row["term_slots"],
        shards=row["shards"],
        stems=spark.read.schema(_STEMS).parquet(f"{root}/stems") if row["stemmer"] else None,
    )


def _committed(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(f"{path}/coll").isEmpty()
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def open_or_build(corpus: DataFrame, path: str, **options) -> Index:
    """Reuse a committed index, build it where there is none."""
    spark = corpus.sparkSession
    return open_index(spark, path) if _committed(spark, path) else build_index(corpus, path, **options)


_STEMS = "word STRING, stem STRING"
_VECTOR = "ARRAY<STRUCT<term: STRING, tf: INT, positions: ARRAY<INT>>>"


def _name(what: str, table: str) -> str:
    return f"passagerank_{hashlib.md5(what.encode()).hexdigest()[:16]}_{table}"


def _tables(path: str, id_type: str, keep_text: bool, shards: int) -> dict[str, str]:
    text = "text STRING, " if keep_text else ""
    return {
        "docs": f"(doc_id {id_type}, {text}terms {_VECTOR}, dl INT) USING parquet "
        f"CLUSTERED BY (doc_id) SORTED BY (doc_id) INTO {shards} BUCKETS LOCATION '{path}/docs'",
        "postings": f"(term STRING, doc_id {id_type}, tf INT, dl INT, positions ARRAY<INT>, term_slot INT) "
        f"USING parquet PARTITIONED BY (term_slot) "
        f"CLUSTERED BY (doc_id) SORTED BY (term) INTO {shards} BUCKETS LOCATION '{path}/postings'",
    }


def _attach(spark: SparkSession, spec: dict[str, str]) -> dict[str, DataFrame]:
    """Name stored files in the session catalog so that scans know their bucketing."""
    out = {}
    for table, ddl in spec.items():
        name = _name(ddl, table)
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE {name} {ddl}")
        if table == "postings":
            spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
        out[table] = spark.table(name)
    return out


def _write_bucketed(df, path, shards, bucket, sort, slot):
    """Write bucket files under ``path`` through a catalog entry that is dropped again (files stay); without ``sort`` rows stay in their order."""
    name = _name(path, "write")
    writer = df.write.format("parquet").mode("errorifexists").option("path", path).option("compression", "zstd")
    if slot:
        writer = writer.partitionBy(slot)
    writer = writer.bucketBy(shards, bucket)
    (writer.sortBy(sort) if sort else writer).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
