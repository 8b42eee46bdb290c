"""Document fingerprints by winnowing, with Spark expressions only.

Tokens are words, cut after 32 characters.  Every window of ``w`` successive hashes of ``k``
tokens keeps its smallest hash, the rightmost one on ties, with its position.  A passage of
``k + w - 1`` tokens that two texts share is therefore found in both.

Edge cases: null and empty texts have an empty fingerprint, like to each other and to no other; a
text of fewer than ``k`` tokens is one gram, of fewer than ``w`` grams one window; the next document
of a row is the one with the next smaller id, null being the smallest, and of several rows with
that id the smallest text; an only document is its own next; an empty table gives no rows; extra columns are not
read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagerank.llm.shared import shuffle_partitions, stored, text_of

#: Token pattern, tokens of a gram, grams of a window.
TOKEN = r"[^\x20\x09-\x0D]{1,32}"
K, W = 4, 8
LAST = (1 << 31) - 1
#: Stands for a null id, below all others.
NO_ID = -(1 << 63)


def token_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))


def gram_hashes(hashes: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` tokens, each a 32-bit hash above its mirrored position."""
    rolled = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(hashes) - k, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]),
    )
    packed = F.transform(rolled, lambda g, i: F.shiftleft(g.bitwiseAND(F.lit(0xFFFFFFFF)), 31) + (F.lit(LAST) - i))
    return F.when(F.size(hashes) > 0, packed).otherwise(F.array().cast("array<bigint>"))


def chosen_grams(packed: Column, w: int) -> Column:
    """The smallest of every window; equal hashes compare by position, the rightmost being smallest."""
    least = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(packed) - w + 1, F.lit(1))), lambda i: F.array_min(F.slice(packed, i, w))
    )
    return F.when(F.size(packed) > 0, F.array_distinct(least)).otherwise(packed)


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with ``name``: the chosen grams as packed integers, in order of position."""
    return (
        df.withColumn("__hashes", token_hashes(F.col(text)))
        .withColumn("__grams", gram_hashes(F.col("__hashes"), k))
        .withColumn(name, chosen_grams(F.col("__grams"), w))
        .drop("__hashes", "__grams")
    )


def shown(grams: Column) -> Column:
    """A fingerprint as text: ``hash:position`` of every chosen gram."""
    return F.array_join(
        F.transform(
            grams,
            lambda g: F.concat(
                F.lpad(F.lower(F.hex(F.shiftright(g, 31))), 8, "0"), F.lit(":"),
                (F.lit(LAST) - g.bitwiseAND(F.lit(LAST))).cast("string"),
            ),
        ),
        " ",
    )


def hash_set(grams: Column) -> Column:
    return F.array_distinct(F.transform(grams, lambda g: F.shiftright(g, 31)))


def likeness(one: Column, other: Column) -> Column:
    """Jaccard likeness of two hash sets; two empty ones are alike."""
    shared = F.size(F.array_intersect(one, other))
    every = F.size(one) + F.size(other) - shared
    return F.when(every == 0, 1.0).otherwise(shared / every)


def next_documents(keys: DataFrame) -> DataFrame:
    """``keys`` (``key`` distinct) with ``next``: the next smaller key, the largest after the smallest.

    Keys are range-partitioned and written; only each range's first key passes the driver.
    """
    spark = keys.sparkSession
    ranged = keys.repartitionByRange(shuffle_partitions(spark), F.col("key").desc())
    ranged = stored(ranged.withColumn("__range", F.spark_partition_id()), "winnow-order")
    firsts = sorted((r["__range"], r["m"]) for r in ranged.groupBy("__range").agg(F.max("key").alias("m")).collect())
    follow = [(firsts[i][0], firsts[(i + 1) % len(firsts)][1]) for i in range(len(firsts))]
    after = F.broadcast(spark.createDataFrame(follow, "__range INT, __first BIGINT"))
    order = Window.partitionBy("__range").orderBy(F.col("key").desc())
    return (
        ranged.withColumn("__lead", F.lead("key").over(order))
        .join(after, "__range")
        .select(*keys.columns, F.coalesce("__lead", "__first").alias("next"))
    )


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Every document with its fingerprint, its edited text and that text's, and both likenesses.

    Texts are dealt by id once, and this exchange serves both as the documents and as their next ones.
    """
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("key"), text_of(text).alias("text"))
    keys = base.groupBy("key").agg(F.max(F.floor(F.length("text") / 2)).alias("half"))
    pairs = stored(next_documents(keys), "winnow-next")
    dealt = base.repartition(shuffle_partitions(spark), "key")
    following = dealt.groupBy("key").agg(F.min("text").alias("text"))
    found = pairs.select(F.col("key").alias("of"), F.col("next").alias("key"), "half").join(following, "key")
    ahead = with_fingerprint(found, "text", "grams", k, w).select(
        F.col("of").alias("key"), F.substring("text", F.lit(1), F.col("half").cast("int")).alias("prefix"),
        hash_set(F.col("grams")).alias("next_set"),
    )
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("prefix", F.lit(1), half))
    out = dealt.join(ahead, "key").withColumn("edited", edited)
    out = with_fingerprint(with_fingerprint(out, "text", "grams", k, w), "edited", "edited_grams", k, w)
    out = out.withColumn("own_set", hash_set(F.col("grams")))
    return out.select(
        F.nullif(F.col("key"), F.lit(NO_ID)).alias("doc_id"), "text", "edited", "grams", "edited_grams",
        likeness(F.col("own_set"), hash_set(F.col("edited_grams"))).alias("near_edited"),
        likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
    )
