"""Mixing sources to target weights: pivotal dependent rounding in a distributed reduction tree.

Every document of a source is wanted ``target / source size`` times, at most twice.  Whole
copies are given at once; what is left is a probability.  Two documents of a source exchange probability,
weighed by their sizes, until one of them is settled at 0 or 1; the other goes on.  A block
of documents leaves at most one unsettled, and these meet in blocks of the next level
until a source has one left.  Each exchange keeps the expected words of the source,
so the words taken miss the target by half of the last document at most.

Edge cases: a null or empty text has size 0 and takes 0 words; sources order by code point,
null last, as a source of its own; repeated rows (same id, source, text) are taken
equally often; an empty table gives no rows; a table without words has targets of 0; extra columns stay with their
rows, whatever their names, but names that begin with two underscores are kept for the operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagerank.llm.shared import WORD, stored, text_of
from passagerank.operators.sizing import lookup_join

#: Weights by the order of sources, share of all sizes, and most copies.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Documents that one expression settles.
BLOCK = 64


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target, n`` per source from ``source, size, n`` rows.

    A weight's share of all sizes, stopping at ``most`` times the source's size; what is
    above goes to the others by weight until none is above.  That is the level at which
    sources, ordered by size per weight, stop being full.  One row per source takes part.
    """
    per = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    per = per.withColumn(
        "__w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    )
    fill = Window.orderBy(F.col("source_size") / F.col("__w"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = F.coalesce(F.sum("source_size").over(upto), F.lit(0)) * most
    per = (
        per.withColumn("__total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("__weights", F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(upto), F.lit(0)))
        .withColumn("__level", (F.col("__total") - ahead) / F.col("__weights"))
    )
    full = F.col("__level") * F.col("__w") > F.col("source_size") * most
    open_level = F.min(F.when(~full, F.struct(F.col("source_size") / F.col("__w"), F.col("__level"))))
    level = open_level.over(everything)["__level"]
    per = per.withColumn("__at", level)
    target = F.least(F.col("__at") * F.col("__w"), (F.col("source_size") * most).cast("double"))
    return per.select("source", "source_size", target.alias("target"), "n")


def _uniform(*parts) -> Column:
    """A keyed value in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _exchange(state: Column, doc: Column) -> Column:
    """Settles the unsettled document of ``state`` or ``doc`` and keeps the other."""
    held = state["open"]
    up = F.least((1 - held["p"]) * held["size"], doc["p"] * doc["size"])
    down = F.least(held["p"] * held["size"], (1 - doc["p"]) * doc["size"])
    rise = _uniform(held["key"], doc["key"]) * (up + down) < down
    step = F.when(rise, up).otherwise(-down)
    # the document whose limit set the step is settled exactly, the other keeps the rest
    held_ends = F.when(
        rise, (1 - held["p"]) * held["size"] <= doc["p"] * doc["size"]
    ).otherwise(held["p"] * held["size"] <= (1 - doc["p"]) * doc["size"])
    held_p = F.when(held_ends, F.when(rise, 1.0).otherwise(0.0)).otherwise(held["p"] + step / held["size"])
    doc_p = F.when(~held_ends, F.when(rise, 0.0).otherwise(1.0)).otherwise(doc["p"] - step / doc["size"])
    after_held, after_doc = held.withField("p", held_p), doc.withField("p", doc_p)
    return F.struct(
        F.when(held_ends, after_doc).otherwise(after_held).alias("open"),
        F.concat(state["done"], F.array(F.when(held_ends, after_held).otherwise(after_doc))).alias("done"),
    )


def _settle(docs: Column, kind: str) -> Column:
    """All documents of a block, all but one of them settled."""
    start = F.struct(
        F.element_at(docs, 1).alias("open"), F.array().cast(f"array<{kind}>").alias("done")
    )
    rest = F.slice(docs, 2, F.greatest(F.size(docs) - 1, F.lit(0)))

    def step(state, doc):
        # a document that rounding errors have brought to 0 or 1 hands over
        settled = (state["open"]["p"] <= 0) | (state["open"]["p"] >= 1)
        return F.when(
            settled, F.struct(doc.alias("open"), F.concat(state["done"], F.array(state["open"])).alias("done"))
        ).otherwise(_exchange(state, doc))

    end = F.aggregate(rest, start, step)
    return F.concat(end["done"], F.array(end["open"]))


def word_count(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, text_hash, size, n``: equal rows joined to one unit with their number."""
    return (
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            F.xxhash64(text_of(text)).alias("text_hash"), word_count(text).alias("size"),
        )
        .groupBy("doc_id", "source", "text_hash", "size")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 42,
    weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK,
) -> DataFrame:
    """``doc_id, source, text_hash, size, n, source_size, target, copies``: one row per unit.

    ``copies`` is how often each of the ``n`` equal rows is taken.  It depends on the
    rows and the seed only.
    """
    wanted = stored(units(docs, doc_id, text, source), "mix-units")
    targets = stored(source_targets(wanted, weights, share, most), "mix-targets")
    largest = targets.agg(F.max("n")).first()[0] or 0
    same = F.col("source").eqNullSafe(F.col("__source"))
    hot = targets.select(F.col("source").alias("__source"), "source_size", "target", F.col("n").alias("__docs"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a source name and a null get a key that joins like any other
    keyed = lambda df, name: df.withColumn("__key", F.concat_ws("", F.when(F.col(name).isNull(), "0").otherwise("1"), name))
    joined = (
        lookup_join(keyed(wanted, "source"), keyed(hot, "__source").drop("__source"), ["__key"])
        .drop("__key")
        .withColumn("__rate", rate)
        .withColumn("whole", F.floor("__rate"))
        .withColumn("p", F.col("__rate") - F.col("whole"))
    )
    kept = ["doc_id", "text_hash", "size", "n", "whole", "source_size", "target"]
    doc = F.struct(
        (F.col("size") * F.col("n")).cast("double").alias("size"),
        F.xxhash64("doc_id", "text_hash", F.lit(seed)).alias("key"),
        "p",
        F.struct(*kept).alias("row"),
    )
    still = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    plain = joined.filter(~still).select("source", *kept, F.lit(0).alias("extra"))
    level = joined.filter(still).select("source", "__docs", doc.alias("doc"))
    settled, most_left, depth = [plain], largest, 0
    while most_left > 1:
        most_left = -(-most_left // block)
        blocks = F.ceil(F.col("__docs") / (float(block) ** (depth + 1))).cast("long")
        kind = level.schema["doc"].dataType.simpleString()
        grouped = (
            level.withColumn("__block", F.pmod(F.xxhash64(F.col("doc.key"), F.lit(depth)), blocks))
            .groupBy("source", "__block")
            # large documents first: small ones that follow can still settle them
            .agg(F.array_sort(F.collect_list(F.struct((-F.col("doc.size")).alias("o"), "doc"))).alias("docs"), F.max("__docs").alias("__docs"))
            .withColumn("docs", F.transform("docs", lambda x: x["doc"]))
        )
        after = stored(
            grouped.select("source", "__docs", F.explode(_settle(F.col("docs"), kind)).alias("doc")), f"mix-level{depth}"
        )
        open_ = (F.col("doc.p") > 0) & (F.col("doc.p") < 1)
        settled.append(after.filter(~open_).select("source", "doc.row.*", F.col("doc.p").cast("int").alias("extra")))
        level, depth = after.filter(open_), depth + 1
    # one document of a source at most is left: it goes to the nearer side
    draw = (F.col("doc.p") >= 0.5).cast("int")
    out = level.select("source", "doc.row.*", draw.alias("extra"))
    for part in settled:
        out = out.unionByName(part)
    return out.withColumn("copies", F.col("whole") + F.col("extra")).select(
        "doc_id", "source", "text_hash", "size", "n", "source_size", "target", "copies"
    )


def taken(mixed: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    return mixed.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def copied(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as they are taken, with the columns they have."""
    key = F.xxhash64(F.col(doc_id), text_of(text), F.coalesce(F.col(source).cast("string"), F.lit("")), F.col(source).isNull())
    left = docs.withColumn("__key", key).withColumn("__check", F.xxhash64(text_of(text)))
    right = mixed.filter("copies > 0").select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("source").alias("__source"), "copies"
    )
    return (
        left.join(
            right.withColumnRenamed("copies", "__copies"),
            left[doc_id].eqNullSafe(F.col("__doc")) & (F.col("__check") == F.col("__hash"))
            & left[source].eqNullSafe(F.col("__source")),
        )
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
        .select(*docs.columns)
    )
