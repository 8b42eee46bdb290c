"""Ranked lexical search by pipelined term partitioning.

Documents are dealt to shards, of which each holds its documents' counts of the query terms.  Terms belong to stages (their owners)
by how many documents hold them, the rarest first.  Items travel in bundles, one for every shard: a bundle carries sparse
accumulators (item, document, score) from one owner to the next.  A stage joins the bundles with its postings by cogroup and adds
integer contributions; the last stage selects.

An accumulator stops when what is left cannot lift it to the k-th score that its item has already reached, and an item takes
no new documents once all that is left is below that score.  Both bounds are exact, so the ranking is that of the whole sums.

Items are answered in packs of bounded size; vocabulary, weights and the k-th scores of one pack are what the driver holds.

Edge cases: null texts and texts without terms are no documents of the collection; an item without known terms has no hits;
equal scores are ordered by document, a null id last; repeated rows are ranked each, and repeated items answered each;
empty tables give no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passagerank.llm.shared import stored, text_of

#: Fixed values of the contract: terms, and capitals that are lowered.
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms in at most this share of the documents belong to the first owner, the second and so on; the last has the rest.
OWNERS = (1 / 64, 1 / 12, 1 / 4)
#: Documents and postings of a shard, characters of a pack of items, items of a bundle.
SHARD_DOCS, SHARD_POSTINGS, PACK_CHARS, BUNDLE = 8192, 1_000_000, 4_000_000, 256


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.translate(str.maketrans(UPPER, LOWER)))


# shards of the collection: one row each, so that their postings never move


SHARDS = "shard long, docs array<{doc}>, n array<int>, starts array<int>, terms array<int>, tf array<int>"


def shards(docs: DataFrame, vocabulary: dict[str, int], doc_id: str, text: str) -> DataFrame:
    """Documents with a term, their number of terms, and the counts of those in ``vocabulary``."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, number = shipped.value, TaskContext.get().partitionId(), 0
        kind, held, size = None, [], 0

        def flush():
            nonlocal held, size, number
            row = [[part << 32 | number], [[h[0] for h in held]], [[h[1] for h in held]]]
            starts = np.cumsum([0, *(len(h[2]) for h in held)])
            row += [[starts], [[t for h in held for t in h[2]]], [[c for h in held for c in h[2].values()]]]
            kinds = [pa.int64(), pa.list_(kind), *[pa.list_(pa.int32())] * 4]
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["shard", "docs", "n", "starts", "terms", "tf"]
            )

        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for doc, content in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    found = terms_of(content)
                    if not found:
                        continue
                    held.append((doc, len(found), Counter(known[t] for t in found if t in known)))
                    size += len(held[-1][2])
                    if len(held) >= SHARD_DOCS or size >= SHARD_POSTINGS:
                        yield flush()
        if held:
            yield flush()

    columns = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return columns.mapInArrow(run, SHARDS.format(doc=columns.schema["doc_id"].dataType.simpleString()))


def _postings(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Per shard of a batch: number, documents' terms in all, and the term, document and count of its postings."""
    for i in range(batch.num_rows):
        n, starts, terms, tf = (batch.column(c)[i].values.to_numpy() for c in ("n", "starts", "terms", "tf"))
        yield batch.column("shard")[i].as_py(), n, terms, np.repeat(np.arange(len(n)), np.diff(starts)), tf


def contributions(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What one occurrence of a term in an item adds per unit of its weight, for every posting (count, document's terms)."""
    m = 100 - 25 + (25 * n.astype(np.int64) * documents) // length
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass(frozen=True)
class Pack:
    """What the stages need to know of a pack of items: the query side, of bounded size."""

    items: list  # ids
    users: list  # per term: items (by number) and how often they hold it
    weights: list  # per term
    owners: list  # per term
    rest: np.ndarray  # per owner and item: the most that its terms and those of later owners add
    documents: int
    length: int


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def plan(found: DataFrame, items: list[tuple], vocabulary: dict[str, int]) -> Pack | None:
    """Statistics of the collection, the owner of every term and the bounds of every item."""
    total = found.select(F.size("docs").alias("d"), F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"))
    documents, length = total.agg(F.sum("d"), F.sum("l")).first()
    if not documents:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, most = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, n, terms, doc, tf in _postings(batch):
                holding += np.bincount(terms, minlength=len(vocabulary))
                np.maximum.at(most, terms, contributions(tf, n[doc], documents, length))
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(holding[some]), pa.array(most[some])], ["term", "df", "most"])

    measured = found.mapInArrow(run, "term long, df long, most long").groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))
    weights, owners, most = [0] * len(vocabulary), [0] * len(vocabulary), [0] * len(vocabulary)
    # as many rows as the pack has terms, at most
    for row in measured.collect():
        weights[row["term"]], most[row["term"]] = weight(documents, row["df"]), row["most"]
        owners[row["term"]] = sum(row["df"] > share * documents for share in OWNERS)
    users: list[list[tuple[int, int]]] = [[] for _ in vocabulary]
    rest = np.zeros((len(OWNERS) + 2, len(items)), np.int64)
    for number, (_, terms) in enumerate(items):
        for term, times in terms.items():
            users[vocabulary[term]].append((number, times))
            rest[owners[vocabulary[term]], number] += times * weights[vocabulary[term]] * most[vocabulary[term]]
    rest = np.cumsum(rest[::-1], axis=0)[::-1].copy()
    return Pack([i for i, _ in items], users, weights, owners, rest, documents, length)


# stages


def owned(found: DataFrame, pack: Pack, owner: int, with_docs: bool) -> DataFrame:
    """Per shard and bundle: the postings of the owner's terms that an item of the bundle holds, by term."""
    shipped = found.sparkSession.sparkContext.broadcast(pack)
    doc = found.schema["docs"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = shipped.value
        bundles = -(-len(pack.items) // BUNDLE)
        asked = np.zeros((bundles, len(pack.users)), bool)
        for term, users in enumerate(pack.users):
            if pack.owners[term] == owner:
                asked[[i // BUNDLE for i, _ in users], term] = True
        for batch in batches:
            for i, (shard, n, terms, doc, tf) in enumerate(_postings(batch)):
                for bundle in range(bundles):
                    at = np.flatnonzero(asked[bundle][terms])
                    at = at[np.argsort(terms[at], kind="stable")]
                    gain = contributions(tf[at], n[doc[at]], pack.documents, pack.length)
                    sides = [terms[at].astype(np.int32), doc[at].astype(np.int32), gain.astype(np.int32)]
                    docs = batch.column("docs").slice(i, 1) if with_docs else pa.array([None], batch.column("docs").type)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard]), pa.array([bundle]), pa.array([len(n)]), docs,
                         *(pa.array([s.tobytes()], pa.binary()) for s in sides)],
                        ["shard", "bundle", "size", "docs", "terms", "doc", "gain"],
                    )

    return found.mapInArrow(
        run, f"shard long, bundle long, size long, docs {doc}, terms binary, doc binary, gain binary"
    )


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest score per row, 0 where there are fewer."""
    if scores.shape[1] < k:
        return np.zeros(len(scores), np.int64)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def _added(carried: pa.Table, postings: pa.Table, pack: Pack, owner: int, reached: np.ndarray) -> tuple[np.ndarray, int]:
    """Scores of the bundle's items (rows) and the shard's documents after the owner's terms; 0 where there is no accumulator."""
    of = postings.drop_columns("docs").to_pylist()[0]
    first = of["bundle"] * BUNDLE
    count = min(BUNDLE, len(pack.items) - first)
    scores = np.zeros((count, of["size"]), np.int64)
    for row in carried.select(["item", "doc", "score"]).to_pylist():
        item, doc, score = (np.frombuffer(row[c], t) for c, t in (("item", np.int16), ("doc", np.int32), ("score", np.int64)))
        scores[item, doc] = score
    terms, doc, gain = (np.frombuffer(of[c], np.int32) for c in ("terms", "doc", "gain"))
    # an item whose k-th score is above all that is left takes no new documents
    shut = pack.rest[owner, first : first + count] < reached[first : first + count]
    begins = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])[: len(terms)])
    for low, high in zip(begins.tolist(), np.append(begins, len(terms))[1:].tolist(), strict=True):
        docs, gains = doc[low:high], gain[low:high].astype(np.int64) * pack.weights[terms[low]]
        for item, times in pack.users[terms[low]]:
            at = item - first
            if 0 <= at < count:
                row = scores[at]
                if shut[at]:
                    live = row[docs] > 0
                    row[docs[live]] += gains[live] * times
                else:
                    row[docs] += gains * times
    return scores, first


CARRIED = "shard long, bundle long, item binary, doc binary, score binary, item_best array<int>, best array<bigint>"


def stage(carried: DataFrame, postings: DataFrame, pack: Pack, owner: int, reached: np.ndarray, k: int) -> DataFrame:
    """The bundles after the owner's terms; ``item_best, best`` are the greatest scores of the shard so far."""
    shipped = carried.sparkSession.sparkContext.broadcast((pack, reached))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        pack, reached = shipped.value
        scores, first = _added(left, right, pack, owner, reached)
        count = len(scores)
        local = np.maximum(_best(scores, k), reached[first : first + count])
        left_over = pack.rest[owner + 1, first : first + count]
        item, doc = np.nonzero((scores > 0) & (scores + left_over[:, None] >= local[:, None]))
        top_item, top = [], []
        for i in range(count):
            row = scores[i][scores[i] > 0]
            row = np.partition(row, len(row) - k)[len(row) - k :] if len(row) > k else row
            top_item += [first + i] * len(row)
            top += row.tolist()
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int64()), "bundle": pa.array([key[1].as_py()], pa.int64()),
            "item": pa.array([item.astype(np.int16).tobytes()], pa.binary()),
            "doc": pa.array([doc.astype(np.int32).tobytes()], pa.binary()),
            "score": pa.array([scores[item, doc].tobytes()], pa.binary()),
            "item_best": pa.array([top_item], pa.list_(pa.int32())), "best": pa.array([top], pa.list_(pa.int64())),
        })

    return carried.groupBy("shard", "bundle").cogroup(postings.groupBy("shard", "bundle")).applyInArrow(run, CARRIED)


def reached_by(carried: DataFrame, items: int, k: int) -> np.ndarray:
    """Per item the k-th score so far over all shards, 0 where there are fewer: one row per item."""
    pairs = carried.select(F.explode(F.arrays_zip("item_best", "best")).alias("p")).select("p.item_best", "p.best")
    place = F.row_number().over(Window.partitionBy("item_best").orderBy(F.col("best").desc()))
    out = np.zeros(items, np.int64)
    for row in pairs.withColumn("place", place).filter(F.col("place") == k).collect():
        out[row["item_best"]] = row["best"]
    return out


def last_stage(carried: DataFrame, postings: DataFrame, pack: Pack, owner: int, reached: np.ndarray, k: int) -> DataFrame:
    """``item, doc_id, score``: the k best of every shard after the last owner."""
    shipped = carried.sparkSession.sparkContext.broadcast((pack, reached))
    kind = postings.schema["docs"].dataType.elementType.simpleString()

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        pack, reached = shipped.value
        scores, first = _added(left, right, pack, owner, reached)
        ids = right.column("docs")[0].as_py()
        items, docs, best = [], [], []
        for i, row in enumerate(scores):
            at = np.flatnonzero(row)
            if len(at) > k:
                at = at[row[at] >= np.partition(row[at], len(at) - k)[len(at) - k]]
            ranked = sorted((-int(row[d]), ids[d] is None, 0 if ids[d] is None else ids[d], d) for d in at.tolist())[:k]
            items += [first + i] * len(ranked)
            docs += [ids[d] for *_, d in ranked]
            best += [-score for score, *_ in ranked]
        kind = right.schema.field("docs").type.value_type
        return pa.table({"item": pa.array(items, pa.int64()), "doc_id": pa.array(docs, kind), "score": pa.array(best, pa.int64())})

    schema = f"item long, doc_id {kind}, score long"
    return carried.groupBy("shard", "bundle").cogroup(postings.groupBy("shard", "bundle")).applyInArrow(run, schema)


def _answered(spark: SparkSession, docs: DataFrame, items: list[tuple], doc_id: str, text: str, k: int) -> DataFrame | None:
    """``item, doc_id, score`` of one pack: the k best documents of every item, ``item`` by its place in ``items``."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    found = stored(shards(docs, vocabulary, doc_id, text), "terms-shards")
    pack = plan(found, items, vocabulary)
    if pack is None:
        return None
    bundles = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((len(items) - 1) // BUNDLE).cast("long"))).alias("bundle")
    none = F.lit(b"").cast("binary")
    carried = found.select(
        "shard", bundles, none.alias("item"), none.alias("doc"), none.alias("score"),
        F.lit(None).cast("array<int>").alias("item_best"), F.lit(None).cast("array<bigint>").alias("best"),
    )
    reached = np.zeros(len(items), np.int64)
    for owner in range(len(OWNERS)):
        carried = stored(stage(carried, owned(found, pack, owner, False), pack, owner, reached, k), "terms-carried")
        reached = np.maximum(reached, reached_by(carried, len(items), k))
    last = len(OWNERS)
    return last_stage(carried.drop("item_best", "best"), owned(found, pack, last, True), pack, last, reached, k)


def packs(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Items and their terms, packs of bounded size at a time."""
    held: list[tuple] = []
    chars = 0
    for row in items.select(F.col(item_id).alias("i"), text_of(text).alias("t")).toLocalIterator():
        held.append((row["i"], Counter(terms_of(row["t"]))))
        chars += len(row["t"])
        if chars >= PACK_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def rank(
    docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k highest-scoring documents of every item, those with a score above 0."""
    spark = docs.sparkSession
    kinds = [items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()]
    out = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for held in packs(items, item_id, item_text):
        found = _answered(spark, docs, held, doc_id, text, k)
        if found is None:
            continue
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(held)], f"item bigint, item_id {kinds[0]}")
        # as many rows as the pack has items, times k
        out = out.union(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
