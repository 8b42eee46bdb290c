"""Best hits of a batch with very many matches: a block of queries meets a block of documents in one task.

A posting is weighed once, and not once for every query that asks for its term; the weights of a block of documents are then
summed as arrays.  Blocks are bounded by postings, query terms and hits, so a task holds as much whatever the size of the batch.

A document goes to its block as one row, a query as one row to every block.  Where the ``k`` best of every block would be many rows,
a query's score to reach is first looked for in some of the documents, and a block gives only hits that reach it.  Every document is
scored all the same; a query that then has fewer than ``k`` hits is scored again without it.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.functions.weighting import fixed
from passagerank.operators.index import Index
from passagerank.operators.ranking import top_k
from passagerank.operators.sizing import lookup_join, measure, skew_join
from passagerank.operators.workspace import cut, workspace

# executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A batch of more (query, posting) matches, with a posting matched by so many queries on average, is scored in blocks.
MANY_MATCHES = 10_000_000
MANY_QUERIES = 64
BLOCK_POSTINGS = 2_000_000
BLOCK_TERMS = 4_000_000
BLOCK_HITS = 2_000_000
#: Blocks are cut finer than need be, for tasks enough, down to so many postings.
LEAST_POSTINGS = 250_000
#: So many terms of queries are taken apart at a time.
CHUNK_TERMS = 500_000
#: Beyond so many hits of all blocks a score to reach is looked for, in one document of ``LOOK_EVERY``.
MANY_HITS = 20_000_000
LOOK_EVERY = 8
# A term of this share of a block's documents is added as a whole row.
_DENSE = 8


def many_matches(wanted: DataFrame, index: Index) -> bool:
    """Whether ``wanted(qid, term, qtf, term_slot)``, small enough for a broadcast, is worth scoring in blocks."""
    asked = wanted.groupBy("term_slot", "term").agg(F.count(F.lit(1)).alias("__n"))
    known = index.term_stats.join(F.broadcast(asked), ["term_slot", "term"])
    row = known.agg(F.sum(F.col("df") * F.col("__n")).alias("matches"), F.sum("df").alias("postings")).first()
    return (row["matches"] or 0) > max(MANY_MATCHES, MANY_QUERIES * (row["postings"] or 0))


def best_by_blocks(wanted: DataFrame, index: Index, weight: Column, k: int) -> DataFrame:
    """``(qid, doc_id, rank, total)``: the ``k`` best documents of a query; equal totals by document id."""
    keys = ["term_slot", "term"]
    wanted = cut(wanted)
    asked = wanted.select(*keys, "qtf").distinct()
    small = measure(asked).small
    stats = index.term_stats
    pairs = stats.join(F.broadcast(asked), keys) if small else stats.join(asked, keys)
    pairs = cut(pairs.withColumn("pair", F.monotonically_increasing_id()))
    queries = cut(wanted.select("qid").distinct().withColumn("query", F.monotonically_increasing_id()))
    few = measure(queries)
    n_terms, n_postings = wanted.count(), pairs.agg(F.sum("df")).first()[0] or 0
    cores = index.postings.sparkSession.sparkContext.defaultParallelism

    named = F.broadcast(queries) if few.small else queries
    marked = wanted.join(named.withColumnRenamed("qid", "__qid"), F.col("qid").eqNullSafe(F.col("__qid")))
    told = pairs.select(*keys, "qtf", "pair")
    marked = marked.join(F.broadcast(told) if small else told, [*keys, "qtf"])
    marked = cut(marked.groupBy("query").agg(F.collect_list("pair").alias("pairs")).withColumn("least", F.lit(None).cast("bigint")))

    postings = index.postings.select(*keys, "doc_id", "tf", "dl")
    if small:
        slots = [r[0] for r in pairs.select("term_slot").distinct().collect()]
        postings = postings.filter(F.col("term_slot").isin(*(slots or [-1])))

    def documents(postings: DataFrame) -> DataFrame:
        """A document's pairs and their weights as two lists; where postings are bucketed by document, no exchange."""
        if small:
            met = postings.join(F.broadcast(pairs), keys)
        else:
            met = skew_join(postings, pairs, keys, counts=stats.select(*keys, F.col("df").alias("count")))
        weighed = met.select("doc_id", "pair", fixed(weight).alias("w"))
        return weighed.groupBy("doc_id").agg(F.collect_list("pair").alias("pairs"), F.collect_list("w").alias("ws"))

    kind = index.postings.schema["doc_id"].dataType.simpleString()

    def meet(postings: DataFrame, marked: DataFrame, parts: int, packs: int, run, schema: str) -> DataFrame:
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = documents(postings).withColumn("part", _block("doc_id", parts)).withColumn("pack", every(packs))
        right = marked.withColumn("pack", _block("query", packs)).withColumn("part", every(parts))
        # tasks enough that few hold two blocks, whatever the session's number of shuffle partitions
        at = (4 * parts * packs, "part", "pack")
        both = left.repartition(*at).groupBy("part", "pack").cogroup(right.repartition(*at).groupBy("part", "pack"))
        return both.applyInArrow(run, schema)

    def grid(n_postings: int, hits: float) -> tuple[int, int]:
        """Blocks of documents, and of queries of which every one has so many ``hits`` in a block of documents."""
        parts = max(1, -(-n_postings // BLOCK_POSTINGS), min(2 * cores, -(-n_postings // LEAST_POSTINGS)))
        packs = max(1, -(-n_terms // BLOCK_TERMS), math.ceil(few.rows * hits / BLOCK_HITS), -(-2 * cores // parts))
        return parts, max(1, min(packs, few.rows))

    def all_hits(marked: DataFrame, hits: float) -> DataFrame:
        return meet(postings, marked, *grid(n_postings, hits), _block_hits(k), f"query BIGINT, doc_id {kind}, total BIGINT")

    order = [F.col("total").desc(), F.col("doc_id")]
    parts = grid(n_postings, k)[0]
    reach = _reach(k)
    if few.rows * parts * k <= MANY_HITS or 2 * reach * LOOK_EVERY > parts * k:
        best = top_k(all_hits(marked, k), ["query"], order, k, tasks=parts)
    else:
        some = postings.filter(F.pmod(F.xxhash64("doc_id", F.lit(LOOK_EVERY)), F.lit(LOOK_EVERY)) == 0)
        looked = grid(-(-n_postings // LOOK_EVERY), reach)
        # a block gives its fair part and some more; what it holds back could only raise the score to reach
        part = math.ceil(reach / looked[0] + 4 * math.sqrt(reach / looked[0]))
        tops = meet(some, marked, *looked, _block_tops(min(reach, part)), "query BIGINT, tops ARRAY<BIGINT>")
        tops = tops.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list("tops")), asc=False).alias("tops"))
        least = tops.select("query", F.get("tops", F.lit(reach - 1)).alias("least"))
        least = cut(marked.drop("least").join(least, "query", "left"))
        path = f"{workspace(index.postings.sparkSession)}/hits-{uuid.uuid4().hex}"
        hits = all_hits(least, reach * LOOK_EVERY / parts)
        hits.write.option("compression", "zstd").parquet(path)
        hits = index.postings.sparkSession.read.schema(hits.schema).parquet(path)
        counts = cut(hits.groupBy("query").agg(F.count(F.lit(1)).alias("n")))
        n_hits = counts.agg(F.sum("n")).first()[0] or 0
        lacking = least.filter(F.col("least").isNotNull()).join(counts, "query", "left").filter(F.coalesce("n", F.lit(0)) < k)
        lacking = cut(lacking.select("query", "pairs", F.lit(None).cast("bigint").alias("least")))
        if not lacking.isEmpty():
            again = lookup_join(hits, lacking.select("query"), ["query"], "left_anti")
            hits = again.union(all_hits(lacking, k))
        best = top_k(hits.repartition(max(2 * cores, -(-n_hits // BLOCK_HITS)), "query"), ["query"], order, k)
    return best.join(named, "query").select("qid", "doc_id", "rank", "total")


def _reach(k: int) -> int:
    """So many of the documents that are looked at have to reach a score that hardly any query lacks ``k`` hits in all: as many as the
    ``k`` best have there on average, and five standard deviations."""
    share = 1 / LOOK_EVERY
    return math.ceil(k * share + 5 * math.sqrt(k * share * (1 - share))) + 1


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def _block_hits(k: int):
    def run(documents: pa.Table, marked: pa.Table) -> pa.Table:
        return _hits(*_rows(documents), *_queries(marked), k)

    return run


def _block_tops(k: int):
    def run(documents: pa.Table, marked: pa.Table) -> pa.Table:
        docs, at, pair, w = _rows(documents)
        query, tops = [], []
        for q, _, totals in _best(len(docs), at, pair, w, *_queries(marked), k):
            query.append(q)
            tops.append(totals)
        lengths = np.cumsum([0, *map(len, tops)])
        lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(_joined(tops, np.int64)))
        return pa.table({"query": pa.array(query, pa.int64()), "tops": lists})

    return run


def _rows(documents: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The documents of a block in order, and its postings as arrays."""
    column = documents["doc_id"].combine_chunks()
    order = pc.sort_indices(column, null_placement="at_start")
    place = np.empty(len(column), np.int64)
    place[order.to_numpy()] = np.arange(len(column))
    counts = pc.list_value_length(documents["pairs"]).to_numpy()
    pair, w = (pc.list_flatten(documents[c]).to_numpy() for c in ("pairs", "ws"))
    return column.take(order), np.repeat(place, counts), pair, w


def _queries(marked: pa.Table) -> tuple[Iterator[tuple[np.ndarray, np.ndarray]], dict[int, int]]:
    """The terms of whole queries, some at a time, and the totals to reach."""
    query, counts = marked["query"].to_numpy(), pc.list_value_length(marked["pairs"]).to_numpy()
    least = {q: s for q, s in zip(query.tolist(), marked["least"].to_pylist(), strict=True) if s is not None}
    ends = np.cumsum(counts)

    def chunks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        head, done = 0, 0
        while head < len(query):
            tail = max(head + 1, int(np.searchsorted(ends, done + CHUNK_TERMS, "right")))
            asked = pc.list_flatten(marked["pairs"].slice(head, tail - head)).to_numpy()
            yield np.repeat(query[head:tail], counts[head:tail]), asked
            head, done = tail, ends[tail - 1]

    return chunks(), least


def block_hits(weighed: pa.Table, marked: pa.Table, k: int, least: dict[int, int] | None = None) -> pa.Table:
    """The ``k`` best documents of every query of one block: ``query, doc_id, total``; of a query with a ``least`` total, those that reach it."""
    docs = pc.unique(weighed["doc_id"])
    docs = docs.take(pc.sort_indices(docs, null_placement="at_start"))
    column = weighed["doc_id"].combine_chunks()
    at = pc.index_in(column, docs, skip_nulls=False).to_numpy(zero_copy_only=False).astype(np.int64)
    pair, w = weighed["pair"].to_numpy(), weighed["w"].to_numpy()
    return _hits(docs, at, pair, w, [(marked["query"].to_numpy(), marked["pair"].to_numpy())], least or {}, k)


def _hits(docs: pa.Array, at, pair, w, queries, least: dict[int, int], k: int) -> pa.Table:
    who, where, totals = [], [], []
    for q, chosen, sums in _best(len(docs), at, pair, w, queries, least, k):
        who.append(np.full(len(chosen), q, np.int64))
        where.append(chosen.astype(np.int32))
        totals.append(sums)
    return pa.table({
        "query": pa.array(_joined(who, np.int64)), "doc_id": docs.take(pa.array(_joined(where, np.int32))),
        "total": pa.array(_joined(totals, np.int64)),
    })


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _best(n: int, at, pair, w, queries, least: dict[int, int], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every query that meets something: the places of its best documents among ``n``, and their totals.

    ``queries`` gives pairs of arrays, a query and a pair it asks for, with all of a query in one of them."""
    order = np.lexsort((at, pair))
    pair, at, w = pair[order], at[order], w[order]
    if len(pair):  # documents that share an id are one
        first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (at[1:] != at[:-1])])
        counted = bool((w <= 0).any())
        pair, at, w = pair[first], at[first], np.add.reduceat(w, first)
    else:
        counted = False
    starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    ends, names = np.r_[starts[1:], len(pair)][: len(starts)], pair[starts]

    rows: dict[int, np.ndarray] = {}

    def whole(p: int) -> np.ndarray:
        if p not in rows:
            rows[p] = np.zeros(n, np.int64)
            rows[p][at[starts[p]:ends[p]]] = w[starts[p]:ends[p]]
        return rows[p]

    sums = np.zeros(n, np.int64)
    for query, asked in queries:
        order = np.argsort(query, kind="stable")
        query, asked = query[order], asked[order]
        place = np.searchsorted(names, asked)
        held = place < len(names)
        held[held] = names[place[held]] == asked[held]
        query, place = query[held], place[held]
        heads = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
        tails = np.r_[heads[1:], len(query)][: len(heads)]
        for head, tail in zip(heads.tolist(), tails.tolist(), strict=True):
            sums[:] = 0
            hit = np.zeros(n, bool) if counted else None
            for p in place[head:tail].tolist():
                s, e = starts[p], ends[p]
                if counted:  # a weight of nothing is a match as well
                    hit[at[s:e]] = True
                if (e - s) * _DENSE >= n:
                    sums += whole(p)
                else:
                    sums[at[s:e]] += w[s:e]
            q = int(query[head])
            matched = hit if counted else sums
            if q in least:
                reached = sums >= least[q]
                matched = reached & (matched != 0)
            chosen = np.flatnonzero(matched)
            if len(chosen) > k:
                values = sums[chosen]
                lowest = np.partition(values, len(values) - k)[len(values) - k]
                above = values > lowest
                above[np.flatnonzero(values == lowest)[: k - int(above.sum())]] = True
                chosen = chosen[above]
            yield q, chosen, sums[chosen]
