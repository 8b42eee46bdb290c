"""Repeated passages by longest-previous-factor arrays over suffix order.

A byte is repeated if it lies in a string of ``length`` bytes that starts somewhere else as well.  Matches never cross texts.

Every such string has an anchor, its gram of least hash (the leftmost of several), so equal strings have equal
anchors at equal places.  Strings that start one after another and have the same anchor are a *context*: the bytes that hold them all.
Contexts that could repeat are known by the bytes before or behind their anchor; only these leave their texts.  Equal contexts are
one, with a count.  The different contexts of one anchor form a group: their strings are put into suffix order, and the previous and next smaller
positions in that order give every string its longest previous factor, and by the same passes in reverse its longest later one.

A group of more contexts than a task should hold is not collected: its strings are told apart by hashes, in blocks of
neighbouring starts first, and those of blocks that only partly repeat one by one.

Positions are ordered by document id (null ids last), then by a hash of the text, then by place.  Equal texts are one text with copies.

Edge cases: null and empty texts, and those shorter than ``length``, lose nothing to each other; texts are read whole, in segments; a text that repeats a
short period loses all but its first bytes, or all; rows of the same id and text are alike, and none of them is later than the
other; an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.llm.shared import setting, stored, text_of
from passagerank.operators.sizing import lookup_join

#: Bytes of a string that must not repeat.
LENGTH = 400
#: Starts of a segment; different contexts of a group that one task sorts, bytes of contexts sorted together; starts of a block.
SEGMENT, GROUP_CONTEXTS, SORT_BYTES, BLOCK = 1 << 20, 1024, 1_000_000, 16
#: Contexts that are hashed at a time; bits of a filter per key, and at most.
ROWS, BITS, MOST_BITS = 512, 16, 1 << 28
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def gram_of(length: int) -> int:
    """Bytes of a gram: a power of two, half the string at most."""
    return min(32, 1 << (max(2, length) // 2).bit_length() - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * M2
        return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from every place, by doubling."""
    with np.errstate(over="ignore"):
        found, width = _mix((data.astype(np.uint64) + np.uint64(1)) * M1), 1
        while width < gram:
            found = found[:-width] * (M1 ^ np.uint64(width * 2)) + found[width:]
            width *= 2
        return _mix(found)


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of the anchor of every string of ``length`` bytes in ``data``, and the hashes of all grams."""
    hashes = gram_hashes(data, gram)
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    window, width = length - gram + 1, 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: width - window], least[window - width :])
    return (least & low).astype(np.int64), hashes


def _sides(hashes: np.ndarray, at: np.ndarray, span: int, gram: int, side: int) -> np.ndarray:
    """A hash of the ``span`` bytes from ``at``."""
    with np.errstate(over="ignore"):
        found = np.full(len(at), np.uint64(side), np.uint64)
        for offset in (*range(0, span - gram, gram), span - gram):
            found = _mix(found * M1 + hashes[at + offset])
    return found.view(np.int64)


def _contexts(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Contexts of the texts between ``offsets``, segment by segment: first start, number of starts, place of the
    anchor, hashes of the bytes before and with it, and with and behind it (0 if no string of the context has them whole)."""
    gram = gram_of(length)
    half = (length - gram) // 2
    behind = length - half
    for begin in range(int(offsets[0]), int(offsets[-1]) - length + 1, SEGMENT):
        part = data[begin : min(begin + SEGMENT + length - 1, int(offsets[-1]))]
        place, hashes = anchors(part, length, gram)
        n = len(place)
        # strings that run over the end of a text are none
        inside = offsets[(offsets > begin) & (offsets < begin + n + length - 1)] - begin
        ends = np.zeros(n + 1, np.int64)
        np.add.at(ends, np.maximum(inside - length + 1, 0), 1)
        np.add.at(ends, np.minimum(inside, n), -1)
        valid = np.cumsum(ends[:n]) == 0
        change = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])))
        size = np.diff(np.append(change, n))
        some = valid[change]
        start, size = change[some], size[some]
        at = place[start]
        reach = at - start  # of the first start to the anchor; that of the last is the least
        left, right = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        has = reach >= half
        left[has] = _sides(hashes, at[has] - half, half + gram, gram, 1)
        has = reach - size + 1 < half
        right[has] = _sides(hashes, at[has], behind, gram, 2)
        yield start + begin, size, at + begin, left, right


def text_hash(text: str = "text") -> Column:
    return F.unhex(F.md5(text_of(text).cast("binary")))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, and where each begins and the last ends."""
    binary = column.cast(pa.binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset : binary.offset + len(binary) + 1].astype(np.int64)
    data = binary.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


ANCHORS = "text_hash binary, doc_id {doc}, starts array<int>, sizes array<int>, places array<int>, left array<long>, right array<long>"


def anchored(docs: DataFrame, length: int, doc_id: str, text: str) -> DataFrame:
    """Per row of ``length`` bytes or more its contexts: starts, number of strings, anchors and what could repeat.

    Of equal texts in a batch one has them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            seen: set[bytes] = set()
            new = pa.array([not (k in seen or seen.add(k)) for k in keys])
            rest, part = batch.filter(pa.compute.invert(new)), batch.filter(new)
            data, offsets = _buffers(part.column(2))
            found = list(_contexts(data, offsets, length)) or [tuple(np.zeros(0, np.int64) for _ in range(5))]
            start, size, place, left, right = (np.concatenate(c) for c in zip(*found, strict=True))
            # what a segment's end has cut in two is one: a text has the same contexts wherever it stands
            new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + size[:-1]))[: len(start)])
            start, place, size = start[new], place[new], np.add.reduceat(size, new) if len(new) else size
            left, right = (np.bitwise_or.reduceat(c, new) if len(new) else c for c in (left, right))
            of = np.searchsorted(offsets, start, "right") - 1
            bounds = pa.array(np.searchsorted(of, np.arange(len(part) + 1)).astype(np.int32))
            ints = [(c - offsets[of]).astype(np.int32) for c in (start, place)]
            columns = [ints[0], size.astype(np.int32), ints[1], left, right]
            lists = [pa.ListArray.from_arrays(bounds, pa.array(c)) for c in columns]
            names = ["text_hash", "doc_id", "starts", "sizes", "places", "left", "right"]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names)
            if rest.num_rows:
                none = [pa.nulls(rest.num_rows, c.type) for c in lists]
                yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(1), *none], names)

    rows = docs.select(text_hash(text).alias("text_hash"), F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    rows = rows.filter(F.octet_length("text") >= length)
    return rows.mapInArrow(run, ANCHORS.format(doc=rows.schema["doc_id"].dataType.simpleString()))


def candidates(found: DataFrame) -> DataFrame:
    """``text_hash, doc_id, contexts``: contexts that could repeat; ``doc_id`` is the least that has the text."""
    one = F.explode(F.arrays_zip("starts", "sizes", "places", "left", "right")).alias("c")
    rows = found.select("text_hash", one).select(
        "text_hash", F.struct("c.starts", "c.sizes", "c.places").alias("context"),
        F.explode(F.array("c.left", "c.right")).alias("side"),
    ).filter("side <> 0")
    # copies of a text have the same marks and repeat nothing by that
    mark = F.xxhash64("text_hash", "context")
    twice = rows.select("side", mark.alias("mark")).groupBy("side").agg(F.min("mark").alias("a"), F.max("mark").alias("b"))
    twice = stored(twice.filter("a <> b").select("side"), "repeats-sides")
    could = lookup_join(rows, twice, ["side"], "left_semi").groupBy("text_hash").agg(F.collect_set("context").alias("contexts"))
    return could.join(copies(found).select("text_hash", "doc_id"), "text_hash")


def copies(found: DataFrame) -> DataFrame:
    """``text_hash, doc_id, copies``: the least id of every text and its number of rows."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("least")
    rows = found.groupBy("text_hash").agg(least, F.count(F.lit(1)).alias("copies"))
    return rows.select("text_hash", F.col("least.doc_id").alias("doc_id"), "copies")


def occurrences(texts: DataFrame, length: int) -> DataFrame:
    """One row per context of ``texts(text_hash, doc_id, text, contexts)``; ``reach`` is from its first start to its anchor."""
    place, start, size = (F.col(f"c.{n}") for n in ("places", "starts", "sizes"))
    rows = texts.select("text_hash", "doc_id", "text", F.explode("contexts").alias("c"))
    held = F.substring("text", start + 1, size + length - 1)
    return rows.select(
        F.xxhash64(F.substring("text", place + 1, F.lit(gram_of(length)))).alias("anchor"),
        F.unhex(F.md5(F.concat(held, (place - start).cast("string").cast("binary")))).alias("context"),
        "text_hash", "doc_id", start.alias("start"), size.alias("size"), (place - start).alias("reach"),
    )


def grouped(every: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``anchor, context, first, size, reach, bytes`` of contexts whose anchor has different ones: one row per context."""
    mark = F.xxhash64("context")
    several = every.groupBy("anchor").agg(F.min(mark).alias("a"), F.max(mark).alias("b")).filter("a <> b").select("anchor")
    rows = lookup_join(every, stored(several, "repeats-several"), ["anchor"], "left_semi")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")
    firsts = rows.groupBy("anchor", "context").agg(F.min(place).alias("first"), F.first("size").alias("size"), F.first("reach").alias("reach"))
    # the text that has a context first gives its bytes
    wanted = firsts.groupBy(F.col("first.text_hash").alias("text_hash")).agg(F.collect_list(F.struct("anchor", "context", "first", "size", "reach")).alias("of"))
    given = texts.select("text_hash", "text").join(wanted, "text_hash").select("text", F.explode("of").alias("c"))
    return given.select("c.*", F.substring("text", F.col("c.first.start") + 1, F.col("c.size") + length - 1).alias("bytes"))


def may_have(rows: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """``rows`` without most of those whose ``key`` (a 64-bit hash) is none of ``keys(key)``: a bitmap of bounded size is broadcast."""
    bits = 1 << 15
    while bits < min(MOST_BITS, BITS * keys.count()):
        bits *= 2
    # Spark counts bits and buckets of bitmaps from 1 on
    number = F.pmod("key", F.lit(bits)) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(number).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("__bits")
    )
    placed = rows.withColumn("__at", F.pmod(key, F.lit(bits)) + 1)
    placed = placed.withColumn("__bucket", F.bitmap_bucket_number("__at")).withColumn("__at", F.bitmap_bit_position("__at").cast("int"))
    found = placed.join(F.broadcast(maps), "__bucket")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return found.filter(F.getbit(byte, F.col("__at") % 8) == 1).select(*rows.columns)


# suffix order of a task's groups


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the strings of ``length`` bytes from every place that has as many, by doubling."""
    ranks, width = data.astype(np.uint64), 1
    while width < min(8, length) and width * 2 <= length:
        ranks = (ranks[:-width] << np.uint64(8 * width)) | ranks[width:]
        width *= 2
    ranks = _dense(ranks)
    while width < length:
        step = min(width, length - width)
        ranks = _dense((ranks[:-step].astype(np.uint64) << np.uint64(32)) | ranks[step:])
        width += step
    return ranks


def _dense(keys: np.ndarray) -> np.ndarray:
    """The keys' places among the distinct ones."""
    order = np.argsort(keys)
    keys = keys[order]
    ranks = np.empty(len(keys), np.uint32)
    ranks[order] = np.cumsum(np.append(np.uint32(0), keys[1:] != keys[:-1])[: len(keys)], dtype=np.uint32)
    return ranks


def nearest_smaller(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Per place in suffix order the common prefix with the nearest place before it that has a smaller position, 0 if none has.

    ``common`` is the common prefix of a place with the one before it.  Pointers jump over what is larger.
    """
    n = len(position)
    before, shared = np.arange(n) - 1, common.copy()
    if n:
        shared[0] = 0
    open_ = np.flatnonzero((before >= 0) & (shared > 0))
    open_ = open_[position[before[open_]] > position[open_]]
    while len(open_):
        by = before[open_]
        shared[open_] = np.minimum(shared[open_], shared[by])
        before[open_] = before[by]
        open_ = open_[(before[open_] >= 0) & (shared[open_] > 0)]
        open_ = open_[position[before[open_]] > position[open_]]
    return np.where(before >= 0, shared, 0)


def previous_factors(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest previous factors, in suffix order: what a string shares with an earlier one, before or behind it in that order."""
    back = np.zeros_like(common)
    back[1:] = common[1:][::-1]
    return np.maximum(nearest_smaller(position, common), nearest_smaller(position[::-1], back)[::-1])


def repeated_starts(held: list[bytes], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For every context, in order of position: which of its strings another context has, and which an earlier one has."""
    sizes = np.fromiter(map(len, held), np.int64, len(held))
    ranks = prefix_ranks(np.frombuffer(b"".join(held), np.uint8), length)
    starts = np.cumsum(sizes) - sizes
    strings = sizes - length + 1
    of = np.repeat(np.arange(len(held)), strings)
    place = np.arange(int(strings.sum())) - np.repeat(np.cumsum(strings) - strings, strings) + starts[of]
    order = np.argsort(ranks[place], kind="stable")
    position, ranked = place[order], ranks[place[order]]
    # common prefixes shorter than the string do not count
    common = np.append(0, np.where(ranked[1:] == ranked[:-1], length, 0))[: len(order)]
    earlier, later = previous_factors(position, common), previous_factors(-position, common)
    flags = np.zeros((2, len(order)), bool)
    flags[0][order] = (earlier >= length) | (later >= length)
    flags[1][order] = earlier >= length
    cuts = np.cumsum(strings)[:-1]
    return np.split(flags[0], cuts), np.split(flags[1], cuts)


MARKS = "context binary, low int, n int, later boolean"


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()


def _marks(rows: list[tuple[bytes, bool, np.ndarray]]) -> pa.RecordBatch:
    out: list[list] = [[] for _ in range(4)]
    for name, later, flags in rows:
        lows, sizes = _runs(flags)
        for column, values in zip(out, ([name] * len(lows), lows, sizes, [later] * len(lows)), strict=True):
            column += values
    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["context", "low", "n", "later"])


def sorted_groups(groups: DataFrame, length: int) -> DataFrame:
    """Marks of the contexts of ``held``, arrays of (first, context, bytes) in order of position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(names, contents):
            some, earlier = repeated_starts(contents, length)
            return _marks([r for n, a, b in zip(names, some, earlier, strict=True) for r in ((n, False, a), (n, True, b))])

        names, contents, size = [], [], 0
        for batch in batches:
            for group in batch.column(0):
                names += group.values.field("context").to_pylist()
                contents += group.values.field("bytes").to_pylist()
                size = size + sum(map(len, contents[len(contents) - len(group.values) :]))
                if size >= SORT_BYTES:
                    yield flush(names, contents)
                    names, contents, size = [], [], 0
        if names:
            yield flush(names, contents)

    return groups.mapInArrow(run, MARKS)


# groups of very many contexts


def _digest(content: bytes, mark: int) -> bytes:
    return hashlib.blake2b(content, digest_size=16, salt=mark.to_bytes(8, "little", signed=True)).digest()


BLOCKS = "context binary, first {first}, core binary, whole binary, low int, n int"


def blocks(contexts: DataFrame, length: int) -> DataFrame:
    """Blocks of neighbouring starts by their distance to the anchor: a hash of what all their strings share, and one of all bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            at, out = [], [[] for _ in range(4)]
            for i, (reach, size, held) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("reach", "size", "bytes")), strict=True)):
                for block in range((reach - size + 1) // BLOCK, reach // BLOCK + 1):
                    low = max(0, reach - (block * BLOCK + BLOCK - 1))
                    n = min(size, reach - block * BLOCK + 1) - low
                    core = held[reach - block * BLOCK : reach - block * BLOCK - BLOCK + 1 + length]
                    at.append(i)
                    row = (_digest(core, block), _digest(held[low : low + n + length - 1], reach - low), low, n)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kept = batch.select(["context", "first"]).take(pa.array(at, pa.int64()))
            kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["context", "first", "core", "whole", "low", "n"]
            )

    return contexts.mapInArrow(run, BLOCKS.format(first=contexts.schema["first"].dataType.simpleString()))


def strings(rows: DataFrame, length: int) -> DataFrame:
    """``context, first, string, low``: a hash of every string of the blocks in ``of``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            at, names, lows = [], [], []
            for i, (held, of) in enumerate(zip(batch.column("bytes").to_pylist(), batch.column("of").to_pylist(), strict=True)):
                for low in (low for b in of for low in range(b["low"], b["low"] + b["n"])):
                    at.append(i)
                    lows.append(low)
                    names.append(_digest(held[low : low + length], 0))
            kept = batch.select(["context", "first"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(names, pa.binary()), pa.array(lows, pa.int32())], ["context", "first", "string", "low"]
            )

    first = rows.schema["first"].dataType.simpleString()
    return rows.mapInArrow(run, f"context binary, first {first}, string binary, low int")


def hashed_groups(contexts: DataFrame, length: int) -> DataFrame:
    """Marks of contexts whose groups are too large to sort in one task."""
    found = stored(blocks(contexts, length), "repeats-blocks")
    # equal blocks are one, that of the first context that has it
    least = F.min(F.struct("first", "context", "low", "n", "core")).alias("of")
    wholes = stored(found.groupBy("whole").agg(least, F.count(F.lit(1)).alias("times")), "repeats-wholes")
    one = wholes.select("whole", "times", "of.*")
    alike = lookup_join(found, one.filter("times > 1").select("whole", F.col("context").alias("of")), ["whole"])
    alike = alike.select("context", "low", "n", (F.col("context") != F.col("of")).alias("after"))
    cores = one.groupBy("core").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("core")
    parts = lookup_join(one, stored(cores, "repeats-cores"), ["core"], "left_semi")
    parts = parts.groupBy("context").agg(F.collect_list(F.struct("low", "n")).alias("of"))
    single = stored(strings(contexts.select("context", "first", "bytes").join(parts, "context"), length), "repeats-strings")
    equal = single.groupBy("string").agg(F.count(F.lit(1)).alias("__n"), F.min("first").alias("least"))
    equal = lookup_join(single, stored(equal.filter("__n > 1").drop("__n"), "repeats-equal"), ["string"])
    equal = equal.select("context", "low", F.lit(1).alias("n"), (F.col("first") > F.col("least")).alias("after"))
    return alike.union(equal).select("context", "low", "n", _both("after"))


def _both(after: str) -> Column:
    """A run is marked once as repeated, and once more as later if it is."""
    return F.explode(F.when(F.col(after), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("later")


def marks(contexts: DataFrame, length: int, most: int | None = None) -> DataFrame:
    """``context, low, n, later``: runs of strings that other contexts of ``contexts`` have, and that earlier ones have."""
    most = GROUP_CONTEXTS if most is None else most
    spark = contexts.sparkSession
    sizes = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("__n"))
    large = stored(sizes.filter(F.col("__n") > most).select("anchor"), "repeats-large")
    some = not large.isEmpty()
    small = lookup_join(contexts, large, ["anchor"], "left_anti") if some else contexts
    groups = small.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("first", "context", "bytes"))).alias("held"))
    # a group may hold about a megabyte: few of them travel together
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "64"):
        found = stored(sorted_groups(groups.filter(F.size("held") > 1).select("held"), length), "repeats-sorted")
    return found.union(hashed_groups(lookup_join(contexts, large, ["anchor"], "left_semi"), length)) if some else found


# texts


def repeated_texts(
    docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts that may lose bytes (``text_hash, text``), ``text_hash, runs`` with the runs of starts of repeated strings
    (``start, n, later``), and ``text_hash, doc_id, copies`` of all texts of ``length`` bytes or more."""
    found = stored(anchored(docs, length, doc_id, text), "repeats-anchors")
    could = stored(candidates(found), "repeats-candidates")
    same = stored(copies(found), "repeats-copies")
    rows = docs.select(text_hash(text).alias("text_hash"), F.col(doc_id).alias("doc_id"), text_of(text).cast("binary").alias("text"))
    one = F.xxhash64("text_hash", "doc_id")
    some = may_have(rows, could.select(one.alias("key")), one).alias("a").join(
        could.alias("b"), (F.col("a.text_hash") == F.col("b.text_hash")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    )
    texts = stored(some.select("a.text_hash", "a.doc_id", "text", "contexts"), "repeats-texts")
    if texts.count() > could.count():  # rows of one id and text
        texts = stored(texts.dropDuplicates(["text_hash"]), "repeats-texts")
    every = stored(occurrences(texts, length), "repeats-occurrences")
    marked = stored(marks(stored(grouped(every, texts, length), "repeats-contexts"), length), "repeats-marks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")
    several = every.groupBy("context").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").select(
        "context", F.col("first.text_hash").alias("of"), F.col("first.start").alias("at")
    )
    places = every.select("context", "text_hash", "start", "size")
    alike = lookup_join(places, stored(several, "repeats-alike"), ["context"])
    more = (F.col("text_hash") != F.col("of")) | (F.col("start") != F.col("at"))
    alike = alike.withColumn("after", more).select("text_hash", "start", F.col("size").alias("n"), _both("after"))
    by_mark = marked.groupBy("context").agg(F.collect_list(F.struct("low", "n", "later")).alias("marks"))
    shared = lookup_join(places, stored(by_mark, "repeats-by-context"), ["context"])
    shared = shared.select("text_hash", "start", F.explode("marks").alias("m")).select(
        "text_hash", (F.col("start") + F.col("m.low")).alias("start"), "m.n", "m.later"
    )
    runs = alike.union(shared).groupBy("text_hash").agg(F.collect_list(F.struct("start", "n", "later")).alias("runs"))
    return texts.select("text_hash", "text"), runs, same


def _spans(runs: pa.StructArray, length: int, keep_first: bool) -> tuple[list[int], list[int]]:
    """Maximal stretches of a text that the strings of the runs cover: starts and ends."""
    starts, n, later = (runs.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n", "later"))
    if keep_first:
        starts, n = starts[later], n[later]
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate((starts + n + length - 1)[order])
    first = np.append(True, starts[1:] > ends[:-1])[: len(starts)]
    return starts[first].tolist(), ends[np.append(first[1:], True)[: len(starts)]].tolist()


SPANS = "array<struct<start:int,end:int>>"


def merged(runs: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """``text_hash, spans`` of texts that lose bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [_spans(runs.values, length, keep_first) for runs in batch.column(1)]
            spans = [[{"start": a, "end": b} for a, b in zip(*f, strict=True)] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["text_hash", "spans"])

    return runs.mapInArrow(run, f"text_hash binary, spans {SPANS}").filter(F.size("spans") > 0)


def kept(text: str, spans: str) -> Column:
    """The bytes of a binary column that are left outside its spans (ascending, apart)."""
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(text)))
    parts = F.zip_with(begins, ends, lambda a, b: F.hex(F.substring(F.col(text), a + 1, b - a)))
    return F.unhex(F.array_join(parts, ""))


def removed(
    docs: DataFrame, length: int = LENGTH, keep_first: bool = False, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text_hash, n_bytes, spans, n_removed, kept_sha256`` per row: the stretches of bytes that go, and a hash of the rest.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else; with ``keep_first`` only if it
    starts earlier, so that the first of all copies stays.
    """
    texts, runs, same = repeated_texts(docs, length, doc_id, text)
    spans = stored(merged(runs, length, keep_first), "repeats-spans")
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    lost = lookup_join(texts.select("text_hash", "text"), spans, ["text_hash"]).select(
        "text_hash", "spans", gone.alias("n_removed"), F.sha2(kept("text", "spans"), 256).alias("kept_sha256")
    )
    lost = stored(lost, "repeats-lost")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.octet_length(text_of(text)).cast("bigint").alias("n_bytes"),
        F.sha2(text_of(text).cast("binary"), 256).alias("whole_sha256"),
    )
    several = stored(same.filter("copies > 1").select("text_hash", F.col("doc_id").alias("least"), F.lit(True).alias("copied")), "repeats-copied")
    rows = lookup_join(lookup_join(rows, lost, ["text_hash"], "left"), several, ["text_hash"], "left")
    goes = F.coalesce("copied", F.lit(False))
    if keep_first:
        goes = goes & ~F.col("doc_id").eqNullSafe(F.col("least"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    none = F.array().cast(SPANS)
    return rows.select(
        "doc_id", "text_hash", "n_bytes", F.when(goes, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(goes, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(goes, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )


def kept_bytes(rows: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``rows`` with the column ``text`` as the bytes that are left outside ``spans``; null as empty."""
    given = rows.withColumn(text, text_of(text).cast("binary"))
    return given.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(kept(text, spans)))
