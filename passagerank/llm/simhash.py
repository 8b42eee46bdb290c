"""SimHash near-duplicates by multi-index hashing.

A fingerprint's 64 bits are two segments of 32.  Fingerprints within 3 bits differ in at most
one bit of one segment, so every distinct segment value enumerates its ball of
radius 1 and fetches the values that exist.  Fingerprints that share a neighbouring pair of values are
compared in full.  They come in blocks by a hash, two blocks at a time, and a
comparison returns the links of a spanning forest, never all pairs.

Edge cases: null and empty texts have the fingerprint 0, linked like any other; a text of
fewer words than a shingle is one shingle; repeated rows and equal texts share a component;
a null id never names a component, unless it has no other; an empty table gives no rows.
Extra columns are not read, whatever their names; only ``keep_one`` returns them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.llm.components import components
from passagerank.llm.shared import stored, text_of
from passagerank.operators.sizing import lookup_join

#: Hash seed and the number of bits that may differ.
SEED = 42
DISTANCE = 3
#: Fingerprints of one segment value in a block, which are compared with each other at a time.
TILE = 2048
#: Shingles whose bits are counted at a time.
ROWS = 1 << 16


def shingle_hashes(text: bytes, words: int) -> bytes:
    """Eight bytes for every shingle of a text; a text of fewer words is one shingle, an empty one has none."""
    from xxhash import xxh64_digest

    found = text.lower().split()
    if not found:
        return b""
    joined = b" ".join(found)
    if len(found) <= words:
        return xxh64_digest(joined, SEED)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    spans = zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)
    return b"".join([xxh64_digest(joined[s:e], SEED) for s, e in spans])


def text_fingerprint(text: bytes, words: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes, repeats included."""
    hashes = shingle_hashes(text, words)
    if not hashes:
        return 0
    digests = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(digests), ROWS):
        counts += np.unpackbits(digests[at : at + ROWS], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(digests)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` per row; ``fp`` is the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            fps = pa.array([text_fingerprint(t.as_py(), words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "text_hash", "fp"])

    content = text_of(text)
    columns = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(content).alias("text_hash"), content.alias("text"))
    kind = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row and every column the least row that it is connected to; none of them is without links."""
    label = np.arange(len(near))
    while True:
        across = np.where(near, label[:, None], len(near)).min(axis=0)
        back = np.where(near, across[None, :], len(near)).min(axis=1)
        if (back == label).all():
            return label, across
        label = back


def spanning_links(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links that connect what the pairs within ``distance`` bits between two blocks connect.

    The blocks are compared tile by tile; what two tiles connect is reduced to one link per fingerprint.
    """
    us, vs = [], []
    for i in range(0, len(left), TILE):
        for j in range(0, len(right), TILE):
            a, b = left[i : i + TILE], right[j : j + TILE]
            near = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= distance
            rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            near = near[np.ix_(rows, columns)]
            if not near.size:
                continue
            label, across = _forest(near)
            us += [*a[rows].tolist(), *b[columns].tolist()]
            vs += [*a[rows[label]].tolist(), *a[rows[across]].tolist()]
    return us, vs


def _compare(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                found = spanning_links(left.values.to_numpy(), right.values.to_numpy(), distance)
                us += found[0]
                vs += found[1]
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def _ball(value: Column) -> Column:
    """The 32-bit values that differ from ``value`` in one bit and are larger, and itself."""
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(31)), lambda i: value.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
    )
    return F.array_distinct(F.concat(F.array(value), flips))


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``u, v``: links between distinct ``fp`` that connect all that lie within ``distance`` bits.

    ``distance`` is at most 3: two segments and balls of radius 1 find all such pairs.
    """
    if distance > 3:
        raise ValueError("two segments with radius 1 find pairs within 3 bits")
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    segment = F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), F.shiftrightunsigned("fp", 32).alias("value")),
        F.struct(F.lit(1).alias("seg"), low.alias("value")),
    ))
    keys = fps.select("fp", segment.alias("s")).select("fp", "s.seg", "s.value")
    values = stored(keys.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")), "simhash-values")
    # one value of many fingerprints is spread over as many blocks as it fills: few values are so full
    full = values.filter(F.col("n") > TILE).select("seg", "value", F.ceil(F.col("n") / TILE).alias("blocks"))
    block = F.coalesce(F.pmod(F.xxhash64("fp"), F.col("blocks")), F.lit(0)).cast("int").alias("block")
    index = stored(
        lookup_join(keys, full, ["seg", "value"], "left").select("fp", "seg", "value", block)
        .groupBy("seg", "value", "block").agg(F.collect_list("fp").alias("fps")),
        "simhash-index",
    )
    probes = values.select("seg", F.col("value").alias("of"), "n", F.explode(_ball(F.col("value"))).alias("value"))
    # a value meets itself only if several fingerprints have it
    probes = probes.filter((F.col("of") != F.col("value")) | (F.col("n") > 1)).drop("n")
    met = stored(probes.join(values.drop("n"), ["seg", "value"]), "simhash-met")
    left = index.select("seg", F.col("value").alias("of"), F.col("block").alias("b1"), F.col("fps").alias("left"))
    right = index.select("seg", "value", F.col("block").alias("b2"), F.col("fps").alias("right"))
    pairs = met.join(left, ["seg", "of"]).join(right, ["seg", "value"])
    pairs = pairs.filter((F.col("of") != F.col("value")) | (F.col("b1") <= F.col("b2"))).select("left", "right")
    return pairs.mapInArrow(_compare(distance), "u bigint, v bigint").filter("u <> v").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, distance: int = DISTANCE
) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` per row; the component's id is its smallest ``doc_id``."""
    rows = stored(fingerprints(docs, doc_id, text, words), "simhash-rows")
    first = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-first")
    linked = components(links(first.select("fp"), distance))
    of = first.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    of = stored(of, "simhash-components")
    smallest = of.groupBy("component").agg(F.min("first").alias("component_id"))
    found = stored(of.join(smallest, "component").select("fp", "component_id"), "simhash-classes")
    return rows.join(found, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that give their component its id, one of each component."""
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "fp").agg(
        F.min("text_hash").alias("text_hash")
    )
    first = first.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"))
    rows = docs.withColumn("__of", F.xxhash64(text_of(text)))
    kept = rows.join(first, rows[doc_id].eqNullSafe(F.col("__doc")) & (F.col("__of") == F.col("__hash")))
    return kept.dropDuplicates([doc_id, "__of"]).select(*docs.columns)


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
