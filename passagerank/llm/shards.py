"""Shards of nearly equal bytes: minimax contiguous partition of ordered atomic groups.

Equal texts hash alike, so the hash orders all groups of equal texts: the atomic groups.  The smallest feasible shard
capacity over them is found by binary search with a greedy check, and the shards are cut there.

The sizes of all groups need not reach the driver for that.  A range of the order stands for the groups in it.  Taken as
one, ranges give a capacity that suffices; cut anywhere, they give one below which nothing will do.  Only ranges in which a
greedy cut under a capacity between these may fall are divided again, until both capacities are equal and every
cut stands between two groups.

Edge cases: a null text counts as empty; an empty table gives no rows; repeated rows are rows of
their own, in the same shard and with slots of their own; more shards than groups leaves
shards empty; one group above the mean shard size sets the capacity, and the other
shards share the rest evenly; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagerank.llm.shared import stored, text_of

#: Bits of the hash that make the first ranges, and more bits of it for each division.
BUCKET_BITS, MORE_BITS = 16, 6
#: A row costs its text and so many bytes.
ROW_BYTES = 8


def feasible(prefix: np.ndarray, n_shards: int, capacity: int) -> bool:
    """Whether filling shards greedily up to ``capacity`` places every group."""
    at = 0
    for _ in range(n_shards):
        at = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        if at == len(prefix) - 1:
            return True
    return False


def smallest_capacity(sizes: np.ndarray, n_shards: int) -> int:
    """The least capacity with which ``n_shards`` contiguous runs hold all ordered sizes."""
    if not len(sizes):
        return 0
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    total, largest = int(prefix[-1]), int(sizes.max())
    low = max(largest, -(-total // n_shards))
    high = low + largest
    while low < high:
        middle = (low + high) // 2
        if feasible(prefix, n_shards, middle):
            high = middle
        else:
            low = middle + 1
    return low


def cut_points(sizes: np.ndarray, n_shards: int) -> list[int]:
    """Starts of the shards (and the end) under the smallest capacity.

    Of all cuts under that capacity, the one that keeps what is left most even is taken.
    """
    n = len(sizes)
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    capacity = smallest_capacity(sizes, n_shards)
    earliest = [n]  # earliest[k]: first group from which k shards can hold all that follows
    for _ in range(n_shards):
        earliest.append(int(np.searchsorted(prefix, prefix[earliest[-1]] - capacity, "left")))
    starts = [0]
    for shard in range(n_shards - 1):
        at, left = starts[-1], n_shards - shard - 1
        aim = prefix[at] + (prefix[-1] - prefix[at]) / (left + 1)
        end = int(np.searchsorted(prefix, aim, "left"))
        if end > at and aim - prefix[end - 1] < prefix[min(end, n)] - aim:
            end -= 1
        last = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        starts.append(min(max(end, at, earliest[left]), last))
    return [*starts, n]


def _reached(prefix: np.ndarray, atomic: np.ndarray, at: int, capacity: int, divide: bool) -> int:
    """Bytes up to which a shard that begins at byte ``at`` is filled; with ``divide`` ranges of several groups may be cut anywhere."""
    end = min(at + capacity, int(prefix[-1]))
    segment = int(np.searchsorted(prefix, end, "right")) - 1
    return end if segment == len(atomic) or (divide and not atomic[segment]) else max(int(prefix[segment]), 0)


def _least_divided(prefix: np.ndarray, atomic: np.ndarray, n_shards: int, low: int, high: int) -> int:
    """The least capacity from ``low`` to ``high`` that holds everything if ranges of several groups may be cut anywhere."""
    def fits(capacity: int) -> bool:
        at = 0
        for _ in range(n_shards):
            at = _reached(prefix, atomic, at, capacity, True)
        return at == int(prefix[-1])

    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def undecided(sizes: np.ndarray, atomic: np.ndarray, n_shards: int) -> np.ndarray:
    """Ranges of several groups that a cut under the smallest capacity over single groups may fall into."""
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    enough = smallest_capacity(sizes, n_shards)
    largest = int(sizes[atomic].max()) if atomic.any() else 0
    least = _least_divided(prefix, atomic, n_shards, max(largest, -(-int(prefix[-1]) // n_shards)), enough)
    if least == enough:
        return np.zeros(0, np.int64)
    found, low, high = np.zeros(len(sizes), bool), 0, 0
    for _ in range(n_shards):
        low, high = _reached(prefix, atomic, low, least, False), _reached(prefix, atomic, high, enough, True)
        found[max(0, np.searchsorted(prefix, low, "right") - 1) : np.searchsorted(prefix, high, "right")] = True
    return np.flatnonzero(found & ~atomic)


def _ranges(rows: DataFrame, bits: int) -> list[tuple[int, int, int, bool]]:
    """First hash (unsigned), bits, size of every range of the hash's first ``bits``, and whether it holds one group alone."""
    start = F.shiftrightunsigned("__hash", 64 - bits).alias("__start") if bits < 64 else F.col("__hash").alias("__start")
    found = rows.groupBy(start).agg(F.sum("size").alias("b"), (F.min("__hash") == F.max("__hash")).alias("one")).collect()
    return [((r["__start"] << (64 - bits)) % 2**64, bits, r["b"], r["one"]) for r in found]


def cut_hashes(rows: DataFrame, n_shards: int, bucket_bits: int = BUCKET_BITS, more_bits: int = MORE_BITS) -> list[int]:
    """The hashes (unsigned) at which shards after the first begin, for ``rows(__hash, size)``; 2 ** 64 where nothing is left."""
    ranges = sorted(_ranges(rows, bucket_bits))
    while True:
        sizes = np.array([r[2] for r in ranges], np.int64)
        atomic = np.array([r[3] for r in ranges], bool)
        open_ = undecided(sizes, atomic, n_shards) if len(sizes) else []
        if not len(open_):
            starts = cut_points(sizes, n_shards)
            return [ranges[at][0] if at < len(ranges) else 2**64 for at in starts[1:-1]]
        # a few ranges around every cut, each of which is divided into so many more
        chosen = [ranges[i] for i in open_]
        kept = [r for i, r in enumerate(ranges) if i not in set(open_.tolist())]
        for bits in sorted({r[1] for r in chosen}):
            names = [r[0] >> (64 - bits) for r in chosen if r[1] == bits]
            wanted = rows.sparkSession.createDataFrame([(n,) for n in names], "__name BIGINT")
            mine = rows.withColumn("__name", F.shiftrightunsigned("__hash", 64 - bits)).join(F.broadcast(wanted), "__name", "left_semi")
            kept += _ranges(mine, min(64, bits + more_bits))
        ranges = sorted(kept)


def assign_shards(
    docs: DataFrame, n_shards: int = 24, doc_id: str = "doc_id", text: str = "text", bucket_bits: int = BUCKET_BITS
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; equal texts share a shard.

    ``slot`` counts the rows of a shard from 0 without gaps.  A bucket with very many rows is
    numbered in pieces by a hash of the id, so no task sorts a whole hot group.
    """
    spark = docs.sparkSession
    content = text_of(text)
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(content) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"),
            F.xxhash64(content).alias("__hash"),
        ).withColumn("__bucket", F.shiftrightunsigned("__hash", 64 - bucket_bits).cast("int")),
        "shards",
    )
    shard = F.lit(0)
    for cut in cut_hashes(rows.select("__hash", "size"), n_shards, bucket_bits):
        # signed numbers with the sign bit turned around are in the order of unsigned ones
        if cut < 2**64:
            turned = F.col("__hash").bitwiseXOR(F.lit(-(2**63)))
            shard = shard + (turned >= F.lit(cut - 2**63)).cast("int")
    rows = rows.withColumn("shard", shard.cast("int"))
    held = ["shard", "__bucket"]
    per_bucket = rows.groupBy(*held).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {(r["shard"], r["__bucket"]): r["n"] for r in per_bucket}

    most = max(512, 4 * -(-sum(counts.values()) // (1 << bucket_bits)))
    parts = {k: -(-n // most) for k, n in counts.items() if n > most}
    hot = spark.createDataFrame([(*k, p) for k, p in parts.items()], "shard INT, __bucket INT, __parts INT")
    rows = rows.join(F.broadcast(hot), held, "left").withColumn(
        "__part", F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("__parts").cast("long")), F.lit(0)).cast("int")
    )
    pieces = {(*k, 0): n for k, n in counts.items() if k not in parts}
    if parts:
        found = rows.filter("__parts is not null").groupBy(*held, "__part").count().collect()
        pieces |= {(r["shard"], r["__bucket"], r["__part"]): r["count"] for r in found}

    offsets, filled = [], [0] * n_shards
    for (shard_, bucket, part), n in sorted(pieces.items()):
        offsets.append((shard_, bucket, part, filled[shard_]))
        filled[shard_] += n
    places = spark.createDataFrame(offsets, "shard INT, __bucket INT, __part INT, __offset BIGINT")
    order = Window.partitionBy(*held, "__part").orderBy("__hash", "doc_id")
    return (
        rows.withColumn("__rank", F.row_number().over(order))
        .join(F.broadcast(places), [*held, "__part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("__offset") + F.col("__rank") - 1).alias("slot"))
    )
