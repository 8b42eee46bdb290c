"""CSV whose quoted fields may hold line ends, read by as many tasks as the file has splits.

A file is read line by line.  Whether a split begins inside a quoted field follows from the quotes before it: each split counts its
own, and a running sum over the splits of a file gives the rest.  A task then puts the lines of its split together to records;
what a record has in other splits are fragments, few, and these are joined in their order.

Quotes must stand around fields or be doubled inside them.  Records end at a line feed, with or without a carriage return.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagerank.operators.sizing import lookup_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds of what a split gives: whole records, and parts of records that end, fill or begin a split.
WHOLE, TAIL, MIDDLE, HEAD = range(4)
PIECES = "file string, block bigint, line bigint, kind int, text string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records of the splits of a task, whose lines come in order."""
    at, inside, held, kind, number = None, False, [], WHOLE, 0
    out: list[list] = [[] for _ in range(5)]

    def put(as_kind: int) -> None:
        nonlocal held, number
        for column, value in zip(out, (*at, number, as_kind, "\n".join(held)), strict=True):
            column.append(value)
        held, number = [], number + 1

    def flush() -> pa.RecordBatch:
        nonlocal out
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["file", "block", "line", "kind", "text"])
        out = [[] for _ in range(5)]
        return batch

    for batch in batches:
        for file, block, open_, text in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "open", "value")), strict=True):
            if (file, block) != at:
                if held:
                    put(MIDDLE if kind == TAIL else HEAD)
                at, inside, number = (file, block), open_, 0
                kind = TAIL if inside else WHOLE
            held.append(text)
            if text.count('"') % 2:
                inside = not inside
            if not inside:
                put(kind)
                kind = WHOLE
        yield flush()
    if held:
        put(MIDDLE if kind == TAIL else HEAD)
    yield flush()


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line, text``: the records of quoted CSV files with their place, header lines included."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = counted.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("open"))
    found = lookup_join(lines, opened, ["file", "block"]).select("file", "block", "open", "value").mapInArrow(_pieces, PIECES)
    whole = found.filter(F.col("kind") == WHOLE).select("file", "block", "line", "text")
    order = Window.partitionBy("file").orderBy("block", "line")
    parts = found.filter(F.col("kind") != WHOLE)
    parts = parts.withColumn("record", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
    joined = parts.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("parts")
    ).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["line"].alias("line"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
    )
    return whole.union(joined)


def read_quoted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of quoted CSV files with a header line each, and ``seq``, their place.  Malformed records fail."""
    rows = records(spark, path).filter((F.col("block") != 0) | (F.col("line") != 0))
    rows = rows.withColumn("text", F.regexp_replace("text", "\r$", "")).filter(F.trim("text") != "")
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    parsed = F.from_csv("text", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields), options)
    return rows.select(parsed.alias("r"), F.struct("file", "block", "line").alias("seq")).select("r.*", "seq")
