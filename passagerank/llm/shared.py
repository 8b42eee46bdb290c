"""What several operators of this subpackage need: stored tables and text columns."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank.operators.workspace import workspace

#: Fixed value: what separates words in every operator here (ASCII white space only).
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and fixes its rows."""
    path = f"{workspace(df.sparkSession)}/llm/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_worker(kind: str, name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, once in a worker process, which outlives its tasks; the last ``name`` of a ``kind`` is kept."""
    held = sys.modules.setdefault("passagerank_worker", ModuleType("passagerank_worker")).__dict__
    if kind not in held or held[kind][0] != name:
        held[kind] = (name, make())
    return held[kind][1]


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs inside; the one from before holds again afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_of(name: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
