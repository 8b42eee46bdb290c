"""Scoring candidates with a model in Arrow batches, in slices that a restart does not repeat.

Candidates are dealt to slices by a hash and written once.  A slice is one job: its rows are scored and written, and what is written
is not scored again.  Inside a task rows are sorted by length and cut into batches by their summed length, so that a model pads
little and a batch fits its memory.  The model is loaded once per worker process.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Model = Callable[[Sequence[str], Sequence[str]], Sequence[float]]


@dataclass(frozen=True)
class BatchScorer:
    """Scores pairs of ``query`` and ``text`` with what ``load`` returns: a function of two lists that gives a list of scores.

    ``path`` keeps finished slices; another scorer needs another path.  ``chars`` is the summed length of a batch,
    ``rows`` what a task sorts at a time.  A null query or text is empty.
    """

    load: Callable[[], Model]
    path: str
    query: str = "query"
    text: str = "text"
    slices: int = 8
    chars: int = 100_000
    rows: int = 4_096
    keys: tuple[str, ...] = ("qid", "doc_id")

    def transform(self, candidates: DataFrame, out: str = "score") -> DataFrame:
        """``candidates`` with the column ``out``; what an earlier run finished is read, not worked out again."""
        spark = candidates.sparkSession
        given, kind = f"{self.path}/candidates", candidates.schema
        if not _marked(spark, given):
            dealt = F.pmod(F.xxhash64(*self.keys), F.lit(self.slices)).cast("int")
            candidates.withColumn("__slice", dealt).write.mode("overwrite").partitionBy("__slice").parquet(given)
            _mark(spark, given)
        rows = spark.read.schema(T.StructType([*kind.fields, T.StructField("__slice", T.IntegerType())])).parquet(given)
        for i in range(self.slices):
            done = f"{self.path}/scored-{i}"
            if not _marked(spark, done):
                self._scored(rows.filter(F.col("__slice") == i).drop("__slice"), out).write.mode("overwrite").parquet(done)
                _mark(spark, done)
        scored = spark.read.schema(candidates.withColumn(out, F.lit(0.0)).schema)
        return scored.parquet(*[f"{self.path}/scored-{i}" for i in range(self.slices)])

    def _scored(self, df: DataFrame, out: str) -> DataFrame:
        load, query, text, chars, most, name = self.load, self.query, self.text, self.chars, self.rows, uuid4().hex
        names = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = _loaded(name, load)
            for whole in batches:
                for at in range(0, whole.num_rows, most):
                    part = whole.slice(at, most)
                    queries, texts = ([v or "" for v in part.column(c).to_pylist()] for c in (query, text))
                    scores: list[float] = [0.0] * part.num_rows
                    for some in cut_by_length([len(q) + len(t) for q, t in zip(queries, texts, strict=True)], chars):
                        found = model([queries[i] for i in some], [texts[i] for i in some])
                        for i, score in zip(some, found, strict=True):
                            scores[i] = float(score)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*names, out])

        return df.mapInArrow(run, df.withColumn(out, F.lit(0.0)).schema)


def cut_by_length(lengths: Sequence[int], chars: int) -> Iterator[list[int]]:
    """Places in order of length, as many at a time as pad to ``chars`` together; a longer one stands alone."""
    held: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        # all of a batch are padded to its longest
        if held and lengths[i] * (len(held) + 1) > chars:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def _loaded(name: str, load: Callable[[], Model]) -> Model:
    """The model of this worker process: a worker outlives its tasks."""
    held = sys.modules["builtins"].__dict__.setdefault("__passagerank_models__", {})
    if name not in held:
        held.clear()
        held[name] = load()
    return held[name]


def _mark(spark: SparkSession, path: str) -> None:
    """Says that the table at ``path`` is whole: written after it."""
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}-whole")


def _marked(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(f"{path}-whole").isEmpty()
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
