"""Tree ensembles as one table of nodes: scoring, storage and importances.

A node has the columns of ``SCHEMA``: numbers run from 0, the root, in every tree; a row goes ``left`` if its feature is at
most the threshold, and right otherwise, unknown values too; a leaf has no feature (-1), leads to itself and holds a value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Models of at most so many nodes are scored by column expressions; nodes that are shipped to the workers at a time beyond that.
FOLD_NODES, SHIPPED_NODES = 4_000, 4_000_000


def tree_table(rows: list[dict], tree: int) -> pd.DataFrame:
    """The nodes of one tree as a table, in order of their numbers."""
    return pd.DataFrame([{"tree": tree, "node": i, **r} for i, r in enumerate(rows)], columns=COLUMNS)


@dataclass(frozen=True)
class RankModel:
    """A trained ranker: trees whose values are summed with a weight, over named features."""

    kind: str
    names: list[str]
    nodes: pd.DataFrame
    rate: float
    history: list[dict] = field(default_factory=list)

    @cached_property
    def trees(self) -> list[tuple[int, int]]:
        """First and last place (exclusive) of every tree in ``nodes``."""
        starts = np.flatnonzero(self.nodes["node"].to_numpy() == 0)
        return list(zip(starts.tolist(), [*starts[1:].tolist(), len(self.nodes)], strict=True))

    def _arrays(self, first: int, last: int) -> dict[str, np.ndarray]:
        """Columns of the trees from ``first`` to ``last``, with places in them instead of numbers of nodes."""
        low, high = self.trees[first][0], self.trees[last - 1][1]
        part = self.nodes.iloc[low:high]
        out = {c: part[c].to_numpy() for c in COLUMNS}
        root = np.repeat([a - low for a, _ in self.trees[first:last]], [b - a for a, b in self.trees[first:last]])
        out["left"], out["right"] = (out[c] + root for c in ("left", "right"))
        out["root"] = np.array([a - low for a, _ in self.trees[first:last]])
        return out

    def depth(self) -> int:
        """Splits on the longest way from a root to a leaf."""
        if not self.trees:
            return 0
        at, depth = self._arrays(0, len(self.trees)), 0
        level = at["root"]
        while len(level := level[at["feature"][level] >= 0]):
            level, depth = np.concatenate([at["left"][level], at["right"][level]]), depth + 1
        return depth

    def transform(self, df: DataFrame, out: str = "model_score") -> DataFrame:
        """``df`` with the score of every row: by column expressions for small models, by Arrow batches for others."""
        if not self.trees:
            return df.withColumn(out, F.lit(0.0))
        if len(self.nodes) <= FOLD_NODES:
            return df.withColumn(out, self._folded())
        total = F.lit(0.0)
        for first, last in self._shipments():
            total = total + self._walked(df.sparkSession, first, last)
        return df.withColumn(out, total)

    def _folded(self) -> Column:
        """The sum over all trees as one array fold, a walk from each root as another inside."""
        at = self._arrays(0, len(self.trees))

        def held(name: str, kind: str) -> Column:
            return F.array(*[F.lit(v) for v in at[name].tolist()]).cast(f"array<{kind}>")

        feature = F.array(*[F.lit(max(v, 0)) for v in at["feature"].tolist()]).cast("array<int>")
        threshold, left, right, value = held("threshold", "double"), held("left", "int"), held("right", "int"), held("value", "double")
        given = F.array(*[F.col(n).cast("double") for n in self.names])
        steps = F.sequence(F.lit(1), F.lit(max(1, self.depth())))

        def walk(node: Column, _: Column) -> Column:
            known = F.coalesce(F.get(given, F.get(feature, node)), F.lit(float("nan")))
            return F.when(known <= F.get(threshold, node), F.get(left, node)).otherwise(F.get(right, node))

        roots = F.array(*[F.lit(int(r)) for r in at["root"]]).cast("array<int>")
        return F.aggregate(
            roots, F.lit(0.0), lambda total, root: total + F.lit(self.rate) * F.get(value, F.aggregate(steps, root, walk))
        )

    def _shipments(self) -> Iterator[tuple[int, int]]:
        """Runs of trees of bounded size."""
        first, size = 0, 0
        for i, (low, high) in enumerate(self.trees):
            if size and size + high - low > SHIPPED_NODES:
                yield first, i
                first, size = i, 0
            size += high - low
        yield first, len(self.trees)

    def _walked(self, spark: SparkSession, first: int, last: int) -> Column:
        shipped, rate = spark.sparkContext.broadcast(self._arrays(first, last)), self.rate

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            at = shipped.value
            for columns in batches:
                given = np.stack([c.to_numpy(float, na_value=np.nan) for c in columns], axis=1)
                total = np.zeros(len(given))
                for root in at["root"].tolist():
                    total += rate * at["value"][walked(at, given, root)]
                yield pd.Series(total)

        return score(*[F.col(n).cast("double") for n in self.names])

    def feature_importance(self) -> dict[str, float]:
        """Gain share per feature, averaged over the trees that split."""
        total, counted = np.zeros(len(self.names)), 0
        for low, high in self.trees:
            part = self.nodes.iloc[low:high]
            split = part["feature"].to_numpy() >= 0
            gains = np.bincount(part["feature"].to_numpy()[split], part["gain"].to_numpy()[split], len(self.names))
            if gains.sum() > 0:
                total, counted = total + gains / gains.sum(), counted + 1
        return dict(zip(self.names, (total / max(counted, 1)).tolist(), strict=True))

    def save(self, spark: SparkSession, path: str) -> None:
        """One table of nodes and one of what is known of the whole."""
        table = pa.Table.from_pandas(self.nodes, preserve_index=False)
        nodes = spark.createDataFrame(table).select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in SCHEMA.split(", ")])
        nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(self.kind, self.names, len(self.trees), self.rate)]
        schema = "kind STRING, names ARRAY<STRING>, trees INT, rate DOUBLE"
        spark.createDataFrame(meta, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RankModel:
        meta = spark.read.parquet(f"{path}/meta").first()
        return from_nodes(meta["kind"], list(meta["names"]), spark.read.parquet(f"{path}/nodes"), meta["rate"])


def walked(at: dict[str, np.ndarray], given: np.ndarray, root: int) -> np.ndarray:
    """The leaf that each row of ``given`` comes to from ``root``."""
    node, rows = np.full(len(given), root), np.arange(len(given))
    while len(rows):
        here = node[rows]
        feature = at["feature"][here]
        rows, here, feature = rows[feature >= 0], here[feature >= 0], feature[feature >= 0]
        node[rows] = np.where(given[rows, feature] <= at["threshold"][here], at["left"][here], at["right"][here])
    return node


def from_nodes(kind: str, names: list[str], nodes: DataFrame, rate: float, history: list[dict] | None = None) -> RankModel:
    """A model from a table of its nodes, which the driver holds."""
    held = nodes.select(*COLUMNS).toArrow().to_pandas().sort_values(["tree", "node"], ignore_index=True)
    return RankModel(kind, names, held, rate, history or [])
