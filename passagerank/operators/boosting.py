"""Boosted ranking trees from shared histograms, leaf by leaf.

Features are binned once.  Rows stand in blocks of whole queries, sorted once, and stay where they are: a round is one pass that applies
the last tree and forms the gradients of every query, and one small pass per growth step that sums histograms of
(leaf, feature, bin).  Only histograms are exchanged, one row per bin.  The leaf with the greatest gain is split first; of two
children the smaller is summed, and the other is the difference.  All sums are integers, so they do not depend on the partitioning.

A query of more rows than a block is in blocks of its own, and its gradients come from pairs of blocks.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagerank.operators.pairs import lambda_gradients
from passagerank.operators.sizing import lookup_join
from passagerank.operators.trees import COLUMNS, RankModel, tree_table
from passagerank.operators.workspace import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block; pairs of a query looked at together; rounds after which the state is written.
BLOCK_ROWS, PAIRS, CUT_ROUNDS = 1 << 16, 1 << 21, 10
#: Rows that are worth a task of their own; tasks whose histograms the driver may sum itself.
TASK_ROWS, DIRECT = 1 << 14, 16
#: Rows of a query that one task looks at; a longer one is cut.
QUERY_ROWS = 1 << 18
#: What every row in a pair adds to the Hessian of its leaf: a pair that is ordered very wrongly bends hardly at all
#: but pulls with all its weight.
RIDGE = 1e-3
#: Bins of a feature at most.
WIDTH = 1 << 10
#: Gradients are summed as integers of this part.
UNIT = 2.0**-28
#: Rows that the bounds of the bins are found from at most.
BIN_ROWS = 200_000

STATE = (
    "block long, qid {qid}, docs array<{doc}>, sizes array<int>, label binary, bins binary, best binary, score binary, "
    "grad binary, hess binary"
)
HISTOGRAM = "leaf int, feature int, bin int, grad bigint, hess bigint, n bigint"


# bins


def bin_bounds(rows: DataFrame, names: list[str], max_bins: int, sampled: int = BIN_ROWS) -> list[np.ndarray]:
    """Upper bounds of the bins of every feature: all its values if they are few, quantiles otherwise.

    They are found from ``sampled`` rows at most, chosen by a hash, as is usual for histograms; every row is binned.
    """
    count = rows.count()
    part = rows.select(*[F.col(n).cast("double") for n in names])
    if count > sampled:
        part = rows.filter(F.pmod(F.xxhash64("qid", "doc_id"), F.lit(-(-count // sampled))) == 0).select(*part.columns)
    held = part.toArrow()
    bounds = []
    for n in names:
        values = np.sort(held.column(n).drop_null().to_numpy())
        values = values[~np.isnan(values)]
        distinct = np.unique(values)
        if len(distinct) > max_bins:
            distinct = np.unique(values[(np.arange(1, max_bins + 1) * len(values)) // max_bins - 1])
        bounds.append(distinct[:-1])
    return bounds


def binned(values: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: the first whose bound it does not exceed; unknown ones fall in the last."""
    return np.stack([np.searchsorted(b, values[:, i], "left") for i, b in enumerate(bounds)], axis=1).astype(np.uint16)


# blocks of whole queries


def _best_dcg(label: np.ndarray, cutoffs: tuple[int, ...]) -> list[float]:
    gain = np.sort(np.exp2(np.maximum(label, 0)) - 1)[::-1] / np.log2(2.0 + np.arange(len(label)))
    total = np.cumsum(gain)
    return [float(total[-1]), *(float(total[min(k, len(total)) - 1]) for k in cutoffs)]


def blocks(
    rows: DataFrame, names: list[str], bounds: list[np.ndarray], cutoffs: tuple[int, ...], tied: str = "doc_id", large: bool = False
) -> DataFrame:
    """The state before the first round.  Rows of equal score stand in the order of ``tied``.

    With ``large`` a block is a part of one query.
    """
    spark, n_features = rows.sparkSession, len(names)
    shipped = spark.sparkContext.broadcast(bounds)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, number = shipped.value, TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush(schema):
            nonlocal held, number
            label, bins = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            zero = np.zeros(len(label))
            best = np.array([_best_dcg(h[1], cutoffs) for h in held])
            row = [
                [number], [held[0][0] if large else None], [held[0][3] if large else []], [[len(h[1]) for h in held]], [label.tobytes()],
                [bins.tobytes()], [best.tobytes()], [zero.tobytes()], [zero.tobytes()], [zero.tobytes()],
            ]
            held, number = [], number + 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

        last: list[pa.Table] = []
        schema = None

        def queries() -> Iterator[pa.Table]:
            """Whole queries: a query may run over batches."""
            nonlocal last, schema
            for batch in batches:
                table = pa.table(batch)
                schema = schema or _state_schema(table.schema.field("qid").type, table.schema.field("doc_id").type)
                ids = table.column("qid").combine_chunks()
                codes = ids.dictionary_encode().indices.to_numpy()
                cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(table)]
                for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                    part = table.slice(low, high - low)
                    if last and last[0].column("qid")[0] != part.column("qid")[0]:
                        yield pa.concat_tables(last)
                        last = []
                    last.append(part)
            if last:
                yield pa.concat_tables(last)

        for table in queries():
            label = table.column("label").to_numpy().astype(np.float64)
            values = np.stack([table.column(f"__f{i}").to_numpy() for i in range(n_features)], axis=1)
            ids = table.column("doc_id").to_pylist() if large else []
            held.append((table.column("qid")[0].as_py(), label, binned(values, bounds), ids))
            if large or sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                yield flush(schema)
        if held:
            yield flush(schema)

    features = [F.coalesce(F.col(n).cast("double"), F.lit(float("nan"))).alias(f"__f{i}") for i, n in enumerate(names)]
    wanted = rows.select("qid", "doc_id", F.coalesce("label", F.lit(0)).alias("label"), *features)
    order = F.col("doc_id") if tied == "doc_id" else F.col("doc_id").cast("string").desc()
    count = rows.count()
    parts = max(min(spark.sparkContext.defaultParallelism, -(-count // TASK_ROWS)), -(-count // (4 * BLOCK_ROWS)), 1)
    if large:
        # more parts than a query of this size has blocks, so that none is much larger than a block
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(2 * parts)).alias("__salt")
        placed = wanted.repartition(2 * parts, "qid", salt).sortWithinPartitions("qid", order)
    else:
        placed = wanted.repartition(parts, "qid").sortWithinPartitions("qid", order)
    return placed.mapInArrow(run, STATE.format(qid=kinds["qid"], doc=kinds["doc_id"]))


def stepped(state: DataFrame, tree: Tree | None, rate: float, n_features: int) -> DataFrame:
    """The rows of the blocks of large queries with their scores after ``tree``, each with its place in its block."""
    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    doc = kinds["docs"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                label, score = _part(batch, i, "label", np.float64), _part(batch, i, "score", np.float64)
                if tree is not None:
                    bins = _part(batch, i, "bins", np.uint16).reshape(-1, n_features)
                    score = score + rate * tree.values[tree.leaves(bins)]
                n = len(label)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("block")[i].as_py()] * n, pa.int64()), pa.array(np.arange(n)),
                        pa.array([batch.column("qid")[i].as_py()] * n, batch.column("qid").type),
                        batch.column("docs")[i].values, pa.array(label), pa.array(score),
                    ],
                    ["block", "pos", "qid", "doc_id", "label", "score"],
                )

    return state.mapInArrow(run, f"block long, pos long, qid {kinds['qid']}, doc_id {doc}, label double, score double")


def pull_large(state: DataFrame, tree: Tree | None, rate: float, n_features: int) -> DataFrame:
    """As ``pull``, for parts of queries: the pairs of a query are summed block by block of its ranking."""
    rows = cut(stepped(state, tree, rate, n_features))
    pulled = rows.join(lambda_gradients(rows.select("qid", "doc_id", "label", "score")), ["qid", "doc_id"])
    made = pulled.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "score", "grad", "hess"))).alias("made"))
    names = state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("made")[i].values
                score, grad, hess = (held.field(c).to_numpy(zero_copy_only=False) for c in ("score", "grad", "hess"))
                made = [score, *_units(grad, hess)]
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c) for c in names[:-3]), *(pa.array([m.tobytes()]) for m in made)], names
                )

    return state.join(made, "block").select(*names, "made").mapInArrow(run, state.schema)


def _units(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients as integers; rows that stand in a pair get the ridge."""
    hess = np.where((hess > 0) | (grad != 0), hess + RIDGE, 0.0)
    return tuple(np.round(v / UNIT).astype(np.int64) for v in (grad, hess))


def _state_schema(qid: pa.DataType, doc: pa.DataType) -> pa.Schema:
    kinds = [pa.int64(), qid, pa.list_(doc), pa.list_(pa.int32()), *[pa.binary()] * 6]
    names = [c.split()[0] for c in STATE.replace("array<{doc}>", "x").split(", ")]
    return pa.schema(list(zip(names, kinds, strict=True)))


# a round


@dataclass(frozen=True)
class Tree:
    """Splits in the order they were made: (leaf, feature, bin, left, right); values of the leaves, by number."""

    splits: list[tuple[int, int, int, int, int]]
    values: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        found = np.zeros(len(bins), np.int32)
        for leaf, feature, at, left, right in self.splits:
            here = np.flatnonzero(found == leaf)
            found[here] = np.where(bins[here, feature] <= at, left, right)
        return found


def query_gradients(label: np.ndarray, score: np.ndarray, best: float) -> tuple[np.ndarray, np.ndarray]:
    """Pull and bend of every row of one query, over all pairs of differing labels."""
    grad, hess = np.zeros(len(label)), np.zeros(len(label))
    better = np.flatnonzero(label > label.min()) if len(label) else np.zeros(0, int)
    if best <= 0 or not len(better):
        return grad, hess
    rank = np.empty(len(label))
    rank[np.argsort(-score, kind="stable")] = np.arange(len(label))
    gain, discount = np.exp2(label) - 1.0, 1.0 / np.log2(2.0 + rank)
    step = max(1, PAIRS // len(label))
    for at in range(0, len(better), step):
        some = better[at : at + step]
        apart = np.clip(score[some, None] - score[None, :], -500, 500)
        swap = np.abs(gain[some, None] - gain[None, :]) * np.abs(discount[some, None] - discount[None, :]) / best
        swap[label[some, None] <= label[None, :]] = 0.0
        rho = 1.0 / (1.0 + np.exp(apart))
        pull = rho * swap
        # rho * (1 - rho) without cancellation where rho is near 1
        bend = rho / (1.0 + np.exp(-apart)) * swap
        grad[some] += pull.sum(axis=1)
        hess[some] += bend.sum(axis=1)
        grad -= pull.sum(axis=0)
        hess += bend.sum(axis=0)
    return grad, hess


def _part(batch: pa.RecordBatch, i: int, name: str, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_buffer(), kind)


def pull(state: DataFrame, tree: Tree | None, rate: float, n_features: int, cutoffs: int) -> DataFrame:
    """The state with the scores after ``tree`` and the gradients that they give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                label, score = _part(batch, i, "label", np.float64), _part(batch, i, "score", np.float64)
                best = _part(batch, i, "best", np.float64).reshape(-1, cutoffs + 1)[:, 0]
                if tree is not None:
                    bins = _part(batch, i, "bins", np.uint16).reshape(-1, n_features)
                    score = score + rate * tree.values[tree.leaves(bins)]
                grad, hess, at = np.zeros(len(label)), np.zeros(len(label)), 0
                for n, most in zip(batch.column("sizes")[i].as_py(), best.tolist(), strict=True):
                    span = slice(at, at + n)
                    grad[span], hess[span] = query_gradients(label[span], score[span], most)
                    at += n
                made = [score, *_units(grad, hess)]
                row = batch.slice(i, 1)
                kept = [row.column(c) for c in batch.schema.names[:-3]]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array([m.tobytes()]) for m in made)], batch.schema.names)

    return state.mapInArrow(run, state.schema)


def _counted(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Exact integer sums per bin: two halves, each small enough for the floating sums of a count."""
    high, low = values >> 24, values & 0xFFFFFF
    halves = (np.bincount(at, half, WIDTH).astype(np.int64) for half in (high, low))
    return (next(halves) << 24) + next(halves)


def summed(state: DataFrame, splits: list[tuple], leaves: list[int], n_features: int, few: bool = False) -> dict[int, np.ndarray]:
    """Histograms of the named leaves under ``splits``: per feature and bin the sums of grad, hess and rows.

    Those of a ``few`` tasks are summed by the driver, others after an exchange by bin.
    """
    tree = Tree(splits, np.zeros(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {leaf: np.zeros((n_features * WIDTH, 3), np.int64) for leaf in leaves}
        for batch in batches:
            for i in range(batch.num_rows):
                bins = _part(batch, i, "bins", np.uint16).reshape(-1, n_features)
                sides = [_part(batch, i, c, np.int64) for c in ("grad", "hess")]
                found = tree.leaves(bins)
                for leaf, sums in total.items():
                    rows = np.flatnonzero(found == leaf)
                    for f in range(n_features):
                        at, span = bins[rows, f], slice(f * WIDTH, (f + 1) * WIDTH)
                        for c, values in enumerate(sides):
                            sums[span, c] += _counted(at, values[rows])
                        sums[span, 2] += np.bincount(at, minlength=WIDTH)
        out: list[list[np.ndarray]] = [[] for _ in range(6)]
        for leaf, sums in total.items():
            some = np.flatnonzero(sums[:, 2])
            columns = (np.full(len(some), leaf), some // WIDTH, some % WIDTH, *sums[some].T)
            for column, values in zip(out, columns, strict=True):
                column.append(values)
        kinds = [np.int32] * 3 + [np.int64] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(k)) for c, k in zip(out, kinds, strict=True)],
            ["leaf", "feature", "bin", "grad", "hess", "n"],
        )

    rows = state.select("bins", "grad", "hess").mapInArrow(run, HISTOGRAM)
    if not few:
        rows = rows.groupBy("leaf", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("grad", "hess", "n")])
    # a row per leaf, feature and bin at most, of every task if there are few
    held = rows.toArrow()
    leaf, feature, at = (held.column(c).to_numpy() for c in ("leaf", "feature", "bin"))
    sums = np.stack([held.column(c).to_numpy() for c in ("grad", "hess", "n")], axis=1)
    out = {}
    width = int(at.max()) + 1 if len(at) else 1
    for one in leaves:
        out[one] = np.zeros((n_features, width, 3), np.int64)
        here = leaf == one
        np.add.at(out[one], (feature[here], at[here]), sums[here])
    return out


def best_split(histogram: np.ndarray, min_rows: int, min_hess: float) -> tuple[float, int, int] | None:
    """Gain, feature and bin of the best split of a leaf: the first of several."""
    left = np.cumsum(histogram, axis=1)
    total = left[:, -1:, :]
    (gl, hl, nl), (gr, hr, nr), (gt, ht, _) = (np.moveaxis(side, 2, 0) for side in (left, total - left, total))
    gl, hl, gr, hr, gt, ht = (v * UNIT for v in (gl, hl, gr, hr, gt, ht))
    fits = (nl >= min_rows) & (nr >= min_rows) & (hl >= min_hess) & (hr >= min_hess) & (hl > 0) & (hr > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, gl**2 / hl + gr**2 / hr - np.where(ht > 0, gt**2 / ht, 0.0), -np.inf)
    at = int(np.argmax(gain))
    feature, bin_ = divmod(at, gain.shape[1])
    return (float(gain[feature, bin_]), feature, bin_) if gain[feature, bin_] > 0 else None


def _padded(histogram: np.ndarray, width: int) -> np.ndarray:
    return np.pad(histogram, ((0, 0), (0, width - histogram.shape[1]), (0, 0)))


def grow(
    sums: Callable[[list[tuple], list[int]], dict[int, np.ndarray]], num_leaves: int, min_rows: int, min_hess: float,
    max_depth: int | None = None,
) -> tuple[Tree, dict[int, tuple[float, int, int]]]:
    """One tree, leaf by leaf, from ``sums(splits, leaves)``; and gain, grad, hess and rows behind every split and leaf.

    A growth step asks for the histograms of the children of all leaves that could be split next, so that several splits
    may follow from one pass.
    """
    root = sums([], [0])[0]
    held, depth = {0: root}, {0: 0}
    best = {0: best_split(root, min_rows, min_hess)}
    children: dict[int, tuple[int, int]] = {}
    made: list[tuple] = []  # every split that histograms were asked for
    splits: list[tuple] = []
    leaves, gains, following = [0], {}, 1

    def totals(leaf: int) -> np.ndarray:
        return held[leaf][0].sum(axis=0)

    while len(leaves) < num_leaves:
        able = [i for i in leaves if best[i] is not None and (max_depth is None or depth[i] < max_depth)]
        if not able:
            break
        able.sort(key=lambda i: (-best[i][0], i))
        leaf = able[0]
        if leaf not in children:
            asked = {}
            for i in [j for j in able[: num_leaves - len(leaves)] if j not in children]:
                _, feature, at = best[i]
                low, high = following, following + 1
                following += 2
                children[i] = (low, high)
                made.append((i, feature, at, low, high))
                depth[low] = depth[high] = depth[i] + 1
                rows = np.cumsum(held[i][feature, :, 2])
                asked[i] = low if 2 * rows[at] <= rows[-1] else high
            last = len(leaves) + 1 >= num_leaves
            found = {} if last else sums(made, list(asked.values()))
            for i, small in asked.items():
                low, high = children[i]
                if last:
                    # no more splits: sums of the two sides are enough
                    side = np.cumsum(held[i][best[i][1]], axis=0)[best[i][2]]
                    held[low] = side[None, None, :]
                    held[high] = (totals(i) - side)[None, None, :]
                    best[low] = best[high] = None
                    continue
                other = high if small == low else low
                held[small] = _padded(found[small], held[i].shape[1])
                held[other] = held[i] - held[small]
                for one in (low, high):
                    best[one] = best_split(held[one], min_rows, min_hess)
        low, high = children[leaf]
        gains[leaf] = best[leaf]
        splits.append((leaf, best[leaf][1], best[leaf][2], low, high))
        leaves = [i for i in leaves if i != leaf] + [low, high]
    values = np.zeros(following)
    for leaf in leaves:
        g, h, _ = totals(leaf) * [UNIT, UNIT, 1]
        values[leaf] = g / h if h > 0 else 0.0
    return Tree(splits, values), gains


def as_nodes(tree: Tree, gains: dict, bounds: list[np.ndarray], number: int) -> pd.DataFrame:
    """The tree as a table of nodes, numbered from the root on, with the bounds of bins as thresholds."""
    split = {s[0]: s for s in tree.splits}
    order, at = [0], {0: 0}
    for leaf in order:
        if leaf in split:
            for child in split[leaf][3:]:
                at[child] = len(order)
                order.append(child)
    rows = []
    for leaf in order:
        if leaf in split:
            _, feature, bin_, low, high = split[leaf]
            rows.append({
                "feature": feature, "threshold": float(bounds[feature][bin_]), "left": at[low], "right": at[high],
                "value": 0.0, "gain": gains[leaf][0],
            })
        else:
            rows.append({
                "feature": -1, "threshold": float("inf"), "left": at[leaf], "right": at[leaf],
                "value": float(tree.values[leaf]), "gain": 0.0,
            })
    return tree_table(rows, number)


def validated(state: DataFrame, tree: Tree, rate: float, n_features: int, cutoffs: tuple[int, ...]) -> DataFrame:
    """The validation state after ``tree``; ``grad`` holds the measure of every query at every cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                label, score = _part(batch, i, "label", np.float64), _part(batch, i, "score", np.float64)
                bins = _part(batch, i, "bins", np.uint16).reshape(-1, n_features)
                best = _part(batch, i, "best", np.float64).reshape(-1, len(cutoffs) + 1)
                score = score + rate * tree.values[tree.leaves(bins)]
                found, at = np.zeros((len(best), len(cutoffs))), 0
                for q, n in enumerate(batch.column("sizes")[i].as_py()):
                    top = np.argsort(-score[at : at + n], kind="stable")[: max(cutoffs)]
                    gain = (np.exp2(np.maximum(label[at : at + n][top], 0)) - 1) / np.log2(2.0 + np.arange(len(top)))
                    for c, k in enumerate(cutoffs):
                        found[q, c] = gain[:k].sum() / best[q, c + 1] if best[q, c + 1] > 0 else 0.0
                    at += n
                row = batch.slice(i, 1)
                kept = [row.column(c) for c in batch.schema.names[:-3]]
                made = [score.tobytes(), np.round(found / UNIT).astype(np.int64).tobytes(), b""]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array([m], pa.binary()) for m in made)], batch.schema.names)

    return state.mapInArrow(run, state.schema)


def _means(state: DataFrame, cutoffs: tuple[int, ...]) -> list[float]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(cutoffs) + 1, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                found = _part(batch, i, "grad", np.int64).reshape(-1, len(cutoffs))
                total += np.append(found.sum(axis=0), len(found))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "total"])

    rows = state.select("grad").mapInArrow(run, "at bigint, total bigint").groupBy("at").agg(F.sum("total").alias("total"))
    found = {r["at"]: r["total"] for r in rows.collect()}
    return [found[c] * UNIT / max(found[len(cutoffs)], 1) for c in range(len(cutoffs))]


def fit_leaves(
    rows: DataFrame, names: list[str], splits: list[tuple[int, str, float, int, int]], learning_rate: float = 0.1
) -> RankModel:
    """One boosting step with a given tree: its leaves get the Newton steps of the first round's gradients.

    ``splits`` are (leaf, feature, threshold, left, right), from leaf 0 on, in an order in which a leaf stands before its children.
    """
    at = {n: i for i, n in enumerate(names)}
    bounds = [np.unique([t for _, f, t, _, _ in splits if f == n]) for n in names]
    made = [(leaf, at[f], int(np.searchsorted(bounds[at[f]], t)), low, high) for leaf, f, t, low, high in splits]
    usual, large = _by_size(rows, None)
    state = pull(cut(blocks(usual, names, bounds, ())), None, learning_rate, len(names), 0)
    if large is not None:
        state = state.union(pull_large(cut(blocks(large, names, bounds, (), large=True)), None, learning_rate, len(names)))
    leaves = sorted({c for s in made for c in s[3:]} - {s[0] for s in made}) or [0]
    sums = summed(state, made, leaves, len(names))
    values = np.zeros(max(leaves) + 1)
    for leaf, histogram in sums.items():
        g, h, _ = histogram[0].sum(axis=0) * [UNIT, UNIT, 1]
        values[leaf] = g / h if h > 0 else 0.0
    gains = {s[0]: (0.0, s[1], s[2]) for s in made}
    return RankModel("lambdamart", list(names), as_nodes(Tree(made, values), gains, bounds, 0), learning_rate)


def _by_size(rows: DataFrame, depth: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of queries that a task may hold, and of those that it may not, if there are any."""
    if depth is not None and depth <= QUERY_ROWS:
        return rows, None
    sizes = rows.groupBy("qid").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > QUERY_ROWS)
    long = cut(sizes.select("qid"))
    if long.isEmpty():
        return rows, None
    return lookup_join(rows, long, ["qid"], "left_anti"), lookup_join(rows, long, ["qid"], "left_semi")


def train_lambdamart(
    train: DataFrame,
    valid: DataFrame | None,
    names: list[str],
    rounds: int = 100,
    learning_rate: float = 0.1,
    num_leaves: int = 7,
    max_depth: int | None = None,
    max_bins: int = 255,
    min_rows_in_leaf: int = 20,
    min_hess_in_leaf: float = 1e-3,
    eval_at: tuple[int, ...] = (1, 3, 5, 10),
    early_stopping: int | None = None,
    depth: int | None = None,
) -> RankModel:
    """Gradient-boosted ranker: one tree per round, of ``num_leaves`` leaves, grown best leaf first.

    ``valid`` gives the history of the measures at ``eval_at``; with ``early_stopping`` training ends when the last of
    them has not risen for so many rounds, and the trees after its best round are left out.
    """
    if max_bins >= WIDTH:
        raise ValueError(f"max_bins must be below {WIDTH}")
    bounds, n_features = bin_bounds(train, names, max_bins), len(names)
    usual, large = _by_size(train, depth)
    state = cut(blocks(usual, names, bounds, eval_at))
    huge = cut(blocks(large, names, bounds, eval_at, large=True)) if large is not None else None
    check = cut(blocks(valid, names, bounds, eval_at, tied="evaluator")) if valid is not None else None
    tables, history, tree = [], [], None
    best_round, best_measure = -1, -np.inf
    few = state.rdd.getNumPartitions() <= DIRECT and huge is None
    for i in range(rounds):
        before = state
        state = pull(state, tree, learning_rate, n_features, len(eval_at)).persist(StorageLevel.MEMORY_AND_DISK)
        if huge is not None:
            huge = cut(pull_large(huge, tree, learning_rate, n_features))
        every = state if huge is None else state.union(huge)
        tree, gains = grow(
            lambda splits, leaves: summed(every, splits, leaves, n_features, few),  # noqa: B023
            num_leaves, min_rows_in_leaf, min_hess_in_leaf, max_depth,
        )
        tables.append(as_nodes(tree, gains, bounds, i))
        if (i + 1) % CUT_ROUNDS == 0:
            written = cut(state)
            state.unpersist()
            state = written
        before.unpersist()
        if check is None:
            continue
        old = check
        check = validated(check, tree, learning_rate, n_features, eval_at).persist(StorageLevel.MEMORY_AND_DISK)
        means = _means(check, eval_at)
        old.unpersist()
        if (i + 1) % CUT_ROUNDS == 0:
            written = cut(check)
            check.unpersist()
            check = written
        history.append({"round": i, **{f"ndcg_{k}": m for k, m in zip(eval_at, means, strict=True)}})
        if means[-1] > best_measure:
            best_round, best_measure = i, means[-1]
        elif early_stopping is not None and i - best_round >= early_stopping:
            tables = tables[: best_round + 1]
            break
    state.unpersist()
    if check is not None:
        check.unpersist()
    nodes = pd.concat(tables, ignore_index=True) if tables else pd.DataFrame(columns=COLUMNS)
    return RankModel("lambdamart", list(names), nodes, learning_rate, history)
