"""Random-forest regression: exact trees, grown by shared histograms only while a node is too large for a task.

Rows of a tree are drawn with replacement: every row stands in it as often as a Poisson draw keyed by seed, tree and row says.
A node that fits a task is handed to one, with its rows, which grows all that is below it from the exact values.  All
trees grow side by side.  Larger nodes are split by binned histograms first, level by level; the best split is found where the histograms are
summed, and only splits come to the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passagerank.operators.boosting import bin_bounds
from passagerank.operators.sizing import BROADCAST_BYTES, BROADCAST_ROWS
from passagerank.operators.trees import COLUMNS, SCHEMA, RankModel, from_nodes, tree_table
from passagerank.operators.workspace import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a node that one task grows.
TASK_ROWS = 1_000_000
#: What stands for the chances of 0, 1, 2 and more copies of a row, of 2 ** 32.
POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(12)]) * 2.0**32


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row (by a 64-bit key) stands in a tree."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD6E8FEB86659FD93) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.searchsorted(POISSON, (x >> np.uint64(32)).astype(np.float64), "right")


def grow_exact(values: np.ndarray, target: np.ndarray, weight: np.ndarray, max_depth: int | None = None, min_rows: int = 1) -> pd.DataFrame:
    """Nodes of the tree of least squares, grown level by level until leaves are pure, numbered level by level.

    Every value is a possible threshold (the middle to the next one).  The split with the greatest gain wins, of equal
    ones that of the first feature, then the least value.  Rows are sorted once per feature and keep that order in every node.
    """
    some = np.flatnonzero(weight > 0)
    values, target, weight = values[some], target[some].astype(np.float64), weight[some].astype(np.float64)
    n, n_features = values.shape
    columns: dict[str, list] = {c: [] for c in COLUMNS[2:]}
    orders = [np.argsort(values[:, f], kind="stable") for f in range(n_features)]
    # rows of the level's open nodes, node by node, in the order of every feature
    sizes, first, depth = np.array([n]), 0, 0
    if not n:
        return tree_table([{"feature": -1, "threshold": np.inf, "left": 0, "right": 0, "value": 0.0, "gain": 0.0}], 0)
    wy = weight * target
    while len(sizes):
        node = np.repeat(np.arange(len(sizes)), sizes)
        starts = np.cumsum(sizes) - sizes
        order = orders[0] if n_features else np.arange(n)
        total_w = np.add.reduceat(weight[order], starts)
        total_y = np.add.reduceat(wy[order], starts)
        least, most = (u.reduceat(target[order], starts) for u in (np.minimum, np.maximum))
        gain, feature, threshold = np.zeros(len(sizes)), np.full(len(sizes), -1), np.full(len(sizes), np.inf)
        if max_depth is None or depth < max_depth:
            for f in range(n_features):
                rows = orders[f]
                x = values[rows, f]
                w, y = _running(weight[rows], starts, node), _running(wy[rows], starts, node)
                count = np.arange(1, len(rows) + 1) - starts[node]
                follows = np.append(node[1:] == node[:-1], False)
                after = np.append(x[1:], np.nan)
                fits = follows & (x < after) & (count >= min_rows) & (sizes[node] - count >= min_rows)
                fits &= (least < most)[node]
                at = np.flatnonzero(fits)
                if not len(at):
                    continue
                of = node[at]
                left, right = y[at] ** 2 / w[at], (total_y[of] - y[at]) ** 2 / (total_w[of] - w[at])
                found = left + right - total_y[of] ** 2 / total_w[of]
                # the greatest gain of every node, the first place of it; sums that differ by rounding alone are equal
                found = np.round(found, 9)
                begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                best = np.maximum.reduceat(found, begins)
                here = of[begins]
                place = np.full(len(begins), -1)
                hits = np.flatnonzero(found == np.repeat(best, np.diff(np.append(begins, len(of)))))
                owners, firsts = np.unique(np.searchsorted(here, of[hits]), return_index=True)
                place[owners] = at[hits[firsts]]
                better = best > gain[here]
                gain[here[better]], feature[here[better]] = best[better], f
                middle = x[place[better]] + (after[place[better]] - x[place[better]]) / 2
                threshold[here[better]] = np.where(middle < after[place[better]], middle, x[place[better]])
        split = feature >= 0
        number = first + np.arange(len(sizes))
        children = first + len(sizes) + 2 * (np.cumsum(split) - split)
        columns["feature"].append(feature)
        columns["threshold"].append(threshold)
        columns["left"].append(np.where(split, children, number))
        columns["right"].append(np.where(split, children + 1, number))
        columns["value"].append(total_y / total_w)
        columns["gain"].append(np.where(split, gain, 0.0))
        first, depth = first + len(sizes), depth + 1
        if not split.any():
            break
        # a stable partition keeps the order of every feature inside the children
        goes = np.zeros(n, bool)
        rows, inner = orders[0], split[node]
        goes[rows[inner]] = values[rows[inner], feature[node[inner]]] <= threshold[node[inner]]
        parent = (np.cumsum(split) - 1)[node[inner]]
        begins = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        went = np.add.reduceat(goes[rows[inner]], begins, dtype=np.int64)
        sizes = np.stack([went, np.diff(np.append(begins, len(parent))) - went], axis=1).ravel()
        to = np.cumsum(sizes) - sizes
        orders = [_parted(order[inner], goes, parent, begins, to) for order in orders]
    out = pd.DataFrame({c: np.concatenate(v) for c, v in columns.items()})
    out.insert(0, "node", np.arange(len(out)))
    out.insert(0, "tree", 0)
    return out


def _parted(rows: np.ndarray, goes: np.ndarray, parent: np.ndarray, begins: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The rows of split nodes, those that go left of each before those that go right, otherwise in their order."""
    left = goes[rows].astype(np.int64)
    before = _running(left, begins, parent) - left
    place = np.arange(len(rows)) - begins[parent]
    out = np.empty_like(rows)
    out[np.where(left == 1, to[2 * parent] + before, to[2 * parent + 1] + place - before)] = rows
    return out


def _running(values: np.ndarray, starts: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Running sums that begin anew in every node."""
    total = np.cumsum(values)
    return total - (total[starts] - values[starts])[node]


ROW = "tree int, node int, key long, label double, copies int, {features}"


def _features(n: int) -> str:
    return ", ".join(f"f{i} double" for i in range(n))


def _grown(values, target, weight, tree: int, above: int, max_depth: int | None, min_rows: int) -> pa.RecordBatch:
    """A finished subtree; ``above`` is the number of the node that it stands for."""
    nodes = grow_exact(values, target, weight, max_depth, min_rows)
    nodes["tree"] = tree
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
    columns = [pa.array(nodes[c].to_numpy(), k) for c, k in zip(COLUMNS, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([above] * len(nodes), pa.int32())], [*COLUMNS, "above"])


def train_random_forest(
    train: DataFrame,
    names: list[str],
    n_trees: int = 100,
    max_depth: int | None = None,
    max_bins: int = 255,
    min_rows_in_leaf: int = 1,
    bootstrap: bool = True,
    seed: int = 42,
    task_rows: int | None = None,
) -> RankModel:
    """Random-forest regression on the labels, every feature tried at every split, trees unbounded by default."""
    task_rows = TASK_ROWS if task_rows is None else task_rows
    spark = train.sparkSession
    if not n_trees:
        return RankModel("randomforest", list(names), pd.DataFrame(columns=COLUMNS), 0.0, [])
    features = [F.coalesce(F.col(n).cast("double"), F.lit(float("nan"))).alias(f"f{i}") for i, n in enumerate(names)]
    rows = cut(train.select(
        F.xxhash64("qid", "doc_id").alias("key"), F.coalesce("label", F.lit(0)).cast("double").alias("label"), *features
    ))
    count = rows.count()
    if not count:
        raise ValueError("no rows to learn from")
    if count <= min(task_rows, BROADCAST_ROWS) and count * 8 * (len(names) + 2) <= BROADCAST_BYTES:
        grown = _by_tree(rows, len(names), n_trees, max_depth, min_rows_in_leaf, bootstrap, seed)
        return from_nodes("randomforest", list(names), cut(grown), 1.0 / n_trees)
    top, plain = _Top(n_trees, count), [f"f{i}" for i in range(len(names))]
    bounds = bin_bounds(rows.select(F.col("key").alias("qid"), F.col("key").alias("doc_id"), *plain), plain, max_bins)
    while large := top.large(task_rows):
        found = _level(rows, top, large, bounds, len(names), min_rows_in_leaf, bootstrap, seed)
        top.split(found, large, bounds, max_depth)
    placed = _routed(rows, top, len(names), bootstrap, seed)
    left = {i: (None if max_depth is None else max_depth - d) for i, d in top.depths().items()}

    def finish(table: pa.Table) -> pa.Table:
        values = np.stack([table.column(f"f{i}").to_numpy() for i in range(len(names))], axis=1)
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        batch = _grown(
            values, table.column("label").to_numpy(), table.column("copies").to_numpy(), tree, node, left[tree, node], min_rows_in_leaf
        )
        return pa.Table.from_batches([batch])

    below = cut(placed.groupBy("tree", "node").applyInArrow(finish, f"{SCHEMA}, above int"))
    return top.joined(list(names), below, 1.0 / n_trees)


def _by_tree(rows: DataFrame, n_features: int, n_trees: int, max_depth, min_rows: int, bootstrap: bool, seed: int) -> DataFrame:
    """All trees of a table that a task can hold: the table is sent to the tasks, a tree is the work of one."""
    spark = rows.sparkSession
    held = rows.toArrow()
    # the order of rows must not depend on the partitions they come in
    order = np.lexsort([held.column(c).to_numpy() for c in (*[f"f{i}" for i in range(n_features)], "label", "key")])
    values = np.stack([held.column(f"f{i}").to_numpy() for i in range(n_features)], axis=1)[order]
    shipped = spark.sparkContext.broadcast((values, held.column("label").to_numpy()[order], held.column("key").to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, label, keys = shipped.value
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                weight = draws(keys, tree, seed) if bootstrap else np.ones(len(label), np.int64)
                yield _grown(values, label, weight, tree, 0, max_depth, min_rows)

    trees = spark.range(0, n_trees, 1, n_trees)
    return trees.mapInArrow(run, f"{SCHEMA}, above int").drop("above")


class _Top:
    """The nodes above those that tasks finish: few, as each of them has very many rows.

    A large node that the shared bins cannot split is a leaf, and so is one at the greatest depth.
    """

    def __init__(self, n_trees: int, rows: int):
        self.nodes: dict[tuple[int, int], dict] = {(t, 0): {"rows": rows, "depth": 0, "split": None, "value": None} for t in range(n_trees)}

    def large(self, task_rows: int) -> list[tuple[int, int]]:
        """Nodes with more rows than a task should hold that are neither split nor leaves."""
        return [k for k, v in self.nodes.items() if v["split"] is None and v["value"] is None and v["rows"] > task_rows]

    def split(self, found: list, asked: list[tuple[int, int]], bounds: list[np.ndarray], max_depth: int | None) -> None:
        rows = {(r["tree"], r["node"]): r for r in found}
        following = {t: max(n for s, n in self.nodes if s == t) + 1 for t, _ in asked}
        for key in asked:
            r, held = rows.get(key), self.nodes[key]
            held["value"] = r["y"] / r["w"] if r else 0.0
            if r is None or r["s"] is None or (max_depth is not None and held["depth"] >= max_depth):
                continue
            tree, low, s = key[0], following[key[0]], r["s"]
            following[tree] += 2
            held["split"] = (s["feature"], float(bounds[s["feature"]][s["bin"]]), low, low + 1, s["gain"])
            for child, n in ((low, s["left_n"]), (low + 1, r["n"] - s["left_n"])):
                self.nodes[tree, child] = {"rows": n, "depth": held["depth"] + 1, "split": None, "value": None}

    def depths(self) -> dict[tuple[int, int], int]:
        return {k: v["depth"] for k, v in self.nodes.items()}

    def route(self, values: np.ndarray, tree: int) -> np.ndarray:
        node = np.zeros(len(values), np.int64)
        for (t, n), v in sorted(self.nodes.items()):
            if t == tree and v["split"] is not None:
                here = np.flatnonzero(node == n)
                feature, threshold, low, high, *_ = v["split"]
                node[here] = np.where(values[here, feature] <= threshold, low, high)
        return node

    def joined(self, names: list[str], below: DataFrame, rate: float) -> RankModel:
        """The whole trees: a finished part stands in the place of the node that it was handed."""
        parts = below.toArrow().to_pandas()
        out = []
        for t in sorted({t for t, _ in self.nodes}):
            mine = parts[parts["tree"] == t]
            # top nodes keep their numbers; the nodes below a handed one, but its root, follow
            following = max(n for s, n in self.nodes if s == t) + 1
            rows = {
                n: (t, n, *v["split"][:4], v["value"], v["split"][4]) if v["split"] else (t, n, -1, np.inf, n, n, v["value"], 0.0)
                for (s, n), v in self.nodes.items() if s == t and v["value"] is not None
            }
            for above, part in mine.sort_values(["above", "node"]).groupby("above"):
                part = part.sort_values("node")
                place = np.append(above, following + np.arange(len(part) - 1))
                following += len(part) - 1
                for r, n in zip(part.itertuples(index=False), place.tolist(), strict=True):
                    rows[n] = (t, n, r.feature, r.threshold, int(place[r.left]), int(place[r.right]), r.value, r.gain)
            # a tree that drew no row at all is a leaf
            rows = rows or {0: (t, 0, -1, np.inf, 0, 0, 0.0, 0.0)}
            out += [rows[n] for n in sorted(rows)]
        return RankModel("randomforest", names, pd.DataFrame(out, columns=COLUMNS), rate, [])


def _copies(keys: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    return draws(keys, tree, seed) if bootstrap else np.ones(len(keys), np.int64)


def _routed(rows: DataFrame, top: _Top, n_features: int, bootstrap: bool, seed: int) -> DataFrame:
    """Every row once per tree that it stands in, with the node it has come to, where that is no leaf yet."""
    trees = sorted({t for t, _ in top.nodes})
    handed = {t: np.zeros(max(n for s, n in top.nodes if s == t) + 1, bool) for t in trees}
    for (t, n), v in top.nodes.items():
        handed[t][n] = v["value"] is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(f"f{i}").to_numpy() for i in range(n_features)], axis=1)
            keys = batch.column("key").to_numpy()
            for tree in trees:
                copies = _copies(keys, tree, seed, bootstrap)
                some = np.flatnonzero(copies)
                node = top.route(values[some], tree)
                some, node = some[handed[tree][node]], node[handed[tree][node]]
                part = batch.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), tree, np.int32)), pa.array(node.astype(np.int32)), part.column("key"), part.column("label"),
                        pa.array(copies[some].astype(np.int32)), *(part.column(f"f{i}") for i in range(n_features)),
                    ],
                    ["tree", "node", "key", "label", "copies", *(f"f{i}" for i in range(n_features))],
                )

    return rows.mapInArrow(run, ROW.format(features=_features(n_features)))


def _level(rows: DataFrame, top: _Top, large: list, bounds, n_features: int, min_rows: int, bootstrap: bool, seed: int) -> list:
    """Rows, copies and sum of every large node, and its best binned split ``s`` if there is one: one row each."""
    wanted = set(large)
    trees = sorted({t for t, _ in wanted})
    unit = 2.0**-20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            values = np.stack([batch.column(f"f{i}").to_numpy() for i in range(n_features)], axis=1)
            bins = [np.searchsorted(b, values[:, f], "left") for f, b in enumerate(bounds)]
            label, keys = batch.column("label").to_numpy(), batch.column("key").to_numpy()
            for tree in trees:
                copies, node = _copies(keys, tree, seed, bootstrap), top.route(values, tree)
                for n in np.unique(node[copies > 0]).tolist():
                    if (tree, n) not in wanted:
                        continue
                    here = np.flatnonzero((node == n) & (copies > 0))
                    for f in range(n_features):
                        sums = total.setdefault((tree, n, f), np.zeros((len(bounds[f]) + 1, 3), np.int64))
                        at, size = bins[f][here], len(sums)
                        sums[:, 0] += np.bincount(at, minlength=size)
                        sums[:, 1] += np.bincount(at, copies[here], size).astype(np.int64)
                        sums[:, 2] += np.round(np.bincount(at, copies[here] * label[here], size) / unit).astype(np.int64)
        out = [(t, n, f, b, *s) for (t, n, f), sums in total.items() for b, s in enumerate(sums.tolist()) if s[0]]
        kinds = [pa.int32()] * 4 + [pa.int64()] * 3
        columns = list(zip(*out, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["tree", "node", "feature", "bin", "n", "w", "y"]
        )

    found = rows.mapInArrow(run, "tree int, node int, feature int, bin int, n long, w long, y long")
    summed = found.groupBy("tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), (F.sum("y") * unit).alias("y"))
    # a feature of a node has as many rows as bins
    whole = Window.partitionBy("tree", "node", "feature")
    walk = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = summed.select(
        "tree", "node", "feature", "bin",
        *[F.sum(c).over(walk).alias(f"left_{c}") for c in ("n", "w", "y")], *[F.sum(c).over(whole).alias(c) for c in ("n", "w", "y")],
    ).filter((F.col("left_n") >= min_rows) & (F.col("n") - F.col("left_n") >= max(min_rows, 1)))
    gain = F.pow("left_y", F.lit(2.0)) / F.col("left_w") + F.pow(F.col("y") - F.col("left_y"), F.lit(2.0)) / (
        F.col("w") - F.col("left_w")
    ) - F.pow("y", F.lit(2.0)) / F.col("w")
    best = placed.withColumn("gain", F.round(gain, 9)).filter("gain > 0").groupBy("tree", "node").agg(
        F.max_by(F.struct("feature", "bin", "gain", "left_n"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("s")
    )
    whole = summed.filter("feature = 0").groupBy("tree", "node").agg(*[F.sum(c).alias(c) for c in ("n", "w", "y")])
    return whole.join(best, ["tree", "node"], "left").collect()
