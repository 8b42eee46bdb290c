"""Stance data: labels, folds and the weighted score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.operators.sizing import lookup_join

# Stance names and their labels.
LABELS = {"agree": 1, "disagree": 2, "discuss": 3, "unrelated": 4}


def stance_to_label(stance: Column) -> Column:
    label = F.lit(None).cast("int")
    for name, value in reversed(LABELS.items()):
        label = F.when(stance == name, F.lit(value)).otherwise(label)
    unknown = F.raise_error(F.concat(F.lit("Stance does not exist: "), F.coalesce(stance, F.lit("null"))))
    return F.when(stance.isin(*LABELS), label).otherwise(unknown.cast("int"))


def first_bodies(bodies: DataFrame, order: Sequence[str]) -> DataFrame:
    """One text per body id, the first in ``order``: an aggregate, so repeats combine before the exchange."""
    first = F.min_by("article_body", F.struct(*order))
    return bodies.groupBy("body_id").agg(first.alias("article_body"))


def pair_bodies(stances: DataFrame, bodies: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Stances with the text of their body."""
    return lookup_join(stances, first_bodies(bodies, order), ["body_id"])


def shuffle_key(row_id: Column, seed: int) -> Column:
    """Reproducible random order: the same on every engine and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


#: Keys that the driver sorts to find one cut; hex digits that a counting pass looks at.
CUT_KEYS, DIGITS = 4_096, 3


def kfold(
    stances: DataFrame,
    n: int,
    seed: int = 42,
    row_id: str = "row_id",
    compat: bool = False,
    cut_keys: int = CUT_KEYS,
) -> DataFrame:
    """Add ``fold`` in 0..n-1 after a seeded shuffle; fold i begins at ceil(i/n*size).

    Rows do not move: the keys at which folds begin are found by counting, and a row is labelled by its own key.  Rows of
    one id have one key; they stay together.  ``compat`` leaves the last fold out, as the original reader does.
    """
    key = shuffle_key(F.col(row_id), seed)
    size = stances.count()
    begins = sorted({-(-i * size // n) for i in range(1, n)} - {0, size})
    cuts = order_statistics(stances.select(key.alias("key"), F.col(row_id).alias("id")), begins, cut_keys)
    # several folds may begin at one place where there are fewer rows than folds
    place = [-(-i * size // n) for i in range(1, n)]
    own = F.struct(key.alias("key"), F.col(row_id).alias("id"))
    fold = F.lit(0)
    for at in place:
        if at < size:
            fold = fold + (F.lit(True) if at == 0 else own >= _literal(cuts[at], stances.schema[row_id].dataType)).cast("int")
    folds = stances.withColumn("fold", fold.cast("int"))
    return folds.filter(F.col("fold") < n - 1) if compat else folds


def _literal(cut: tuple, kind) -> Column:
    return F.struct(F.lit(cut[0]).alias("key"), F.lit(cut[1]).cast(kind).alias("id"))


def order_statistics(keys: DataFrame, places: Sequence[int], cut_keys: int = CUT_KEYS) -> dict[int, tuple]:
    """The ``(key, id)`` that stands at each place (from 0) of the sorted ``keys(key, id)``; ``key`` is a hex string.

    A pass counts keys by their next digits, only where a place still lies among many; few are then sorted by the driver.
    """
    open_ = {at: ("", at) for at in places}  # digits known so far, place among the keys that have them
    found: dict[int, tuple] = {}
    length = 0
    while open_:
        length += DIGITS
        starts = sorted({prefix for prefix, _ in open_.values()})
        some = keys if starts == [""] else keys.filter(F.substring("key", 1, length - DIGITS).isin(starts))
        counts = some.groupBy(F.substring("key", 1, length).alias("p")).count().collect()
        few, after = {}, {}
        for at, (prefix, place) in open_.items():
            for r in sorted((r for r in counts if r["p"].startswith(prefix)), key=lambda r: r["p"]):
                if place < r["count"]:
                    (few if r["count"] <= cut_keys or length >= 32 else after)[at] = (r["p"], place)
                    break
                place -= r["count"]
        if few:
            wanted = sorted({prefix for prefix, _ in few.values()})
            rows = keys.filter(F.substring("key", 1, length).isin(wanted)).distinct().collect() if length >= 32 else (
                keys.filter(F.substring("key", 1, length).isin(wanted)).collect()
            )
            for at, (prefix, place) in few.items():
                mine = sorted(((r["key"], r["id"]) for r in rows if r["key"].startswith(prefix)))
                found[at] = mine[min(place, len(mine) - 1)]
        open_ = after
    return found


def fnc_score(actual: Column, predicted: Column) -> Column:
    """0.25 when equal, 0.50 more when that label is related, 0.25 when both are related."""
    score = (
        F.when(actual == predicted, F.lit(0.25)).otherwise(0.0)
        + F.when((actual == predicted) & (actual != 4), F.lit(0.50)).otherwise(0.0)
        + F.when(actual.isin(1, 2, 3) & predicted.isin(1, 2, 3), F.lit(0.25)).otherwise(0.0)
    )
    bad = F.raise_error(F.concat(F.lit("label not in 1..4: "), F.coalesce(predicted.cast("string"), F.lit("null"))))
    return F.when(predicted.isin(1, 2, 3, 4), score).otherwise(bad.cast("double"))


def evaluate_fold(
    fold: DataFrame, predictions: DataFrame, row_id: str = "row_id", by: Sequence[str] = ()
) -> DataFrame:
    """Summed score of ``predictions(row_id, predicted)`` against ``fold(row_id, label)``.

    Every row needs exactly one partner; a missing one on either side fails the job.
    """
    a = fold.select(row_id, *by, F.col("label").cast("int").alias("label"), F.lit(1).alias("__a"))
    b = predictions.select(row_id, F.col("predicted").cast("int").alias("predicted"), F.lit(1).alias("__b"))
    paired = a.join(b, row_id, "full")
    unpaired = F.raise_error(F.concat(F.lit("rows without a partner: "), F.col(row_id).cast("string")))
    score = F.when(
        F.col("__a").isNotNull() & F.col("__b").isNotNull(), fnc_score(F.col("label"), F.col("predicted"))
    ).otherwise(unpaired.cast("double"))
    return paired.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(score), F.lit(0.0)).alias("score")
    )


def evaluate_comp(stances: DataFrame, predictions: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Total on a labelled set; predictions are labels (integers) or stance names (strings)."""
    kind = predictions.schema["predicted"].dataType.simpleString()
    if kind == "string":
        predictions = predictions.withColumn("predicted", stance_to_label(F.col("predicted")))
    elif kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"Bad labels format: {kind}")
    return evaluate_fold(stances, predictions, row_id)


def random_baseline(stances: DataFrame, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Uniform labels 1..4 from a hash of the row id."""
    digit = F.substring(shuffle_key(F.col(row_id), seed), 1, 1)
    label = F.instr(F.lit("0123456789abcdef"), digit) % 4 + 1
    return stances.withColumn("predicted", label.cast("int"))
