"""Ranking measures for every query of every system in one aggregate.

``judge`` orders a run once the way the public evaluator does and carries
running counts of relevant and non-relevant hits.  Every measure is then a plain
sum, minimum or maximum over its rows, so partial aggregation runs before the
exchange and a query with very many hits is no burden on one task.
Averages run over all judged queries; a query without hits counts 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.operators.ranking import GROUP_ROWS, row_numbers, running_in_group, top_k
from passagerank.operators.sizing import lookup_join

CUTOFFS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
NDCG_CUTOFFS = (1, 3, 5, 10)
RECALL_POINTS = tuple(range(11))
GM_FLOOR = 1e-5


@dataclass(frozen=True)
class Judged:
    """Hits with position, rating and running counts; and what every judged query needs.

    ``ideal`` is joined only for measures of gain.
    """

    rows: DataFrame
    needs: DataFrame
    ideal: DataFrame
    keys: list[str] = field(default_factory=lambda: ["qid"])


def _evaluator_order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").cast("string").desc()]


def trec_order(run: DataFrame, keys: tuple[str, ...] = ("qid",), depth: int | None = None,
               group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``pos``: 1-based position by score, equal scores by descending document id as text.

    The stored ``rank`` plays no part.  ``depth`` is the greatest number of hits
    of a query where the run is known to be cut.
    """
    bounded = depth is not None and depth <= group_rows
    return row_numbers(run, list(keys), _evaluator_order(), "pos", bounded, group_rows)


def judge(
    run: DataFrame,
    qrels: DataFrame,
    keys: tuple[str, ...] = ("qid",),
    min_rating: int = 1,
    depth: int | None = None,
    ndcg_cutoffs: tuple[int, ...] = NDCG_CUTOFFS,
    group_rows: int = GROUP_ROWS,
) -> Judged:
    """Join a run with judgements.  ``keys`` other than ``qid`` tell systems apart."""
    keys = list(keys)
    qrels = qrels.select("qid", "doc_id", "rating")
    hits = run.select(*keys, "doc_id", "score").join(qrels, ["qid", "doc_id"], "left")
    rel = (F.coalesce("rating", F.lit(0)) >= min_rating).cast("int")
    nonrel = (F.col("rating") < min_rating).cast("int")
    counted = hits.withColumn("rel", rel).withColumn("nonrel", F.coalesce(nonrel, F.lit(0)))
    sums = {"pos": F.lit(1), "rel_so_far": F.col("rel"), "nonrel_so_far": F.col("nonrel")}
    bounded = depth is not None and depth <= group_rows
    # groups are counted before the join, which adds no row
    placed = running_in_group(counted, keys, _evaluator_order(), sums, bounded, group_rows, run)
    needs = _needs(qrels, min_rating)
    return Judged(lookup_join(placed, needs, ["qid"]), needs, _ideal(qrels, ndcg_cutoffs), keys)


def _gain(rating: Column) -> Column:
    return F.pow(F.lit(2.0), F.greatest(F.coalesce(rating, F.lit(0)), F.lit(0))) - 1


def _needs(qrels: DataFrame, min_rating: int) -> DataFrame:
    """Per judged query: relevant ``R`` and non-relevant ``M``."""
    return qrels.groupBy("qid").agg(
        F.count(F.when(F.col("rating") >= min_rating, 1)).alias("R"),
        F.count(F.when(F.col("rating") < min_rating, 1)).alias("M"),
    )


def _ideal(qrels: DataFrame, cutoffs: tuple[int, ...]) -> DataFrame:
    """Per judged query: the gain of the best possible order at every cut-off."""
    best = top_k(qrels, ["qid"], [F.col("rating").desc(), F.col("doc_id")], max(cutoffs), "place")
    value = _gain(F.col("rating")) / F.log2(F.col("place") + 2)
    return best.groupBy("qid").agg(
        *[F.sum(F.when(F.col("place") < k, value)).alias(f"ideal_{k}") for k in cutoffs]
    )


def _over_r(total: Column) -> Column:
    return F.when(F.col("R") > 0, total / F.col("R")).otherwise(0.0)


def _is_rel() -> Column:
    return F.col("rel") == 1


def _count_if(condition: Column) -> Column:
    return F.sum(condition.cast("int"))


def _bpref_term() -> Column:
    above, r, m = F.col("nonrel_so_far"), F.col("R"), F.col("M")
    penalty = F.least(above, r) / F.least(r, m)
    return F.when(_is_rel(), F.when(above == 0, F.lit(1.0)).otherwise(1 - penalty))


Measure = tuple[str, Column, Callable[[Column], Column] | None]


def _measures(name: str, cutoffs: tuple[int, ...] = CUTOFFS) -> list[Measure]:
    """Columns of a measure: name, aggregate over the hits of a query, finish on the joined row."""
    precision = F.col("rel_so_far") / F.col("pos")
    if name == "counts":
        return [
            ("num_ret", F.count(F.lit(1)), None),
            ("num_rel_ret", F.sum("rel"), None),
        ]
    if name == "map":
        return [("map", F.sum(F.when(_is_rel(), precision)), _over_r)]
    if name == "rprec":
        return [("rprec", _count_if(_is_rel() & (F.col("pos") <= F.col("R"))), _over_r)]
    if name == "bpref":
        return [("bpref", F.sum(_bpref_term()), _over_r)]
    if name == "recip_rank":
        return [("recip_rank", F.min(F.when(_is_rel(), F.col("pos"))), lambda first: 1 / first)]
    if name == "iprec":
        return [
            (
                f"iprec_{p / 10:.1f}".replace(".", "_"),
                F.max(F.when(F.col("rel_so_far") * 10 >= F.lit(p) * F.col("R"), precision)),
                None,
            )
            for p in RECALL_POINTS
        ]
    if name == "precision":
        return [
            (f"p_{k}", _count_if(_is_rel() & (F.col("pos") <= k)), lambda c, k=k: c / F.lit(float(k)))
            for k in cutoffs
        ]
    if name == "recall":
        return [(f"recall_{k}", _count_if(_is_rel() & (F.col("pos") <= k)), _over_r) for k in cutoffs]
    if name == "ndcg":
        cutoffs = NDCG_CUTOFFS if cutoffs == CUTOFFS else cutoffs
        value = _gain(F.col("rating")) / F.log2(F.col("pos") + 1)
        return [
            (
                f"ndcg_{k}",
                F.sum(F.when(F.col("pos") <= k, value)),
                lambda dcg, k=k: F.when(F.col(f"ideal_{k}") > 0, dcg / F.col(f"ideal_{k}")).otherwise(0.0),
            )
            for k in cutoffs
        ]
    raise ValueError(f"unknown measure {name!r}")


OFFICIAL = ("map", "rprec", "bpref", "recip_rank", "iprec", "precision", "recall")


def per_query(judged: Judged, measures: tuple[str, ...] = OFFICIAL, cutoffs: tuple[int, ...] = CUTOFFS,
              systems: tuple[str, ...] = ()) -> DataFrame:
    """One row per judged query (and system), every measure a column."""
    columns = [m for name in measures for m in _measures(name, cutoffs)]
    found = judged.rows.groupBy(*judged.keys).agg(*[agg.alias(f"__{n}") for n, agg, _ in columns])
    base = judged.needs.join(judged.ideal, "qid") if "ndcg" in measures else judged.needs
    if systems:
        base = base.withColumn("name", F.explode(F.array(*[F.lit(s) for s in systems])))
    joined = base.join(found, judged.keys, "left")
    out = []
    for name, _, finish in columns:
        raw = F.col(f"__{name}")
        value = finish(raw) if finish else raw
        zero = F.lit(0) if name.startswith("num_") else F.lit(0.0)
        out.append(F.coalesce(value, zero).alias(name))
    return joined.select(*judged.keys, "R", "M", *out)


def summary(judged: Judged, measures: tuple[str, ...] = OFFICIAL, cutoffs: tuple[int, ...] = CUTOFFS,
            systems: tuple[str, ...] = ()) -> DataFrame:
    """Means over all judged queries, one row (per system)."""
    table = per_query(judged, measures, cutoffs, systems)
    names = [n for m in measures for n, _, _ in _measures(m, cutoffs)]
    groups = [k for k in judged.keys if k != "qid"]
    return table.groupBy(*groups).agg(*[F.avg(n).alias(n) for n in names])


def eval_counts(judged: Judged) -> DataFrame:
    """num_q, num_ret, num_rel, num_rel_ret over the judged queries."""
    table = per_query(judged, ("counts",))
    return table.groupBy(*[k for k in judged.keys if k != "qid"]).agg(
        F.count(F.lit(1)).alias("num_q"),
        F.sum("num_ret").alias("num_ret"),
        F.sum("R").alias("num_rel"),
        F.sum("num_rel_ret").alias("num_rel_ret"),
    )


def eval_gm_map(judged: Judged) -> DataFrame:
    """Geometric mean of average precision, floored at 1e-5."""
    table = per_query(judged, ("map",))
    return table.groupBy(*[k for k in judged.keys if k != "qid"]).agg(_geometric_mean().alias("gm_map"))


def _geometric_mean() -> Column:
    return F.exp(F.avg(F.log(F.greatest(F.col("map"), F.lit(GM_FLOOR)))))


def _single(name: str):
    def measure(judged: Judged, cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
        return per_query(judged, (name,), cutoffs).drop("R", "M")

    measure.__name__ = f"eval_{name}"
    measure.__doc__ = f"Per-query {name}; ``summary`` gives the mean."
    return measure


eval_map = _single("map")
eval_rprec = _single("rprec")
eval_bpref = _single("bpref")
eval_recip_rank = _single("recip_rank")
eval_iprec = _single("iprec")
eval_precision = _single("precision")
eval_recall = _single("recall")
eval_ndcg = _single("ndcg")


def report(judged: Judged, measures: tuple[str, ...] = OFFICIAL) -> DataFrame:
    """The evaluator's report: one (measure, value) row each, counts and means, from one pass over the run."""
    table = per_query(judged, ("counts", *dict.fromkeys(("map", *measures))))
    means = [n for m in measures for n, _, _ in _measures(m)]
    values = {
        "num_q": F.count(F.lit(1)),
        "num_ret": F.sum("num_ret"),
        "num_rel": F.sum("R"),
        "num_rel_ret": F.sum("num_rel_ret"),
        "gm_map": _geometric_mean(),
        **{n: F.avg(n) for n in means},
    }
    systems = [k for k in judged.keys if k != "qid"]
    wide = table.groupBy(*systems).agg(*[v.cast("double").alias(n) for n, v in values.items()])
    return wide.unpivot(systems, list(values), "measure", "value")


def experiment(
    runs: dict[str, DataFrame],
    qrels: DataFrame,
    metrics: tuple[str, ...] = ("map",),
    topics: DataFrame | None = None,
    depth: int | None = None,
) -> DataFrame:
    """Compare named systems: one row per system.  ``topics`` restricts the judged queries."""
    if topics is not None:
        qrels = lookup_join(qrels, topics.select("qid").distinct(), ["qid"], "left_semi")
    tagged = None
    for name, run in runs.items():
        part = run.select("qid", "doc_id", "score").withColumn("name", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    judged = judge(tagged, qrels, ("name", "qid"), depth=depth)
    return summary(judged, metrics, systems=tuple(runs))
