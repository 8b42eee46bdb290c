"""Term weighting models as column expressions.

Each takes the columns of a matched posting (``tf`` in the document, ``qtf`` in
the query, document length ``dl``, document frequency ``df``, collection
frequency ``cf``) and the collection constants, and returns the contribution of
that term.  Contributions are summed as fixed-point integers, so a score does
not depend on the order in which a cluster adds them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1_000_000_000


@dataclass(frozen=True)
class Collection:
    """Collection statistics; one row, read to the driver once per index."""

    n_docs: int
    n_nonempty: int
    total_terms: int

    @property
    def avgdl(self) -> float:
        return self.total_terms / self.n_docs if self.n_docs else 0.0


def fixed(weight: Column) -> Column:
    """A weight as a scaled integer: sums are exact and order-free."""
    return F.floor(weight * F.lit(float(SCALE)) + F.lit(0.5)).cast("bigint")


def unfixed(total: Column) -> Column:
    return total / F.lit(float(SCALE))


def stored_length(dl: Column) -> Column:
    """Document length as a one-byte search-engine norm keeps it.

    Lengths under 24 are exact; above, only the four leading bits of
    ``dl - 24`` survive.
    """
    rest = (dl - 24).cast("int")
    step = F.when(rest < 16, 1)
    for bits in range(5, 31):
        step = step.when(rest < (1 << bits), 1 << (bits - 4))
    step = step.otherwise(1 << 27)
    return F.when(dl < 24, dl.cast("double")).otherwise(F.lit(24.0) + (rest - rest % step))


def bm25_search(c: Collection, k1: float = 0.9, b: float = 0.4, length_norm: str = "byte") -> Column:
    """BM25 in the form of the full-text library used for plain search."""
    if length_norm not in ("byte", "exact"):
        raise ValueError("length_norm is 'byte' or 'exact'")
    dl = F.col("dl").cast("double")
    dl = stored_length(F.col("dl")) if length_norm == "byte" else dl
    n = float(c.n_nonempty)
    avgdl = c.total_terms / n if n else 1.0
    df, tf, qtf = F.col("df"), F.col("tf"), F.col("qtf")
    idf = F.log(F.lit(1.0) + (F.lit(n) - df + 0.5) / (df + 0.5))
    return qtf * idf * tf / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / F.lit(avgdl)))


def bm25(c: Collection, k1: float = 1.2, b: float = 0.75, k3: float = 8.0) -> Column:
    """Robertson BM25 with query saturation, logarithm to base 2."""
    df, tf, qtf, dl = F.col("df"), F.col("tf"), F.col("qtf"), F.col("dl")
    k = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / F.lit(c.avgdl)) + tf
    return (
        tf * F.lit(k3 + 1) * qtf / ((F.lit(k3) + qtf) * k)
        * F.log2((F.lit(float(c.n_docs)) - df + 0.5) / (df + 0.5))
    )


def tf(c: Collection) -> Column:
    return F.col("tf").cast("double")


def tf_idf(c: Collection, k1: float = 1.2, b: float = 0.75) -> Column:
    df, tf, qtf, dl = F.col("df"), F.col("tf"), F.col("qtf"), F.col("dl")
    robertson = F.lit(k1) * tf / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / F.lit(c.avgdl)))
    return qtf * robertson * F.log2(F.lit(float(c.n_docs)) / df + 1)


def pl2(c: Collection, c_param: float = 1.0) -> Column:
    """Poisson model with Laplace after-effect and length normalisation 2."""
    tfn = F.col("tf") * F.log2(F.lit(1.0) + F.lit(c_param * c.avgdl) / F.col("dl"))
    mean = F.col("cf") / F.lit(float(c.n_docs))
    return (
        F.col("qtf") / (tfn + 1)
        * (
            tfn * F.log2(tfn / mean)
            + (mean - tfn) * F.lit(math.log2(math.e))
            + F.lit(0.5) * F.log2(F.lit(2 * math.pi) * tfn)
        )
    )


def dlh13(c: Collection) -> Column:
    """Hypergeometric divergence model; the second term falls away when a document is one term only."""
    tf, dl = F.col("tf"), F.col("dl")
    f = tf / dl
    first = tf * F.log2((tf * F.lit(c.avgdl) / dl) * (F.lit(float(c.n_docs)) / F.col("cf")))
    second = F.when(f < 1, F.lit(0.5) * F.log2(F.lit(2 * math.pi) * tf * (F.lit(1.0) - f))).otherwise(0.0)
    return F.col("qtf") * (first + second) / (tf + 0.5)


def hiemstra_lm(c: Collection, lam: float = 0.15) -> Column:
    """Language model with linear smoothing."""
    return F.log2(
        F.lit(1.0)
        + F.lit(lam) * F.col("tf") * F.lit(float(c.total_terms))
        / (F.lit(1 - lam) * F.col("cf") * F.col("dl"))
    )


# Feature names as they appear in a learning-to-rank row.
FEATURES = {
    "f_sample": bm25,
    "f_bm25": bm25,
    "f_tf": tf,
    "f_pl2": pl2,
    "f_tf_idf": tf_idf,
    "f_dlh13": dlh13,
    "f_hiemstra_lm": hiemstra_lm,
}
