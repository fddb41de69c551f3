"""Similarity formulas as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the blended scores.
CONTENT_WEIGHTS = {"genre": 0.4, "tag": 0.25, "year": 0.1, "title": 0.05, "rate": 0.2}
PORTRAIT_WEIGHTS = {"genre": 0.4, "tag": 0.3, "year": 0.1, "rate": 0.2}


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    return dot / (norm_a * norm_b)


def significance(cos: Column, size: Column, n_a: Column, n_b: Column) -> Column:
    """Cosine scaled by the share of ``a``'s keys in common; damps popular ``b``."""
    return cos * size / (n_a * F.log10(n_b + 10))


def correlation(n: Column, dot: Column, sx: Column, sy: Column, sxx: Column, syy: Column,
                smooth: int = 0) -> Column:
    """Pearson correlation from sums; NULL when a side is constant and ``smooth`` is 0."""
    den = F.sqrt(n * sxx - sx * sx) * F.sqrt(n * syy - sy * sy) + F.lit(float(smooth))
    return F.when(den != 0, (n * dot - sx * sy) / den)


def regularized(n: Column, corr: Column, virtual: float, prior: float) -> Column:
    w = n / (n + F.lit(float(virtual)))
    return w * corr + (1 - w) * F.lit(float(prior))


def year(a: Column, b: Column, span: int = 10) -> Column:
    gap = F.abs(a - b)
    return F.when(gap > span, F.lit(0.0)).otherwise(1 - gap / F.lit(float(span)))


def rate(r: Column, top: float = 5.0) -> Column:
    # ``least`` skips NULLs, so an unknown rate is kept NULL explicitly
    return F.when(r.isNotNull(), F.least(r / F.lit(top), F.lit(1.0)))


def profile_key(w: Column, max_w: Column) -> Column:
    """Weight of a profile entry relative to the strongest one, 0 when absent."""
    return F.when(w.isNotNull(), F.least(w / max_w, F.lit(1.0))).otherwise(F.lit(0.0))


def doubled_cosine(dot: Column, sum_a: Column, sum_b: Column,
                   common_a: Column, common_b: Column) -> Column:
    """Cosine over the concatenation of two weighted token lists.

    A token present on both sides is counted twice, once per list: ``sum_*``
    are the squared weights of a side, ``common_*`` the part of it that the
    other side shares.
    """
    a, b = sum_a + common_a, sum_b + common_b
    return F.when((a > 0) & (b > 0), 2 * dot / (F.sqrt(a) * F.sqrt(b))).otherwise(F.lit(0.0))


def list_cosine(a: Column, b: Column) -> Column:
    """The same measure on two token arrays, duplicates counted as they occur."""
    in_b = F.size(F.filter(a, lambda x: F.array_contains(b, x)))
    in_a = F.size(F.filter(b, lambda x: F.array_contains(a, x)))
    left, right = F.size(a) + in_a, F.size(b) + in_b
    return F.when((left > 0) & (right > 0),
                  (in_a + in_b) / (F.sqrt(left.cast("double")) * F.sqrt(right.cast("double")))
                  ).otherwise(F.lit(0.0))
