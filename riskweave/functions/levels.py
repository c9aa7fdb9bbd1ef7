"""Band / level expressions shared by every scoring rule.

All helpers build one JVM-side ``CASE WHEN`` expression, so they stay inside
whole-stage codegen. A NULL input matches no branch and falls through to the
``otherwise`` value, which several reference rules rely on.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _chain(conds: Sequence[Column], values: Sequence, default) -> Column:
    expr = None
    for cond, value in zip(conds, values, strict=True):
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default)


def at_least(col: Column, cuts: Sequence, labels: Sequence, default) -> Column:
    """First label whose cut satisfies ``col >= cut`` (cuts descending)."""
    return _chain([col >= c for c in cuts], labels, default)


def at_most(col: Column, cuts: Sequence, labels: Sequence, default) -> Column:
    """First label whose cut satisfies ``col <= cut`` (cuts ascending)."""
    return _chain([col <= c for c in cuts], labels, default)


def lookup(col: Column, keys: Sequence, values: Sequence, default) -> Column:
    """Exact-match mapping ``col == key -> value``."""
    return _chain([col == k for k in keys], values, default)


def risk_level(col: Column) -> Column:
    """Upper-case CRITICAL/HIGH/MEDIUM/LOW at 75/50/25."""
    return at_least(col, K.LEVEL_CUTS, K.LEVEL_LABELS, K.LEVEL_ELSE)


def clamp(col: Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    """``least(hi, greatest(lo, col))``; NULL input gives ``lo`` (both skip NULL)."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), col))


def dec(text: str) -> Column:
    """Exact decimal literal, as a SQL numeric literal would be."""
    return F.lit(Decimal(text))


def ratio_or_null(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` — guarded for ANSI mode."""
    return num / F.when(den != 0, den)
