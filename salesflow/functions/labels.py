"""Labels: right-closed size classes and status rules."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesflow.functions._util import to_col

# Fixed values from the reference: size-class edges and label sets,
# status labels and status thresholds.
DEFAULT_EDGES = (0, 500, 2000, float("inf"))
LABELS_FR = ("Petite", "Moyenne", "Grosse")
LABELS_EN = ("Small", "Medium", "Large")
STATUS_TARGET = ("excellent", "bon", "faible", "vide")
STATUS_REGION = ("✓ Atteint", "⚠ Proche", "✗ En dessous")
STATUS_TWO_WAY = ("✓ Atteint", "✗ Non atteint")
FIXED_STATUS_LIMITS = (80000, 50000)


def _lit(v):
    if isinstance(v, float) and v in (float("inf"), float("-inf")):
        return F.lit(v)
    return F.lit(Decimal(str(v)))


def bucket(c: Column | str, edges: Sequence[float] = DEFAULT_EDGES,
           labels: Sequence[str] = LABELS_FR, na_label: str | None = None) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2], ...`` -> labels.

    Values at or below the first edge, above the last, or null get
    ``na_label`` (null by default; ``'nan'`` reproduces the text variant).
    ``Bucketizer`` is left-closed, so the rule is spelled out with
    ``when``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    x = to_col(c)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (x > _lit(lo)) & (x <= _lit(hi)) if hi != float("inf") else (x > _lit(lo))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(na_label).cast("string"))


def status_vs_target(ca: Column | str, objectif: Column | str | float,
                     empty: Column | None = None) -> Column:
    """ca >= obj -> excellent, >= 0.8 obj -> bon, else faible; empty -> vide."""
    ca_c = to_col(ca)
    obj = objectif if isinstance(objectif, Column) else (
        F.col(objectif) if isinstance(objectif, str) else _lit(objectif))
    rule = (F.when(ca_c >= obj, F.lit(STATUS_TARGET[0]))
             .when(ca_c >= obj * F.lit(Decimal("0.8")), F.lit(STATUS_TARGET[1]))
             .otherwise(F.lit(STATUS_TARGET[2])))
    if empty is not None:
        rule = F.when(empty, F.lit(STATUS_TARGET[3])).otherwise(rule)
    return rule


def status_fixed(ca: Column | str, empty: Column | None = None,
                 limits: tuple = FIXED_STATUS_LIMITS) -> Column:
    """Strict limits: > 80000 excellent, > 50000 bon, else faible."""
    ca_c = to_col(ca)
    hi, lo = limits
    rule = (F.when(ca_c > F.lit(hi), F.lit(STATUS_TARGET[0]))
             .when(ca_c > F.lit(lo), F.lit(STATUS_TARGET[1]))
             .otherwise(F.lit(STATUS_TARGET[2])))
    if empty is not None:
        rule = F.when(empty, F.lit(STATUS_TARGET[3])).otherwise(rule)
    return rule


def status_region(ca: Column | str, target: Column | str = 100) -> Column:
    """At least the target (100 % of it): atteint, at least 80 %: proche,
    else en dessous.  The amounts are compared, not a rounded %; given a %
    alone, the target is 100."""
    c, t = to_col(ca), target if isinstance(target, int) else to_col(target)
    t = F.lit(t) if isinstance(t, int) else t
    return (F.when(c >= t, F.lit(STATUS_REGION[0]))
             .when(c * 100 >= t * 80, F.lit(STATUS_REGION[1]))
             .otherwise(F.lit(STATUS_REGION[2])))


def status2(pct_rounded: Column | str) -> Column:
    """Two-way status on the already rounded %: >= 100 atteint."""
    return F.when(to_col(pct_rounded) >= 100, F.lit(STATUS_TWO_WAY[0])) \
            .otherwise(F.lit(STATUS_TWO_WAY[1]))
