"""Class labels from numbers: three rules that treat boundaries differently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class limits and names of the footprint classes.
CLASS_LIMITS = (2500.0, 5000.0)
CLASS_NAMES = ("Low", "Medium", "High")


def threshold_code(value: Column, limits: Sequence[float] = CLASS_LIMITS, null_as_null: bool = True) -> Column:
    """Number of limits at or below the value: below 2500 is 0, below 5000 is 1, else 2.

    With ``null_as_null=False`` a null value falls in the last class.
    """
    code = sum((value >= limit).cast("int") for limit in limits)
    return code if null_as_null else F.coalesce(code, F.lit(len(limits)))


def threshold_label(
    value: Column,
    limits: Sequence[float] = CLASS_LIMITS,
    names: Sequence[str] = CLASS_NAMES,
    null_as_null: bool = True,
) -> Column:
    return F.get(F.array(*map(F.lit, names)), threshold_code(value, limits, null_as_null))


def cut_code(value: Column, edges: Sequence[float]) -> Column:
    """Index of the right-closed interval ``(edges[i], edges[i+1]]`` holding the value; null outside all of them."""
    inside = (value > edges[0]) & (value <= edges[-1])
    return F.when(inside, sum((value > edge).cast("int") for edge in edges[1:-1]))


def cut_label(
    value: Column,
    edges: Sequence[float] = (0.0, *CLASS_LIMITS, float("inf")),
    names: Sequence[str] = CLASS_NAMES,
) -> Column:
    return F.get(F.array(*map(F.lit, names)), cut_code(value, edges))


def quantile_code(value: Column, edges: Sequence[Column]) -> Column:
    """Bin number given the inner quantile edges; a value on an edge belongs to the lower bin."""
    return sum((value > edge).cast("int") for edge in edges)
