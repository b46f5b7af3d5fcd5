"""Join helper shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.session import shared_dir

#: Groups up to which their rows are broadcast.
BROADCAST_GROUPS = 100_000


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other, keeping one copy of the key columns.

    No broadcast is forced: the optimizer picks one where it knows the side is below its size limit, and adaptive
    execution splits hot keys of a sort-merge join.
    """
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on))
    return left.join(renamed, condition, how).drop(*(f"_r_{c}" for c in on))


def join_groups(rows: DataFrame, groups: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """As :func:`join_same`, for a right side of one row per key, such as an aggregate of ``rows``.

    ``groups`` is checkpointed and counted.  Few are broadcast, so no row moves, however many share a key.  More are looked
    up in a hash table per partition: rows are dealt by key but not sorted, and what a task holds are groups.
    """
    shared_dir(rows.sparkSession)
    groups = groups.checkpoint()
    few = groups.count() <= BROADCAST_GROUPS
    return join_same(rows, F.broadcast(groups) if few else groups.hint("shuffle_hash"), on, how)
