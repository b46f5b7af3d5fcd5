"""Training, validation and test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.operators.joins import join_groups
from tidewheel.operators.ordering import positions, running_totals
from tidewheel.panel import Panel
from tidewheel.session import shared_dir

# Shares of the two usual splits.
TRAIN_TEST = {"train": 0.8, "test": 0.2}
TRAIN_VALIDATION_TEST = {"train": 0.8, "validation": 0.1, "test": 0.1}


def by_share(position: Column, size: Column, shares: Mapping[str, float]) -> Column:
    """Name of the part a zero-based position belongs to; a part ends at ``floor(size * cumulative share)``."""
    names = list(shares)
    upto, expr = 0.0, None
    for name in names[:-1]:
        upto = round(upto + shares[name], 10)
        inside = position < F.floor(size * F.lit(upto))
        expr = F.when(inside, name) if expr is None else expr.when(inside, name)
    return expr.otherwise(names[-1])


def with_series_position(df: DataFrame, panel: Panel, name: str = "position") -> DataFrame:
    """Zero-based position in each series and the series length (``<name>_total``)."""
    if not panel.daily:
        return positions(df, [panel.time], panel.keys, name, group_size=True)
    w = Window.partitionBy(*panel.keys)
    return df.withColumns(
        {
            name: F.row_number().over(w.orderBy(panel.time)).cast("long") - 1,
            f"{name}_total": F.count(F.lit(1)).over(w),
        }
    )


def chronological_split(
    df: DataFrame, panel: Panel, shares: Mapping[str, float] = TRAIN_TEST, name: str = "split"
) -> DataFrame:
    """Cut each series in time order, so that a test row is always later than the training rows of its series."""
    placed = with_series_position(df, panel, "_p")
    return placed.withColumn(name, by_share(F.col("_p"), F.col("_p_total"), shares)).drop("_p", "_p_total")


def global_split(
    df: DataFrame, panel: Panel, shares: Mapping[str, float] = TRAIN_TEST, name: str = "split"
) -> DataFrame:
    """Cut the whole table by position in (keys, time) order: the last part holds the last *series*, not dates."""
    if panel.daily:
        # one row per series is ordered instead of all rows
        shared_dir(df.sparkSession)
        sizes = df.groupBy(*panel.keys).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
        starts = running_totals(sizes, panel.keys, {"_start": F.col("_n")}, group_totals=True).drop("_n")
        placed = join_groups(with_series_position(df, panel, "_p"), starts, panel.keys)
        placed = placed.withColumns({"_p": F.col("_p") + F.col("_start"), "_p_total": F.col("_start_total")})
    else:
        placed = positions(df, panel.order, (), "_p", group_size=True)
    split = by_share(F.col("_p"), F.col("_p_total"), shares)
    return placed.withColumn(name, split).drop("_p", "_p_total", "_start", "_start_total")


def hash_split(
    df: DataFrame, keys: Sequence[str], shares: Mapping[str, float] = TRAIN_TEST, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Random split that depends on the row's keys and the seed only, not on partitioning or order."""
    slots = 1_000_000
    slot = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(slots))
    return df.withColumn(name, by_share(slot, F.lit(slots), shares))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    shares: Mapping[str, float] = TRAIN_TEST,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Random split that keeps the exact share of every class; ``keys`` identify a row."""
    drawn = df.withColumn("_h", F.xxhash64(F.lit(seed), *keys))
    placed = positions(drawn, ["_h", *keys], [label], "_p", group_size=True)
    return placed.withColumn(name, by_share(F.col("_p"), F.col("_p_total"), shares)).drop("_h", "_p", "_p_total")


def expanding_folds(df: DataFrame, panel: Panel, folds: int = 5, name: str = "fold") -> DataFrame:
    """Fold number 0..folds per series: fold k is scored by a model trained on all rows with a smaller number."""
    placed = with_series_position(df, panel, "_p")
    fold = F.floor(F.col("_p") * (folds + 1) / F.col("_p_total")).cast("int")
    return placed.withColumn(name, fold).drop("_p", "_p_total")
