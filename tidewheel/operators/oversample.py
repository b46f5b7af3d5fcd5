"""Balancing of classes with synthetic minority rows (SMOTE)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.joins import join_same
from tidewheel.operators.neighbours import feature_vector, nearest_in_group
from tidewheel.operators.ordering import positions
from tidewheel.session import shared_dir

COPIES_PER_TASK = 10_000


def _uniform(*seed: Column) -> Column:
    """Number in [0, 1) fixed by its arguments."""
    return F.pmod(F.xxhash64(*seed), F.lit(1 << 30)) / float(1 << 30)


def synthetic_rows(
    train: DataFrame, label: str, features: Sequence[str], row_id: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """Synthetic rows (label, features) that raise every class of ``train`` to the size of the largest.

    Each lies on the segment between a row and one of its ``k`` nearest neighbours of the same class.  A class takes
    its rows in turn as starting points; neighbour and place on the segment follow from the row, the copy number and
    the seed, so a recomputed task gives the same rows.  Pass the training part only, checkpointed if it is costly to
    compute: it is read several times.
    """
    shared_dir(train.sparkSession)
    rows = train.select(F.col(label), F.col(row_id), feature_vector(features).alias("_x")).withColumn(
        "_h", F.xxhash64(F.lit(seed), row_id)
    )
    largest = (
        rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).scalar()
    )
    placed = positions(rows, ["_h", row_id], [label], "_p", group_size=True).withColumn(
        "_need", largest - F.col("_p_total")
    )
    copies = F.floor(F.col("_need") / F.col("_p_total")) + (
        F.col("_p") < F.col("_need") % F.col("_p_total")
    ).cast("bigint")
    bases = placed.where(F.col("_need") > 0).select(label, row_id, "_x", copies.alias("_copies")).checkpoint()
    found = nearest_in_group(bases.withColumn("_ask", F.col("_copies") > 0), label, "_x", "_ask", k)
    found = found.withColumn(label, F.col(label).cast(train.schema[label].dataType))
    asked = join_same(bases.where(F.col("_copies") > 0), found, [label, "_x"])
    # a tiny class needs very many copies of one row: deal them out in blocks before making them
    blocks = asked.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPIES_PER_TASK)))
    ).repartition(label, row_id, "_block")
    first = F.col("_block") * COPIES_PER_TASK
    copy = F.explode(F.sequence(first, F.least(first + COPIES_PER_TASK, F.col("_copies")) - 1))
    drawn = (
        blocks.withColumn("_copy", copy)
        .withColumn("_u", _uniform(F.lit(seed + 1), F.col(row_id), F.col("_copy")))
        .withColumn("_pick", F.floor(_uniform(F.lit(seed + 2), F.col(row_id), F.col("_copy")) * F.size("neighbours")))
        .withColumn("_other", F.coalesce(F.get("neighbours", F.col("_pick").cast("int")), F.col("_x")))
    )
    made = [
        (F.get("_x", F.lit(i)) + F.col("_u") * (F.get("_other", F.lit(i)) - F.get("_x", F.lit(i)))).alias(c)
        for i, c in enumerate(features)
    ]
    return drawn.select(label, *made)


def oversample(
    train: DataFrame, label: str, features: Sequence[str], row_id: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """The training rows and the synthetic ones, marked by ``is_synthetic``."""
    shared_dir(train.sparkSession)
    rows = train.select(label, row_id, *(F.col(c).cast("double").alias(c) for c in features)).checkpoint()
    made = synthetic_rows(rows, label, features, row_id, k, seed)
    return rows.drop(row_id).withColumn("is_synthetic", F.lit(False)).unionByName(made.withColumn("is_synthetic", F.lit(True)))
