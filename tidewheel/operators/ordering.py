"""Positions and running totals in a total order, without ever sorting one group in one task.

The order is cut at a hash-chosen sample of the rows (as a sample sort does), totals per piece are added up in a
table of one row per piece, and only rows of one piece meet in one task.  The sample depends on the hashes of the keys
alone, so every evaluation of the plan cuts at the same places, also after an executor is lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.session import parallelism

OVERSAMPLE = 8
PIECES_PER_PARTITION = 2
SAMPLE_BITS = 8


def range_piece(df: DataFrame, order_by: Sequence[str], name: str = "_piece", pieces: int | None = None) -> DataFrame:
    """Number the range piece (0..pieces-1) that each row falls in when sorted by ``order_by``.

    Rows with equal ``order_by`` values cannot be separated, so aggregate duplicates first.
    """
    pieces = pieces or PIECES_PER_PARTITION * parallelism(df.sparkSession)
    key = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    # Only the choice of cuts looks at a part of the keys.  One key in 256 enters, before any shuffle (a table too small
    # to give enough cuts that way needs no fine cutting); of those, the smallest hash of each slot stays, which map
    # tasks combine, so the number of rows that meet in one task is the number of slots.
    hashed = df.select(key.alias("k"), F.xxhash64(key).alias("h")).where(F.pmod("h", F.lit(1 << SAMPLE_BITS)) == 0)
    slot = F.pmod(F.shiftright("h", SAMPLE_BITS), F.lit(pieces * OVERSAMPLE))
    sample = (
        hashed.groupBy(slot.alias("slot"))
        .agg(F.min_by("k", "h").alias("k"))
        .agg(F.sort_array(F.collect_list("k")).alias("s"))
    )
    # every OVERSAMPLE-th sampled row is a cut, scaled down when there are fewer rows than wanted
    share = F.size("s") / F.lit(float(pieces))
    cuts = sample.select(
        F.array_distinct(
            F.transform(F.sequence(F.lit(1), F.lit(pieces - 1)), lambda i: F.get("s", F.floor(i * share).cast("int")))
        ).alias("cuts")
    )
    width = 1
    while width * 2 < pieces:
        width *= 2
    # binary search for the number of cuts below the row, one projection per step so that it stays in generated code
    out = df.withColumns({"_cuts": cuts.scalar(), name: F.lit(0)})
    while width:
        at = F.col(name)
        out = out.withColumn(name, F.when(F.get("_cuts", at + (width - 1)) < key, at + width).otherwise(at))
        width //= 2
    return out.drop("_cuts")


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    weights: Mapping[str, Column],
    keys: Sequence[str] = (),
    group_totals: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """For each weight add the sum over all earlier rows of the same key group (the row itself excluded).

    ``group_totals`` also adds ``<name>_total``, the sum over the whole group.  ``order_by`` must be unique within a
    group and the input must give the same rows each time it is read (write or checkpoint it first if it does not).
    """
    keys, order_by = list(keys), list(order_by)
    cut = range_piece(df.withColumns({f"_w_{n}": w for n, w in weights.items()}), [*keys, *order_by], pieces=pieces)
    per_piece = cut.groupBy(*keys, "_piece").agg(*(F.sum(f"_w_{n}").alias(f"_t_{n}") for n in weights))
    # at most one row per piece and key here
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_piece.select(
        *keys,
        "_piece",
        *(F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in weights),
        *(F.sum(f"_t_{n}").over(whole).alias(f"{n}_total") for n in weights if group_totals),
    )
    # an offset stands before the rows of its piece, so one window adds it up with them and nothing is joined
    first = offsets.select(
        *keys, "_piece", F.lit(True).alias("_first"), *(F.col(f"_o_{n}").alias(f"_w_{n}") for n in weights),
        *(F.col(f"{n}_total").alias(f"_g_{n}") for n in weights if group_totals),
    )
    both = cut.withColumn("_first", F.lit(False)).unionByName(first, allowMissingColumns=True)
    piece = Window.partitionBy(*keys, "_piece")
    inside = piece.orderBy(F.desc("_first"), *order_by).rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumns({n: F.sum(f"_w_{n}").over(inside) for n in weights})
    if group_totals:
        out = out.withColumns({f"{n}_total": F.max(f"_g_{n}").over(piece) for n in weights})
    return out.where(~F.col("_first")).drop("_first", "_piece", *(f"{p}_{n}" for n in weights for p in ("_w", "_g")))


def positions(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "position",
    group_size: bool = False,
) -> DataFrame:
    """Zero-based position in the order within each key group (``<name>_total``: the size of the group)."""
    return running_totals(df, order_by, {name: F.lit(1)}, keys, group_size)
