"""Integer codes for categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.joins import join_groups
from tidewheel.operators.ordering import positions
from tidewheel.session import shared_dir


def alphabetical_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value, code): the distinct values of each column in ascending text order, counted from 0.

    All columns are read in one pass.  The distinct values are checkpointed, so that ordering and joining them does
    not read the data again.
    """
    shared_dir(df.sparkSession)
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    values = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct().checkpoint()
    return positions(values, ["value"], ["column"], "code")


def frequency_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per distinct value, most frequent first, ties in alphabetical order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg((-F.count(F.lit(1))).alias("_n"))
    shared_dir(df.sparkSession)
    counts = counts.checkpoint()
    return positions(counts, ["_n", column], (), name).drop("_n")


def encode(
    df: DataFrame, columns: Sequence[str], suffix: str = "_encoded", learn_from: DataFrame | None = None
) -> DataFrame:
    """Add alphabetical codes for each column; null gets no code.

    The codes are those of all values in ``learn_from``, by default of ``df`` itself.
    """
    if not columns:
        return df
    codes = alphabetical_codes(df if learn_from is None else learn_from, columns)
    for c in columns:
        of_column = codes.where(F.col("column") == c).select(
            F.col("value").cast(df.schema[c].dataType).alias(c), F.col("code").alias(f"{c}{suffix}")
        )
        df = join_groups(df, of_column, [c], "left")
    return df


def ordered_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per distinct value in its own order (numbers by size, dates by time), counted from 0."""
    shared_dir(df.sparkSession)
    values = df.select(column).where(F.col(column).isNotNull()).distinct().checkpoint()
    return positions(values, [column], (), name)


def index_by_frequency(train: DataFrame, df: DataFrame, column: str, name: str) -> DataFrame:
    """Codes learnt from ``train``; values not seen there (and null) get the next code after the last one."""
    codes = frequency_codes(train, column, name)
    unseen = train.agg(F.count_distinct(column).alias("n")).scalar()
    return join_groups(df, codes, [column], "left").withColumn(name, F.coalesce(F.col(name), unseen))
