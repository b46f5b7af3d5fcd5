"""Roll-ups of many levels from one table of partial states.

The lowest level holds, per key and day, what merges: count, sum, sum of squares, minimum, maximum.  It is read from the
data once; every coarser level is a merge of its rows, and new days are merged in without reading the old ones again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How the columns of a state merge.
MERGED = {"n": F.sum, "total": F.sum, "squares": F.sum, "low": F.min, "high": F.max}


def states(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` and the state of the non-null values of each combination; keys without a value have a count of zero."""
    v = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"), F.min(v).alias("low"), F.max(v).alias("high")
    )


def merged(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """States of several tables as one: days that came later, or parts of the data that were summed up apart."""
    both = reduce(DataFrame.unionByName, tables)
    return both.groupBy(*keys).agg(*(f(c).alias(c) for c, f in MERGED.items()))


def roll_up(lowest: DataFrame, levels: Mapping[str, Sequence[Column]]) -> DataFrame:
    """``rollup, keys, n, total, mean, std, low, high`` for all ``levels`` from one scan of the lowest one.

    A level is a list of key expressions; their values come as an array of strings.  Rows are listed once per level and merged
    on the map side first.  Null keys are a group of their own.
    """
    kinds = F.array(*(
        F.struct(F.lit(name).alias("rollup"), F.array(*(k.cast("string") for k in keys)).alias("keys")) for name, keys in levels.items()
    ))
    listed = lowest.select(F.inline(kinds), *MERGED)
    found = listed.groupBy("rollup", "keys").agg(*(f(c).alias(c) for c, f in MERGED.items()))
    mean = F.try_divide(F.col("total"), F.col("n"))
    spread = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), (F.col("squares") - mean * F.col("total")) / (F.col("n") - 1))))
    return found.select("rollup", "keys", "n", "total", mean.alias("mean"), spread.alias("std"), "low", "high")
