"""Grouped summaries, shares, rankings and record lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.joins import join_same


def summarise(df: DataFrame, by: Sequence[str], digits: int | None = None, **aggregates: Column) -> DataFrame:
    """Grouped aggregates, rounded to ``digits`` where that is given and the aggregate is not a count."""
    out = df.groupBy(*by).agg(*(expr.alias(name) for name, expr in aggregates.items()))
    if digits is None:
        return out
    floats = [f.name for f in out.schema.fields if f.name in aggregates and f.dataType.typeName() == "double"]
    return out.withColumns({name: F.round(name, digits) for name in floats})


def top(df: DataFrame, k: int, by: str, tie: Sequence[str], ascending: bool = False) -> DataFrame:
    """The ``k`` first rows by ``by``; ``tie`` columns make the choice unique."""
    order = F.asc(by) if ascending else F.desc(by)
    return df.orderBy(order, *tie).limit(k)


def group_mean(df: DataFrame, by: Sequence[str], value: str, name: str, digits: int = 3) -> DataFrame:
    return summarise(df, by, digits, **{name: F.avg(value)})


def group_profile(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean (4 decimals), total (2 decimals) and row count."""
    return df.groupBy(*by).agg(
        F.round(F.avg(value), 4).alias("avg_value"),
        F.round(F.sum(value), 2).alias("total_value"),
        F.count(F.lit(1)).alias("record_count"),
    )


def period_compare(
    df: DataFrame, by: Sequence[str], period: str, periods: tuple[int, int], value: str
) -> DataFrame:
    """Mean value of two periods side by side and the change between them in percent."""
    first, second = (f"avg_{p}" for p in periods)
    wide = (
        df.where(F.col(period).isin(*periods))
        .groupBy(*by)
        .agg(*(F.avg(F.when(F.col(period) == p, F.col(value))).alias(f"avg_{p}") for p in periods))
    )
    return wide.withColumn(
        "change_pct", F.try_divide(F.col(second) - F.col(first), F.col(first)) * 100
    )


def distribution(df: DataFrame, by: str) -> DataFrame:
    """Row count and percentage per value; the total is added up from the grouped counts."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def mean_share(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean per group and its share, in percent, of the sum of all group means."""
    means = df.groupBy(by).agg(F.avg(value).alias("avg_value"))
    total = means.agg(F.sum("avg_value").alias("t")).scalar()
    return means.withColumn("share_pct", F.col("avg_value") * 100 / total)


def two_stage_mean(df: DataFrame, key: str, time: str, value: str, unit: str = "month") -> DataFrame:
    """Mean over the daily means of each period, so that days weigh the same however many rows they hold."""
    daily = df.groupBy(key, time).agg(F.avg(value).alias("daily_mean"))
    period = F.date_trunc(unit, F.col(time)).cast("date").alias(unit)
    return daily.groupBy(key, period).agg(F.avg("daily_mean").alias("avg_value"))


def top_keys(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The ``k`` keys with the largest total value."""
    totals = df.groupBy(key).agg(F.round(F.sum(value), 2).alias("total_value"))
    return top(totals, k, "total_value", [key]).select(key)


def keep_top_keys(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """Rows of the ``k`` largest keys.  The broadcast side has exactly ``k`` rows."""
    return df.join(F.broadcast(top_keys(df, key, value, k)), key, "left_semi")


def best_record(df: DataFrame, by: str, largest: bool = True) -> DataFrame:
    """The single record with the largest (smallest) value of ``by``; ties go to the largest record."""
    record = F.struct(by, *(c for c in df.columns if c != by))
    pick = F.max(record) if largest else F.min(record)
    return df.where(F.col(by).isNotNull()).agg(pick.alias("r")).select("r.*").select(*df.columns)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last-write-wins: for each key the record with the largest ``order`` columns, as a mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    record = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(record).select(*keys, "r.*").select(*df.columns)


def union_ragged(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by name; columns missing from a frame are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def exceeds_distinct(df: DataFrame, column: str, limit: int = 20) -> DataFrame:
    """One row telling whether a column has more than ``limit`` distinct values; stops counting just past the limit."""
    seen = df.select(column).dropna().distinct().limit(limit + 1)
    return seen.agg((F.count(F.lit(1)) > limit).alias("exceeds"))


def lookup(df: DataFrame, equals: Mapping[str, object], newest: str, tie: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest records whose columns equal the given values."""
    wanted = reduce(lambda a, b: a & b, (F.col(c) == v for c, v in equals.items()))
    return top(df.where(wanted), n, newest, tie)


def compare_sources(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: str, right_value: str
) -> DataFrame:
    """Totals of two sources per shared key, with difference in percent of the right one."""
    a = left.groupBy(*keys).agg(F.sum(left_value).alias("left_total"))
    b = right.groupBy(*keys).agg(F.sum(right_value).alias("right_total"))
    return join_same(a, b, keys).withColumn(
        "diff_pct", F.try_divide(F.col("left_total") - F.col("right_total"), F.col("right_total")) * 100
    )
