"""Aggregations over message streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.sources.kafka import event_time

KEYS = ("country", "sector")


def _totals(value: str, stamp: str) -> list[Column]:
    return [
        F.sum(value).alias("total_mtco2"),
        F.avg(value).alias("avg_mtco2"),
        F.count(F.lit(1)).alias("record_count"),
        F.max(stamp).alias("last_updated"),
    ]


def window_totals(
    records: DataFrame,
    keys: Sequence[str] = KEYS,
    value: str = "mtco2_per_day",
    width: str = "1 day",
    lateness: str = "1 day",
    date: str = "date",
    stamp: str = "processed_at",
) -> DataFrame:
    """Tumbling-window sum, mean, count and last update per key.  Works on streams and on static frames.

    Rows later than ``lateness`` behind the newest event are dropped by the stream, which bounds its state.  A hot key
    is combined in each input task before the shuffle, so a state partition receives one row per task and window.
    """
    timed = records.withColumn("event_time", event_time(F.col(date)))
    if timed.isStreaming:
        timed = timed.withWatermark("event_time", lateness)
    return (
        timed.groupBy(*keys, F.window("event_time", width).alias("w"))
        .agg(*_totals(value, stamp))
        .withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")})
        .drop("w")
    )


def cumulative_totals(
    records: DataFrame, keys: Sequence[str] = KEYS, value: str = "mtco2_per_day", stamp: str = "processed_at"
) -> DataFrame:
    """Sum, mean and count since the start of the stream; one state row per key."""
    return records.groupBy(*keys).agg(*_totals(value, stamp))


def once(
    records: DataFrame, keys: Sequence[str] = (*KEYS, "date"), stamp: str = "ingested_at", received: str = "kafka_timestamp", lateness: str = "1 day"
) -> DataFrame:
    """Each message once, though its producer may have sent it again: equal ``keys`` and equal ``stamp`` are one message.

    A stream remembers a message until the newest stamp is ``lateness`` past it, which bounds its state; a copy that comes
    later still is late itself and dropped.  A message without a readable stamp counts from when it was received.
    """
    timed = records.withColumn("_sent", F.coalesce(F.try_to_timestamp(F.col(stamp)), F.col(received)))
    if timed.isStreaming:
        return timed.withWatermark("_sent", lateness).dropDuplicatesWithinWatermark([*keys, stamp]).drop("_sent")
    return timed.dropDuplicates([*keys, stamp]).drop("_sent")
