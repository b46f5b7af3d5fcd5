"""Streaming sinks that survive a replayed micro-batch, and the tables they leave."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewheel.operators.rollup import latest
from tidewheel.streaming.keyed import KeyedTable

# Fixed value: seconds between micro-batches.
TRIGGER_SECONDS = 10


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch callback: each micro-batch owns the folder ``batch_id=N`` and replaces it when replayed.

    An empty batch adds no rows.  It is not looked for, since that would evaluate every batch twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def connector_writer(format: str, **options: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch callback appending to another batch sink; a replayed batch is appended twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(format).mode("append").options(**options).save()

    return write


def _writer(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str, mode: str, drain: bool
) -> DataStreamWriter:
    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if drain else {"processingTime": f"{TRIGGER_SECONDS} seconds"}
    return writer.trigger(**trigger).queryName(name)


def start_connector(
    stream: DataFrame, sink: Mapping[str, str], checkpoint: str, name: str = "connector", drain: bool = False
) -> StreamingQuery:
    """Append every record to another installed sink, given by its ``format`` and options."""
    return _writer(stream, connector_writer(**sink), checkpoint, name, "append", drain).start()


def start_raw(stream: DataFrame, path: str, checkpoint: str, name: str = "raw", drain: bool = False) -> StreamingQuery:
    """Store every record once.  ``drain`` stops when the present input is used up."""
    return _writer(stream, batch_writer(path), checkpoint, name, "append", drain).start()


def start_aggregates(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "aggregates",
    mode: str = "update",
    drain: bool = False,
) -> StreamingQuery:
    """Store each micro-batch's changed (``update``), closed (``append``) or full (``complete``) results."""
    return _writer(stream, batch_writer(path), checkpoint, name, mode, drain).start()


def start_upserts(
    stream: DataFrame, table: KeyedTable, checkpoint: str, order: Sequence[str] = (), name: str = "upserts", mode: str = "update", drain: bool = False
) -> StreamingQuery:
    """Keep a keyed table up to date with each micro-batch's changed results."""
    return _writer(stream, table.writer(order), checkpoint, name, mode, drain).start()


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key's result: an upsert resolved on reading."""
    return latest(spark.read.parquet(path), keys, ["batch_id", "last_updated"]).drop("batch_id")


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The last result of a ``complete`` query: its newest batch alone."""
    stored = spark.read.parquet(path)
    return stored.where(F.col("batch_id") == stored.agg(F.max("batch_id")).scalar()).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: Sequence[str], out: str) -> int:
    """Write the newest version of each key to ``out`` as one batch, numbered as the newest one it holds.

    Later batches may be written next to it, and :func:`read_latest` reads both alike; the old folder is left as it is.
    Returns the number of the batch up to which ``out`` is complete.
    """
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("batch_id")).first()[0]
    kept = latest(stored.where(F.col("batch_id") <= newest), keys, ["batch_id", "last_updated"]).drop("batch_id")
    kept.write.mode("overwrite").parquet(f"{out}/batch_id={newest}")
    return newest


def run_all(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait until any query ends, then stop the others; raises the failure of a failed one."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            q.stop()


def progress(query: StreamingQuery) -> dict[str, float]:
    """Rows, input rate and processing rate of the last micro-batch."""
    last = query.lastProgress or {}
    wanted = ("batchId", "numInputRows", "inputRowsPerSecond", "processedRowsPerSecond")
    return {k: last[k] for k in wanted if k in last}
