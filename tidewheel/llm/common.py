"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.session import run_dir

#: A word: a run of anything but space and the ASCII controls tab to carriage return.  ``bytes.split()`` cuts alike.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared one and read it again: lineage ends there."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, limit: str = "4m") -> None:
    """Let Arrow batches end after ``limit`` bytes, so that long texts don't pile up in a Python worker."""
    spark.conf.set(BATCH_BYTES, limit)


def fold(doc_id: str, parts: int) -> Column:
    """``crc32`` of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def by_hash(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` rows whose ``keys`` have the smallest hashes, equal hashes by key.

    Rows that cannot be among them are filtered out before anything moves: about twice ``n`` rows pass, however many
    partitions there are.
    """
    span = 1 << 40
    total = df.count()
    place = F.pmod(F.xxhash64(*keys), F.lit(span))
    share = min(1.0, (2 * n + 100) / max(1, total))
    return df.withColumn("_place", place).where(F.col("_place") <= int(span * share)).orderBy("_place", *keys).limit(n).drop("_place")


_caches: list[dict] = []


def worker_cache() -> dict:
    """A table that a worker process keeps between tasks."""
    _caches.append(cache := {})
    return cache


def give_back(spark: SparkSession) -> None:
    """Have idle Python workers empty their caches and return free memory to the system.

    A stage without Python doesn't claim it, and would share an executor with what earlier stages have left behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gc.collect()
            claim()
            time.sleep(0.05)  # keeps this worker busy, so that the next task takes another one
            yield batch

    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(run, "id long").count()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, behind as many underscores as it takes to be no column of ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def claim(own: dict | None = None) -> None:
    """Empty what other operators keep in this worker process: a pipeline's stages follow each other in one worker.

    What they and earlier tasks have freed goes back to the system, so that a worker holds no more than its own task's peak.
    """
    for cache in _caches:
        if cache is not own:
            cache.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)
