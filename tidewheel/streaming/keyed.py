"""A keyed table on plain Parquet files: batches are upserts, and reading a part of the keys reads a part of the files.

Keys fall into buckets.  A batch writes the rows of the buckets it touches and then a commit: the list of live folders, by
bucket.  Readers see what the newest commit lists, so a batch that died half-way is invisible and a replayed one replaces
itself.  A bucket with many live folders is merged into one by the batch that makes it so; others are left as they are.
Neither a batch nor a lookup reads the history of the buckets it doesn't touch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators.rollup import latest

ENTRY = "bucket int, batch_id long, n long"


@dataclass(frozen=True)
class KeyedTable:
    """``path`` holds the table, ``keys`` identify a row, ``most`` live folders a bucket has before it is merged.

    ``bucket`` gives a row's bucket number from its keys: by default a hash of all of them.  Where updates come close
    together, a bucket of their own keeps them from touching all others (a day's windows, say).  A commit has a row per
    live folder: at most ``most`` for each bucket.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    bucket: Column | None = None
    most: int = 4

    def _numbered(self, df: DataFrame) -> DataFrame:
        number = self.bucket if self.bucket is not None else F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        return df.withColumn("_bucket", number.cast("int"))

    def _commits(self, spark: SparkSession) -> list[int]:
        """Numbers of the finished commits, from the names of their folders."""
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commit/batch_id=*/_SUCCESS")
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def entries(self, spark: SparkSession, before: int | None = None) -> list[tuple[int, int, int]]:
        """Live folders as ``(bucket, batch, rows)`` by the newest commit (with a smaller number than ``before``)."""
        done = [n for n in self._commits(spark) if before is None or n < before]
        if not done:
            return []
        rows = spark.read.schema(ENTRY).parquet(f"{self.path}/commit/batch_id={done[-1]}").select("bucket", "batch_id", "n")
        return sorted(tuple(r) for r in rows.collect())

    def _folders(self, spark: SparkSession, entries: Sequence[tuple[int, int, int]]) -> DataFrame:
        paths = [f"{self.path}/rows/batch_id={batch}/_bucket={bucket}" for bucket, batch, _ in entries]
        return spark.read.option("basePath", f"{self.path}/rows").parquet(*paths)

    def _merged(self, stored: DataFrame) -> DataFrame:
        """The newest version of each key.  The order within a batch is settled when it is written."""
        return latest(stored.drop("_bucket"), self.keys, ["batch_id"]).drop("batch_id")

    def upsert(self, batch: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Write a batch; of several rows with a key, the one with the largest ``order`` counts (by default, of all columns).

        A batch without rows commits nothing new.  Batches have rising numbers; one that comes again, as the newest one,
        replaces itself, and an older one is not written again.
        """
        spark = batch.sparkSession
        if any(n > batch_id for n in self._commits(spark)):
            return
        live = self.entries(spark, before=batch_id)
        rest = [c for c in batch.columns if c not in self.keys]
        once = latest(batch, self.keys, list(order) or rest or list(self.keys))
        # a bucket is one file here, unless it is a large one, which adaptive execution splits
        target = f"{self.path}/rows/batch_id={batch_id}"
        self._numbered(once).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(target)
        touched = {}
        if self._written(spark, target):
            stored = spark.read.option("basePath", f"{self.path}/rows").parquet(target)
            touched = {r["_bucket"]: r["n"] for r in stored.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        crowded = {b for b in touched if sum(e[0] == b for e in live) >= self.most}
        if crowded:
            old = [e for e in live if e[0] in crowded]
            new = [(b, batch_id, 0) for b in crowded]
            whole = self._numbered(self._merged(self._folders(spark, old + new)))
            merged = f"{self.path}/merged/batch_id={batch_id}"
            whole.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(merged)
            again = spark.read.parquet(merged)
            again.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(target)
            touched |= {r["_bucket"]: r["n"] for r in again.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        kept = [e for e in live if e[0] not in crowded]
        rows = kept + [(b, batch_id, n) for b, n in touched.items()]
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commit/batch_id={batch_id}")

    def _written(self, spark: SparkSession, target: str) -> bool:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_bucket=*")
        return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place))

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All keys in their newest version; None before the first row."""
        entries = self.entries(spark)
        return self._merged(self._folders(spark, entries)) if entries else None

    def lookup(self, wanted: DataFrame) -> DataFrame | None:
        """The newest version of the rows whose keys are in ``wanted``: only their buckets are opened.

        The buckets asked for come to the driver, a number each.
        """
        spark = wanted.sparkSession
        asked = wanted.select(*self.keys).distinct()
        numbers = {r[0] for r in self._numbered(asked).select("_bucket").distinct().collect()}
        entries = [e for e in self.entries(spark) if e[0] in numbers]
        if not entries:
            return None
        return self._merged(self._folders(spark, entries).join(asked, list(self.keys), "left_semi"))

    def writer(self, order: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
        """foreachBatch callback."""
        return lambda batch, batch_id: self.upsert(batch, batch_id, order)
