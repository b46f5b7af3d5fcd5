"""Batch sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names and types of the annual inventory file.
INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("country_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("sector", T.StringType()),
        T.StructField("emission_mtco2", T.DoubleType()),
        T.StructField("per_capita_tco2", T.DoubleType()),
    ]
)

# Columns of the daily panel file.
PANEL_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()), T.StructField("country", T.StringType()),
        T.StructField("sector", T.StringType()), T.StructField("MtCO2 per day", T.DoubleType()),
    ]
)

# Fields that model metric records may have; each record fills some of them.
METRIC_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("model_type", "task", "country", "sector")]
    + [T.StructField(n, T.DoubleType()) for n in ("mae", "rmse", "r2", "accuracy", "precision", "recall", "f1", "error_std")]
    + [
        T.StructField(n, T.LongType())
        for n in (
            "train_samples", "test_samples", "train_size", "test_size", "n_estimators_used",
            "epochs_run", "seq_len", "horizon", "train_sequences", "test_sequences",
        )
    ]
    + [
        T.StructField(
            "sector_errors",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("mae", T.DoubleType()),
                        T.StructField("rmse", T.DoubleType()),
                        T.StructField("count", T.LongType()),
                    ]
                ),
            ),
        )
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, recursive: bool = False) -> DataFrame:
    """CSV with a header line.  Without a schema the types are inferred, which reads the files one extra time."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with its own schema; hive-style folders become partition columns."""
    return spark.read.parquet(path)


def read_metrics(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Metric records from JSON lines, or from one file holding a JSON array."""
    return spark.read.schema(METRIC_SCHEMA).option("multiLine", array_file).json(path)


def first_available(candidates: Sequence[Callable[[], DataFrame]]) -> DataFrame | None:
    """Result of the first reader whose path exists, or None."""
    for read in candidates:
        try:
            return read()
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return None
