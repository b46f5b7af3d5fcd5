"""Batch sinks, model persistence and the run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_id string, run_name string, params map<string,string>, metrics map<string,double>, "
    "start_time timestamp, end_time timestamp"
)


def append(df: DataFrame, format: str = "parquet", **options: str) -> None:
    """Append to any installed batch sink, e.g. a document-store connector (``database``, ``collection`` options)."""
    df.write.format(format).mode("append").options(**options).save()


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], replace_all: bool = True) -> None:
    """Overwrite hive-style folders, all of them or only those present in ``df``.

    The rebalance hint brings rows of a folder together, so that few files are written, and lets adaptive execution
    split a folder that holds much more than the others.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if replace_all else "dynamic"
    ).partitionBy(*by).parquet(path)


def write_for_lookup(df: DataFrame, path: str, sort_by: Sequence[str]) -> None:
    """Parquet range-partitioned by the lookup columns, so that file statistics prune a lookup to few files."""
    df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_top_json(df: DataFrame, path: str, order: Sequence, n: int) -> None:
    """One JSON-lines file with the first ``n`` rows of a ranked result."""
    df.orderBy(*order).limit(n).coalesce(1).write.mode("overwrite").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metric table as JSON and, without nested columns, as CSV."""
    flat = [f.name for f in metrics.schema.fields if f.dataType.typeName() not in ("map", "struct", "array")]
    metrics = metrics.persist()
    try:
        metrics.write.mode("overwrite").json(f"{path}/json")
        write_csv(metrics.select(*flat), f"{path}/csv")
    finally:
        metrics.unpersist()


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    start: datetime,
    end: datetime,
) -> None:
    """Append one row to the run table."""
    row = (run_id, run_name, {k: str(v) for k, v in params.items()}, dict(metrics), start, end)
    append(spark.createDataFrame([row], RUN_SCHEMA), path=path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, columns: Sequence[str], model_type: str) -> DataFrame:
    """Predictions with their origin, ready to be appended to a prediction table."""
    return model.transform(df).select(
        *columns,
        "prediction",
        F.lit(model_type).alias("model_type"),
        F.current_timestamp().alias("prediction_date"),
    )
