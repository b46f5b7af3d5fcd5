"""End-to-end jobs: from source files to stored features, summaries, streams and model comparison.

Each job reads its source once, stores the result, and works on from the stored table, so nothing is recomputed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewheel.functions.binning import threshold_code, threshold_label
from tidewheel.functions.calendar import mid_year, with_calendar
from tidewheel.functions.schema import first_match, normalise, pack, sanitise_names, with_provenance
from tidewheel.models.features import ABLATION_SETS, panel_features
from tidewheel.models.forecast import baseline_forecasts, baseline_metrics
from tidewheel.models.regression import HELD_OUT, ablation, boosted, held_out
from tidewheel.operators.clean import drop_null, positive, within
from tidewheel.operators.rollup import group_profile, union_ragged
from tidewheel.operators.series import trailing_features
from tidewheel.operators.split import TRAIN_VALIDATION_TEST, chronological_split
from tidewheel.panel import Panel
from tidewheel.sources.kafka import decode, valid
from tidewheel.sources.readers import INVENTORY_SCHEMA, PANEL_SCHEMA, read_csv, read_parquet
from tidewheel.sources.writers import append, log_run, write_metrics, write_partitioned, write_top_json
from tidewheel.streaming.sinks import start_aggregates, start_connector, start_raw
from tidewheel.streaming.windows import window_totals

DAILY = Panel(("country", "sector"), "emission_date", "mtco2_per_day", daily=True)


def load_panel(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Daily readings to described features, stored by country and year; returns the stored table.

    Several readings of a country, sector and day are added up: a daily panel has one row per key and date, which the
    window pass relies on.
    """
    rows = normalise(read_csv(spark, source, PANEL_SCHEMA), "emission_date", "mtco2_per_day")
    rows = rows.groupBy(*DAILY.keys, "emission_date").agg(F.round(F.sum("mtco2_per_day"), 6).alias("mtco2_per_day"))
    featured = trailing_features(with_calendar(rows, "emission_date"), DAILY, leak_free=False, change=True)
    stamped = pack(featured.dropna(subset=["lag_7d", "lag_30d"]), country="country", sector="sector").withColumn(
        "timestamp", F.to_timestamp("emission_date")
    )
    write_partitioned(with_provenance(stamped, "daily_panel", "processed_at"), out, ["country", "year"])
    return read_parquet(spark, out)


def summarise_panel(features: DataFrame, out: str) -> DataFrame:
    """The twenty countries with the highest mean, also stored as JSON records."""
    stats = group_profile(features, ["country"], "mtco2_per_day")
    write_top_json(stats, out, [F.desc("avg_value"), "country"], 20)
    return features.sparkSession.read.schema(stats.schema).json(out)


def load_inventory(spark: SparkSession, source: str, out: str, sink: Mapping[str, str] | None = None) -> DataFrame:
    """Annual inventory: fixed schema, cleaned, stamped mid-year, stored by country and year.

    ``sink`` holds format and options of a further sink to append to, such as a document store's collection.
    """
    rows = drop_null(read_csv(spark, source, INVENTORY_SCHEMA), ["country_code", "year", "emission_mtco2"])
    kept = within(positive(rows, "emission_mtco2"), "year", 1990, 2024).withColumn("timestamp", mid_year(F.col("year")))
    stamped = with_provenance(pack(kept, country="country_code", sector="sector"), "annual_inventory")
    write_partitioned(stamped, out, ["country_code", "year"])
    stored = read_parquet(spark, out)
    if sink:
        append(stored, **sink)
    return stored


def load_individuals(spark: SparkSession, source: str, target: str, out: str, schema: StructType | None = None) -> DataFrame:
    """Individuals with class name and code; without ``schema`` the file is read once more to infer it."""
    rows = read_csv(spark, source, schema)
    labelled = rows.withColumns(
        {"emission_class": threshold_label(F.col(target)), "emission_label": threshold_code(F.col(target))}
    )
    with_provenance(labelled, "individuals").write.mode("overwrite").parquet(out)
    return read_parquet(spark, out)


def load_vehicles(spark: SparkSession, source: str, out: str, schema: StructType | None = None) -> DataFrame:
    """Vehicles with clean names and believable emissions; without ``schema`` the file is read once more to infer it."""
    rows = sanitise_names(read_csv(spark, source, schema))
    emission = first_match(rows.columns, "(?i)co2")
    if emission:
        rows = within(rows, emission, 0, 1000, closed=False)
    with_provenance(rows, "vehicles").write.mode("overwrite").parquet(out)
    return read_parquet(spark, out)


def run_speed_layer(
    topic: DataFrame, out: str, checkpoint: str, drain: bool = False, sink: Mapping[str, str] | None = None
) -> list[StreamingQuery]:
    """Store raw records and daily totals of a message stream side by side.

    ``sink`` holds format and options of a further sink for the raw records, such as a document store's collection.
    """
    records = valid(decode(topic))
    running = [
        start_raw(records, f"{out}/raw", f"{checkpoint}/raw", f"raw-{checkpoint[-8:]}", drain),
        start_aggregates(
            window_totals(records), f"{out}/totals", f"{checkpoint}/totals", f"totals-{checkpoint[-8:]}", drain=drain
        ),
    ]
    if sink:
        running.append(start_connector(records, sink, f"{checkpoint}/sink", f"sink-{checkpoint[-8:]}", drain))
    return running


def compare_models(
    rows: DataFrame,
    out: str,
    panel: Panel = DAILY,
    feature_sets: Mapping[str, Sequence[str]] = ABLATION_SETS,
    run_id: str = "compare",
    **settings: object,
) -> DataFrame:
    """Baselines and boosted trees on nested feature sets, scored on the last tenth of each series.

    Boosting stops early on the tenth before, which no score sees.

    Metric records go to ``out/metrics`` as JSON and CSV and the run to ``out/runs``; returns the records.
    """
    spark, start = rows.sparkSession, datetime.now(timezone.utc)
    # the trees take no missing values, so the first 30 rows of a series are left out
    featured = panel_features(baseline_forecasts(rows, panel), panel, ("lag_7d", "lag_30d"))
    parts = chronological_split(featured, panel, TRAIN_VALIDATION_TEST)
    path = f"{out}/features"
    parts.write.mode("overwrite").parquet(path)
    stored = read_parquet(spark, path)
    train, test = held_out(stored), stored.where(F.col("split") == "test")
    names = {"naive": "Naive_Baseline_Yesterday", "moving_avg_7d": "Moving_Average_Baseline_7d"}
    metrics = union_ragged(
        [
            baseline_metrics(test, panel.value, names),
            ablation(train, test, panel.value, feature_sets, lambda f: boosted(f, panel.value, HELD_OUT, **settings)),
        ]
    ).withColumn("task", F.lit("panel regression"))
    write_metrics(metrics, f"{out}/metrics")
    written = spark.read.schema(metrics.schema).json(f"{out}/metrics/json")
    best = written.where(F.col("r2").isNotNull()).agg(F.max("r2").alias("r2")).first()
    log_run(spark, f"{out}/runs", run_id, "compare_models", settings, {"best_r2": best.r2}, start, datetime.now(timezone.utc))
    return written
