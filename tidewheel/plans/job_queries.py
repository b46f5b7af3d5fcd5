"""Registered queries: the end-to-end jobs on the given tables, written out as the files a producer would deliver."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.plans import jobs
from tidewheel.plans.adapters import (
    INDIVIDUALS, INVENTORY, PANEL, event_stream, individuals, inventory, messages, panel, vehicles,
)
from tidewheel.plans.catalog import query
from tidewheel.plans.io_queries import DAILY_TOTALS
from tidewheel.plans.rollup_queries import CLEAN_VEHICLES
from tidewheel.plans.series_queries import SERIES, SQL_ID, day, frame
from tidewheel.session import run_dir
from tidewheel.sources.readers import INVENTORY_SCHEMA
from tidewheel.sources.writers import write_csv
from tidewheel.streaming.sinks import read_latest, read_raw


def _panel_file(spark, folder, path):
    raw = panel(spark, folder).select(
        F.col("emission_date").cast("string").alias("date"), "country", "sector",
        F.col("mtco2_per_day").alias("MtCO2 per day"),
    )
    write_csv(raw, path)
    return path


LAGGED = f"""{PANEL}, f AS (SELECT *, LAG(mtco2_per_day) OVER ({SERIES}) AS lag_1d, LAG(mtco2_per_day, 30) OVER ({SERIES}) AS lag_30d,
  AVG(mtco2_per_day) OVER {frame(6)} AS m7 FROM panel)"""


@query(
    "job_panel",
    f"""WITH {LAGGED} SELECT {SQL_ID}, CAST(year(emission_date) AS INTEGER) AS year, lag_30d, ROUND(m7, 6) AS rolling_avg_7d,
    ROUND((mtco2_per_day - lag_1d) / NULLIF(lag_1d, 0) * 100, 6) AS pct_change, 'daily_panel' AS data_source
    FROM f WHERE lag_30d IS NOT NULL""",
)
def job_panel(spark, folder):
    path = run_dir(spark, "job-panel")
    stored = jobs.load_panel(spark, _panel_file(spark, folder, f"{path}/in"), f"{path}/out")
    return stored.select(
        "country", "sector", day(), "year", "lag_30d", F.round("rolling_avg_7d", 6).alias("rolling_avg_7d"),
        F.round("pct_change", 6).alias("pct_change"), "data_source",
    )


@query(
    "job_panel_summary",
    f"""WITH {LAGGED} SELECT country, ROUND(AVG(mtco2_per_day), 4) AS avg_value, ROUND(SUM(mtco2_per_day), 2) AS total_value,
    COUNT(*) AS record_count FROM f WHERE lag_30d IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def job_panel_summary(spark, folder):
    path = run_dir(spark, "job-summary")
    stored = jobs.load_panel(spark, _panel_file(spark, folder, f"{path}/in"), f"{path}/out")
    return jobs.summarise_panel(stored, f"{path}/summary")


@query(
    "job_inventory",
    f"""WITH {INVENTORY} SELECT country_code, year, sector, emission_mtco2, CAST(year AS VARCHAR) || '-07-01' AS day FROM inventory
    WHERE emission_mtco2 > 0 AND year BETWEEN 1990 AND 2024""",
)
def job_inventory(spark, folder):
    path = run_dir(spark, "job-inventory")
    write_csv(inventory(spark, folder).select(*INVENTORY_SCHEMA.names), f"{path}/in")
    sink = {"format": "parquet", "path": f"{path}/collection"}
    jobs.load_inventory(spark, f"{path}/in", f"{path}/out", sink)
    return spark.read.parquet(f"{path}/collection").select(
        "country_code", "year", "sector", "emission_mtco2", F.date_format("timestamp", "yyyy-MM-dd").alias("day")
    )


@query(
    "job_individuals",
    f"""WITH {INDIVIDUALS} SELECT id, CAST(CASE WHEN CarbonEmission < 2500 THEN 0 WHEN CarbonEmission < 5000 THEN 1 ELSE 2 END AS INTEGER)
    AS emission_label, order_total FROM individuals""",
)
def job_individuals(spark, folder):
    path = run_dir(spark, "job-individuals")
    rows = individuals(spark, folder)
    write_csv(rows, f"{path}/in")
    stored = jobs.load_individuals(spark, f"{path}/in", "CarbonEmission", f"{path}/out", rows.schema)
    return stored.select(F.col("id").cast("bigint").alias("id"), "emission_label", "order_total")


@query("job_vehicles", f'WITH {CLEAN_VEHICLES} SELECT "Model", "Fuel_Type", "CO2_Emissionsg_per_km" FROM clean')
def job_vehicles(spark, folder):
    path = run_dir(spark, "job-vehicles")
    rows = vehicles(spark, folder)
    write_csv(rows, f"{path}/in")
    stored = jobs.load_vehicles(spark, f"{path}/in", f"{path}/out", rows.schema)
    return stored.select(F.col("Model").cast("bigint").alias("Model"), "Fuel_Type", "CO2_Emissionsg_per_km")


@query(
    "job_speed_layer",
    f"""WITH {DAILY_TOTALS} SELECT sector, CAST(SUM(record_count) AS BIGINT) AS raw_records, COUNT(*) AS windows,
    ROUND(SUM(total_mtco2), 2) AS total FROM d GROUP BY 1""",
)
def job_speed_layer(spark, folder):
    path = run_dir(spark, "job-speed")
    sink = {"format": "parquet", "path": f"{path}/collection"}
    for q in jobs.run_speed_layer(messages(event_stream(spark, folder)), path, f"{path}/checkpoint", drain=True, sink=sink):
        q.awaitTermination()
    stored = read_raw(spark, f"{path}/raw").groupBy("sector").agg(F.count(F.lit(1)).alias("raw_records"))
    sent = spark.read.parquet(f"{path}/collection").groupBy("sector").agg(F.count(F.lit(1)).alias("sent"))
    raw = stored.join(sent, "sector").where("sent = raw_records").drop("sent")
    totals = (
        read_latest(spark, f"{path}/totals", ["country", "sector", "window_start"])
        .groupBy("sector")
        .agg(F.count(F.lit(1)).alias("windows"), F.round(F.sum("total_mtco2"), 2).alias("total"))
    )
    return raw.join(totals, "sector")


@query(
    "job_compare_models",
    f"""WITH {PANEL}, numbered AS (SELECT *, ROW_NUMBER() OVER ({SERIES}) - 1 AS k FROM panel),
    known AS (SELECT ROW_NUMBER() OVER ({SERIES}) - 1 AS i, COUNT(*) OVER (PARTITION BY country, sector) AS n FROM numbered WHERE k >= 30)
    SELECT model_type, n, TRUE AS has_scores FROM (SELECT COUNT(*) AS n FROM known WHERE i >= FLOOR(n * 0.9)),
    (SELECT UNNEST(['Naive_Baseline_Yesterday', 'Moving_Average_Baseline_7d', 'Ablation_TimeOnly', 'Ablation_TimeLag', 'Boosted_Regression']) AS model_type)""",
)
def job_compare_models(spark, folder):
    """Two baselines and three boosted models with the library's settings."""
    path = run_dir(spark, "job-models")
    records = jobs.compare_models(panel(spark, folder), path)
    return records.select(
        "model_type", F.col("test_samples").cast("bigint").alias("n"),
        (F.col("rmse").isNotNull() & F.col("mae").isNotNull() & (F.col("mae") <= F.col("rmse"))).alias("has_scores"),
    )
