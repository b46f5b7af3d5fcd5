from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.functions.calendar import with_calendar
from tidewheel.models import forecast
from tidewheel.models.features import SEQUENCE_FEATURES, panel_features
from tidewheel.operators.metrics import comparison_record
from tidewheel.operators.series import past_values, over_series
from tidewheel.operators.split import TRAIN_VALIDATION_TEST
from tidewheel.plans import jobs
from tidewheel.session import run_dir
from tidewheel.sources.kafka import VALUE_FIELD, encode
from tidewheel.sources.readers import read_metrics, read_parquet
from tidewheel.sources.writers import write_csv
from tidewheel.streaming.sinks import read_latest, read_raw


@pytest.fixture(scope="module")
def daily(spark):
    """Two countries, two sectors, 120 days: seasonal level with a weekly dip."""
    rows = []
    for c, base in (("CN", 30.0), ("US", 12.0)):
        for s, share in (("Power", 0.4), ("Ground Transport", 0.2)):
            for i in range(120):
                d = date(2020, 1, 1) + timedelta(days=i)
                dip = 0.85 if d.weekday() >= 5 else 1.0
                rows.append((str(d), c, s, round(base * share * dip * (1 + 0.15 * float(np.cos(2 * np.pi * (i - 15) / 365))), 4)))
    return spark.createDataFrame(rows, f"date string, country string, sector string, `{VALUE_FIELD}` double")


def test_panel_job_and_summary(spark, daily):
    path = run_dir(spark, "job")
    write_csv(daily, f"{path}/in")
    stored = jobs.load_panel(spark, f"{path}/in", f"{path}/out")
    assert stored.count() == 4 * (120 - 30)
    assert {"season", "month_sin", "pct_change", "metadata", "timestamp", "data_source", "processed_at"} <= set(stored.columns)
    assert stored.where("year = 2020 AND country = 'CN'").count() == 180
    top = jobs.summarise_panel(stored, f"{path}/top").orderBy(F.desc("avg_value")).collect()
    assert [r.country for r in top] == ["CN", "US"] and top[0].record_count == 180


def test_inventory_job_drops_bad_rows_and_appends(spark):
    path = run_dir(spark, "job")
    rows = [("CN", "China", 1990, "Power", 5.0, 1.0), ("CN", "China", 1989, "Power", 5.0, 1.0), ("US", "USA", 2000, "Power", -1.0, 1.0), ("US", "USA", 2000, "Power", None, 1.0)]
    write_csv(spark.createDataFrame(rows, jobs.INVENTORY_SCHEMA), f"{path}/in")
    sink = {"format": "parquet", "path": f"{path}/collection"}
    for _ in range(2):
        assert jobs.load_inventory(spark, f"{path}/in", f"{path}/out", sink).count() == 1
    assert read_parquet(spark, f"{path}/collection").count() == 2


def test_speed_layer_job(spark, daily):
    path = run_dir(spark, "job")
    sent = encode(daily, daily.columns, "t").withColumn("timestamp", F.current_timestamp())
    sent.write.parquet(f"{path}/topic")
    topic = spark.readStream.schema(sent.schema).parquet(f"{path}/topic")
    for q in jobs.run_speed_layer(topic, f"{path}/out", f"{path}/checkpoint", drain=True):
        q.awaitTermination()
    assert read_raw(spark, f"{path}/out/raw").count() == 480
    totals = read_latest(spark, f"{path}/out/totals", ["country", "sector", "window_start"])
    assert totals.count() == 480 and totals.agg(F.sum("record_count")).first()[0] == 480


def test_model_comparison_job(spark, daily):
    path = run_dir(spark, "job")
    rows = daily.select(F.to_date("date").alias("emission_date"), "country", "sector", F.col(VALUE_FIELD).alias("mtco2_per_day"))
    out = jobs.compare_models(rows, path, maxIter=3, stepSize=0.5, maxDepth=3)
    assert out.count() == 5
    assert read_metrics(spark, f"{path}/metrics/json").count() == 5
    assert read_parquet(spark, f"{path}/runs").first().run_name == "compare_models"
    record = comparison_record(out.withColumns({"accuracy": F.lit(None).cast("double")})).first()
    assert record.best_regression.model_type == "Boosted_Regression" and len(record.regression_models) == 3
    assert record.classification_models == []


def test_sequences_of_several_columns(spark, daily):
    rows = daily.select(F.to_date("date").alias("emission_date"), "country", "sector", F.col(VALUE_FIELD).alias("mtco2_per_day"))
    numbered = rows.withColumn("n", F.dayofyear("emission_date"))
    out = over_series(numbered, jobs.DAILY, {"x": past_values(["n", "n"], 3)}).where("n = 4 AND country = 'CN' AND sector = 'Power'")
    assert out.first().x == [2.0, 2.0, 3.0, 3.0, 4.0, 4.0]
    featured = panel_features(rows, jobs.DAILY, ("lag_30d",))
    made = forecast.supervised(featured, jobs.DAILY, 5, 2, SEQUENCE_FEATURES, TRAIN_VALIDATION_TEST, split_first=True)
    sizes = {(r.split): r["n"] for r in made.groupBy("split").agg(F.count("*").alias("n")).collect()}
    # 90 rows per series: 72 / 9 / 9, each part giving n - 5 - 2 + 1 sequences
    assert sizes == {"train": 4 * 66, "validation": 4 * 3, "test": 4 * 3}
    assert made.first().inputs.__len__() == 5 * (1 + len(SEQUENCE_FEATURES))


def test_calendar_columns_survive_the_window_pass(daily):
    rows = daily.select(F.to_date("date").alias("d"))
    assert set(rows.columns) < set(with_calendar(rows, "d").columns)
