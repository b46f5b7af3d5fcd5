"""Registered queries: files written and read back, message codec and streams."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators.metrics import comparison_record
from tidewheel.operators.quantiles import exact_quantiles
from tidewheel.operators.rollup import top
from tidewheel.plans.catalog import query
from tidewheel.plans.adapters import DAILY, INVENTORY, PANEL, event_stream, inventory, messages, panel, records
from tidewheel.plans.rollup_queries import BLEND, MODELS, clean_inventory, model_records
from tidewheel.plans.series_queries import SERIES, SQL_ID, _metric_sql, day
from tidewheel.operators.series import trailing_features
from tidewheel.session import run_dir
from tidewheel.sources.kafka import VALUE_FIELD, decode, rejected, valid, with_latency
from tidewheel.sources.readers import (
    INVENTORY_SCHEMA, first_available, read_csv, read_metrics, read_parquet, table,
)
from tidewheel.sources.writers import (
    append, log_run, write_csv, write_for_lookup, write_metrics, write_partitioned, write_top_json,
)
from tidewheel.streaming.keyed import KeyedTable
from tidewheel.streaming.sinks import compact, read_latest, read_raw, start_aggregates, start_raw, start_upserts
from tidewheel.streaming.windows import KEYS, cumulative_totals, once, window_totals



# ---------------------------------------------------------------- files


@query("csv_inferred", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_inferred(spark, folder):
    path = run_dir(spark, "csv-inferred")
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    write_csv(table(spark, folder, "orders").select(*columns), path)
    return read_csv(spark, path).withColumns({c: F.col(c).cast("bigint") for c in columns[:2]})


@query("csv_fixed_schema", f"WITH {INVENTORY} SELECT * FROM inventory")
def csv_fixed_schema(spark, folder):
    path = run_dir(spark, "csv-fixed")
    write_csv(inventory(spark, folder).select(*INVENTORY_SCHEMA.names), path)
    return read_csv(spark, path, INVENTORY_SCHEMA)


@query(
    "parquet_partitioned",
    f"""WITH {INVENTORY} SELECT country_code, year, sector, emission_mtco2 FROM inventory
    WHERE emission_mtco2 > 0 AND year BETWEEN 1998 AND 1999""",
)
def parquet_partitioned(spark, folder):
    """Folders per country and year; the year filter prunes folders before any file is opened."""
    path = run_dir(spark, "inventory")
    write_partitioned(clean_inventory(spark, folder), path, ["country_code", "year"])
    return read_parquet(spark, path).where(F.col("year").between(1998, 1999)).select(
        "country_code", "year", "sector", "emission_mtco2"
    )


@query(
    "source_fallback",
    f"""WITH {PANEL}, f AS (SELECT *, LAG(mtco2_per_day, 7) OVER ({SERIES}) AS lag_7d FROM panel)
    SELECT {SQL_ID}, mtco2_per_day, lag_7d FROM f WHERE lag_7d IS NOT NULL""",
)
def source_fallback(spark, folder):
    """No featured Parquet exists, so the CSV is read and its features are made."""
    path = run_dir(spark, "panel-csv")
    write_csv(panel(spark, folder), path)
    found = first_available(
        [
            lambda: read_parquet(spark, f"{path}-featured"),
            lambda: trailing_features(read_csv(spark, path, recursive=True), DAILY),
        ]
    )
    return found.dropna(subset=["lag_7d"]).select("country", "sector", day(), "mtco2_per_day", "lag_7d")


@query(
    "append_twice",
    "SELECT o_orderpriority, CAST(2 * COUNT(*) AS BIGINT) AS n FROM orders GROUP BY 1",
)
def append_twice(spark, folder):
    """The append sink adds to what is there."""
    path = run_dir(spark, "appended")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    append(rows, path=path)
    append(rows, path=path)
    return read_parquet(spark, path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "lookup_layout",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = (SELECT MIN(o_custkey) FROM orders)""",
)
def lookup_layout(spark, folder):
    """A table laid out for lookups by customer; the equality reaches the file statistics."""
    path = run_dir(spark, "lookup")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_for_lookup(rows, path, ["o_custkey", "o_orderkey"])
    smallest = rows.agg(F.min("o_custkey").alias("k")).scalar()
    return read_parquet(spark, path).where(F.col("o_custkey") == smallest)


@query(
    "json_top_records",
    f"""WITH {PANEL} SELECT country, ROUND(AVG(mtco2_per_day), 4) AS avg_emission, COUNT(*) AS record_count FROM panel
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def json_top_records(spark, folder):
    path = run_dir(spark, "top-json")
    stats = (
        panel(spark, folder)
        .groupBy("country")
        .agg(F.round(F.avg("mtco2_per_day"), 4).alias("avg_emission"), F.count(F.lit(1)).alias("record_count"))
    )
    write_top_json(stats, path, [F.desc("avg_emission"), "country"], 20)
    return spark.read.schema("country string, avg_emission double, record_count bigint").json(path)


@query(
    "json_metrics",
    f"""WITH {BLEND}, m AS ({" UNION ALL ".join(_metric_sql(c, n) for c, n in MODELS)})
    SELECT model_type, mae, r2, test_samples FROM m""",
)
def json_metrics(spark, folder):
    path = run_dir(spark, "metrics")
    write_metrics(model_records(spark, folder), path)
    return read_metrics(spark, f"{path}/json").where(F.col("mae").isNotNull()).select(
        "model_type", F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"), "test_samples"
    )


@query(
    "csv_metrics",
    f"""WITH {BLEND}, m AS ({" UNION ALL ".join(_metric_sql(c, n) for c, n in MODELS)})
    SELECT model_type, mae, rmse, test_samples FROM m""",
)
def csv_metrics(spark, folder):
    """The CSV half of the metric table, read back with its types inferred."""
    path = run_dir(spark, "metrics")
    write_metrics(model_records(spark, folder), path)
    return read_csv(spark, f"{path}/csv").where(F.col("mae").isNotNull()).select(
        "model_type", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.col("test_samples").cast("long").alias("test_samples")
    )


@query(
    "model_runs",
    f"""WITH {BLEND}, m AS ({" UNION ALL ".join(_metric_sql(c, n) for c, n in MODELS)})
    SELECT lower(model_type) AS run_id, model_type AS run_name, 'CO2 Emission Prediction' AS task, mae, rmse, r2 FROM m""",
)
def model_runs(spark, folder):
    """Run table with one row per baseline; the metric table has one row per model."""
    path = run_dir(spark, "runs")
    start = datetime.now(timezone.utc)
    scores = model_records(spark, folder).where(F.col("mae").isNotNull()).collect()
    for row in scores:
        metrics = {m: row[m] for m in ("mae", "rmse", "r2")}
        log_run(spark, path, row["model_type"].lower(), row["model_type"], {"task": row["task"]}, metrics, start,
                datetime.now(timezone.utc))
    digits = {"mae": 4, "rmse": 4, "r2": 6}
    return read_parquet(spark, path).select(
        "run_id", "run_name", F.col("params.task").alias("task"),
        *(F.round(F.col(f"metrics.{m}"), d).alias(m) for m, d in digits.items()),
    )


@query(
    "dashboard_record",
    f"""WITH {BLEND}, m AS ({" UNION ALL ".join(_metric_sql(c, n) for c, n in MODELS)})
    SELECT COUNT(*) AS regression_models, CAST(1 AS BIGINT) AS classification_models, STRING_AGG(model_type, ',' ORDER BY model_type) AS names,
    'Blended_Average' AS best, MAX(r2) FILTER (model_type = 'Blended_Average') AS best_r2 FROM m""",
)
def dashboard_record(spark, folder):
    """The comparison record written as JSON and read back."""
    path = run_dir(spark, "dashboard")
    record = comparison_record(model_records(spark, folder))
    record.coalesce(1).write.mode("overwrite").json(path)
    back = spark.read.schema(record.schema).json(path)
    return back.select(
        F.size("regression_models").cast("bigint").alias("regression_models"),
        F.size("classification_models").cast("bigint").alias("classification_models"),
        F.array_join("regression_models.model_type", ",").alias("names"),
        F.col("best_regression.model_type").alias("best"),
        F.round("best_regression.r2", 6).alias("best_r2"),
    )


# ---------------------------------------------------------------- messages


@query(
    "message_encode",
    """SELECT event_id, 'C' || (user_id % 5) || '_' || event_type AS key,
    '{"date":"' || strftime(ts, '%Y-%m-%d') || '","country":"C' || (user_id % 5) || '","sector":"' || event_type ||
    '","MtCO2 per day":' || CAST(value AS VARCHAR) || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"}' AS body FROM events""",
)
def message_encode(spark, folder):
    """Keys and JSON bodies of all messages, without the two fields the producer adds."""
    from tidewheel.sources.kafka import encode

    sent = records(table(spark, folder, "events"))
    out = encode(sent, ["date", "country", "sector", VALUE_FIELD, "timestamp"], "events", F.col("sent"), ["event_id"])
    body = F.concat(F.regexp_extract(F.col("value").cast("string"), '^(.*),"_kafka_ingested_at"', 1), F.lit("}"))
    return out.select("event_id", F.col("key").cast("string").alias("key"), body.alias("body"))


@query(
    "message_decode",
    """SELECT strftime(ts, '%Y-%m-%d') AS date, 'C' || (user_id % 5) AS country, event_type AS sector, value AS mtco2_per_day,
    'events' AS source FROM events WHERE value > 0""",
)
def message_decode(spark, folder):
    return valid(decode(messages(table(spark, folder, "events")))).select(
        "date", "country", "sector", "mtco2_per_day", "source"
    )


BROKEN = "CASE WHEN event_type = 'error' THEN 'not json' WHEN event_type = 'view' THEN 'no country' WHEN value > 50 THEN 'negative' ELSE 'good' END"


@query(
    "message_rejects",
    f"""SELECT {BROKEN} AS kind, COUNT(*) AS n FROM events WHERE {BROKEN} <> 'good' OR value <= 0 GROUP BY 1""",
)
def message_rejects(spark, folder):
    """Messages spoilt in three ways end in the side output, and only those."""
    events = table(spark, folder, "events")
    kind = (
        F.when(F.col("event_type") == "error", "not json")
        .when(F.col("event_type") == "view", "no country")
        .when(F.col("value") > 50, "negative")
        .otherwise("good")
    )
    spoilt = records(events.withColumn("kind", kind)).drop("event_id")
    rows = events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(kind != "no country", F.concat(F.lit("C"), F.pmod("user_id", F.lit(5)))).alias("country"),
        F.col("event_type").alias("sector"),
        F.when(kind == "negative", -F.col("value")).otherwise(F.col("value")).alias(VALUE_FIELD),
        kind.alias("timestamp"),
        F.col("ts").cast("timestamp").alias("sent"),
    )
    assert set(spoilt.columns) == set(rows.columns)
    from tidewheel.sources.kafka import encode

    sent = encode(rows, ["date", "country", "sector", VALUE_FIELD, "timestamp"], "events", F.col("sent"), ["sent", "timestamp"])
    broken = F.when(F.col("timestamp") == "not json", F.lit("{oops").cast("binary")).otherwise(F.col("value"))
    topic = sent.select("key", broken.alias("value"), F.col("sent").alias("timestamp"))
    kinds = F.coalesce("emission_timestamp", F.lit("not json"))
    return rejected(decode(topic)).groupBy(kinds.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "ingest_latency",
    """SELECT event_type AS sector, COUNT(*) AS n, ROUND(AVG(event_id % 1000), 6) AS avg_ms,
    ROUND(QUANTILE_CONT(event_id % 1000, 0.95), 6) AS p95_ms, MAX(event_id % 1000) AS max_ms FROM events GROUP BY 1""",
)
def ingest_latency(spark, folder):
    timed = with_latency(decode(messages(table(spark, folder, "events")))).select("sector", "latency_ms")
    tail = exact_quantiles(timed, "latency_ms", {"p95_ms": 0.95}, ["sector"])
    stats = timed.groupBy("sector").agg(
        F.count("latency_ms").alias("n"), F.round(F.avg("latency_ms"), 6).alias("avg_ms"), F.max("latency_ms").alias("max_ms")
    )
    return stats.join(tail, "sector").withColumn("p95_ms", F.round("p95_ms", 6))


# ---------------------------------------------------------------- streams


DAILY_TOTALS = """d AS (SELECT 'C' || (user_id % 5) AS country, event_type AS sector, CAST(ts AS DATE) AS day, ROUND(SUM(value), 2) AS total_mtco2,
  COUNT(*) AS record_count FROM events WHERE value > 0 GROUP BY 1, 2, 3)"""
DAILY_COLUMNS = """country, sector, CAST(day AS VARCHAR) || ' 00:00:00' AS window_start, CAST(day + INTERVAL 1 DAY AS VARCHAR) AS window_end,
  total_mtco2, total_mtco2 / record_count AS avg_mtco2, record_count"""


def valid_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events through the whole message path: encoded, decoded, validated."""
    return valid(decode(messages(event_stream(spark, folder))))


def _windows(df: DataFrame) -> DataFrame:
    total = F.round("total_mtco2", 2)
    stamp = partial(F.date_format, format="yyyy-MM-dd HH:mm:ss")
    return df.select(
        "country", "sector", stamp("window_start").alias("window_start"), stamp("window_end").alias("window_end"),
        total.alias("total_mtco2"), (total / F.col("record_count")).alias("avg_mtco2"), "record_count",
    )


def _drain(spark: SparkSession, stream: DataFrame, mode: str, keys: list[str]) -> DataFrame:
    path = run_dir(spark, f"stream-{mode}")
    start_aggregates(stream, f"{path}/out", f"{path}/checkpoint", f"totals-{path[-8:]}", mode, drain=True).awaitTermination()
    return read_latest(spark, f"{path}/out", keys)


WINDOW_KEYS = [*KEYS, "window_start"]


@query("stream_daily_update", f"WITH {DAILY_TOTALS} SELECT {DAILY_COLUMNS} FROM d")
def stream_daily_update(spark, folder):
    return _windows(_drain(spark, window_totals(valid_stream(spark, folder)), "update", WINDOW_KEYS))


@query("stream_daily_complete", f"WITH {DAILY_TOTALS} SELECT {DAILY_COLUMNS} FROM d")
def stream_daily_complete(spark, folder):
    return _windows(_drain(spark, window_totals(valid_stream(spark, folder)), "complete", WINDOW_KEYS))


@query(
    "stream_daily_append",
    f"""WITH {DAILY_TOTALS} SELECT {DAILY_COLUMNS} FROM d
    WHERE day + INTERVAL 1 DAY <= (SELECT MAX(CAST(ts AS DATE)) FROM events) - INTERVAL 1 DAY""",
)
def stream_daily_append(spark, folder):
    """Only windows that the watermark has closed."""
    return _windows(_drain(spark, window_totals(valid_stream(spark, folder)), "append", WINDOW_KEYS))


@query("batch_daily_totals", f"WITH {DAILY_TOTALS} SELECT {DAILY_COLUMNS} FROM d")
def batch_daily_totals(spark, folder):
    """The same aggregation on a static frame."""
    return _windows(window_totals(valid(decode(messages(table(spark, folder, "events"))))))


@query(
    "stream_raw_foreachbatch",
    """SELECT strftime(ts, '%Y-%m-%d') AS date, 'C' || (user_id % 5) AS country, event_type AS sector, value AS mtco2_per_day
    FROM events WHERE value > 0""",
)
def stream_raw_foreachbatch(spark, folder):
    path = run_dir(spark, "stream-raw")
    start_raw(valid_stream(spark, folder), f"{path}/out", f"{path}/checkpoint", f"raw-{path[-8:]}", drain=True).awaitTermination()
    return read_raw(spark, f"{path}/out").select("date", "country", "sector", "mtco2_per_day")


@query(
    "stream_two_queries",
    f"""WITH {DAILY_TOTALS} SELECT country, sector, CAST(SUM(record_count) AS BIGINT) AS raw_records,
    CAST(SUM(record_count) AS BIGINT) AS window_records, COUNT(*) AS windows FROM d GROUP BY 1, 2""",
)
def stream_two_queries(spark, folder):
    """Raw store and aggregates run side by side over one decoded stream, each with its own checkpoint."""
    path = run_dir(spark, "stream-both")
    stream = valid_stream(spark, folder)
    running = [
        start_raw(stream, f"{path}/raw", f"{path}/checkpoint-raw", f"raw-{path[-8:]}", drain=True),
        start_aggregates(window_totals(stream), f"{path}/agg", f"{path}/checkpoint-agg", f"agg-{path[-8:]}", drain=True),
    ]
    for q in running:
        q.awaitTermination()
    stored = read_raw(spark, f"{path}/raw").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("raw_records"))
    totals = read_latest(spark, f"{path}/agg", WINDOW_KEYS).groupBy(*KEYS).agg(
        F.sum("record_count").alias("window_records"), F.count(F.lit(1)).alias("windows")
    )
    return stored.join(totals, list(KEYS))


@query(
    "stream_cumulative_avg",
    """SELECT 'C' || (user_id % 5) AS country, event_type AS sector, ROUND(SUM(value), 2) AS total_mtco2,
    ROUND(SUM(value), 2) / COUNT(*) AS avg_mtco2, COUNT(*) AS record_count FROM events WHERE value > 0 GROUP BY 1, 2""",
)
def stream_cumulative_avg(spark, folder):
    """Running totals without windows; complete mode rewrites one row per key."""
    out = _drain(spark, cumulative_totals(valid_stream(spark, folder)), "complete", list(KEYS))
    total = F.round("total_mtco2", 2)
    return out.select(*KEYS, total.alias("total_mtco2"), (total / F.col("record_count")).alias("avg_mtco2"), "record_count")


@query(
    "stream_top_windows",
    f"""WITH {DAILY_TOTALS} SELECT country, sector, CAST(day AS VARCHAR) || ' 00:00:00' AS window_start, total_mtco2 FROM d
    ORDER BY total_mtco2 DESC, country, sector, day LIMIT 10""",
)
def stream_top_windows(spark, folder):
    """Serving view on the stored aggregates."""
    out = _windows(_drain(spark, window_totals(valid_stream(spark, folder)), "update", WINDOW_KEYS))
    return top(out, 10, "total_mtco2", ["country", "sector", "window_start"]).select(
        "country", "sector", "window_start", "total_mtco2"
    )


@query("stream_compacted", f"WITH {DAILY_TOTALS} SELECT {DAILY_COLUMNS}, TRUE AS several_batches FROM d")
def stream_compacted(spark, folder):
    """Update-mode results of several micro-batches, compacted to one version per window."""
    path = run_dir(spark, "stream-compact")
    totals = window_totals(valid_stream(spark, folder))
    start_aggregates(totals, f"{path}/out", f"{path}/checkpoint", f"agg-{path[-8:]}", drain=True).awaitTermination()
    batches = spark.read.parquet(f"{path}/out").agg(F.count_distinct("batch_id")).scalar()
    compact(spark, f"{path}/out", WINDOW_KEYS, f"{path}/compacted")
    return _windows(read_latest(spark, f"{path}/compacted", WINDOW_KEYS)).withColumn("several_batches", batches >= 3)


@query("stream_resent", f"WITH {DAILY_TOTALS} SELECT {DAILY_COLUMNS} FROM d")
def stream_resent(spark, folder):
    """A feed in which every third message comes twice, in different micro-batches, gives the totals of the clean one."""
    path = run_dir(spark, "stream-resent")
    stream = once(valid(decode(messages(event_stream(spark, folder, resent=True)))), [*KEYS, "date", "mtco2_per_day"])
    start_raw(stream, f"{path}/out", f"{path}/checkpoint", f"resent-{path[-8:]}", drain=True).awaitTermination()
    return _windows(window_totals(read_raw(spark, f"{path}/out")))


def _by_day(column: str) -> Column:
    """A window's bucket: its day."""
    return F.unix_date(F.col(column).cast("date"))


@query("stream_keyed", f"WITH {DAILY_TOTALS} SELECT {DAILY_COLUMNS}, TRUE AS reads_a_part FROM d")
def stream_keyed(spark, folder):
    """Window totals of five slices kept as a keyed table, whose newest batch is replayed; a lookup opens a part of the files."""
    path = run_dir(spark, "stream-keyed")
    kept = KeyedTable(f"{path}/table", tuple(WINDOW_KEYS), bucket=_by_day("window_start"), most=2)
    totals = window_totals(valid(decode(messages(event_stream(spark, folder, slices=5)))))
    start_upserts(totals, kept, f"{path}/checkpoint", ["last_updated"], f"keyed-{path[-8:]}", drain=True).awaitTermination()
    whole = kept.read(spark)
    newest = max(batch for _, batch, _ in kept.entries(spark))
    last = spark.read.option("basePath", f"{kept.path}/rows").parquet(f"{kept.path}/rows/batch_id={newest}").drop("_bucket", "batch_id")
    kept.upsert(last.checkpoint(), newest, ["last_updated"])
    day = whole.select(*WINDOW_KEYS).where(F.col("window_start") == whole.agg(F.max("window_start")).scalar()).checkpoint()
    opened, files = len(kept.lookup(day).inputFiles()), len(kept.read(spark).inputFiles())
    return _windows(kept.read(spark)).withColumn("reads_a_part", F.lit(0 < 10 * opened <= files))
