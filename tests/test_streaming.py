import json
import uuid
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewheel.session import run_dir
from tidewheel.sources import kafka
from tidewheel.streaming import sinks
from tidewheel.streaming.keyed import KeyedTable
from tidewheel.streaming.windows import cumulative_totals, once, window_totals


def message(date, country="CN", sector="Power", value=1.0, **extra):
    body = {"date": date, "country": country, "sector": sector, kafka.VALUE_FIELD: value, "_source": "t", **extra}
    return json.dumps(body)


def topic(spark, bodies):
    rows = [(f"k{i}".encode(), b.encode(), datetime(2024, 1, 1)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")


def test_decode_validate_reject(spark):
    bodies = [
        message("2024-01-01"), message("2024-01-01T00:00:00"), message("2024-01-01", value="oops"), "not json",
        message("2024-01-01", country=None), message("2024-01-01", value=-2.0), message("2024-01-01", value=0.0), message(None),
    ]
    decoded = kafka.decode(topic(spark, bodies))
    assert decoded.count() == 8
    good = kafka.valid(decoded)
    assert good.count() == 2 and kafka.rejected(decoded).count() == 6
    times = {r.t for r in good.select(kafka.event_time(F.col("date")).alias("t")).collect()}
    assert times == {datetime(2024, 1, 1)}


def test_encode_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2), "CN", "Power", 1.5), (datetime(2024, 1, 3), None, None, None)],
        f"date timestamp, country string, sector string, `{kafka.VALUE_FIELD}` double",
    )
    out = kafka.encode(df, df.columns, "src").collect()
    assert [bytes(r.key).decode() for r in out] == ["CN_Power", "UNKNOWN_ALL"]
    bodies = [json.loads(bytes(r.value)) for r in out]
    assert bodies[0]["date"] == "2024-01-02T00:00:00" and bodies[0]["_source"] == "src" and bodies[0]["_kafka_ingested_at"]
    assert bodies[1]["country"] is None and kafka.VALUE_FIELD in bodies[1]


def test_latency(spark):
    body = message("2024-01-01", _kafka_ingested_at="2023-12-31T23:59:59.250000")
    assert kafka.with_latency(kafka.decode(topic(spark, [body]))).first().latency_ms == 750


def test_topic_options():
    options = kafka.topic_options("h:1", "t", starting="earliest")
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "1000" and options["failOnDataLoss"] == "false"


@pytest.fixture
def source(spark):
    """A folder of message files read as a stream, one file per micro-batch."""
    path = run_dir(spark, "topic")

    def add(*bodies):
        topic(spark, bodies).coalesce(1).write.mode("append").parquet(path)

    add(message("2024-01-01", value=1.0), message("2024-01-02", value=2.0))

    def stream():
        schema = "key binary, value binary, timestamp timestamp"
        return kafka.valid(kafka.decode(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)))

    return add, stream


def drain(spark, stream, out, checkpoint, mode):
    q = sinks.start_aggregates(stream, out, checkpoint, f"q{uuid.uuid4().hex[:8]}", mode, drain=True)
    q.awaitTermination()
    return q


def totals(df):
    return {str(r.window_start)[:10]: (r.total_mtco2, r.record_count) for r in df.collect()}


@pytest.mark.parametrize("mode", ["update", "complete", "append"])
def test_late_events_modes_and_restart(spark, source, mode):
    add, stream = source
    out, checkpoint = run_dir(spark, "agg"), run_dir(spark, "checkpoint")
    drain(spark, window_totals(stream()), out, checkpoint, mode)
    add(message("2024-01-05", value=5.0), message("2024-01-02", value=3.0))
    drain(spark, window_totals(stream()), out, checkpoint, mode)
    add(message("2024-01-02", value=100.0), message("2024-01-06", value=6.0))
    drain(spark, window_totals(stream()), out, checkpoint, mode)
    got = totals(sinks.read_latest(spark, out, ["country", "sector", "window_start"]))
    closed = {"2024-01-01": (1.0, 1), "2024-01-02": (5.0, 2)}
    late = {"2024-01-01": (1.0, 1), "2024-01-02": (105.0, 3)}
    open_windows = {"2024-01-05": (5.0, 1), "2024-01-06": (6.0, 1)}
    # complete mode keeps all state, so nothing is too late for it
    assert got == {"append": closed, "update": closed | open_windows, "complete": late | open_windows}[mode]


def test_restart_reads_nothing_twice(spark, source):
    add, stream = source
    out, checkpoint = run_dir(spark, "raw"), run_dir(spark, "checkpoint")
    for _ in range(2):
        sinks.start_raw(stream(), out, checkpoint, f"q{uuid.uuid4().hex[:8]}", drain=True).awaitTermination()
    assert sinks.read_raw(spark, out).count() == 2
    add(message("2024-01-03"))
    q = sinks.start_raw(stream(), out, checkpoint, f"q{uuid.uuid4().hex[:8]}", drain=True)
    q.awaitTermination()
    assert sinks.read_raw(spark, out).count() == 3
    assert sinks.progress(q)["numInputRows"] == 1


def test_replayed_batch_replaces_itself(spark):
    path = run_dir(spark, "replay")
    write = sinks.batch_writer(path)
    df = spark.range(5)
    write(df, 0), write(df, 0), write(df.limit(0), 1), write(df, 2)
    assert sinks.read_raw(spark, path).count() == 10


def test_cumulative_stream(spark, source):
    add, stream = source
    out, checkpoint = run_dir(spark, "cum"), run_dir(spark, "checkpoint")
    add(message("2024-01-09", value=6.0))
    drain(spark, cumulative_totals(stream()), out, checkpoint, "complete")
    row = sinks.read_latest(spark, out, ["country", "sector"]).first()
    assert (row.total_mtco2, row.avg_mtco2, row.record_count) == (9.0, 3.0, 3)


def test_run_all_stops_the_rest(spark, source):
    _, stream = source

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    spark.streams.resetTerminated()
    bad = sinks._writer(stream(), fail, run_dir(spark, "c"), f"bad{uuid.uuid4().hex[:6]}", "append", drain=True)
    good = sinks.start_raw(stream(), run_dir(spark, "o"), run_dir(spark, "c"), f"good{uuid.uuid4().hex[:6]}")
    started = [good, bad.start()]
    with pytest.raises(Exception, match="sink is gone"):
        sinks.run_all(spark, started)
    assert not any(q.isActive for q in started)
    spark.streams.resetTerminated()


def test_compaction_and_newest_batch(spark, tmp_path):
    for n, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("a", 3), ("c", 1)]]):
        df = spark.createDataFrame([(k, v, n) for k, v in rows], "k string, v int, last_updated int")
        df.write.parquet(f"{tmp_path}/out/batch_id={n}")
    newest = {(r.k, r.v) for r in sinks.read_latest(spark, f"{tmp_path}/out", ["k"]).collect()}
    assert sinks.compact(spark, f"{tmp_path}/out", ["k"], f"{tmp_path}/small") == 2
    assert {(r.k, r.v) for r in sinks.read_latest(spark, f"{tmp_path}/small", ["k"]).collect()} == newest == {("a", 3), ("b", 1), ("c", 1)}
    assert {(r.k, r.v) for r in sinks.read_complete(spark, f"{tmp_path}/out").collect()} == {("a", 3), ("c", 1)}


# keyed table


def keyed(spark, **options):
    return KeyedTable(run_dir(spark, "keyed"), ("k",), **options)


def values(df):
    return {r.k: r.v for r in df.collect()}


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v double, at long")


def test_upserts_and_replays(spark):
    table, want = keyed(spark, buckets=5, most=2), {}
    assert table.read(spark) is None and table.lookup(batch(spark, (1, 1.0, 1))) is None
    for number in range(8):
        rows = [(k % 23, float(number * 100 + k), k) for k in range(number, 23 * 2, number + 1)]
        table.upsert(batch(spark, *rows), number, ["at"])
        for k, v, _ in rows:
            want[k] = v
        if number in (3, 7):  # again, as after a failure
            table.upsert(batch(spark, *rows), number, ["at"])
        assert values(table.read(spark)) == want
        counts = Counter(b for b, _, _ in table.entries(spark))
        assert max(counts.values()) <= 2
    # an older batch that comes again changes nothing, nor does one that died before its commit
    table.upsert(batch(spark, (1, -1.0, 9)), 2, ["at"])
    table._numbered(batch(spark, (1, -1.0, 9))).write.partitionBy("_bucket").parquet(f"{table.path}/rows/batch_id=99")
    assert values(table.read(spark)) == want
    assert values(table.lookup(batch(spark, (1, 0.0, 0), (77, 0.0, 0)))) == {1: want[1]}


def test_small_update_reads_few_files(spark):
    table = keyed(spark, bucket=F.floor(F.col("k") / 10), most=3)
    table.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit(0.0).alias("v"), F.lit(0).cast("long").alias("at")), 0)
    before = table.entries(spark)
    for number in range(1, 6):
        table.upsert(batch(spark, *((k, float(number), 1) for k in range(500, 510))), number)
    after = table.entries(spark)
    assert len(before) == 100 and set(before) - set(after) <= {(50, 0, 10)} and {e[0] for e in set(after) - set(before)} == {50}
    one = table.lookup(batch(spark, (505, 0.0, 0)))
    assert values(one) == {505: 5.0} and len(one.inputFiles()) <= 3
    assert values(table.read(spark)) == {k: 5.0 if 500 <= k < 510 else 0.0 for k in range(1000)}


def test_null_keys_empty_batches_and_ties(spark):
    table = keyed(spark)
    table.upsert(batch(spark), 0)
    assert table.read(spark) is None
    table.upsert(batch(spark, (None, 1.0, 1), (2, 5.0, 1), (2, 5.0, 1), (2, 3.0, 1)), 1)
    table.upsert(batch(spark), 2)
    assert values(table.read(spark)) == {None: 1.0, 2: 5.0}


def test_each_message_once(spark):
    body = [message("2024-01-01", value=float(v), _kafka_ingested_at=f"2024-01-01T00:00:0{v}") for v in (1, 2, 3)]
    path = run_dir(spark, "twice")
    for part in (body[:2], body, [body[2], message("2024-01-01", value=9.0), message("2024-01-01", value=9.0)]):
        topic(spark, part).coalesce(1).write.mode("append").parquet(path)
    read = spark.readStream.schema("key binary, value binary, timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    out = run_dir(spark, "once")
    sinks.start_raw(once(kafka.valid(kafka.decode(read))), out, run_dir(spark, "cp"), f"o{uuid.uuid4().hex[:6]}", drain=True).awaitTermination()
    assert sorted(r.mtco2_per_day for r in sinks.read_raw(spark, out).collect()) == [1.0, 2.0, 3.0, 9.0]
    static = once(kafka.valid(kafka.decode(topic(spark, body + body))))
    assert static.count() == 3
