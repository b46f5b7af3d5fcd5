from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewheel.session import run_dir, shared_dir
from tidewheel.sources import readers, writers


def test_csv_both_ways(spark):
    path = run_dir(spark, "csv")
    df = spark.createDataFrame([("CN", "Chína", 1990, "a,b", 1.5, None)], readers.INVENTORY_SCHEMA)
    writers.write_csv(df, path)
    assert readers.read_csv(spark, path, readers.INVENTORY_SCHEMA).collect() == df.collect()
    assert dict(readers.read_csv(spark, path).dtypes)["year"] == "int"
    assert readers.read_csv(spark, path.rsplit("/", 1)[0], readers.INVENTORY_SCHEMA, recursive=True).where("country_name = 'Chína'").count() >= 1


def test_partition_overwrite(spark):
    path = run_dir(spark, "parts")
    one = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], "c string, year int, v double")
    two = spark.createDataFrame([("a", 1, 9.0)], "c string, year int, v double")
    writers.write_partitioned(one, path, ["c", "year"])
    writers.write_partitioned(two, path, ["c", "year"], replace_all=False)
    assert {(r.c, r.v) for r in readers.read_parquet(spark, path).collect()} == {("a", 9.0), ("b", 2.0)}
    writers.write_partitioned(two, path, ["c", "year"])
    assert readers.read_parquet(spark, path).count() == 1


def test_fallback(spark):
    path = run_dir(spark, "there")
    spark.range(3).write.parquet(path)
    missing = lambda: readers.read_parquet(spark, f"{path}-not")
    assert readers.first_available([missing, lambda: readers.read_parquet(spark, path)]).count() == 3
    assert readers.first_available([missing]) is None
    with pytest.raises(Exception, match="no_such_column"):
        readers.first_available([lambda: readers.read_parquet(spark, path).select("no_such_column")])


def test_ragged_metrics(spark):
    path = run_dir(spark, "metrics")
    spark.createDataFrame(
        [('[{"model_type":"a","mae":1.0,"sector_errors":{"s":{"mae":1.0,"rmse":2.0,"count":3}}},{"model_type":"b","accuracy":0.5}]',)],
        "value string",
    ).write.text(path)
    rows = {r.model_type: r for r in readers.read_metrics(spark, path, array_file=True).collect()}
    assert rows["a"].sector_errors["s"]["count"] == 3 and rows["b"].accuracy == 0.5 and rows["b"].mae is None
    out = run_dir(spark, "metrics-out")
    writers.write_metrics(readers.read_metrics(spark, path, array_file=True), out)
    assert readers.read_metrics(spark, f"{out}/json").count() == 2
    assert "sector_errors" not in readers.read_csv(spark, f"{out}/csv").columns


def test_run_log_appends(spark):
    path, now = run_dir(spark, "runs"), datetime.now(timezone.utc)
    for i in range(2):
        writers.log_run(spark, path, f"r{i}", "name", {"depth": 3}, {"mae": 0.5}, now, now)
    rows = readers.read_parquet(spark, path).orderBy("run_id").collect()
    assert [r.run_id for r in rows] == ["r0", "r1"] and rows[0].params == {"depth": "3"} and rows[0].metrics["mae"] == 0.5


def test_top_json_is_one_ranked_file(spark):
    path = run_dir(spark, "top")
    writers.write_top_json(spark.range(100), path, [F.desc("id")], 5)
    out = spark.read.json(path)
    assert sorted(r.id for r in out.collect()) == [95, 96, 97, 98, 99] and len(out.inputFiles()) == 1


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert run_dir(spark, "x") != run_dir(spark, "x")
