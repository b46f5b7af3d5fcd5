import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewheel.functions import binning as B
from tidewheel.functions import calendar as C
from tidewheel.functions import schema as S


def test_calendar_edges(spark):
    days = [date(2020, 12, 31), date(2021, 1, 1), date(2020, 2, 29), date(2021, 1, 2), date(2021, 1, 3), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    out = {r.i: r for r in C.with_calendar(df, "d").collect()}
    assert (out[0].day_of_year, out[0].season, out[0].quarter) == (366, "Winter", 4)
    assert (out[1].day_of_year, out[1].season) == (1, "Winter")
    assert (out[2].day_of_year, out[2].day_of_week, out[2].is_weekend) == (60, 5, 1)
    assert (out[3].is_weekend, out[4].is_weekend, out[4].day_of_week) == (1, 1, 6)
    assert out[5].season is None
    assert math.isclose(out[0].month_sin, 0, abs_tol=1e-12) and math.isclose(out[0].month_cos, 1)
    sunday = C.with_calendar(df, "d", origin="sunday", null_as_null=False).collect()
    assert {r.i: r.day_of_week for r in sunday}[4] == 1
    assert {r.i: r.season for r in sunday}[5] == "Autumn"


def test_origin_is_checked():
    with pytest.raises(ValueError):
        C.day_of_week(None, "tuesday")


def test_class_limits(spark):
    values = [-1.0, 0.0, 2499.99, 2500.0, 5000.0, 5000.01, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    v = F.col("v")
    out = df.select(
        "i", B.threshold_label(v).alias("a"), B.threshold_code(v, null_as_null=False).alias("b"), B.cut_label(v).alias("c")
    ).orderBy("i").collect()
    assert [r.a for r in out] == ["Low", "Low", "Low", "Medium", "High", "High", None]
    assert [r.b for r in out] == [0, 0, 0, 1, 2, 2, 2]
    assert [r.c for r in out] == [None, None, "Low", "Low", "Medium", "High", None]


def test_year_features(spark):
    df = spark.createDataFrame([(1999, 0.0), (2000, math.e - 1)], "year int, x double")
    out = C.with_year_features(df, "year", "x").orderBy("year").collect()
    assert [(r.decade, r.years_from_1990) for r in out] == [(1990, 9), (2000, 10)]
    assert math.isclose(out[1].log_x, 1)
    assert df.select(C.mid_year(F.col("year")).alias("t")).first().t == datetime(1999, 7, 1)


def test_roles_by_name(spark):
    empty = lambda names: spark.createDataFrame([], ", ".join(f"`{n}` double" for n in names))
    assert S.value_column(empty(["a", "MtCO2 per day", "z"])) == "MtCO2 per day"
    assert S.value_column(empty(["a", "Total Emission", "z"])) == "Total Emission"
    assert S.value_column(empty(["emission_date", "z"])) == "emission_date"
    assert S.value_column(empty(["emission_date", "z"]), training=True) == "z"
    assert S.value_column(empty(["a", "my mtco2"]), training=True) == "my mtco2"
    assert S.value_column(empty(["a", "b"])) == "b"
    assert S.time_column(empty(["x", "Start Date"])) == "Start Date"
    assert S.time_column(empty(["x", "timestamp"])) == "timestamp"
    assert S.time_column(empty(["x"])) is None
    assert S.label_column(empty(["x", "Risk Level", "y"])) == "Risk Level"
    assert S.label_column(empty(["x", "y"])) == "y"
    assert S.available(empty(["a", "b"]), ["b", "q", "a"]) == ["b", "a"]


def test_normalise_tolerates_bad_text(spark):
    df = spark.createDataFrame(
        [("2020-01-01", "1.5"), ("2020-01-02T00:00:00", "oops"), ("not a day", "3")], "`the date` string, emission string"
    )
    out = S.normalise(df, "day", "value").select("day", "value").collect()
    assert [tuple(r) for r in out] == [(date(2020, 1, 1), 1.5), (date(2020, 1, 2), None), (None, 3.0)]


def test_names(spark):
    assert S.clean_name("CO2 Emissions(g/km)") == "CO2_Emissionsg_per_km"
    assert S.clean_name("Fuel Consumption City (L/100 km)") == "Fuel_Consumption_City_L_per_100_km"
    with pytest.raises(ValueError):
        S.sanitise_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_provenance_and_pack(spark):
    df = S.with_provenance(S.pack(spark.createDataFrame([("x", "y")], "c string, s string"), country="c", sector="s"), "src")
    row = df.first()
    assert row.metadata.country == "x" and row.metadata.sector == "y" and row.data_source == "src" and row.loaded_at
