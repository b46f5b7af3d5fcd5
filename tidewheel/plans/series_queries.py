"""Registered queries: calendar, window and split operators on the daily panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.calendar import cycle, day_of_week, is_weekend, season, with_calendar
from tidewheel.operators.metrics import error_spread, errors_as_map, group_errors
from tidewheel.operators.rollup import top
from tidewheel.operators.scale import (
    fit_min_max, fit_standard, min_max_inverse, scale_min_max, scale_standard,
)
from tidewheel.operators.series import (
    cumulative, lag, over_series, past_mean, pct_change, rolling_mean, sequences, trailing_features,
)
from tidewheel.operators.split import (
    TRAIN_VALIDATION_TEST, chronological_split, expanding_folds, global_split, hash_split, stratified_split,
)
from tidewheel.functions.binning import threshold_code
from tidewheel.models.features import FEATURES, panel_features
from tidewheel.models.forecast import baseline_forecasts, baseline_metrics
from tidewheel.plans.catalog import query
from tidewheel.plans.adapters import DAILY, EVENTS, INDIVIDUALS, PANEL, individuals, panel
from tidewheel.sources.readers import table


ID = ["country", "sector", "day"]


def day() -> Column:
    return F.col("emission_date").cast("string").alias("day")


SQL_ID = "country, sector, CAST(emission_date AS VARCHAR) AS day"
SERIES = "PARTITION BY country, sector ORDER BY emission_date"


def r6(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


def frame(before: int, upto: str = "CURRENT ROW") -> str:
    return f"({SERIES} ROWS BETWEEN {before} PRECEDING AND {upto})"


# ---------------------------------------------------------------- calendar


@query(
    "panel_calendar",
    f"""WITH {PANEL} SELECT {SQL_ID}, CAST(year(emission_date) AS INTEGER) AS year,
    CAST(month(emission_date) AS INTEGER) AS month, CAST(isodow(emission_date) - 1 AS INTEGER) AS day_of_week,
    CAST(dayofweek(emission_date) + 1 AS INTEGER) AS sunday_first, CAST(dayofyear(emission_date) AS INTEGER) AS day_of_year,
    CAST(quarter(emission_date) AS INTEGER) AS quarter,
    CAST(CASE WHEN isodow(emission_date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend FROM panel""",
)
def panel_calendar(spark, folder):
    df = with_calendar(panel(spark, folder), "emission_date")
    names = ("year", "month", "day_of_week", "day_of_year", "quarter", "is_weekend")
    return df.select("country", "sector", day(), *names, day_of_week(F.col("emission_date"), "sunday").alias("sunday_first"))


@query(
    "panel_season",
    f"""WITH {PANEL} SELECT {SQL_ID}, CASE WHEN month(emission_date) IN (12, 1, 2) THEN 'Winter'
    WHEN month(emission_date) IN (3, 4, 5) THEN 'Spring' WHEN month(emission_date) IN (6, 7, 8) THEN 'Summer'
    ELSE 'Autumn' END AS season FROM panel""",
)
def panel_season(spark, folder):
    return panel(spark, folder).select("country", "sector", day(), season(F.month("emission_date")).alias("season"))


@query(
    "panel_cyclical",
    f"""WITH {PANEL} SELECT {SQL_ID}, ROUND(SIN(2 * PI() * month(emission_date) / 12), 6) + 0.0 AS month_sin,
    ROUND(COS(2 * PI() * month(emission_date) / 12), 6) + 0.0 AS month_cos,
    ROUND(SIN(2 * PI() * (isodow(emission_date) - 1) / 7), 6) + 0.0 AS dow_sin FROM panel""",
)
def panel_cyclical(spark, folder):
    month_sin, month_cos = cycle(F.month("emission_date"), 12)
    dow_sin, _ = cycle(F.weekday("emission_date"), 7)
    named = {"month_sin": month_sin, "month_cos": month_cos, "dow_sin": dow_sin}
    # adding zero turns a negative zero into a plain one
    return panel(spark, folder).select(
        "country", "sector", day(), *((F.round(c, 6) + 0.0).alias(n) for n, c in named.items())
    )


# ---------------------------------------------------------------- windows


@query(
    "panel_rolling",
    f"""WITH {PANEL} SELECT {SQL_ID}, ROUND(AVG(mtco2_per_day) OVER {frame(6)}, 6) AS rolling_avg_7d,
    ROUND(AVG(mtco2_per_day) OVER {frame(29)}, 6) AS rolling_avg_30d FROM panel""",
)
def panel_rolling(spark, folder):
    columns = {f"rolling_avg_{n}d": rolling_mean("mtco2_per_day", n) for n in (7, 30)}
    return over_series(panel(spark, folder), DAILY, columns).select("country", "sector", day(), *r6(*columns))


@query(
    "panel_rolling_strict",
    f"""WITH {PANEL} SELECT {SQL_ID},
    CASE WHEN COUNT(*) OVER {frame(6)} = 7 THEN ROUND(AVG(mtco2_per_day) OVER {frame(6)}, 6) END AS rolling_7d,
    CASE WHEN COUNT(*) OVER {frame(29)} = 30 THEN ROUND(AVG(mtco2_per_day) OVER {frame(29)}, 6) END AS rolling_30d
    FROM panel""",
)
def panel_rolling_strict(spark, folder):
    columns = {f"rolling_{n}d": rolling_mean("mtco2_per_day", n, strict=True) for n in (7, 30)}
    return over_series(panel(spark, folder), DAILY, columns).select("country", "sector", day(), *r6(*columns))


@query(
    "panel_rolling_leakfree",
    f"""WITH {PANEL} SELECT {SQL_ID},
    ROUND(AVG(mtco2_per_day) OVER {frame(7, '1 PRECEDING')}, 6) AS rolling_avg_7d,
    ROUND(AVG(mtco2_per_day) OVER {frame(30, '1 PRECEDING')}, 6) AS rolling_avg_30d FROM panel""",
)
def panel_rolling_leakfree(spark, folder):
    columns = {f"rolling_avg_{n}d": past_mean("mtco2_per_day", n) for n in (7, 30)}
    return over_series(panel(spark, folder), DAILY, columns).select("country", "sector", day(), *r6(*columns))


@query(
    "panel_lags",
    f"""WITH {PANEL} SELECT {SQL_ID}, {", ".join(
        f"LAG(mtco2_per_day, {n}) OVER ({SERIES}) AS lag_{n}d" for n in (1, 7, 30))} FROM panel""",
)
def panel_lags(spark, folder):
    columns = {f"lag_{n}d": lag("mtco2_per_day", n) for n in (1, 7, 30)}
    return over_series(panel(spark, folder), DAILY, columns).select("country", "sector", day(), *columns)


@query(
    "panel_pct_change",
    f"""WITH {PANEL}, lagged AS (SELECT *, LAG(mtco2_per_day) OVER ({SERIES}) AS l FROM panel)
    SELECT {SQL_ID}, ROUND((mtco2_per_day - l) / NULLIF(l, 0) * 100, 6) AS pct_change FROM lagged""",
)
def panel_pct_change(spark, folder):
    out = over_series(panel(spark, folder), DAILY, {"pct_change": pct_change("mtco2_per_day")})
    return out.select("country", "sector", day(), *r6("pct_change"))


FEATURES_SQL = f"""{PANEL}, codes AS (
  SELECT *, CAST(DENSE_RANK() OVER (ORDER BY country) - 1 AS BIGINT) AS country_encoded,
         CAST(DENSE_RANK() OVER (ORDER BY sector) - 1 AS BIGINT) AS sector_encoded FROM panel),
featured AS (
  SELECT *, CAST(year(emission_date) AS INTEGER) AS year, CAST(month(emission_date) AS INTEGER) AS month,
    CAST(isodow(emission_date) - 1 AS INTEGER) AS day_of_week, CAST(quarter(emission_date) AS INTEGER) AS quarter,
    CAST(CASE WHEN isodow(emission_date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    ROUND(SIN(2 * PI() * month(emission_date) / 12), 6) + 0.0 AS month_sin,
    ROUND(COS(2 * PI() * month(emission_date) / 12), 6) + 0.0 AS month_cos,
    {", ".join(f"LAG(mtco2_per_day, {n}) OVER ({SERIES}) AS lag_{n}d" for n in (1, 7, 30))},
    ROUND(AVG(mtco2_per_day) OVER {frame(7, '1 PRECEDING')}, 6) AS rolling_avg_7d,
    ROUND(AVG(mtco2_per_day) OVER {frame(30, '1 PRECEDING')}, 6) AS rolling_avg_30d
  FROM codes)"""


@query(
    "panel_features_full",
    f"WITH {FEATURES_SQL} SELECT {SQL_ID}, mtco2_per_day, {', '.join(FEATURES)} FROM featured WHERE lag_7d IS NOT NULL",
)
def panel_features_full(spark, folder):
    rounded = {"month_sin", "month_cos", "rolling_avg_7d", "rolling_avg_30d"}
    return panel_features(panel(spark, folder), DAILY).select(
        "country", "sector", day(), "mtco2_per_day",
        *((F.round(c, 6) + 0.0).alias(c) if c in rounded else F.col(c) for c in FEATURES),
    )


@query(
    "top_keys_avg",
    f"""WITH {PANEL}, lagged AS (SELECT *, LAG(mtco2_per_day, 30) OVER ({SERIES}) AS lag_30d FROM panel)
    SELECT country, ROUND(AVG(mtco2_per_day), 3) AS avg_daily_mtco2 FROM lagged WHERE lag_30d IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_keys_avg(spark, folder):
    """Flagship: scan, calendar, one window pass, null-lag filter, aggregate, top ten."""
    featured = trailing_features(
        with_calendar(panel(spark, folder), "emission_date"), DAILY, leak_free=False, change=True
    )
    means = (
        featured.dropna(subset=["lag_7d", "lag_30d"])
        .groupBy("country")
        .agg(F.round(F.avg("mtco2_per_day"), 3).alias("avg_daily_mtco2"))
    )
    return top(means, 10, "avg_daily_mtco2", ["country"])


@query(
    "cumulative_avg",
    f"""WITH {PANEL}, c AS (SELECT *, ROUND(SUM(mtco2_per_day) OVER ({SERIES} ROWS UNBOUNDED PRECEDING), 2) AS cumulative_sum,
      COUNT(*) OVER ({SERIES} ROWS UNBOUNDED PRECEDING) AS cumulative_count FROM panel)
    SELECT {SQL_ID}, cumulative_sum, cumulative_count, cumulative_sum / cumulative_count AS cumulative_avg FROM c""",
)
def cumulative_avg(spark, folder):
    return cumulative(panel(spark, folder), DAILY).select("country", "sector", day(), *_cumulative())


def _cumulative() -> list[Column]:
    total = F.round("cumulative_sum", 2)
    return [
        total.alias("cumulative_sum"), "cumulative_count", (total / F.col("cumulative_count")).alias("cumulative_avg")
    ]


EVENT_SERIES = "PARTITION BY event_type ORDER BY event_id"


EVENT_FEATURES = f"""SELECT event_id, event_type, {", ".join(
        f"LAG(value, {n}) OVER ({EVENT_SERIES}) AS lag_{n}d" for n in (1, 7, 30))},
    ROUND(AVG(value) OVER ({EVENT_SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS rolling_avg_7d,
    ROUND(AVG(value) OVER ({EVENT_SERIES} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 6) AS rolling_avg_30d
    FROM events"""


def _event_features(spark: SparkSession, folder: str, **options: int) -> DataFrame:
    events = table(spark, folder, "events").select("event_type", "event_id", "value")
    out = trailing_features(events, EVENTS, **options)
    return out.select("event_id", "event_type", "lag_1d", "lag_7d", "lag_30d", *r6("rolling_avg_7d", "rolling_avg_30d"))


@query("event_features_split", EVENT_FEATURES)
def event_features_split(spark, folder):
    """Row-level series of any length: cut into overlapping pieces instead of one task per event type."""
    return _event_features(spark, folder)


@query("event_features_pieces", EVENT_FEATURES)
def event_features_pieces(spark, folder):
    """The same with pieces so short that every series spans several at any size of table."""
    return _event_features(spark, folder, piece_rows=100)


@query(
    "event_cumulative_avg",
    f"""WITH c AS (SELECT event_id, event_type, ROUND(SUM(value) OVER ({EVENT_SERIES} ROWS UNBOUNDED PRECEDING), 2) AS cumulative_sum,
      COUNT(*) OVER ({EVENT_SERIES} ROWS UNBOUNDED PRECEDING) AS cumulative_count FROM events)
    SELECT *, cumulative_sum / cumulative_count AS cumulative_avg FROM c""",
)
def event_cumulative_avg(spark, folder):
    events = table(spark, folder, "events").select("event_type", "event_id", "value")
    return cumulative(events, EVENTS).select("event_id", "event_type", *_cumulative())


@query(
    "event_chrono_split",
    f"""WITH p AS (SELECT event_type, event_id, value, ROW_NUMBER() OVER ({EVENT_SERIES}) - 1 AS i,
      COUNT(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_type, CASE WHEN i < FLOOR(n * 0.8) THEN 'train' WHEN i < FLOOR(n * 0.9) THEN 'validation' ELSE 'test' END AS split,
    COUNT(*) AS n, MIN(event_id) AS first_id, MAX(event_id) AS last_id, ROUND(SUM(value), 2) AS total FROM p GROUP BY 1, 2""",
)
def event_chrono_split(spark, folder):
    events = table(spark, folder, "events").select("event_type", "event_id", "value")
    return (
        chronological_split(events, EVENTS, TRAIN_VALIDATION_TEST)
        .groupBy("event_type", "split")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
            F.round(F.sum("value"), 2).alias("total"),
        )
    )


# ---------------------------------------------------------------- sequences, splits, scalers


@query(
    "sequences_30_7",
    f"""WITH {PANEL}, s AS (SELECT *,
      LIST(mtco2_per_day) OVER {frame(29)} AS i,
      LIST(mtco2_per_day) OVER ({SERIES} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS t FROM panel)
    SELECT {SQL_ID}, CAST(LEN(i) AS INTEGER) AS n_inputs, i[1] AS first_input, i[30] AS last_input,
    ROUND(LIST_SUM(i), 2) AS sum_inputs, t[1] AS first_target, t[7] AS last_target, ROUND(LIST_SUM(t), 2) AS sum_targets
    FROM s WHERE LEN(i) = 30 AND LEN(t) = 7""",
)
def sequences_30_7(spark, folder):
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 2)
    return sequences(panel(spark, folder), DAILY).select(
        "country", "sector", day(),
        F.size("inputs").alias("n_inputs"), F.get("inputs", F.lit(0)).alias("first_input"),
        F.get("inputs", F.lit(29)).alias("last_input"), total("inputs").alias("sum_inputs"),
        F.get("targets", F.lit(0)).alias("first_target"), F.get("targets", F.lit(6)).alias("last_target"),
        total("targets").alias("sum_targets"),
    )


def _split_summary(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by, "split").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("emission_date").cast("string").alias("first_day"),
        F.max("emission_date").cast("string").alias("last_day"),
        F.round(F.sum("mtco2_per_day"), 2).alias("total"),
    )


SPLIT_SQL = """COUNT(*) AS n, CAST(MIN(emission_date) AS VARCHAR) AS first_day,
    CAST(MAX(emission_date) AS VARCHAR) AS last_day, ROUND(SUM(mtco2_per_day), 2) AS total"""
PLACED = f"""{PANEL}, placed AS (SELECT *, ROW_NUMBER() OVER ({SERIES}) - 1 AS i,
  COUNT(*) OVER (PARTITION BY country, sector) AS n,
  ROW_NUMBER() OVER (ORDER BY country, sector, emission_date) - 1 AS gi, COUNT(*) OVER () AS gn FROM panel)"""


@query(
    "chrono_split",
    f"""WITH {PLACED} SELECT country, sector, CASE WHEN i < FLOOR(n * 0.8) THEN 'train' ELSE 'test' END AS split, {SPLIT_SQL}
    FROM placed GROUP BY 1, 2, 3""",
)
def chrono_split(spark, folder):
    return _split_summary(chronological_split(panel(spark, folder), DAILY), "country", "sector")


@query(
    "chrono_split3",
    f"""WITH {PLACED} SELECT country, sector, CASE WHEN i < FLOOR(n * 0.8) THEN 'train'
    WHEN i < FLOOR(n * 0.9) THEN 'validation' ELSE 'test' END AS split, {SPLIT_SQL} FROM placed GROUP BY 1, 2, 3""",
)
def chrono_split3(spark, folder):
    return _split_summary(chronological_split(panel(spark, folder), DAILY, TRAIN_VALIDATION_TEST), "country", "sector")


@query(
    "global_split",
    f"""WITH {PLACED} SELECT country, sector, CASE WHEN gi < FLOOR(gn * 0.8) THEN 'train' ELSE 'test' END AS split, {SPLIT_SQL}
    FROM placed GROUP BY 1, 2, 3""",
)
def global_split_query(spark, folder):
    return _split_summary(global_split(panel(spark, folder), DAILY), "country", "sector")


@query(
    "stratified_counts",
    f"""WITH {INDIVIDUALS}, c AS (SELECT CASE WHEN CarbonEmission < 2500 THEN 0 WHEN CarbonEmission < 5000 THEN 1 ELSE 2 END AS label,
      COUNT(*) AS n FROM individuals GROUP BY 1)
    SELECT CAST(label AS INTEGER) AS label, 'train' AS split, CAST(FLOOR(n * 0.8) AS BIGINT) AS n FROM c
    UNION ALL SELECT CAST(label AS INTEGER), 'test', n - CAST(FLOOR(n * 0.8) AS BIGINT) FROM c""",
)
def stratified_counts(spark, folder):
    labelled = individuals(spark, folder).withColumn("label", threshold_code(F.col("CarbonEmission")))
    return stratified_split(labelled, "label", ["id"]).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "hash_split",
    f"""WITH {PANEL} SELECT COUNT(*) AS n, ROUND(SUM(mtco2_per_day), 2) AS total, 2 AS parts, TRUE AS shares_hold FROM panel""",
)
def hash_split_query(spark, folder):
    """The parts cover all rows once, and their shares lie within four standard errors of those asked for."""
    parts = hash_split(panel(spark, folder), ["country", "sector", "emission_date"])
    train = F.count_if(F.col("split") == "train")
    n = F.count(F.lit(1))
    return parts.agg(
        n.alias("n"), F.round(F.sum("mtco2_per_day"), 2).alias("total"), F.count_distinct("split").cast("int").alias("parts"),
        (F.abs(train - 0.8 * n) <= 4 * F.sqrt(0.8 * 0.2 * n)).alias("shares_hold"),
    )


@query(
    "expanding_folds",
    f"""WITH {PLACED} SELECT country, sector, CAST(FLOOR(i * 6 / n) AS INTEGER) AS fold, COUNT(*) AS n,
    CAST(MIN(emission_date) AS VARCHAR) AS first_day FROM placed GROUP BY 1, 2, 3""",
)
def expanding_folds_query(spark, folder):
    return (
        expanding_folds(panel(spark, folder), DAILY)
        .groupBy("country", "sector", "fold")
        .agg(F.count(F.lit(1)).alias("n"), F.min("emission_date").cast("string").alias("first_day"))
    )


TRAIN = f"{PLACED}, train AS (SELECT * FROM placed WHERE i < FLOOR(n * 0.8))"


@query(
    "minmax_scaled",
    f"""WITH {TRAIN}, e AS (SELECT MIN(mtco2_per_day) AS lo, MAX(mtco2_per_day) AS hi FROM train)
    SELECT {SQL_ID}, ROUND((mtco2_per_day - lo) / (hi - lo), 6) AS scaled FROM panel, e""",
)
def minmax_scaled(spark, folder):
    df = panel(spark, folder)
    train = chronological_split(df, DAILY).where(F.col("split") == "train")
    out = scale_min_max(df, fit_min_max(train, ["mtco2_per_day"]), ["mtco2_per_day"])
    return out.select("country", "sector", day(), F.round("mtco2_per_day", 6).alias("scaled"))


@query(
    "minmax_roundtrip",
    f"""WITH {TRAIN}, e AS (SELECT country, sector, MIN(mtco2_per_day) AS lo, MAX(mtco2_per_day) AS hi FROM train GROUP BY 1, 2)
    SELECT country, sector, CAST(emission_date AS VARCHAR) AS day, ROUND((mtco2_per_day - lo) / (hi - lo), 6) AS scaled,
    mtco2_per_day AS restored FROM panel JOIN e USING (country, sector)""",
)
def minmax_roundtrip(spark, folder):
    """Scaled per series with the training range, and back."""
    df, by = panel(spark, folder), ["country", "sector"]
    train = chronological_split(df, DAILY).where(F.col("split") == "train")
    out = scale_min_max(df, fit_min_max(train, ["mtco2_per_day"], by), ["mtco2_per_day"], by)
    back = min_max_inverse(F.col("mtco2_per_day"), F.col("mtco2_per_day_min"), F.col("mtco2_per_day_max"))
    return out.select(
        "country", "sector", day(), F.round("mtco2_per_day", 6).alias("scaled"), F.round(back, 2).alias("restored")
    )


@query(
    "standardized",
    f"""WITH {TRAIN}, e AS (SELECT AVG(mtco2_per_day) AS m, STDDEV_POP(mtco2_per_day) AS s FROM train)
    SELECT {SQL_ID}, ROUND((mtco2_per_day - m) / s, 6) AS scaled FROM panel, e""",
)
def standardized(spark, folder):
    df = panel(spark, folder)
    train = chronological_split(df, DAILY).where(F.col("split") == "train")
    out = scale_standard(df, fit_standard(train, ["mtco2_per_day"]), ["mtco2_per_day"])
    return out.select("country", "sector", day(), F.round("mtco2_per_day", 6).alias("scaled"))


# ---------------------------------------------------------------- baselines


BASE = f"""{PANEL}, featured AS (SELECT *, LAG(mtco2_per_day) OVER ({SERIES}) AS naive,
  LAG(mtco2_per_day, 7) OVER ({SERIES}) AS lag_7d,
  AVG(mtco2_per_day) OVER {frame(7, '1 PRECEDING')} AS moving_avg_7d FROM panel),
known AS (SELECT * FROM featured WHERE lag_7d IS NOT NULL),
placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY country, sector, emission_date) - 1 AS gi, COUNT(*) OVER () AS gn FROM known),
test AS (SELECT * FROM placed WHERE gi >= FLOOR(gn * 0.8))"""


def scored_baselines(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline forecasts of the last fifth of the table in (country, sector, date) order."""
    df = baseline_forecasts(
        over_series(panel(spark, folder), DAILY, {"lag_7d": lag("mtco2_per_day", 7)}), DAILY
    ).dropna(subset=["lag_7d", "mtco2_per_day"])
    return global_split(df, DAILY).where(F.col("split") == "test")


def _metric_sql(column: str, name: str) -> str:
    return f"""SELECT '{name}' AS model_type, ROUND(AVG(ABS(mtco2_per_day - {column})), 4) AS mae,
    ROUND(SQRT(AVG(POW(mtco2_per_day - {column}, 2))), 4) AS rmse,
    ROUND(1 - AVG(POW(mtco2_per_day - {column}, 2)) / VAR_POP(mtco2_per_day), 6) AS r2, COUNT(*) AS test_samples FROM test"""


def _rounded_scores() -> list[Column]:
    return [F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), F.col("test_samples")]


@query("baseline_naive", f"WITH {BASE} {_metric_sql('naive', 'Naive_Baseline_Yesterday')}")
def baseline_naive(spark, folder):
    names = {"naive": "Naive_Baseline_Yesterday"}
    return baseline_metrics(scored_baselines(spark, folder), "mtco2_per_day", names).select("model_type", *_rounded_scores())


@query("baseline_ma7", f"WITH {BASE} {_metric_sql('moving_avg_7d', 'Moving_Average_Baseline_7d')}")
def baseline_ma7(spark, folder):
    names = {"moving_avg_7d": "Moving_Average_Baseline_7d"}
    return baseline_metrics(scored_baselines(spark, folder), "mtco2_per_day", names).select("model_type", *_rounded_scores())


@query(
    "sector_errors",
    f"""WITH {BASE} SELECT sector, ROUND(AVG(ABS(mtco2_per_day - moving_avg_7d)), 4) AS mae,
    ROUND(SQRT(AVG(POW(mtco2_per_day - moving_avg_7d, 2))), 4) AS rmse, COUNT(*) AS "count",
    (SELECT ROUND(STDDEV_SAMP(moving_avg_7d - mtco2_per_day), 4) FROM test) AS error_std FROM test GROUP BY 1""",
)
def sector_errors(spark, folder):
    scored = scored_baselines(spark, folder)
    spread = scored.agg(F.round(error_spread("mtco2_per_day", "moving_avg_7d"), 4).alias("s")).scalar()
    return group_errors(scored, "mtco2_per_day", "moving_avg_7d", ["sector"]).select(
        "sector", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), "count"
    ).withColumn("error_std", spread)


@query(
    "country_errors_map",
    f"""WITH {BASE}, e AS (SELECT country, ROUND(AVG(ABS(mtco2_per_day - naive)), 4) AS mae, COUNT(*) AS n FROM test GROUP BY 1)
    SELECT COUNT(*) AS groups, CAST(SUM(n) AS BIGINT) AS rows, STRING_AGG(country || '=' || CAST(mae AS VARCHAR), ',' ORDER BY country) AS errors FROM e""",
)
def country_errors_map(spark, folder):
    """Per-country errors folded into one map and read back out of it."""
    errors = group_errors(scored_baselines(spark, folder), "mtco2_per_day", "naive", ["country"])
    folded = errors_as_map(errors.withColumn("mae", F.round("mae", 4)), "country")
    entries = F.map_entries("sector_errors")
    return folded.select(
        F.size("sector_errors").cast("bigint").alias("groups"),
        F.aggregate(entries, F.lit(0).cast("bigint"), lambda a, e: a + e["value"]["count"]).alias("rows"),
        F.array_join(
            F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]["mae"].cast("string"))), ","
        ).alias("errors"),
    )
