"""Registered queries: roll-ups, profiles, labels, codes and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.binning import cut_label, threshold_code, threshold_label
from tidewheel.functions.calendar import mid_year, season, with_year_features
from tidewheel.functions.schema import normalise, pack, sanitise_names
from tidewheel.models.classify import tertile_label
from tidewheel.operators.clean import (
    drop_null, flag_outliers, members, missing_report, not_null, outlier_summary, positive, require_rows,
    slice_or_widen, within,
)
from tidewheel.operators.encode import encode, frequency_codes, index_by_frequency
from tidewheel.operators.lattice import merged, roll_up, states
from tidewheel.operators.metrics import (
    best_regression, class_report, classification_metrics, classification_table, clip_low, paired_t, regression_table,
)
from tidewheel.operators.ordering import positions
from tidewheel.operators.profile import (
    box_plot, correlation, dataset_profile, describe, feature_summary, histogram, key_values, target_correlation,
)
from tidewheel.operators.quantiles import approx_quantiles, exact_quantiles
from tidewheel.operators.rollup import (
    compare_sources, distinct_values, distribution, exceeds_distinct, group_mean, group_profile, keep_top_keys, lookup,
    mean_share, period_compare, summarise, top, two_stage_mean, union_ragged,
)
from tidewheel.operators.series import lag, over_series, rolling_mean
from tidewheel.operators.joins import join_groups
from tidewheel.operators.split import hash_split
from tidewheel.plans.catalog import query
from tidewheel.plans.adapters import (
    DAILY, GAPPY, INDIVIDUALS, INVENTORY, PANEL, VEHICLES, gappy_panel, individuals, inventory, panel, vehicles,
)
from tidewheel.plans.series_queries import BASE, SERIES, SQL_ID, _metric_sql, day, frame, scored_baselines
from tidewheel.models.forecast import baseline_metrics
from tidewheel.sources.readers import table



def rounded(digits: int, *names: str) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


def exact_total(value: str, digits: int) -> Column:
    """Sum of two-decimal amounts that does not depend on the order of the rows, rounded to ``digits``."""
    return F.round(F.sum(F.col(value).cast("decimal(18,2)")), digits).cast("double")


def with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("emission_date"))


# ---------------------------------------------------------------- grouped summaries


@query(
    "annual_total",
    f"""WITH {PANEL} SELECT CAST(year(emission_date) AS INTEGER) AS year, CAST(ROUND(SUM(CAST(mtco2_per_day AS DECIMAL(18, 2))), 1) AS DOUBLE) AS total_daily_mtco2
    FROM panel GROUP BY 1 ORDER BY 1""",
)
def annual_total(spark, folder):
    return (
        with_year(panel(spark, folder))
        .groupBy("year")
        .agg(exact_total("mtco2_per_day", 1).alias("total_daily_mtco2"))
        .orderBy("year")
    )


@query(
    "sector_profile",
    f"""WITH {PANEL} SELECT sector, ROUND(AVG(mtco2_per_day), 3) AS avg_daily_mtco2, CAST(ROUND(SUM(CAST(mtco2_per_day AS DECIMAL(18, 2))), 1) AS DOUBLE) AS total_mtco2
    FROM panel GROUP BY 1""",
)
def sector_profile(spark, folder):
    return (
        panel(spark, folder)
        .groupBy("sector")
        .agg(F.round(F.avg("mtco2_per_day"), 3).alias("avg_daily_mtco2"), exact_total("mtco2_per_day", 1).alias("total_mtco2"))
        .orderBy(F.desc("avg_daily_mtco2"))
    )


@query(
    "period_compare",
    f"""WITH {PANEL}, y AS (SELECT sector, CAST(year(emission_date) AS INTEGER) AS year, mtco2_per_day AS v FROM panel
      WHERE year(emission_date) IN (1999, 2000))
    SELECT year, sector, ROUND(AVG(v), 3) AS avg_daily_mtco2 FROM y GROUP BY 1, 2""",
)
def period_compare_long(spark, folder):
    chosen = members(with_year(panel(spark, folder)), "year", (1999, 2000))
    return group_mean(chosen, ["year", "sector"], "mtco2_per_day", "avg_daily_mtco2").orderBy("sector", "year")


@query(
    "period_compare_pivot",
    f"""WITH {PANEL}, a AS (SELECT sector, AVG(CASE WHEN year(emission_date) = 1999 THEN mtco2_per_day END) AS a,
      AVG(CASE WHEN year(emission_date) = 2000 THEN mtco2_per_day END) AS b FROM panel GROUP BY 1)
    SELECT sector, ROUND(a, 3) AS avg_1999, ROUND(b, 3) AS avg_2000, ROUND((b - a) / NULLIF(a, 0) * 100, 6) AS change_pct FROM a""",
)
def period_compare_pivot(spark, folder):
    wide = period_compare(with_year(panel(spark, folder)), ["sector"], "year", (1999, 2000), "mtco2_per_day")
    return wide.select("sector", *rounded(3, "avg_1999", "avg_2000"), *rounded(6, "change_pct"))


@query(
    "season_avg",
    f"""WITH {PANEL} SELECT CASE WHEN month(emission_date) IN (12, 1, 2) THEN 'Winter' WHEN month(emission_date) IN (3, 4, 5)
    THEN 'Spring' WHEN month(emission_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
    ROUND(AVG(mtco2_per_day), 3) AS avg_emission FROM panel GROUP BY 1""",
)
def season_avg(spark, folder):
    seasonal = panel(spark, folder).withColumn("season", season(F.month("emission_date")))
    return group_mean(seasonal, ["season"], "mtco2_per_day", "avg_emission").orderBy("season")


@query(
    "key_stats",
    f"""WITH {PANEL} SELECT country, ROUND(AVG(mtco2_per_day), 4) AS avg_value, ROUND(SUM(mtco2_per_day), 2) AS total_value,
    COUNT(*) AS record_count FROM panel GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def key_stats(spark, folder):
    return top(group_profile(panel(spark, folder), ["country"], "mtco2_per_day"), 20, "avg_value", ["country"])


@query(
    "inventory_sector_top5",
    f"""WITH {INVENTORY} SELECT sector, ROUND(AVG(emission_mtco2), 2) AS avg_emission_mt FROM inventory
    WHERE emission_mtco2 > 0 AND year BETWEEN 1990 AND 2024 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
)
def inventory_sector_top5(spark, folder):
    means = group_mean(clean_inventory(spark, folder), ["sector"], "emission_mtco2", "avg_emission_mt", 2)
    return top(means, 5, "avg_emission_mt", ["sector"])


@query(
    "class_distribution",
    f"""WITH {INDIVIDUALS}, c AS (SELECT CASE WHEN CarbonEmission < 2500 THEN 'Low' WHEN CarbonEmission < 5000 THEN 'Medium'
      ELSE 'High' END AS emission_class FROM individuals)
    SELECT emission_class, COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM c), 6) AS pct FROM c GROUP BY 1""",
)
def class_distribution(spark, folder):
    labelled = individuals(spark, folder).withColumn("emission_class", threshold_label(F.col("CarbonEmission")))
    return distribution(labelled, "emission_class").select("emission_class", "n", *rounded(6, "pct"))


CLEAN_VEHICLES = f"{VEHICLES}, clean AS (SELECT * FROM vehicles WHERE \"CO2_Emissionsg_per_km\" > 0 AND \"CO2_Emissionsg_per_km\" < 1000)"


def clean_vehicles(spark: SparkSession, folder: str) -> DataFrame:
    named = sanitise_names(vehicles(spark, folder))
    return within(named, "CO2_Emissionsg_per_km", 0, 1000, closed=False)


@query(
    "fuel_profile",
    f"""WITH {CLEAN_VEHICLES} SELECT "Fuel_Type", ROUND(AVG("CO2_Emissionsg_per_km"), 1) AS avg_co2_g_per_km,
    COUNT(*) AS vehicle_count FROM clean GROUP BY 1""",
)
def fuel_profile(spark, folder):
    return (
        clean_vehicles(spark, folder)
        .groupBy("Fuel_Type")
        .agg(F.round(F.avg("CO2_Emissionsg_per_km"), 1).alias("avg_co2_g_per_km"), F.count(F.lit(1)).alias("vehicle_count"))
        .orderBy("avg_co2_g_per_km")
    )


@query(
    "monthly_two_stage",
    f"""WITH {PANEL}, d AS (SELECT country, emission_date, AVG(mtco2_per_day) AS m FROM panel GROUP BY 1, 2)
    SELECT country, strftime(emission_date, '%Y-%m-01') AS month, ROUND(AVG(m), 7) AS avg_value FROM d GROUP BY 1, 2""",
)
def monthly_two_stage(spark, folder):
    out = two_stage_mean(panel(spark, folder), "country", "emission_date", "mtco2_per_day")
    return out.select("country", F.col("month").cast("string").alias("month"), *rounded(7, "avg_value"))


@query(
    "sector_share",
    f"""WITH {PANEL}, m AS (SELECT sector, AVG(mtco2_per_day) AS a FROM panel GROUP BY 1)
    SELECT sector, ROUND(a, 3) AS avg_value, ROUND(a * 100 / SUM(a) OVER (), 6) AS share_pct FROM m""",
)
def sector_share(spark, folder):
    out = mean_share(panel(spark, folder), "sector", "mtco2_per_day")
    return out.select("sector", *rounded(3, "avg_value"), *rounded(6, "share_pct"))


@query(
    "dow_profile",
    f"""WITH {PANEL} SELECT CAST(isodow(emission_date) - 1 AS INTEGER) AS day_of_week, ROUND(AVG(mtco2_per_day), 3) AS avg_value,
    CAST(CASE WHEN isodow(emission_date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend FROM panel GROUP BY 1, 3""",
)
def dow_profile(spark, folder):
    days = panel(spark, folder).withColumn("day_of_week", F.weekday("emission_date"))
    return group_mean(days, ["day_of_week"], "mtco2_per_day", "avg_value").withColumn(
        "is_weekend", (F.col("day_of_week") >= 5).cast("int")
    )


@query(
    "month_profile",
    f"""WITH {PANEL} SELECT CAST(month(emission_date) AS INTEGER) AS month, ROUND(AVG(mtco2_per_day), 3) AS avg_value FROM panel GROUP BY 1""",
)
def month_profile(spark, folder):
    months = panel(spark, folder).withColumn("month", F.month("emission_date"))
    return group_mean(months, ["month"], "mtco2_per_day", "avg_value")


@query(
    "topk_yearly",
    f"""WITH {INVENTORY}, t AS (SELECT country_code, ROUND(SUM(emission_mtco2), 2) AS s FROM inventory GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
    SELECT year, country_code, ROUND(SUM(emission_mtco2), 6) AS total FROM inventory
    WHERE country_code IN (SELECT country_code FROM t) GROUP BY 1, 2""",
)
def topk_yearly(spark, folder):
    return summarise(
        keep_top_keys(inventory(spark, folder), "country_code", "emission_mtco2", 5),
        ["year", "country_code"], 6, total=F.sum("emission_mtco2"),
    )


# ---------------------------------------------------------------- profiles


@query(
    "dataset_profile",
    f"""WITH {PANEL} SELECT COUNT(*) AS rows, CAST(MIN(emission_date) AS VARCHAR) AS first_time,
    CAST(MAX(emission_date) AS VARCHAR) AS last_time, COUNT(DISTINCT country) AS distinct_country,
    COUNT(DISTINCT sector) AS distinct_sector FROM panel""",
)
def dataset_profile_query(spark, folder):
    out = dataset_profile(panel(spark, folder), "emission_date", ["country", "sector"])
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_time", "last_time")})


@query(
    "key_values",
    f"""WITH {PANEL} SELECT 'country' AS key, country AS value, COUNT(*) AS n FROM panel GROUP BY 2
    UNION ALL SELECT 'sector', sector, COUNT(*) FROM panel GROUP BY 2""",
)
def key_values_query(spark, folder):
    return key_values(panel(spark, folder), ["country", "sector"])


@query(
    "missing_report",
    f"""WITH {GAPPY} SELECT 'mtco2_per_day' AS column_name, COUNT(*) - COUNT(mtco2_per_day) AS missing,
    ROUND((COUNT(*) - COUNT(mtco2_per_day)) * 100.0 / COUNT(*), 2) AS missing_pct FROM gappy""",
)
def missing_report_query(spark, folder):
    return missing_report(gappy_panel(spark, folder))


@query(
    "describe_value",
    f"""WITH {GAPPY} SELECT COUNT(mtco2_per_day) AS n, ROUND(AVG(mtco2_per_day), 4) AS mean, ROUND(STDDEV_SAMP(mtco2_per_day), 4) AS std,
    MIN(mtco2_per_day) AS min, ROUND(QUANTILE_CONT(mtco2_per_day, 0.25), 4) AS q25, ROUND(QUANTILE_CONT(mtco2_per_day, 0.5), 4) AS q50,
    ROUND(QUANTILE_CONT(mtco2_per_day, 0.75), 4) AS q75, MAX(mtco2_per_day) AS max FROM gappy""",
)
def describe_value(spark, folder):
    out = describe(gappy_panel(spark, folder), "mtco2_per_day")
    return out.select("n", "min", "max", *rounded(4, "mean", "std", "q25", "q50", "q75"))


SUMMARISED = ("mtco2_per_day", "month", "lag_7")


@query(
    "feature_summary",
    f"""WITH {PANEL}, f AS (SELECT mtco2_per_day, CAST(month(emission_date) AS DOUBLE) AS month,
      LAG(mtco2_per_day, 7) OVER ({SERIES}) AS lag_7 FROM panel)
    {" UNION ALL ".join(f"SELECT '{c}' AS feature, MIN({c}) AS min, MAX({c}) AS max, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_POP({c}), 4) AS std FROM f"
                        for c in SUMMARISED)}""",
)
def feature_summary_query(spark, folder):
    df = over_series(panel(spark, folder), DAILY, {"lag_7": lag("mtco2_per_day", 7)})
    df = df.withColumn("month", F.month("emission_date"))
    return feature_summary(df, SUMMARISED).select("feature", "min", "max", *rounded(4, "mean", "std"))


CORRELATED = ("mtco2_per_day", "lag_1", "lag_7", "rolling_7d", "rolling_30d", "month", "is_weekend")


LAGGED_ROWS = f"""{PANEL}, f AS (SELECT mtco2_per_day, LAG(mtco2_per_day) OVER ({SERIES}) AS lag_1, LAG(mtco2_per_day, 7) OVER ({SERIES}) AS lag_7,
      CASE WHEN COUNT(*) OVER {frame(6)} = 7 THEN AVG(mtco2_per_day) OVER {frame(6)} END AS rolling_7d,
      CASE WHEN COUNT(*) OVER {frame(29)} = 30 THEN AVG(mtco2_per_day) OVER {frame(29)} END AS rolling_30d,
      month(emission_date) AS month, CASE WHEN isodow(emission_date) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM panel),
    k AS (SELECT * FROM f WHERE lag_7 IS NOT NULL AND rolling_30d IS NOT NULL)"""


def correlated_rows(spark: SparkSession, folder: str) -> DataFrame:
    v = "mtco2_per_day"
    columns = {"lag_1": lag(v, 1), "lag_7": lag(v, 7)}
    columns |= {f"rolling_{n}d": rolling_mean(v, n, strict=True) for n in (7, 30)}
    return over_series(panel(spark, folder), DAILY, columns).withColumns(
        {"month": F.month("emission_date"), "is_weekend": (F.weekday("emission_date") >= 5).cast("int")}
    )


@query(
    "corr_matrix",
    f"""WITH {LAGGED_ROWS}
    {" UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(CORR({a}, {b}), 6) + 0.0 AS r FROM k"
                        for a in CORRELATED for b in CORRELATED)}""",
)
def corr_matrix(spark, folder):
    return correlation(correlated_rows(spark, folder), CORRELATED).select("feature_a", "feature_b", (F.round("r", 6) + 0.0).alias("r"))


@query(
    "target_correlation",
    f"""WITH {LAGGED_ROWS}, r AS ({" UNION ALL ".join(
        f"SELECT '{a}' AS feature, CORR({a}, mtco2_per_day) AS r FROM k" for a in CORRELATED[1:])})
    SELECT feature, ROUND(r, 6) + 0.0 AS r, ROUND(ABS(r), 6) AS strength, CAST(ROW_NUMBER() OVER (ORDER BY ABS(r) DESC, feature) AS INTEGER) AS place FROM r""",
)
def target_correlation_query(spark, folder):
    ranked = target_correlation(correlated_rows(spark, folder), "mtco2_per_day", CORRELATED[1:])
    return ranked.select("feature", (F.round("r", 6) + 0.0).alias("r"), F.round("strength", 6).alias("strength"), "place")


@query(
    "histogram",
    f"""WITH {PANEL}, e AS (SELECT MIN(mtco2_per_day) AS lo, MAX(mtco2_per_day) AS hi FROM panel),
    b AS (SELECT CAST(LEAST(FLOOR((mtco2_per_day - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, lo, (hi - lo) / 50 AS w FROM panel, e)
    SELECT bin, ROUND(MIN(lo + bin * w), 4) AS bin_start, COUNT(*) AS n FROM b GROUP BY 1""",
)
def histogram_query(spark, folder):
    return histogram(panel(spark, folder), "mtco2_per_day", 50).select("bin", *rounded(4, "bin_start"), "n")


QUARTILES = """q AS (SELECT country, QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.5) AS median, QUANTILE_CONT(v, 0.75) AS q3
  FROM p GROUP BY 1)"""


@query(
    "boxplot_stats",
    f"""WITH {PANEL}, p AS (SELECT country, mtco2_per_day AS v FROM panel), {QUARTILES},
    b AS (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM p JOIN q USING (country))
    SELECT country, ROUND(MIN(q1), 4) AS q1, ROUND(MIN(median), 4) AS median, ROUND(MIN(q3), 4) AS q3,
    MIN(v) FILTER (inside) AS whisker_low, MAX(v) FILTER (inside) AS whisker_high, COUNT(*) FILTER (NOT inside) AS outliers,
    COUNT(*) AS n FROM b GROUP BY 1""",
)
def boxplot_stats(spark, folder):
    out = box_plot(panel(spark, folder), ["country"], "mtco2_per_day")
    return out.select("country", *rounded(4, "q1", "median", "q3"), "whisker_low", "whisker_high", "outliers", "n")


BOUNDS = """e AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM
  (SELECT QUANTILE_CONT(l_extendedprice, 0.25) AS q1, QUANTILE_CONT(l_extendedprice, 0.75) AS q3 FROM lineitem))"""


@query(
    "iqr_outliers",
    f"""WITH {BOUNDS} SELECT ROUND(MIN(q1), 6) AS q1, ROUND(MIN(q3), 6) AS q3, ROUND(MIN(lower), 6) AS lower, ROUND(MIN(upper), 6) AS upper,
    COUNT(*) FILTER (l_extendedprice < lower OR l_extendedprice > upper) AS outliers,
    ROUND(COUNT(*) FILTER (l_extendedprice < lower OR l_extendedprice > upper) * 100.0 / COUNT(*), 6) AS outlier_pct FROM lineitem, e""",
)
def iqr_outliers(spark, folder):
    """On the raw amounts: exact quartiles of the whole fact table through the distributed sort."""
    out = outlier_summary(table(spark, folder, "lineitem").select("l_extendedprice"), "l_extendedprice")
    return out.select(*rounded(6, "q1", "q3", "lower", "upper"), "outliers", *rounded(6, "outlier_pct"))


@query(
    "outlier_flags",
    f"""WITH {PANEL}, e AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM
      (SELECT QUANTILE_CONT(mtco2_per_day, 0.25) AS q1, QUANTILE_CONT(mtco2_per_day, 0.75) AS q3 FROM panel))
    SELECT {SQL_ID}, mtco2_per_day < lower OR mtco2_per_day > upper AS is_outlier FROM panel, e""",
)
def outlier_flags(spark, folder):
    out = flag_outliers(panel(spark, folder), "mtco2_per_day")
    return out.select("country", "sector", day(), "is_outlier")


@query(
    "exact_quantiles_by_key",
    """SELECT l_returnflag, ROUND(QUANTILE_CONT(l_extendedprice, 0.05), 4) AS p05, ROUND(QUANTILE_CONT(l_extendedprice, 0.5), 4) AS p50,
    ROUND(QUANTILE_CONT(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY 1""",
)
def exact_quantiles_by_key(spark, folder):
    probs = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    rows = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    return exact_quantiles(rows, "l_extendedprice", probs, ["l_returnflag"]).select("l_returnflag", *rounded(4, *probs))


@query(
    "approx_quantiles_by_key",
    """SELECT l_returnflag, COUNT(*) AS n, TRUE AS p05_holds, TRUE AS p50_holds, TRUE AS p95_holds FROM lineitem GROUP BY 1""",
)
def approx_quantiles_by_key(spark, folder):
    """The rank of each estimate lies within 1/accuracy of the rank asked for."""
    rows = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    probs = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    found = approx_quantiles(rows, "l_extendedprice", probs, ["l_returnflag"])
    n, x = F.count(F.lit(1)), F.col("l_extendedprice")
    holds = [
        # ranks of equal values cover a range; a whole rank is allowed for rounding
        ((F.count_if(x < F.col(c)) <= (p + 1e-4) * n + 1) & (F.count_if(x <= F.col(c)) >= (p - 1e-4) * n - 1)).alias(f"{c}_holds")
        for c, p in probs.items()
    ]
    return join_groups(rows, found, ["l_returnflag"]).groupBy("l_returnflag").agg(n.alias("n"), *holds)


# ---------------------------------------------------------------- labels and codes


@query(
    "label_threshold",
    f"""WITH {INDIVIDUALS} SELECT id, CASE WHEN CarbonEmission < 2500 THEN 'Low' WHEN CarbonEmission < 5000 THEN 'Medium' ELSE 'High' END
    AS emission_class, CAST(CASE WHEN CarbonEmission < 2500 THEN 0 WHEN CarbonEmission < 5000 THEN 1 ELSE 2 END AS INTEGER) AS emission_label
    FROM individuals""",
)
def label_threshold(spark, folder):
    v = F.col("CarbonEmission")
    return individuals(spark, folder).select(
        "id", threshold_label(v).alias("emission_class"), threshold_code(v).alias("emission_label")
    )


@query(
    "label_cut",
    f"""WITH {INDIVIDUALS} SELECT id, CASE WHEN CarbonEmission <= 0 THEN NULL WHEN CarbonEmission <= 2500 THEN 'Low'
    WHEN CarbonEmission <= 5000 THEN 'Medium' ELSE 'High' END AS emission_class FROM individuals""",
)
def label_cut(spark, folder):
    return individuals(spark, folder).select("id", cut_label(F.col("CarbonEmission")).alias("emission_class"))


@query(
    "label_qcut",
    f"""WITH {INDIVIDUALS}, e AS (SELECT QUANTILE_CONT(CarbonEmission, 1.0/3) AS a, QUANTILE_CONT(CarbonEmission, 2.0/3) AS b FROM individuals)
    SELECT id, CAST(CASE WHEN CarbonEmission <= a THEN 0 WHEN CarbonEmission <= b THEN 1 ELSE 2 END AS INTEGER) AS label FROM individuals, e""",
)
def label_qcut(spark, folder):
    return tertile_label(individuals(spark, folder), "CarbonEmission").select("id", "label")


@query(
    "label_encode",
    f"""WITH {INDIVIDUALS} SELECT id, CAST(DENSE_RANK() OVER (ORDER BY segment) - 1 AS BIGINT) AS segment_encoded,
    CAST(DENSE_RANK() OVER (ORDER BY home) - 1 AS BIGINT) AS home_encoded FROM individuals""",
)
def label_encode(spark, folder):
    return encode(individuals(spark, folder), ["segment", "home"]).select("id", "segment_encoded", "home_encoded")


@query(
    "index_frequency",
    f"""WITH {INDIVIDUALS}, c AS (SELECT home, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, home) - 1 AS home_idx, COUNT(*) AS n FROM individuals GROUP BY 1)
    SELECT home, home_idx, n FROM c""",
)
def index_frequency(spark, folder):
    df = individuals(spark, folder)
    return df.groupBy("home").agg(F.count(F.lit(1)).alias("n")).join(frequency_codes(df, "home", "home_idx"), "home")


@query(
    "index_unseen",
    f"""WITH {INDIVIDUALS}, t AS (SELECT * FROM individuals WHERE CarbonEmission < -900),
    c AS (SELECT home, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, home) - 1 AS i FROM t GROUP BY 1)
    SELECT id, COALESCE(i, (SELECT COUNT(*) FROM c)) AS home_idx FROM individuals LEFT JOIN c USING (home)""",
)
def index_unseen(spark, folder):
    """Codes learnt on the lowest balances only; every other home gets the extra last code."""
    df = individuals(spark, folder)
    return index_by_frequency(df.where(F.col("CarbonEmission") < -900), df, "home", "home_idx").select("id", "home_idx")


# ---------------------------------------------------------------- cleaning and schema


def clean_inventory(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_null(inventory(spark, folder), ["country_code", "year", "emission_mtco2"])
    return within(positive(kept, "emission_mtco2"), "year", 1990, 2024)


@query(
    "inventory_clean",
    f"""WITH {INVENTORY} SELECT country_code, year, sector, emission_mtco2, per_capita_tco2,
    CAST(year AS VARCHAR) || '-07-01 00:00:00' AS at, country_code AS meta_country, sector AS meta_sector, 'annual_inventory' AS data_source
    FROM inventory WHERE emission_mtco2 > 0 AND year BETWEEN 1990 AND 2024""",
)
def inventory_clean(spark, folder):
    stamped = clean_inventory(spark, folder).withColumns(
        {"timestamp": mid_year(F.col("year")), "data_source": F.lit("annual_inventory")}
    )
    packed = pack(stamped, country="country_code", sector="sector")
    return packed.select(
        "country_code", "year", "sector", "emission_mtco2", "per_capita_tco2",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.col("metadata.country").alias("meta_country"), F.col("metadata.sector").alias("meta_sector"), "data_source",
    )


@query("vehicles_clean", f"WITH {CLEAN_VEHICLES} SELECT * FROM clean")
def vehicles_clean(spark, folder):
    return clean_vehicles(spark, folder)


@query(
    "column_sanitize",
    f"""WITH {VEHICLES} SELECT COUNT(*) AS rows, ROUND(AVG("Engine_SizeL"), 6) AS avg_engine,
    ROUND(MAX("CO2_Emissionsg_per_km"), 1) AS max_co2, COUNT(DISTINCT "Vehicle_Class") AS classes FROM vehicles""",
)
def column_sanitize(spark, folder):
    return sanitise_names(vehicles(spark, folder)).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("Engine_SizeL"), 6).alias("avg_engine"),
        F.round(F.max("CO2_Emissionsg_per_km"), 1).alias("max_co2"), F.count_distinct("Vehicle_Class").alias("classes"),
    )


@query(
    "schema_detect",
    f"""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS mtco2_per_day, 'Orders' AS data_source FROM orders""",
)
def schema_detect(spark, folder):
    """Text columns under foreign names, one of them with unreadable numbers, brought to the panel's names and types."""
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("Reading Date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("MtCO2 per day"),
    )
    found = normalise(raw, "emission_date", "mtco2_per_day")
    return found.select("o_orderkey", day(), "mtco2_per_day", F.lit("Orders").alias("data_source"))


@query(
    "inventory_features",
    f"""WITH {INVENTORY} SELECT country_code, year, sector, CAST(FLOOR(year / 10) * 10 AS INTEGER) AS decade,
    CAST(year - 1990 AS INTEGER) AS years_from_1990, ROUND(LN(1 + emission_mtco2), 6) AS log_emission_mtco2 FROM inventory""",
)
def inventory_features(spark, folder):
    out = with_year_features(drop_null(inventory(spark, folder)), "year", "emission_mtco2")
    return out.select("country_code", "year", "sector", "decade", "years_from_1990", *rounded(6, "log_emission_mtco2"))


@query(
    "key_slice",
    f"""WITH {PANEL} SELECT {SQL_ID}, mtco2_per_day FROM panel WHERE country = 'A' AND sector = 'F' AND mtco2_per_day IS NOT NULL""",
)
def key_slice(spark, folder):
    at = (F.col("country") == "A") & (F.col("sector") == "F")
    chosen = slice_or_widen(panel(spark, folder).where(not_null("mtco2_per_day")), at, F.col("sector") == "F", 30 + 7 + 50)
    return require_rows(chosen, 100).select("country", "sector", day(), "mtco2_per_day")


@query(
    "key_slice_widened",
    f"""WITH {PANEL} SELECT {SQL_ID}, mtco2_per_day FROM panel WHERE sector = 'F'""",
)
def key_slice_widened(spark, folder):
    """The wanted country does not occur, so the slice falls back to all countries of the sector."""
    at = (F.col("country") == "Z") & (F.col("sector") == "F")
    chosen = slice_or_widen(panel(spark, folder), at, F.col("sector") == "F", 87)
    return chosen.select("country", "sector", day(), "mtco2_per_day")


@query(
    "distinct_keys",
    f"""WITH {INDIVIDUALS} SELECT DISTINCT home, (SELECT COUNT(DISTINCT CarbonEmission) > 20 FROM individuals) AS continuous_target FROM individuals""",
)
def distinct_keys(spark, folder):
    df = individuals(spark, folder)
    return distinct_values(df, "home").withColumn("continuous_target", exceeds_distinct(df, "CarbonEmission").scalar())


@query(
    "serving_lookup",
    f"""WITH {INVENTORY} SELECT country_code, sector, year, emission_mtco2 FROM inventory
    WHERE country_code = 'NATION_3' AND sector = '1-URGENT' ORDER BY year DESC LIMIT 3""",
)
def serving_lookup(spark, folder):
    wanted = {"country_code": "NATION_3", "sector": "1-URGENT"}
    return lookup(inventory(spark, folder), wanted, "year", ["country_code"], 3).select(
        "country_code", "sector", "year", "emission_mtco2"
    )


@query(
    "ordered_head",
    f"""WITH {PANEL} SELECT {SQL_ID}, mtco2_per_day FROM panel ORDER BY emission_date, country, sector LIMIT 100""",
)
def ordered_head(spark, folder):
    """The first rows of the replay order."""
    return top(panel(spark, folder), 100, "emission_date", ["country", "sector"], ascending=True).select(
        "country", "sector", day(), "mtco2_per_day"
    )


@query(
    "global_order",
    """SELECT l_orderkey, l_linenumber, ROW_NUMBER() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS position
    FROM lineitem""",
)
def global_order(spark, folder):
    """Position of every fact row in chronological order, without a single-task sort."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return positions(table(spark, folder, "lineitem").select(*order), order).select(
        "l_orderkey", "l_linenumber", "position"
    )


# ---------------------------------------------------------------- joins of sources


SOURCES = """a AS (SELECT n_name AS country, CAST(year(o_orderdate) AS INTEGER) AS year, ROUND(SUM(o_totalprice), 2) AS left_total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
b AS (SELECT n_name AS country, CAST(year(o_orderdate) AS INTEGER) AS year, ROUND(SUM(l_extendedprice), 2) AS right_total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2), j AS (SELECT * FROM a JOIN b USING (country, year))"""


def _sources(spark: SparkSession, folder: str) -> DataFrame:
    # one side is reduced to orders, the other to order lines summed per order, before either meets the customers
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("country"))
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("amount"))
    per_customer = orders.groupBy("o_custkey", "year").agg(F.sum("o_totalprice").alias("amount"))
    lines_per_customer = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "year").agg(F.sum("amount").alias("amount"))
    )
    place = lambda df: df.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    out = compare_sources(place(per_customer), place(lines_per_customer), ["country", "year"], "amount", "amount")
    return out.select("country", "year", *rounded(2, "left_total", "right_total"))


@query(
    "annual_validation",
    f"""WITH {SOURCES} SELECT country, year, left_total, right_total, ROUND((left_total - right_total) / right_total * 100, 6) AS diff_pct FROM j""",
)
def annual_validation(spark, folder):
    return _sources(spark, folder).withColumn(
        "diff_pct", F.round(F.try_divide(F.col("left_total") - F.col("right_total"), F.col("right_total")) * 100, 6)
    )


@query(
    "annual_validation_corr",
    f"WITH {SOURCES} SELECT ROUND(CORR(left_total, right_total), 6) AS r, COUNT(*) AS n FROM j",
)
def annual_validation_corr(spark, folder):
    return _sources(spark, folder).agg(
        F.round(F.corr("left_total", "right_total"), 6).alias("r"), F.count(F.lit(1)).alias("n")
    )


# ---------------------------------------------------------------- model comparison


RULE = f"""{INDIVIDUALS}, scored AS (SELECT
  CASE WHEN CarbonEmission < 2500 THEN 0 WHEN CarbonEmission < 5000 THEN 1 ELSE 2 END AS label,
  CASE WHEN v < 2500 THEN 0 WHEN v < 5000 THEN 1 ELSE 2 END AS predicted
  FROM (SELECT *, CarbonEmission + (order_count - 10) * 150.0 AS v FROM individuals)),
classes AS (SELECT label AS c FROM scored UNION SELECT predicted FROM scored),
counts AS (SELECT c, (SELECT COUNT(*) FROM scored WHERE label = c) AS support, (SELECT COUNT(*) FROM scored WHERE predicted = c) AS guessed,
  (SELECT COUNT(*) FROM scored WHERE label = c AND predicted = c) AS hits FROM classes),
pr AS (SELECT c, support, hits, CASE WHEN guessed = 0 THEN 0.0 ELSE hits / CAST(guessed AS DOUBLE) END AS p,
  CASE WHEN support = 0 THEN 0.0 ELSE hits / CAST(support AS DOUBLE) END AS r FROM counts),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pr)"""


def rule_scored(spark: SparkSession, folder: str) -> DataFrame:
    """True class, and the class a simple rule guesses from the balance shifted by the number of orders."""
    v = F.col("CarbonEmission")
    return individuals(spark, folder).select(
        threshold_code(v).alias("label"), threshold_code(v + (F.col("order_count") - 10) * 150.0).alias("predicted")
    )


@query(
    "class_report",
    f"""WITH {RULE} SELECT CAST(c AS VARCHAR) AS class, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, support FROM f
    UNION ALL SELECT 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6), CAST(SUM(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', ROUND(SUM(p * support) / SUM(support), 6), ROUND(SUM(r * support) / SUM(support), 6),
      ROUND(SUM(f * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM f""",
)
def class_report_query(spark, folder):
    return class_report(rule_scored(spark, folder), "label", "predicted").select(
        "class", *rounded(6, "precision", "recall", "f1"), "support"
    )


@query(
    "classification_table",
    f"""WITH {RULE} SELECT 'Rule Classification' AS model, printf('%.4f', SUM(hits) / SUM(support)) AS accuracy,
    printf('%.4f', SUM(p * support) / SUM(support)) AS precision, printf('%.4f', SUM(r * support) / SUM(support)) AS recall,
    printf('%.4f', SUM(f * support) / SUM(support)) AS f1, CAST(CAST(SUM(support) AS BIGINT) AS VARCHAR) AS samples FROM f""",
)
def classification_table_query(spark, folder):
    scores = classification_metrics(rule_scored(spark, folder), "label", "predicted")
    return classification_table(scores.withColumn("model_type", F.lit("Rule_Classification")))


def model_records(spark: SparkSession, folder: str) -> DataFrame:
    """Ragged metric records: two baselines, one blend of them, and the rule classifier."""
    scored = scored_baselines(spark, folder).withColumn("blend", (F.col("naive") + 6 * F.col("moving_avg_7d")) / 7)
    names = {"naive": "Naive_Baseline_Yesterday", "moving_avg_7d": "Moving_Average_Baseline_7d", "blend": "Blended_Average"}
    regressions = baseline_metrics(scored, "mtco2_per_day", names).withColumn("task", F.lit("CO2 Emission Prediction"))
    classes = classification_metrics(rule_scored(spark, folder), "label", "predicted").withColumn(
        "model_type", F.lit("Rule_Classification")
    )
    return union_ragged([regressions, classes])


MODELS = (("naive", "Naive_Baseline_Yesterday"), ("moving_avg_7d", "Moving_Average_Baseline_7d"), ("blend", "Blended_Average"))
BLEND = BASE.replace("test AS (SELECT *", "test AS (SELECT *, (naive + 6 * moving_avg_7d) / 7 AS blend")


@query(
    "metric_table",
    f"""WITH {BLEND}, m AS ({" UNION ALL ".join(_metric_sql(c, n) for c, n in MODELS)})
    SELECT replace(model_type, '_', ' ') AS model, 'CO2 Emission Prediction' AS task, printf('%.4f', mae) AS mae, printf('%.4f', rmse) AS rmse,
    printf('%.4f', r2) AS r2, CAST(test_samples AS VARCHAR) AS test_samples FROM m""",
)
def metric_table(spark, folder):
    records = model_records(spark, folder).withColumns({c: F.round(c, d) for c, d in (("mae", 4), ("rmse", 4), ("r2", 6))})
    return regression_table(records)


@query(
    "best_model",
    f"""WITH {BLEND}, m AS ({" UNION ALL ".join(_metric_sql(c, n) for c, n in MODELS)})
    SELECT model_type, r2, test_samples FROM m WHERE model_type NOT LIKE '%Baseline%' AND model_type NOT LIKE '%Ablation%' ORDER BY r2 DESC LIMIT 1""",
)
def best_model(spark, folder):
    return best_regression(model_records(spark, folder)).select("model_type", *rounded(6, "r2"), "test_samples")


@query(
    "paired_t_test",
    f"""WITH {BASE}, d AS (SELECT ABS(mtco2_per_day - naive) - ABS(mtco2_per_day - moving_avg_7d) AS d FROM test)
    SELECT ROUND(AVG(d), 4) AS mean_diff, ROUND(STDDEV_SAMP(d), 4) AS std_diff, COUNT(*) AS n,
    ROUND(AVG(d) / (STDDEV_SAMP(d) / SQRT(COUNT(*))), 6) AS t FROM d""",
)
def paired_t_test(spark, folder):
    out = paired_t(scored_baselines(spark, folder), "mtco2_per_day", "naive", "moving_avg_7d")
    return out.select(*rounded(4, "mean_diff", "std_diff"), "n", *rounded(6, "t"))


@query(
    "clipped_prediction",
    f"""WITH {INDIVIDUALS} SELECT id, GREATEST(CarbonEmission, 0.0) AS prediction FROM individuals""",
)
def clipped_prediction(spark, folder):
    return individuals(spark, folder).select("id", clip_low(F.col("CarbonEmission")).alias("prediction"))


@query("hash_split_share", "SELECT COUNT(*) AS n_same, TRUE AS shares_hold FROM orders")
def hash_split_share(spark, folder):
    """A row's part depends on its keys alone, however rows are dealt, and shares are as asked for."""
    rows = table(spark, folder, "orders").select("o_orderkey")
    again = hash_split(rows.repartition(3), ["o_orderkey"], name="again")
    both = hash_split(rows, ["o_orderkey"]).join(again, "o_orderkey")
    n = F.count(F.lit(1))
    return both.where(F.col("split") == F.col("again")).agg(
        n.alias("n_same"), (F.abs(F.count_if(F.col("split") == "train") - 0.8 * n) <= 4 * F.sqrt(0.8 * 0.2 * n)).alias("shares_hold")
    )


_LEVELS = {
    "country": "country", "sector": "sector", "country_sector": "country, sector", "year": "EXTRACT(YEAR FROM emission_date)",
    "month": "EXTRACT(MONTH FROM emission_date)", "all": "",
}
_STATES = """COUNT(*) AS n, ROUND(SUM(mtco2_per_day), 1) AS total, ROUND(AVG(mtco2_per_day), 3) AS mean, ROUND(STDDEV_SAMP(mtco2_per_day), 2) AS std,
    MIN(mtco2_per_day) AS low, MAX(mtco2_per_day) AS high FROM panel"""


@query(
    "lattice_rollups",
    f"WITH {PANEL} " + " UNION ALL ".join(
        f"SELECT '{name}' AS rollup, CONCAT_WS('/', {keys or repr('')}) AS keys, {_STATES}{' GROUP BY ' + keys if keys else ''}" for name, keys in _LEVELS.items()
    ),
)
def lattice_rollups(spark, folder):
    """Six roll-ups from one table of states, to which the last year's days are added as if they had come later."""
    rows, keys = panel(spark, folder), ["country", "sector", "emission_date"]
    late = F.year("emission_date") >= 1998
    lowest = merged([states(rows.where(~late), keys, "mtco2_per_day"), states(rows.where(late), keys, "mtco2_per_day")], keys)
    levels = {
        "country": [F.col("country")], "sector": [F.col("sector")], "country_sector": [F.col("country"), F.col("sector")],
        "year": [F.year("emission_date")], "month": [F.month("emission_date")], "all": [],
    }
    found = roll_up(lowest, levels)
    return found.select(
        "rollup", F.concat_ws("/", "keys").alias("keys"), "n", F.round("total", 1).alias("total"), F.round("mean", 3).alias("mean"), F.round("std", 2).alias("std"), "low", "high"
    )
