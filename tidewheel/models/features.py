"""Model-ready feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewheel.functions.calendar import with_calendar
from tidewheel.operators.encode import encode
from tidewheel.operators.series import trailing_features
from tidewheel.panel import Panel

# Names of the model features, in groups that the ablation adds one after the other.
TIME_FEATURES = ("year", "month", "day_of_week", "quarter", "is_weekend", "month_sin", "month_cos")
KEY_FEATURES = ("country_encoded", "sector_encoded")
LAG_FEATURES = ("lag_1d", "lag_7d", "lag_30d")
ROLLING_FEATURES = ("rolling_avg_7d", "rolling_avg_30d")
FEATURES = TIME_FEATURES + LAG_FEATURES + ROLLING_FEATURES + KEY_FEATURES

# Columns of the sequence forecaster, next to the value itself.
SEQUENCE_FEATURES = ROLLING_FEATURES + LAG_FEATURES + ("month_sin", "month_cos", "is_weekend")

# The feature sets that the ablation compares.
ABLATION_SETS = {
    "Ablation_TimeOnly": TIME_FEATURES + KEY_FEATURES,
    "Ablation_TimeLag": TIME_FEATURES + KEY_FEATURES + LAG_FEATURES,
    "Boosted_Regression": FEATURES,
}


def panel_features(df: DataFrame, panel: Panel, drop_null: tuple[str, ...] = ("lag_7d",)) -> DataFrame:
    """Calendar, lag, leak-free rolling and encoded key columns; rows null in ``drop_null`` or the value are dropped.

    The key codes are those of the whole input, learnt without the window pass; they are joined to the kept rows.
    """
    featured = trailing_features(with_calendar(df, panel.time, origin="monday"), panel, leak_free=True)
    return encode(featured.dropna(subset=[*drop_null, panel.value]), panel.keys, learn_from=df)
