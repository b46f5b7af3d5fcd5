"""Calendar, season and cyclical columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month numbers of each season (northern hemisphere); every other month is Autumn.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}


def day_of_week(date: Column, origin: str = "monday") -> Column:
    """Monday-based 0..6, or Sunday-based 1..7 with ``origin='sunday'``."""
    if origin == "sunday":
        return F.dayofweek(date)
    if origin == "monday":
        return F.weekday(date)
    raise ValueError(f"origin must be 'monday' or 'sunday', not {origin!r}")


def is_weekend(date: Column) -> Column:
    return (F.weekday(date) >= 5).cast("int")


def season(month: Column, null_as_null: bool = True) -> Column:
    """Season name; a null month stays null unless ``null_as_null`` is False (then it is Autumn)."""
    rest = F.when(month.isNotNull(), "Autumn") if null_as_null else F.lit("Autumn")
    for name, months in reversed(SEASONS.items()):
        rest = F.when(month.isin(*months), name).otherwise(rest)
    return rest


def cycle(value: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) position of ``value`` on a circle of length ``period``."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def with_calendar(df: DataFrame, time: str, origin: str = "monday", null_as_null: bool = True) -> DataFrame:
    """Add year, month, day_of_week, day_of_year, quarter, season, is_weekend and the cyclical columns."""
    date = F.col(time)
    month_sin, month_cos = cycle(F.month(date), 12)
    dow_sin, _ = cycle(F.weekday(date), 7)
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "day_of_week": day_of_week(date, origin),
            "day_of_year": F.dayofyear(date),
            "quarter": F.quarter(date),
            "season": season(F.month(date), null_as_null),
            "is_weekend": is_weekend(date),
            "month_sin": month_sin,
            "month_cos": month_cos,
            "dow_sin": dow_sin,
        }
    )


def mid_year(year: Column) -> Column:
    """Timestamp standing for a whole year: 1 July, midnight."""
    return F.make_date(year, F.lit(7), F.lit(1)).cast("timestamp")


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def with_year_features(df: DataFrame, year: str, value: str, origin: int = 1990) -> DataFrame:
    """Decade, years since ``origin`` and the log1p of the value."""
    return df.withColumns(
        {
            "decade": decade(F.col(year)),
            f"years_from_{origin}": F.col(year) - origin,
            f"log_{value}": F.log1p(F.col(value)),
        }
    )
