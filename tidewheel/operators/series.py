"""Row-based window columns over panels: rolling means, lags, changes and sequences."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidewheel.operators.ordering import positions, running_totals
from tidewheel.panel import Panel

PIECE_ROWS = 200_000


@dataclass(frozen=True)
class SeriesColumn:
    """A window expression and how many rows it looks back and ahead."""

    build: Callable[[WindowSpec], Column]
    before: int = 0
    after: int = 0


def rolling_mean(value: str, rows: int, strict: bool = False) -> SeriesColumn:
    """Mean of the last ``rows`` rows including the current one; ``strict`` gives null until all of them exist."""

    def build(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-(rows - 1), 0)
        mean = F.avg(value).over(frame)
        return F.when(F.count(value).over(frame) == rows, mean) if strict else mean

    return SeriesColumn(build, before=rows - 1)


def past_mean(value: str, rows: int) -> SeriesColumn:
    """Mean of up to ``rows`` rows strictly before the current one, so the row's own value never leaks in."""
    return SeriesColumn(lambda w: F.avg(value).over(w.rowsBetween(-rows, -1)), before=rows)


def lag(value: str, rows: int) -> SeriesColumn:
    return SeriesColumn(lambda w: F.lag(value, rows).over(w), before=rows)


def pct_change(value: str) -> SeriesColumn:
    """Change against the previous row in percent; null when that row is missing, null or zero."""

    def build(w: WindowSpec) -> Column:
        previous = F.lag(value, 1).over(w)
        return F.try_divide(F.col(value) - previous, previous) * 100

    return SeriesColumn(build, before=1)


def past_values(values: str | Sequence[str], rows: int) -> SeriesColumn:
    """Array of the last ``rows`` values, oldest first, the current one last; null at the start of a series.

    Several columns give one flat array that holds them row after row.
    """

    def build(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-(rows - 1), 0)
        if isinstance(values, str):
            listed = F.collect_list(values).over(frame)
        else:
            listed = F.flatten(F.collect_list(F.array(*(F.col(c).cast("double") for c in values))).over(frame))
        return F.when(F.count(F.lit(1)).over(frame) == rows, listed)

    return SeriesColumn(build, before=rows - 1)


def next_values(value: str, rows: int) -> SeriesColumn:
    """Array of the following ``rows`` values; null at the end of a series."""

    def build(w: WindowSpec) -> Column:
        frame = w.rowsBetween(1, rows)
        return F.when(F.count(F.lit(1)).over(frame) == rows, F.collect_list(value).over(frame))

    return SeriesColumn(build, after=rows)


def over_series(
    df: DataFrame, panel: Panel, columns: Mapping[str, SeriesColumn], piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Add window columns computed along each series.

    All columns share one partitioning and order, so Spark plans a single exchange and sort for them.  A daily panel
    is windowed series by series.  Any other panel is cut into pieces of ``piece_rows`` rows; the rows within reach
    of a piece's ends are copied into it and dropped again afterwards, which gives the same values.
    """
    if panel.daily:
        w = Window.partitionBy(*panel.keys).orderBy(panel.time)
        return df.withColumns({name: c.build(w) for name, c in columns.items()})
    before = max(c.before for c in columns.values())
    after = max(c.after for c in columns.values())
    placed = positions(df, [panel.time], panel.keys, "_at")
    home = F.floor(F.col("_at") / piece_rows)
    first = F.floor((F.col("_at") - after) / piece_rows)
    last = F.floor((F.col("_at") + before) / piece_rows)
    copies = placed.withColumn("_home", home).withColumn("_part", F.explode(F.sequence(first, last)))
    w = Window.partitionBy(*panel.keys, "_part").orderBy("_at")
    out = copies.withColumns({name: c.build(w) for name, c in columns.items()})
    return out.where(F.col("_part") == F.col("_home")).drop("_at", "_home", "_part")


def trailing_features(
    df: DataFrame,
    panel: Panel,
    lags: Sequence[int] = (1, 7, 30),
    means: Sequence[int] = (7, 30),
    leak_free: bool = True,
    change: bool = False,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Lags, rolling means and percent change in one window pass; ``piece_rows`` as in :func:`over_series`.

    Means for model features must be ``leak_free``; means that include the current row are for description only.
    """
    mean = past_mean if leak_free else rolling_mean
    columns = {f"lag_{n}d": lag(panel.value, n) for n in lags}
    columns |= {f"rolling_avg_{n}d": mean(panel.value, n) for n in means}
    if change:
        columns["pct_change"] = pct_change(panel.value)
    return over_series(df, panel, columns, piece_rows)


def sequences(
    df: DataFrame, panel: Panel, length: int = 30, horizon: int = 7, features: Sequence[str] | None = None
) -> DataFrame:
    """Sliding supervised pairs: ``inputs`` (``length`` rows of the features, by default of the value) and ``targets``
    (the next ``horizon`` values).

    A series of n rows gives n - length - horizon + 1 pairs.  Null values would shorten an array, so drop them first.
    """
    inputs = past_values(list(features) if features else panel.value, length)
    pairs = over_series(df, panel, {"inputs": inputs, "targets": next_values(panel.value, horizon)})
    return pairs.where(F.col("inputs").isNotNull() & F.col("targets").isNotNull())


def cumulative(df: DataFrame, panel: Panel) -> DataFrame:
    """Add cumulative_sum, cumulative_count and cumulative_avg from the start of the series up to the current row."""
    value = F.col(panel.value)
    filled, counted = F.coalesce(value.cast("double"), F.lit(0.0)), value.isNotNull().cast("long")
    total, count = F.col("cumulative_sum"), F.col("cumulative_count")
    if panel.daily:
        w = Window.partitionBy(*panel.keys).orderBy(panel.time).rowsBetween(Window.unboundedPreceding, 0)
        out = df.withColumns({"cumulative_sum": F.sum(filled).over(w), "cumulative_count": F.sum(counted).over(w)})
    else:
        out = running_totals(
            df, [panel.time], {"cumulative_sum": filled, "cumulative_count": counted}, panel.keys
        ).withColumns({"cumulative_sum": total + filled, "cumulative_count": count + counted})
    return out.withColumn("cumulative_avg", F.try_divide(total, count))
