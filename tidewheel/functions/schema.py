"""Column roles, names and tolerant type conversion."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name fragments that mark a column's role.
LABEL_MARKS = ("level", "class", "category", "label")


def first_match(names: Iterable[str], pattern: str, exclude: str | None = None) -> str | None:
    """First name in which the regular expression is found, skipping names that hold ``exclude``."""
    for name in names:
        if re.search(pattern, name) and not (exclude and re.search(exclude, name)):
            return name
    return None


def time_column(df: DataFrame, fallback: str = "timestamp") -> str | None:
    found = first_match(df.columns, r"(?i)date")
    if found is None and fallback in df.columns:
        return fallback
    return found


def value_column(df: DataFrame, training: bool = False) -> str:
    """Measured value by name, else the last column (``training``: no date names, else the last numeric column)."""
    if not training:
        return first_match(df.columns, r"MtCO2|(?i:emission)") or df.columns[-1]
    for name in df.columns:
        if re.search(r"(?i)mtco2", name) or re.search(r"(?i)emission", name) and "date" not in name.lower():
            return name
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        raise ValueError("no numeric column to use as value")
    return numeric[-1]


def label_column(df: DataFrame) -> str:
    return first_match(df.columns, "(?i)" + "|".join(LABEL_MARKS)) or df.columns[-1]


def available(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def parse_date(text: Column, pattern: str | None = None) -> Column:
    """Date from a plain date or an ISO date-time; anything unreadable becomes null."""
    return F.try_to_date(text, pattern) if pattern else F.try_to_timestamp(text).cast("date")


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def normalise(df: DataFrame, time_as: str, value_as: str, training: bool = False) -> DataFrame:
    """Detect the time and value columns; give them fixed names, a date type and a double type."""
    time, value = time_column(df), value_column(df, training)
    if time is None:
        raise ValueError(f"no date column among {df.columns}")
    out = df.withColumnRenamed(value, value_as).withColumn(value_as, to_number(F.col(value_as)))
    as_date = F.col(f"`{time}`")
    if isinstance(df.schema[time].dataType, T.StringType):
        as_date = parse_date(as_date)
    return out.withColumn(time_as, as_date.cast("date"))


def clean_name(name: str) -> str:
    """Spaces become underscores, parentheses go, a slash reads ``_per_``."""
    return name.translate(str.maketrans({" ": "_", "(": None, ")": None, "/": "_per_"}))


def sanitise_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    clashes = [n for n, count in Counter(n.lower() for n in names).items() if count > 1]
    if clashes:
        raise ValueError(f"columns clash after cleaning: {clashes}")
    return df.toDF(*names)


def pack(df: DataFrame, name: str = "metadata", **fields: str) -> DataFrame:
    """Add a struct column; ``fields`` maps struct field names to columns."""
    return df.withColumn(name, F.struct(*(F.col(col).alias(field) for field, col in fields.items())))


def with_provenance(df: DataFrame, source: str, time_as: str = "loaded_at") -> DataFrame:
    return df.withColumns({"data_source": F.lit(source), time_as: F.current_timestamp()})
