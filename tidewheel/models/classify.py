"""Boosted multi-class classification of tabular records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidewheel.functions.binning import quantile_code
from tidewheel.functions.schema import label_column
from tidewheel.models import boosting
from tidewheel.models.boosting import Boosted, Settings
from tidewheel.models.regression import kept
from tidewheel.operators.encode import encode, ordered_codes
from tidewheel.operators.joins import join_groups
from tidewheel.operators.oversample import oversample
from tidewheel.operators.quantiles import approx_quantiles, exact_quantiles
from tidewheel.operators.split import hash_split

# The boosted classifier's settings.
BOOSTING = Settings(rounds=300, rate=0.1, depth=5, row_share=0.8, seed=42)

# Fixed value: what a missing category is called before coding.
NULL_CATEGORY = "nan"


def tertile_label(df: DataFrame, value: str, name: str = "label", bins: int = 3, approx: bool = False) -> DataFrame:
    """Class 0..bins-1 by the value's quantiles; values equal to an edge go to the lower class."""
    probs = {f"e{i}": i / bins for i in range(1, bins)}
    edges = (approx_quantiles if approx else exact_quantiles)(df, value, probs)
    return (
        df.withColumn("_e", edges.select(F.struct(*probs).alias("e")).scalar())
        .withColumn(name, quantile_code(F.col(value), [F.col(f"_e.{e}") for e in probs]))
        .drop("_e")
    )


def prepare(df: DataFrame, target: str | None = None, max_classes: int = 20) -> tuple[DataFrame, list[str]]:
    """Turn the target into ``label`` codes and text columns into codes.

    A target with more than ``max_classes`` distinct values is cut into tertiles.  Of any other, integers stay as they
    are, text is coded alphabetically and other types in their own order.  A null in a text column is a category of its
    own, called ``NULL_CATEGORY``; rows with any other null are dropped.  Choosing the coding counts the distinct values
    first; the result is checkpointed, since splits, balancing and scoring all read it.
    """
    target = target or label_column(df)
    kind = df.schema[target].dataType
    distinct = df.select(target).dropna().distinct().limit(max_classes + 1).count()
    if distinct > max_classes:
        labelled = tertile_label(df, target, "_label")
    elif isinstance(kind, IntegralType):
        labelled = df.withColumn("_label", F.col(target).cast("int"))
    else:
        codes = ordered_codes(df, target, "_label").withColumn("_label", F.col("_label").cast("int"))
        labelled = join_groups(df, codes, [target], "left")
    # the target may be called label itself
    labelled = labelled.drop(target).withColumnRenamed("_label", "label")
    text = [f.name for f in labelled.schema.fields if f.dataType.typeName() == "string"]
    named = labelled.withColumns({c: F.coalesce(c, F.lit(NULL_CATEGORY)) for c in text})
    coded = encode(named, text, "_encoded").drop(*text).withColumnsRenamed({f"{c}_encoded": c for c in text})
    features = [c for c in coded.columns if c != "label"]
    return kept(coded.dropna()), features


def fit_balanced(
    train: DataFrame, features: Sequence[str], row_id: str, label: str = "label", held_share: float = 0.1, seed: int = 42, **settings: object
) -> Boosted:
    """Hold a share of the training rows out, oversample the others, and boost one model of all classes on them.

    Boosting stops when the loss on the rows held out, which have no synthetic neighbours among the others, no longer falls.
    ``settings`` are those of :class:`boosting.Settings`.  Classes are the codes 0 to the largest one in ``label``.
    """
    parts = kept(hash_split(train, [row_id], {"train": 1 - held_share, "held": held_share}, seed, "_part"))
    rows = oversample(parts.where(F.col("_part") == "train"), label, features, row_id, seed=seed).drop("is_synthetic")
    held = parts.where(F.col("_part") == "held").select(label, *(F.col(c).cast("double").alias(c) for c in features))
    both = rows.select(label, *features).withColumn("_held", F.lit(False)).unionByName(held.withColumn("_held", F.lit(True)))
    classes = (train.agg(F.max(label)).first()[0] or 0) + 1
    return boosting.fit(kept(both), features, label, max(2, classes), "_held", BOOSTING, seed=seed, **settings)
