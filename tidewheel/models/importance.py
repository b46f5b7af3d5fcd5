"""Model explanation by permuting one feature at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.session import parallelism


def with_partner(df: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Add ``_partner``: the same columns of another, randomly chosen row, each row being chosen once.

    Rows are dealt to buckets by hash; inside a bucket every row gets the next one in hash order, the last one the
    first.  Buckets are even however the data is skewed, since ``keys`` identify a row.
    """
    buckets = parallelism(df.sparkSession) * 4
    drawn = df.withColumn("_h", F.xxhash64(F.lit(seed), *keys)).withColumn("_b", F.pmod("_h", F.lit(buckets)))
    order = Window.partitionBy("_b").orderBy("_h", *keys)
    record = F.struct(*columns)
    following = F.coalesce(F.lead(record).over(order), F.first(record).over(order))
    return drawn.withColumn("_partner", following).drop("_h", "_b")


def permutation_importance(
    model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], seed: int = 42
) -> DataFrame:
    """Growth of the rmse when a feature is permuted, and the mean change of the prediction, per feature.

    One shuffle pairs the rows and one pass scores them once per feature.
    """
    paired = with_partner(df.select(*keys, label, *features), features, [*keys], seed)
    variants = F.array(
        F.struct(F.lit("").alias("feature"), F.struct(*features).alias("x")),
        *(
            F.struct(
                F.lit(f).alias("feature"),
                F.struct(*(F.col(f"_partner.{c}") if c == f else F.col(c) for c in features)).alias("x"),
            )
            for f in features
        ),
    )
    rows = paired.select(label, F.struct(*keys).alias("_id"), F.inline(variants)).select("_id", label, "feature", "x.*")
    scored = model.transform(rows)
    squared = F.pow(F.col("prediction") - F.col(label), 2)
    per_feature = scored.groupBy("feature").agg(F.sqrt(F.avg(squared)).alias("rmse"), F.count(F.lit(1)).alias("n"))
    plain = per_feature.where(F.col("feature") == "").select("rmse").scalar()
    return per_feature.where(F.col("feature") != "").select(
        "feature", (F.col("rmse") - plain).alias("rmse_growth"), "n"
    )
