"""Message topics: source options, envelope encoding and decoding.

The Kafka format needs Spark's ``spark-sql-kafka`` package; everything but :func:`read_topic` and
:func:`write_topic` works on any frame with ``key``, ``value`` and ``timestamp`` columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators.clean import not_null

VALUE_FIELD = "MtCO2 per day"

# Fields of a message.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField(VALUE_FIELD, T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("_kafka_ingested_at", T.StringType()),
        T.StructField("_source", T.StringType()),
    ]
)


def topic_options(
    servers: str, topic: str, starting: str = "latest", per_trigger: int = 1000, fail_on_loss: bool = False
) -> dict[str, str]:
    """Reader options; ``starting='earliest'`` replays the topic, ``per_trigger`` caps a micro-batch."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
        "maxOffsetsPerTrigger": str(per_trigger),
    }


def read_topic(spark: SparkSession, servers: str, topic: str, **options: object) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def encode(
    df: DataFrame,
    columns: Sequence[str],
    source: str,
    ingested_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows to messages: key ``country_sector`` and a JSON value that keeps nulls and writes dates in ISO form.

    ``keep`` columns are passed on next to key and value.
    """
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    fields = []
    for c in columns:
        kind = df.schema[c].dataType.typeName()
        col = F.col(f"`{c}`")
        fields.append((F.date_format(col, iso) if kind in ("date", "timestamp", "timestamp_ntz") else col).alias(c))
    stamp = F.date_format(ingested_at if ingested_at is not None else F.current_timestamp(), f"{iso}.SSSSSS")
    value = F.to_json(
        F.struct(*fields, stamp.alias("_kafka_ingested_at"), F.lit(source).alias("_source")),
        {"ignoreNullFields": "false"},
    )
    key = F.concat_ws("_", F.coalesce("country", F.lit("UNKNOWN")), F.coalesce("sector", F.lit("ALL")))
    return df.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"), *keep)


def decode(messages: DataFrame) -> DataFrame:
    """Binary values to flat columns; a value that is not valid JSON gives null fields.

    The parsed record is unpacked by a generator: a filter on its fields stays above that, whereas it would be pushed
    below a plain projection and parse every message once more per field.
    """
    parsed = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    fields = messages.select(F.col("timestamp").alias("kafka_timestamp"), F.inline(F.array(parsed)))
    return fields.select(
        "kafka_timestamp",
        "date",
        "country",
        "sector",
        F.col(f"`{VALUE_FIELD}`").alias("mtco2_per_day"),
        F.col("timestamp").alias("emission_timestamp"),
        F.col("_kafka_ingested_at").alias("ingested_at"),
        F.col("_source").alias("source"),
        F.current_timestamp().alias("processed_at"),
    )


def is_valid() -> Column:
    return not_null("country", "mtco2_per_day", "date") & F.coalesce(F.col("mtco2_per_day") > 0, F.lit(False))


def valid(decoded: DataFrame) -> DataFrame:
    return decoded.where(is_valid())


def rejected(decoded: DataFrame) -> DataFrame:
    """The rows :func:`valid` leaves out."""
    return decoded.where(~is_valid())


def event_time(date: Column) -> Column:
    """Timestamp of a plain date or an ISO date-time; null when neither."""
    return F.try_to_timestamp(date)


def with_latency(decoded: DataFrame, name: str = "latency_ms") -> DataFrame:
    """Milliseconds between the producer's stamp and the topic's."""
    return decoded.withColumn(
        name, F.unix_millis("kafka_timestamp") - F.unix_millis(F.try_to_timestamp("ingested_at"))
    )
