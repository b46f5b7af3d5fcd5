"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents its predecessor kept.  ``run`` writes what a stage
returns as Parquet below the shared folder and reads it again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import idsets, jaccard_join, langid, mixing, packing, toxicity
from tidewheel.llm.common import bounded_batches, free_name, give_back, saved, table

#: A text less close than this to every learned language is in none of them.
LEAST_CLOSENESS = 0.25
#: Words that a worker of the last stage remembers, smaller than by default: executors still hold what earlier stages left.
KEPT_BYTES = 16 << 20
#: Bytes of rows that workers take at a time, fewer than by default for the same reason.
BATCH = "1m"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts close to no language that the documents' own ``lang`` column teaches.

    A null or empty text has no letter.  Every row is judged by its own text; repeated rows stay or go together, and all
    columns come back as they were, whatever their names.
    """
    lang, closeness, lead = (free_name(docs, n) for n in ("_lang", "_closeness", "_lead"))
    rated = langid.rate(docs, langid.fit(docs), names=(lang, closeness, lead))
    bounded_batches(spark, BATCH)  # holds when the result is read
    return rated.where((F.col(lang) != langid.UNKNOWN) & (F.col(closeness) >= LEAST_CLOSENESS)).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the compression distance, learned from ``labels``, calls toxic.

    Null and empty texts stay where nothing says otherwise.  Every row is judged by its own text; repeated rows stay or go
    together, and all columns come back as they were, whatever their names.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    names = tuple(free_name(docs, n) for n in ("_score", "_toxic", "_shortening"))
    rated = toxicity.rate(docs, model, names=names)
    bounded_batches(spark, BATCH)  # holds when the result is read
    return rated.where(F.col(names[1]) == 0).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by shared five-word shingles (similarity 0.8 or more) one stays: that with the smallest id.

    Rows are told apart by a number of their own, so an id with several texts keeps those that are no copies, and of
    repeated rows one stays.  A null id comes after all others, equal ids go by a hash of the text, then by number.  Rows
    without words are linked with nothing and stay.  All columns come back as they were, whatever their names.
    """
    row = free_name(docs, "_row")
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    linked = jaccard_join.link(numbered.select(F.col(row).alias("doc_id"), "text"), k=5, percent=80, batch=BATCH)
    linked = saved(linked.select(F.col("doc_id").alias("row"), "component_id"), "linked")
    several = linked.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    members = linked.join(several, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.col(row).alias("row"))
    placed = members.join(numbered.select(order.alias("at")), F.col("row") == F.col("at.row")).select("component_id", "at")
    kept = placed.groupBy("component_id").agg(F.min("at").alias("at"))
    dropped = members.join(kept.select(F.col("at.row").alias("row")), "row", "left_anti").select(F.col("row").alias(row))
    return idsets.without(numbered, dropped, row).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; a null source is one like any other, and rows without words are not taken.

    Repeated rows are taken each for itself.  All columns come back as they were, whatever their names.
    """
    give_back(spark)
    mixed = mixing.mix(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row"))).where("copies > 0")
    return mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed into sequences of 2048; a null text is an empty one, repeated rows are packed each for itself."""
    import public_tokenizers

    give_back(spark)
    packed = packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), kept_bytes=KEPT_BYTES, batch=BATCH))
    give_back(spark)
    return packed


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: SQL cannot express the classifiers; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
