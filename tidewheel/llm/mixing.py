"""Mixing sources to target weights by nested hash thresholds.

Each source has a target in words.  A target above the source's own size is met by whole copies of all its documents
plus a remainder; the remainder is met by the documents whose hash lies below a threshold.  The threshold is found
without sorting: words are summed by source and hash bucket, the bucket in which the budget runs out is split into
finer buckets, and only that one, down to a single hash.  What is then left of the budget is smaller than the document
on which it ran out; further passes spend it on documents small enough to fit, in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import WORD, saved

#: Weights of the sources in order of their names, repeating, and the most copies of a document.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: How often what is left of a budget is spent on smaller documents.
PASSES = 4
#: A hash has LEVELS * STEP bits; a level looks at STEP of them.  At most 2 ** STEP sums per source and level.
LEVELS, STEP = 4, 12


def word_count(text: str = "text"):
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: str = "doc_id"):
    """48 bits of the id's md5, the same on any engine; a null id counts as the empty text."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, LEVELS * STEP // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` for documents with ``source, size``; one row per source, null included.

    All words are shared out by weight.  No target exceeds ``most`` times its source's size; what is cut off there goes
    to the others by weight, until none is above.  In order of ``most * size / weight`` the sources cut off come first,
    so the share per weight is the first one that fits with all earlier sources cut off.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
    weighed = weighed.withColumn("limit", most * F.col("source_size"))
    order = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = weighed.select(
        "source", "source_size", "weight", "limit", F.row_number().over(order).alias("place"),
        ((F.sum("source_size").over(everything) - before)
         / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))).alias("share"),
    )
    fits = F.when(F.col("share") * F.col("weight") <= F.col("limit"), F.col("place"))
    share = F.min_by("share", fits).over(everything)
    return ranked.withColumn("fair", share).select(
        "source", "source_size", F.least(F.col("limit").cast("double"), F.col("fair") * F.col("weight")).alias("target")
    )


def _boundaries(pool: DataFrame, gaps: DataFrame, name: str) -> DataFrame:
    """``key, gap, below, spent``: the documents of ``pool`` with a hash under ``below`` fit into the gap of their key."""
    state = gaps.select("key", "gap", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("spent"), F.lit(False).alias("all"))
    for level in range(LEVELS):
        shift = STEP * (LEVELS - 1 - level)
        inside = pool.join(state.where(~F.col("all")), "key").where(F.shiftright("hash", shift + STEP) == F.col("prefix"))
        sums = inside.groupBy("key", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        filled = sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0))).join(
            state.select("key", "gap", "spent"), "key"
        )
        over = F.col("spent") + F.col("before") + F.col("words") > F.col("gap")
        found = filled.groupBy("key").agg(
            F.min(F.when(over, F.struct("bucket", "before"))).alias("at"), F.sum("words").alias("all_words")
        )
        state = state.join(found, "key", "left").select(
            "key", "gap",
            F.coalesce(F.col("at.bucket"), F.shiftleft("prefix", STEP)).alias("prefix"),
            (F.col("spent") + F.coalesce(F.col("at.before"), F.col("all_words"), F.lit(0))).alias("spent"),
            (F.col("all") | F.col("at").isNull()).alias("all"),
        )
        state = saved(state, f"{name}-{level}")
    top = F.lit(1 << (LEVELS * STEP))
    return state.select("key", "gap", "spent", F.when(F.col("all"), top).otherwise(F.col("prefix")).alias("below"))


def _key(source: str = "source"):
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, passes: int = PASSES
) -> DataFrame:
    """One row per source: its size and target, the whole copies of its documents, and the limits of each pass.

    ``docs`` needs ``doc_id, text, source``; other columns are not read.  The text is read once: sizes are written to the
    shared folder, and all sums run over them.
    """
    sizes = saved(docs.select("source", word_count().alias("size"), document_hash().alias("hash")), "sizes")
    targets = source_targets(sizes, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.select(_key().alias("key"), "source_size", "target", whole.alias("whole"))
    gap = F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    marked = saved(targets.withColumn("gap", gap), "targets")
    pool = sizes.where(F.col("size") > 0).select(_key().alias("key"), "hash", "size")
    gaps = marked.select("key", "gap")
    for number in range(passes):
        fitting = pool.join(gaps, "key").where(F.col("size") <= F.col("gap"))
        if number:
            fitting = fitting.join(marked.drop("gap"), "key").where(~_chosen(number))
        found = _boundaries(fitting.select("key", "hash", "size"), gaps, f"mix-{number}")
        limits = found.select("key", *[F.col(c).alias(f"{c}_{number}") for c in ("gap", "below", "spent")])
        marked = saved(marked.join(limits, "key"), f"limits-{number}")
        gaps = marked.select("key", (F.col(f"gap_{number}") - F.col(f"spent_{number}")).alias("gap"))
    return marked


def _chosen(passes: int):
    """Whether a pass before number ``passes`` takes one more copy of a document."""
    out = F.lit(False)
    for n in range(passes):
        out = out | ((F.col("size") <= F.col(f"gap_{n}")) & (F.col("hash") < F.col(f"below_{n}")))
    return out


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, passes: int = PASSES
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken``: how often the mix takes each document.

    ``docs`` needs ``doc_id, text, source``; other columns stay, but for those with the names added.  Null texts have
    size 0 and are not taken; a null source is a source like any other and comes last.  Rows with equal ids have equal
    hashes and are taken together or not at all, so a repeated row changes no other.  An empty table gives an empty one.
    """
    limits = plan(docs, weights, most, passes)
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c not in added]
    # other columns travel in a struct, out of the way of the names used here
    row = F.struct(*kept).alias("row")
    rows = docs.select(row, word_count().alias("size"), document_hash().alias("hash"), _key().alias("key"))
    copies = F.when(F.col("size") > 0, F.col("whole") + _chosen(passes).cast("long")).otherwise(F.lit(0)).cast("long")
    out = rows.join(limits, "key").withColumn("copies", copies)
    return out.select("row.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
