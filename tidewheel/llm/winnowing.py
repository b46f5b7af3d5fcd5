"""Document fingerprints by winnowing, in DataFrame functions alone.

Words are hashed; a k-gram's hash is a cyclic polynomial of its words' hashes, which rolls: dropping the first word and
adding the next is a rotation and two exclusive ors.  Of every window of ``window`` consecutive k-grams the smallest hash
is kept, the rightmost one if several are equal, with its position.  Any run of ``k + window - 1`` words that two texts
share puts at least one common hash into both fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.session import parallelism

K, WINDOW = 3, 4


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once and not for every element of a lambda inside."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _turned(h: Column, by: int) -> Column:
    """64-bit rotation to the left."""
    return h if by == 0 else F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """``array<struct<position int, hash long>>`` of a text, in order of position.

    A text of fewer than ``k`` words has one k-gram, all of it; one without words (or null) has an empty fingerprint.
    """
    empty = F.array().cast("array<struct<position:int,hash:bigint>>")

    def gram(hashes: Column, i: Column) -> Column:
        out = None
        for j in range(k):
            own = _turned(F.coalesce(F.get(hashes, i + j), F.lit(0).cast("long")), k - 1 - j)
            out = own if out is None else out.bitwiseXOR(own)
        return out

    def kept(grams: Column, i: Column) -> Column:
        within = [F.get(grams, i + j) for j in range(window)]

        def placed(least: Column) -> Column:
            at = F.lit(0)
            for j in range(1, window):
                at = F.when(F.get(grams, i + j) == least, F.lit(j)).otherwise(at)
            return F.struct((i + at).cast("int").alias("position"), least.alias("hash"))

        return _let(F.least(*within), placed)

    def selected(grams: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(grams) - window, F.lit(0)))
        return _let(
            F.transform(starts, lambda i: kept(grams, i)),
            lambda found: F.filter(found, lambda x, i: (i == 0) | (F.get(found, i - 1)["position"] != x["position"])),
        )

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - k, F.lit(0)))
        return F.when(F.size(hashes) == 0, empty).otherwise(_let(F.transform(starts, lambda i: gram(hashes, i)), selected))

    return _let(F.transform(words_of(text), lambda w: F.xxhash64(w)), of_hashes)


def hashes_of(print_: Column) -> Column:
    return F.transform(print_, lambda x: x["hash"])


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes; two empty ones are alike."""
    a, b = hashes_of(left), hashes_of(right)
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def digest(print_: Column) -> Column:
    """A short name for a fingerprint: how many hashes it has and 96 bits over hashes and positions."""
    return F.lower(F.concat_ws("-", F.size(print_).cast("string"), F.hex(F.xxhash64(print_)), F.hex(F.hash(print_).cast("long"))))


def with_next(docs: DataFrame, made: dict[str, Column], pieces: int | None = None) -> DataFrame:
    """``docs`` (``doc_id, text``) with columns ``made``, and ``next_text`` and ``next_<name>`` of the document after it.

    Order is ``doc_id`` (null first), then text; after the last comes the first.  Ids are cut at quantiles, which are ids
    of the table themselves: a piece starts with a document that is also dealt to the piece before, so neighbours meet
    without a global order.  Bounds are at most ``pieces`` numbers.
    """
    pieces = pieces or parallelism(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / pieces for i in range(1, pieces)]
    found = rows.agg(
        F.percentile_approx("doc_id", shares, F.lit(max(10_000, 20 * pieces))).alias("cuts"), F.min("doc_id").alias("first"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    # the piece before the first cut starts with the first document
    cuts = sorted({c for c in found["cuts"] or [] if c != found["first"] or found["nulls"]})
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]).cast("array<bigint>")
    piece = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col("doc_id"))))
    is_first = F.col("doc_id").isNull() if found["nulls"] else F.col("doc_id") == F.lit(found["first"]).cast("long")
    guest_of = F.when(is_first, F.lit(len(cuts))).when(F.array_contains(bounds, F.col("doc_id")), F.col("piece") - 1)
    own = F.struct(F.col("piece").alias("piece"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("guest_of").alias("piece"), F.lit(True).alias("guest"))
    dealt = rows.withColumn("piece", piece).withColumn("guest_of", guest_of)
    dealt = dealt.select(
        "doc_id", "text", F.explode(F.when(F.col("guest_of").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("at")
    ).select("doc_id", "text", "at.piece", "at.guest")
    dealt = dealt.repartition("piece").select("*", *[c.alias(n) for n, c in made.items()])
    order = Window.partitionBy("piece").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    following = [F.lead(n).over(order).alias(f"next_{n}") for n in ("text", *made)]
    return dealt.select("doc_id", "text", "guest", *made, *following).where(~F.col("guest")).drop("guest")


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by as many from the start of the next text."""
    n = F.length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))
