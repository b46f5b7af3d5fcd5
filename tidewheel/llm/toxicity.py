"""Toxicity by compression distance.

Zstandard dictionaries are made of both kinds of text.  The ordinary one is trained on windows of ordinary documents.
The toxic ones hold the same content and, after it, the stretches of toxic documents that ordinary documents lack: one
those they lack altogether, the other those that are merely much rarer there.  A window that shortens more under a toxic
dictionary than under the ordinary one is nearer to toxic text; as all share their ordinary part, the difference owes
nothing to how common the rest of the window is.  Windows are words (pieces of at most
``WINDOW`` bytes), each followed by a pad both dictionaries know, as zstandard looks for no match in the last bytes of
an input.  How far a document's windows shorten is turned into a probability by a logistic curve fitted on labels.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, by_hash, claim, saved, worker_cache

#: Labelled rows a model is fitted on, of each label at most: those whose ids have the smallest hashes.
TOXIC_ROWS, ORDINARY_ROWS = 1_500, 4_500
#: Windows of ordinary documents that train the ordinary dictionary, their size, and the dictionary's.
TRAIN_WINDOWS, TRAIN_BYTES, DICTIONARY = 12_000, 256, 8_000
#: A stretch counts as toxic if it stands before so many different words in toxic documents, is so many times as frequent
#: there as in ordinary ones, and its likelihood ratio reaches this; so many are kept, the most telling first.
LEAST_CONTEXTS, LEAST_RATIO, LEAST_EVIDENCE, MOST_STRETCHES = 5, 20.0, 30.0, 256
#: From this ratio on ordinary documents are taken to lack a stretch altogether.
STRICT_RATIO = 100.0
WINDOW = 64
PAD = bytes([0, 1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 14, 15, 16, 17, 18])
#: Stands before every word, and before every stretch in the toxic dictionaries: a match from a word's start is longer by it.
START = b"\x19\x1a"
LEVEL = 1
#: The fast search of level 1 remembers one place for each beginning, so of two stretches that begin alike one was never
#: found.  This one looks at ``2 ** SEARCH_LOG`` places, as many as there are stretches, and takes the longest match; the
#: shortest one, ``MIN_MATCH`` bytes, is that of ``START`` and the shortest stretch.
SEARCH, SEARCH_LOG, MIN_MATCH = zstandard.STRATEGY_GREEDY, 8, 6
THRESHOLD = 0.3
#: Bytes of shortening at which words are counted.
STEPS = (3, 4, 5, 6)
_N = 2 * (1 + len(STEPS))
_FEATURES = "toxic int, " + ", ".join(f"f{n} double" for n in range(_N))
ADDED = ("score", "predicted", "shortening")
#: Distinct words whose distance a worker keeps.
KEPT = 100_000


@dataclass
class Model:
    """Content of the dictionaries, and the weights of the logistic curve."""

    ordinary: bytes
    strict: bytes
    loose: bytes
    weights: tuple[float, ...]


class Distance:
    """Bytes by which windows shorten more under the toxic dictionary."""

    def __init__(self, model: Model) -> None:
        self.compress = [self._compressor(c).compress for c in (model.ordinary, model.strict, model.loose)]
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.weights = np.array(model.weights)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        content += PAD
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=256, dict_size=len(content), strategy=SEARCH, search_log=SEARCH_LOG, min_match=MIN_MATCH,
            write_checksum=0, write_content_size=0, write_dict_id=0,
        )
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)

    def of(self, word: str) -> int:
        """The most that any window of a word shortens under the strict dictionary, and 256 times that under the loose one."""
        data = word.encode()
        starts = range(0, len(data), WINDOW // 2) if len(data) > WINDOW else (0,)
        best = [0, 0]
        for at in starts:
            window = START + b" " + data[at : at + WINDOW] + b" " + PAD
            ordinary, *toxic = (len(compress(window)) for compress in self.compress)
            best = [max(b, ordinary - t) for b, t in zip(best, toxic)]
        return best[0] + 256 * best[1]

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text and toxic dictionary: the largest shortening (8 at most), and how many words reach each of ``STEPS`` (logarithms)."""
        split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        stops = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        gains = np.empty(len(coded.dictionary), np.int64)
        for i, word in enumerate(coded.dictionary.to_pylist()):
            gain = self.known.get(word)
            if gain is None:
                gain = self.older.get(word)
                if gain is None:
                    gain = self.of(word)
                if len(word) <= WINDOW:
                    self.known[word] = gain
            gains[i] = gain
        both = gains[coded.indices.to_numpy()]
        text = np.repeat(np.arange(len(texts)), np.diff(stops))
        out = []
        for own in (both & 255, both >> 8):
            largest = np.zeros(len(texts), np.int64)
            np.maximum.at(largest, text, np.minimum(own, 8))
            out += [largest, *(np.log1p(np.bincount(text[own >= least], minlength=len(texts))) for least in STEPS)]
        return np.column_stack(out)

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ self.weights[1:], -30, 30)))


_distances: dict[bytes, Distance] = worker_cache()


def _distance(packed: bytes) -> Distance:
    claim(_distances)
    if packed not in _distances:
        _distances.clear()
        _distances[packed] = Distance(pickle.loads(packed))
    return _distances[packed]


def _stretches(sample: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """Word beginnings and whole words that mark toxic text: those ordinary text lacks, and those it merely has less of.

    Evidence is counted in different following words, so that copies of one document count once.
    """
    lower = F.lower("text")
    words = F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    pairs = sample.select("toxic", words.alias("words")).where(F.size("words") > 0).select(
        "toxic", F.explode(F.arrays_zip(F.col("words").alias("word"), F.slice("words", 2, F.size("words")).alias("following"))).alias("p")
    ).select("toxic", "p.word", "p.following").distinct()
    spaced = F.concat(F.lit(" "), F.col("word"))
    beginnings = F.transform(F.sequence(F.lit(4), F.least(F.lit(12), F.length(spaced))), lambda n: F.substring(spaced, F.lit(1), n))
    pieces = F.when(F.length(spaced) >= 4, beginnings).otherwise(F.array().cast("array<string>"))
    whole = F.when(F.length(spaced) < 24, F.array(F.concat(spaced, F.lit(" ")))).otherwise(F.array().cast("array<string>"))
    by_word = pairs.groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("with"), F.count_if(F.col("toxic") == 0).alias("without")
    )
    by_word = saved(by_word, "words")
    total = by_word.agg(F.sum("with"), F.sum("without")).first()
    n1, n0 = (total[0] or 0), (total[1] or 0)
    if not n1 or not n0:
        return [], []
    counts = by_word.select(F.explode(F.concat(pieces, whole)).alias("piece"), "with", "without").groupBy("piece").agg(
        F.sum("with").alias("a"), F.sum("without").alias("b")
    )
    ratio = ((F.col("a") + 0.5) / n1) / ((F.col("b") + 0.5) / n0)
    expected = (F.col("a") + F.col("b")) / (n1 + n0)
    evidence = 2 * (
        F.col("a") * F.log(F.col("a") / (n1 * expected))
        + F.when(F.col("b") > 0, F.col("b") * F.log(F.greatest(F.col("b"), F.lit(1)) / (n0 * expected))).otherwise(0.0)
    )
    telling = counts.withColumn("ratio", ratio).where((F.col("a") >= LEAST_CONTEXTS) & (F.col("ratio") >= LEAST_RATIO)).withColumn("evidence", evidence)
    top = telling.where(F.col("evidence") >= LEAST_EVIDENCE).orderBy(F.desc("evidence"), F.desc(F.length("piece")), "piece").limit(16 * MOST_STRETCHES)
    kept: dict[str, float] = {}
    for piece, how_much in top.select("piece", "ratio").collect():
        if len(kept) < MOST_STRETCHES and not any(piece.startswith(k) or k.startswith(piece) for k in kept):
            kept[piece] = how_much
    return tuple([START + k.encode() for k, r in kept.items() if (r >= STRICT_RATIO) is strict] for strict in (True, False))


def _ordinary(sample: DataFrame) -> bytes:
    """Content of a dictionary trained on windows of ordinary documents; of few windows, their own text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in pc.utf8_lower(batch.column(0)).cast(pa.binary()).to_pylist():
                out += [text[at : at + TRAIN_BYTES] for at in range(0, len(text), TRAIN_BYTES)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["part"])

    windows = sample.where("toxic = 0").select("text").mapInArrow(cut, "part binary")
    rows = by_hash(saved(windows, "windows"), TRAIN_WINDOWS, "part").collect()
    parts = [bytes(r[0]) for r in rows]
    try:
        return zstandard.train_dictionary(2 * DICTIONARY, parts).as_bytes()[-DICTIONARY:]
    except zstandard.ZstdError:
        return b" ".join(parts)[-DICTIONARY:] or b" "


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[float, ...]:
    """Weights of a logistic curve, intercept first, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(beta))
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs`` (``doc_id, text``) with ``labels`` (``doc_id, toxic``); other columns are not read.

    Null texts and null labels teach nothing; of several labels of an id the largest holds.  At most ``TOXIC_ROWS`` and
    ``ORDINARY_ROWS`` rows are used, weighted so that both labels keep their share of all labelled rows.  Without rows of
    both labels the model gives every text the share of toxic labels.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    present = marks.join(docs.where(F.col("text").isNotNull()).select("doc_id").distinct(), "doc_id", "left_semi")
    ids = saved(present, "labelled")
    chosen = by_hash(ids.where("toxic > 0"), TOXIC_ROWS, "doc_id").unionByName(by_hash(ids.where("toxic = 0"), ORDINARY_ROWS, "doc_id"))
    # at most TOXIC_ROWS + ORDINARY_ROWS ids
    sample = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = saved(sample.withColumn("toxic", (F.col("toxic") > 0).cast("int")), "sample")
    totals = dict(ids.groupBy((F.col("toxic") > 0).cast("int")).count().collect())
    base = _ordinary(sample)
    strict, loose = (base + b"".join(reversed(own)) for own in _stretches(sample))
    model = Model(base, strict, loose, (0.0,) * (1 + _N))
    rows = sample.select("toxic", "text").mapInArrow(_features(pickle.dumps(model)), _FEATURES).collect()
    y = np.array([r[0] for r in rows], float)
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if not 0 < y.sum() < len(y):
        odds = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(base, base, base, (odds, *(0.0,) * _N))
    weight = np.where(y == 1, totals[1] / y.sum(), totals[0] / (1 - y).sum())
    weight *= len(y) / weight.sum()
    return Model(base, strict, loose, logistic(np.array([r[1:] for r in rows], float), y, weight))


def _features(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = _distance(packed)
        for batch in batches:
            columns = distance.features(batch.column(1)).T.astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["toxic", *(f"f{n}" for n in range(_N))])

    return run


def _rated(docs: DataFrame, kept: list[str], names: tuple[str, ...], model: Model, threshold: float) -> DataFrame:
    packed = pickle.dumps(model)
    given = kept if "text" in kept else [*kept, "text"]
    at = given.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = _distance(packed)
        for batch in batches:
            features = distance.features(pc.fill_null(batch.column(at), ""))
            found = distance.probability(features)
            added = [pa.array(found), pa.array((found >= threshold).astype(np.int32)), pa.array(np.maximum(features[:, 0], features[:, 1 + len(STEPS)]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *added], [*kept, *names])

    bounded_batches(docs.sparkSession)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema]
    fields += [f"`{n}` {t}" for n, t in zip(names, ("double", "int", "int"))]
    return docs.select(*given).mapInArrow(run, ", ".join(fields))


def rate(docs: DataFrame, model: Model, threshold: float = THRESHOLD, names: tuple[str, ...] = ADDED) -> DataFrame:
    """``docs`` with the score of their ``text``, whether it reaches ``threshold``, and its largest shortening.

    Columns of these ``names`` are replaced.  A null text counts as empty.
    """
    return _rated(docs, [c for c in docs.columns if c not in names], names, model, threshold)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """As :func:`rate`, but ``doc_id`` and what is added only."""
    return _rated(docs, ["doc_id"], ADDED, model, threshold)
