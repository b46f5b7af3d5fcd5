"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three letters, a word's ends marked) of a language, most
frequent first.  A document's own most frequent n-grams are compared with each profile by the out-of-place distance: the
sum, over its n-grams, of how far their ranks lie apart, or a fixed penalty where the profile lacks one.  The nearest
profile wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, claim, saved

LETTERS = regex.compile(r"\p{L}+")
#: N-grams in a profile, and n-grams of a document that are compared.
PROFILE, COMPARED = 500, 400
UNKNOWN = "und"
_EDGE, _BITS = ord("_"), 21


def grams(text: str) -> np.ndarray:
    """Keys of all n-grams of ``text``, with repeats: up to three code points of 21 bits each."""
    words = LETTERS.findall(text.lower())
    if not words:
        return np.zeros(0, np.int64)
    code = np.frombuffer(f"_{'_'.join(words)}_".encode("utf-32-le"), np.uint32).astype(np.int64)
    inner = code != _EDGE
    pairs = (code[:-1] << _BITS) | code[1:]
    triples = (pairs[:-1] << _BITS) | code[2:]
    # an edge inside a triple joins two words; a lone edge and an edge pair say nothing
    return np.concatenate([code[inner], pairs, triples[inner[1:-1]]])


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if weights is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weights, first) if len(keys) else weights


def learn(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """``lang, rank, gram``: the ``size`` most frequent n-grams of each language, by rank from 0; equal counts by key.

    ``docs`` needs ``text`` and ``lang``; rows where either is null teach nothing.  All rows are counted: each task sums
    up its own, Spark adds the sums.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (keys, n) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], schema=schema)
            sums.clear()

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                keys, n = counted(grams("\n".join(own)))
                if lang in sums:
                    keys, n = counted(np.append(sums[lang][0], keys), np.append(sums[lang][1], n))
                sums[lang] = keys, n.astype(np.int64)
            if sum(len(k) for k, _ in sums.values()) > 1 << 20:
                yield from flush()
        yield from flush()

    bounded_batches(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    # a filter on the row number itself lets every task keep its first ones only
    return sums.withColumn("place", place).where(F.col("place") <= size).select("lang", (F.col("place") - 1).alias("rank"), "gram")


class Profiles:
    """The rank of every n-gram in every profile; small, one table per worker."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int) -> None:
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.keys = np.array(sorted({r[2] for r in rows}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.keys) + 1), -1, np.int64)
        if rows:
            lang = np.array([self.langs.index(r[0]) for r in rows])
            self.ranks[lang, np.searchsorted(self.keys, [r[2] for r in rows])] = [r[1] for r in rows]

    def nearest(self, text: str | None) -> tuple[str, float, float]:
        """Language, closeness (1: in place throughout; 0: no n-gram in common) and lead over the second."""
        keys, n = counted(grams(text)) if text else (np.zeros(0, np.int64), None)
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0, 0.0
        top = keys[np.argsort(-n, kind="stable")[:COMPARED]]
        at = np.searchsorted(self.keys, top)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != top] = len(self.keys)
        ranks = self.ranks[:, at]
        away = np.where(ranks < 0, self.size, np.minimum(np.abs(ranks - np.arange(len(top))), self.size)).sum(axis=1)
        order = np.argsort(away, kind="stable")
        most = self.size * len(top)
        best = int(away[order[0]])
        second = int(away[order[1]]) if len(order) > 1 else most
        return self.langs[order[0]], 1 - best / most, (second - best) / most


ADDED = ("lang_pred", "score", "margin")


def _rated(docs: DataFrame, kept: list[str], names: tuple[str, ...], profiles: DataFrame, size: int) -> DataFrame:
    """Columns ``kept`` of ``docs`` and the prediction; profiles come to the driver, ``size`` rows a language."""
    known = Profiles([tuple(r) for r in profiles.select("lang", "rank", "gram").collect()], size)
    given = kept if "text" in kept else [*kept, "text"]
    at = given.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for batch in batches:
            found = [known.nearest(t.as_py()) for t in batch.column(at)]
            columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else ((), (), ()), (pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], [*kept, *names])

    bounded_batches(docs.sparkSession)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema]
    fields += [f"`{n}` {t}" for n, t in zip(names, ("string", "double", "double"))]
    return docs.select(*given).mapInArrow(run, ", ".join(fields))


def rate(docs: DataFrame, profiles: DataFrame, size: int = PROFILE, names: tuple[str, ...] = ADDED) -> DataFrame:
    """``docs`` with predicted language, closeness and lead of their ``text``; columns of these ``names`` are replaced.

    Null texts, texts without a letter, and every text if nothing was learned, are ``und`` with score 0.  Equal
    distances go to the language that is first by name.
    """
    return _rated(docs, [c for c in docs.columns if c not in names], names, profiles, size)


def predict(docs: DataFrame, profiles: DataFrame, size: int = PROFILE) -> DataFrame:
    """As :func:`rate`, but ``doc_id`` and the prediction only."""
    return _rated(docs, ["doc_id"], ADDED, profiles, size)


def fit(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Profiles, written once."""
    return saved(learn(docs, size), "profiles")
