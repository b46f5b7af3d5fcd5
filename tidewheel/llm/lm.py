"""N-gram language model in Elias-Fano tries.

Tokens are words and one end mark per document.  Level 1 holds the hashes of all words in order; the place of a hash is
the word's number.  Level k holds one key per distinct n-gram of k words: the number of its first k - 1 words in level
k - 1 (its context) times the vocabulary's size plus the number of its last word.  Keys rise, so a level is an
Elias-Fano sequence, and looking an n-gram up is a successor search among the keys of its context.  Counting: tasks sort
and merge the keys of their own texts, Spark deals them out by ranges of keys, and one task merges and writes a shard.
Ranges are cut by how often contexts occur, within a context too, so no shard gets more than ``shard_tokens`` tokens'
worth of keys, whatever word is frequent.

Probabilities are interpolated by absolute discounting: a level stores ``(count - d) / count of the context`` of each
n-gram and ``d * distinct successors / count of the context`` of each context, as sixteen bits each, rounded down on a
scale that reaches the smallest probability the level can hold; so what follows a context never adds up to more than 1.
Level 1 gives words never seen the share that words seen once have (one outcome, as the add-one base has it); counts there
are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, claim, saved, worker_cache
from tidewheel.llm.elias_fano import EliasFano, load, pack, save
from tidewheel.session import run_dir

#: The number of the hash that stands for the end of a text; hashes of words have 62 bits.
END = (1 << 62) - 1
#: Tokens whose keys make one shard, and keys a task collects before it passes them on.
SHARD_TOKENS, HELD_KEYS = 4_000_000, 2_500_000
#: Steps of a stored probability: sixteen bits on a logarithmic scale down to 10 ** -FLOOR, or further where counts ask for it.
FLOOR, STEPS = 7.0, (1 << 16) - 1
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def scale(tokens_total: int, discount: float) -> float:
    """Decades that reach down to the smallest probability of a level: no context counts more than all tokens."""
    return max(FLOOR, math.log10(max(1, tokens_total) / min(discount, 1 - discount)))


def quantised(p: np.ndarray, decades: float) -> np.ndarray:
    """0 for nothing, else 1 to ``STEPS`` by logarithm, rounded down."""
    with np.errstate(divide="ignore"):
        step = np.floor(STEPS + np.log10(np.maximum(p, 1e-300)) * ((STEPS - 1) / decades) + 1e-9)
    return np.where(p > 0, np.clip(step, 1, STEPS), 0).astype(np.uint16)


def probabilities(steps: np.ndarray, decades: float) -> np.ndarray:
    """What :func:`quantised` has stored."""
    return np.where(steps > 0, 10.0 ** ((steps.astype(float) - STEPS) * (decades / (STEPS - 1))), 0.0)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order (``END`` last), the place in them of each token, and how many tokens each text has.

    Every text is closed by ``END``.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    stops = split.offsets.to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([min(digest(w) >> 2, END - 1) for w in names], np.int64)
    distinct, place = np.unique(np.append(hashes, END), return_inverse=True)
    blank = np.array([not w for w in names], bool)
    at = coded.indices.to_numpy()
    kept = ~blank[at] if len(at) else np.zeros(0, bool)
    text = np.repeat(np.arange(len(texts)), np.diff(stops))[kept]
    sizes = np.bincount(text, minlength=len(texts)) + 1
    out = np.full(int(sizes.sum()), len(distinct) - 1, np.int64)
    out[np.arange(len(text)) + text] = place[at[kept]]
    return distinct, out, sizes


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)


def distinct_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and which each is: by a table where they lie close together, else by sorting."""
    if not len(values) or int(values.max()) - int(values.min()) > 8 * len(values):
        return np.unique(values, return_inverse=True)
    low = int(values.min())
    seen = np.zeros(int(values.max()) - low + 1, bool)
    seen[values - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[values - low]


def _blob(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Keys as differences and counts, in few bytes."""
    import zstandard

    width = lambda a: np.dtype(f"<u{1 if a <= 255 else 2 if a <= 65_535 else 4 if a < 1 << 32 else 8}")
    gaps = np.diff(keys, prepend=0)
    planes = np.ascontiguousarray(gaps.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    kind = width(int(counts.max()) if len(counts) else 0)
    head = np.array([len(keys), kind.itemsize], "<i8").tobytes()
    # most counts are one and most high bytes of gaps are zero; low bytes are noise, which the fast level skips
    return zstandard.ZstdCompressor(level=1).compress(head + planes.tobytes() + counts.astype(kind).tobytes())


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    n, width = np.frombuffer(data, "<i8", 2).tolist()
    planes = np.frombuffer(data, np.uint8, 8 * n, 16).reshape(8, n).T
    gaps = np.ascontiguousarray(planes).view("<i8").ravel()
    return np.cumsum(gaps), np.frombuffer(data, np.dtype(f"<u{width}"), n, 16 + 8 * n).astype(np.int64)


@dataclass
class Level:
    """Where the shards of a level are; bounds are small, one number per shard."""

    paths: list[str]
    bounds: np.ndarray  # the smallest key a shard may hold
    offsets: np.ndarray  # the number of its first key
    discount: float = 0.0
    decades: float = FLOOR  # that the stored probabilities reach down
    edges: dict[int, float] = field(default_factory=dict)  # weight left to shorter contexts, of contexts cut by a bound


@dataclass
class Trie:
    levels: list[Level]
    words: int  # distinct
    total: int  # tokens
    once: int  # words seen once


class Reader:
    """A trie opened by a worker; shards are mapped when they are first needed."""

    def __init__(self, trie: Trie) -> None:
        self.trie = trie
        self.open: dict[str, tuple[dict[str, np.ndarray], EliasFano, EliasFano | None]] = {}

    def shard(self, path: str) -> tuple[dict[str, np.ndarray], EliasFano, EliasFano | None]:
        if path not in self.open:
            arrays = load(path)
            parts = lambda p: {k.removeprefix(p): v for k, v in arrays.items() if k.startswith(p)}
            contexts = parts("context_")
            self.open[path] = arrays, EliasFano(parts("key_")), EliasFano(contexts) if contexts else None
        return self.open[path]

    def _by_shard(self, level: Level, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Slices of rising ``keys`` by the shard that would hold them."""
        cuts = np.searchsorted(keys, level.bounds[1:])
        edges = [0, *cuts.tolist(), len(keys)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                yield i, slice(a, b)

    def find(self, number: int, keys: np.ndarray, column: str | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For rising distinct keys of a level: the number of each (or -1), and its value in ``column`` (none: zero)."""
        level = self.trie.levels[number]
        places, values = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for i, own in self._by_shard(level, keys):
            arrays, sequence, _ = self.shard(level.paths[i])
            at, there = sequence.find(keys[own] - level.bounds[i])
            places[own] = np.where(there, at + level.offsets[i], -1)
            if column:
                found = np.zeros(len(at), np.int64)
                found[there] = arrays[column][at[there]]
                values[own] = found
        return places, values

    def weights(self, number: int, contexts: np.ndarray) -> np.ndarray:
        """What contexts (rising, distinct) leave to shorter ones; 1 for a context without successors."""
        level, out = self.trie.levels[number], np.ones(len(contexts))
        for i, own in self._by_shard(level, contexts * self.trie.words):
            arrays, _, sequence = self.shard(level.paths[i])
            at, there = sequence.find(contexts[own] - level.bounds[i] // self.trie.words)
            found = np.ones(len(at))
            found[there] = probabilities(arrays["left"][at[there]], level.decades)
            out[own] = found
        if level.edges:
            cut = np.array(sorted(level.edges), np.int64)
            at = np.minimum(np.searchsorted(cut, contexts), len(cut) - 1)
            same = cut[at] == contexts
            out[same] = np.array([level.edges[int(c)] for c in contexts[same]])
        return out

    def numbers(self, distinct: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of each token."""
        numbers, counts = self.find(0, distinct, "count")
        return numbers[place], counts[place]

    def grams(self, word: np.ndarray, upto: int, column: str | None = None) -> Iterator[tuple]:
        """Level by level from the second: the context of each token (-1: none), and the n-grams that tokens make.

        ``word`` numbers the tokens (-1: unknown), each text closed by the end mark; the first follows an end.  Yields the
        level, contexts, tokens with a context and a known word, their distinct keys, which key each has, and the keys'
        values in ``column``; each key is searched once.
        """
        before = np.append(self.end, word[:-1])
        context = before.copy()
        for number in range(1, upto + 1):
            own = np.flatnonzero((context >= 0) & (word >= 0))
            keys, back = distinct_places(context[own] * self.trie.words + word[own])
            places, values = self.find(number, keys, column) if column or number < upto else (None, None)
            yield number, context, own, keys, back, values
            if number < upto:
                longer = np.full(len(word), -1, np.int64)
                longer[own] = places[back]
                # the next context ends with the token before; nothing reaches back over an end
                context = np.append(-1, longer[:-1])
                context[before == self.end] = -1

    @property
    def end(self) -> int:
        if not hasattr(self, "_end"):
            self._end = int(self.find(0, np.array([END]), "count")[0][0])
        return self._end


_readers: dict[str, Reader] = worker_cache()


def _reader(trie: Trie) -> Reader:
    key = trie.levels[-1].paths[0] if trie.levels and trie.levels[-1].paths else ""
    claim(_readers)
    if key not in _readers:
        _readers.clear()
        _readers[key] = Reader(trie)
    return _readers[key]


def _dealt(docs: DataFrame, trie: Trie | None, number: int, bounds: np.ndarray) -> DataFrame:
    """``shard, blob``: the keys of level ``number`` (0: words) in all texts, merged per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            keys, counts = summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            held.clear()
            cuts = [0, *np.searchsorted(keys, bounds[1:]).tolist(), len(keys)]
            rows = [(i, _blob(keys[a:b], counts[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "blob"])

        for batch in batches:
            distinct, place, _ = tokens(batch.column(0))
            if number == 0:
                counts = np.bincount(place, minlength=len(distinct))
                held.append((distinct[counts > 0], counts[counts > 0]))
            else:
                reader = _reader(trie)
                for level, _, _, keys, back, _ in reader.grams(reader.numbers(distinct, place)[0], number):
                    if level == number:
                        held.append((keys, np.bincount(back, minlength=len(keys))))
            if sum(len(k) for k, _ in held) > HELD_KEYS:
                yield from flush()
        yield from flush()

    return docs.select("text").mapInArrow(run, "shard int, blob binary")


def _merged(dealt: DataFrame, name: str) -> DataFrame:
    """One row per shard: its distinct keys with counts, and sums over them."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_unblob(b) for b in rows["blob"]]
        keys, counts = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        return pd.DataFrame(
            {"shard": [rows["shard"].iloc[0]], "blob": [_blob(keys, counts)], "n": [len(keys)], "tokens": [int(counts.sum())],
             "once": [int((counts == 1).sum())], "twice": [int((counts == 2).sum())], "first": [int(keys[0])], "last": [int(keys[-1])]}
        )

    kinds = "shard int, blob binary, n long, tokens long, once long, twice long, first long, last long"
    return saved(dealt.groupBy("shard").applyInPandas(merge, kinds), name)


def _even(tokens_total: int, shard_tokens: int) -> int:
    return max(1, -(-tokens_total // shard_tokens))


def train(docs: DataFrame, order: int = 2, shard_tokens: int = SHARD_TOKENS) -> Trie:
    """Count all ``text`` of ``docs`` and write a trie of ``order`` levels below the shared folder.

    A null text counts as empty: one end mark.  An empty table gives a trie without words.  What comes to the driver is a
    few numbers per shard.
    """
    spark = docs.sparkSession
    bounded_batches(spark, "6m")
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    folder = run_dir(spark, "trie")
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = _even((size[0] or 0) // 6 + size[1], shard_tokens)
    bounds = np.array([(i << 62) // shards for i in range(shards)], np.int64)
    merged = _merged(_dealt(docs, None, 0, bounds), "words")
    level, rows = _level(merged, bounds, folder, 0, 1, {}, 0.0)
    trie = Trie([level], sum(r["n"] for r in rows), sum(r["tokens"] for r in rows), sum(r["once"] for r in rows))
    for number in range(1, order):
        if not trie.total:
            break
        bounds = _cuts(trie, rows, number, _even(trie.total, shard_tokens))
        merged = _merged(_dealt(docs, trie, number, bounds), f"grams-{number}")
        rows = sorted((r.asDict() for r in merged.drop("blob").collect()), key=lambda r: r["shard"])
        once, twice = sum(r["once"] for r in rows), sum(r["twice"] for r in rows)
        discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
        cut = sorted({int(b // trie.words) for b in bounds[1:]})  # contexts that a bound may divide
        edges = _edge_sums(merged, cut, trie.words) if cut else {}
        level, rows = _level(merged, bounds, folder, number, trie.words, edges, discount, scale(trie.total, discount))
        trie.levels.append(level)
    return trie


def _cuts(trie: Trie, rows: list[dict], number: int, shards: int) -> np.ndarray:
    """Bounds of the next level: keys below which about equal numbers of tokens lie.

    The keys of a context lie between its number and the next one's, times the vocabulary; the words after it have
    numbers by hash, so a share of a context's range holds that share of its distinct successors.
    """
    level, upto = trie.levels[-1], np.cumsum([0] + [r["tokens"] for r in rows])
    bounds = [0]
    for i in range(1, shards):
        goal = upto[-1] * i // shards
        s = int(np.searchsorted(upto, goal, side="right")) - 1
        arrays = load(level.paths[rows[s]["shard"]])
        counts = np.cumsum(arrays["count"].astype(np.int64))
        at = int(np.searchsorted(counts, goal - upto[s], side="right"))
        before = int(counts[at - 1]) if at else 0
        share = (goal - upto[s] - before) / max(1, int(counts[min(at, len(counts) - 1)]) - before)
        context = int(level.offsets[rows[s]["shard"]]) + at
        bounds.append(context * trie.words + int(share * trie.words))
    return np.maximum.accumulate(np.array(bounds, np.int64))


def _edge_sums(merged: DataFrame, cut: list[int], words: int) -> dict[int, tuple[int, int]]:
    """Distinct successors and their count, of contexts cut by a bound: at most one per shard."""
    wanted = np.array(cut, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blob in batch.column(0):
                keys, counts = _unblob(blob.as_py())
                context = keys // words
                for c in wanted[(wanted >= context[0]) & (wanted <= context[-1])].tolist():
                    a, b = np.searchsorted(context, [c, c + 1])
                    rows.append((c, int(b - a), int(counts[a:b].sum())))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["context", "n", "tokens"])

    sums = merged.select("blob").mapInArrow(run, "context long, n long, tokens long").groupBy("context").sum("n", "tokens")
    return {r[0]: (r[1], r[2]) for r in sums.collect()}


def _level(
    merged: DataFrame, bounds: np.ndarray, folder: str, number: int, words: int, edges: dict[int, tuple[int, int]], discount: float,
    decades: float = FLOOR,
) -> tuple[Level, list[dict]]:
    """Write the shards of a level, each by one task; an absent shard is written empty."""

    def write(shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
        base = int(bounds[shard])
        arrays = {f"key_{k}": v for k, v in pack(keys - base).items()}
        kind = np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64
        if number == 0:
            arrays["count"] = counts.astype(kind)
        else:
            context = keys // words
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(keys) else np.zeros(0, np.int64)
            distinct = context[first]
            n = np.diff(np.append(first, len(keys)))
            total = np.add.reduceat(counts, first) if len(keys) else np.zeros(0, np.int64)
            for c, (all_n, all_tokens) in edges.items():
                at = np.flatnonzero(distinct == c)
                n[at], total[at] = all_n, all_tokens
            arrays |= {f"context_{k}": v for k, v in pack(distinct - base // words).items()}
            arrays["share"] = quantised((counts - discount) / np.repeat(total, np.diff(np.append(first, len(keys)))), decades)
            arrays["left"] = quantised(discount * n / total, decades)
            arrays["count"] = counts.astype(kind)
        save(f"{folder}/level{number}-{shard}", arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for shard, blob in zip(*(c.to_pylist() for c in batch.columns)):
                write(shard, *_unblob(blob))
                done.append(shard)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int32())], ["shard"])

    written = merged.select("shard", "blob").mapInArrow(run, "shard int").collect()
    rows = {r["shard"]: r.asDict() for r in merged.drop("blob").collect()}
    none = np.zeros(0, np.int64)
    for shard in set(range(len(bounds))) - {r[0] for r in written}:
        write(shard, none, none)
    sizes = [rows[i]["n"] if i in rows else 0 for i in range(len(bounds))]
    left = {c: float(discount * n / t) for c, (n, t) in edges.items()}
    level = Level([f"{folder}/level{number}-{i}" for i in range(len(bounds))], bounds, np.cumsum([0, *sizes[:-1]]), discount, decades, left)
    return level, [rows[i] for i in sorted(rows)]


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` for every row of ``docs`` (``doc_id, text``).

    ``score`` is the log10 probability of all tokens of a text, end mark included; ``base_score`` that of an add-one
    unigram model.  A null text counts as empty.  With an empty trie every token is unknown and certain.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(trie)
        rare = min(0.5, max(trie.once / max(1, trie.total), 1 / (trie.total + trie.words + 1)))
        for batch in batches:
            distinct, place, sizes = tokens(batch.column(1))
            word, count = reader.numbers(distinct, place)
            base = np.log10((count + 1) / (trie.total + trie.words + 1))
            # a word never seen is one outcome; from every context it gets what that leaves to shorter ones
            p = np.where(word >= 0, count / max(1, trie.total) * (1 - rare), rare) if trie.total else np.ones(len(word))
            for number, context, own, _, back, shares in reader.grams(word, len(trie.levels) - 1, "share") if trie.total else ():
                given = np.flatnonzero(context >= 0)
                contexts, of = distinct_places(context[given])
                p[given] *= reader.weights(number, contexts)[of]
                p[own] += probabilities(shares, trie.levels[number].decades)[back]
            text = np.repeat(np.arange(len(sizes)), sizes)
            sums = [np.bincount(text, weights=x, minlength=len(sizes)) for x in (base, np.log10(np.minimum(p, 1.0)))]
            known = np.bincount(text, weights=count > 0, minlength=len(sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(known), pa.array(sums[0]), pa.array(sums[1])],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    bounded_batches(docs.sparkSession, "6m")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCORED)

