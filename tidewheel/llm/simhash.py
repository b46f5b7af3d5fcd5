"""Near-duplicates by SimHash: every two fingerprints are compared, tile by tile, with exclusive-or and bit counts.

A fingerprint has one bit per position, set where over half of a text's shingle hashes have it set.  Equal fingerprints
are one node from the start.  Nodes are laid out by the population counts of their four 16-bit quarters: two fingerprints
differ in at least as many bits as these counts differ by in sum, so tiles further apart than the radius are skipped.
With random fingerprints about one pair in twelve is left to compare; the number still grows with the square of the table.

Spark deals blocks of tiles: a block meets itself and every block its counts come near to.  Only fingerprints move, eight
bytes each, and a meeting returns the links that join something, never all pairs of a dense neighbourhood.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, claim, saved
from tidewheel.llm.components import components

#: Words in a shingle, seed of its hash, and the most bits by which linked fingerprints differ.
K, SEED, RADIUS = 4, 42, 4
#: Fingerprints of a block: a 32nd of all, so that each moves as often at every size, within these bounds.
LEAST_BLOCK, MOST_BLOCK, BLOCKS = 1 << 10, 1 << 20, 32
#: Comparisons of one numpy step, and bytes of a text whose words are in memory at once.
STEP, PIECE = 1 << 18, 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded piece at a time."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + PIECE) if start + PIECE < len(text) else None
        stop = gap.start() if gap else len(text)
        yield text[start:stop].lower().split()
        start = stop


def _hashes(words: list[bytes], k: int) -> np.ndarray:
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, stops[:-1] + 1)
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    spans = zip(starts[:n].tolist(), stops[k - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def fingerprint(text: bytes, k: int = K) -> int:
    """64 bits; a text of fewer than ``k`` words is one shingle, one without words has fingerprint zero."""
    counts, total, words = np.zeros(64, np.int64), 0, []
    for piece in _pieces(text):
        words += piece
        if len(words) >= k:
            hashes = _hashes(words, k)
            for at in range(0, len(hashes), 1 << 16):
                own = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += own.sum(axis=0, dtype=np.uint32)
            total += len(hashes)
            words = words[len(words) - k + 1 :]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, print`` (the 64 bits as a long) for every row of ``docs`` (``doc_id, text``); null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            prints = np.fromiter((fingerprint(t.as_py(), k) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, print long")


def hex_digits(print_: str) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def quarter_counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters, lowest bits first."""
    return np.bitwise_count(prints.astype("<u8").view("<u2").reshape(-1, 4)).astype(np.int16)


class Layout:
    """Blocks of tiles: neighbouring tiles share a block, a large tile has several.

    Built from the number of fingerprints per tile, at most 17 ** 4 rows.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, most: int):
        order = np.lexsort(counts.T[::-1])
        counts, sizes = counts[order], sizes[order]
        self.code = counts @ np.array([4913, 289, 17, 1])
        self.first, self.parts = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // most))
        block, held, low, high = -1, most, [], []
        for i, (tile, size, parts) in enumerate(zip(counts, sizes.tolist(), self.parts.tolist())):
            if parts > 1 or held + size > most:
                block, held = block + 1, 0
                low += [tile] * parts
                high += [tile] * parts
            self.first[i] = block
            low[-1], high[-1] = np.minimum(low[-1], tile), np.maximum(high[-1], tile)
            block, held = block + parts - 1, most if parts > 1 else held + size
        self.low, self.high = np.array(low).reshape(-1, 4), np.array(high).reshape(-1, 4)

    def block(self, prints: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.code, quarter_counts(prints) @ np.array([4913, 289, 17, 1]))
        spread = (prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[at] + (spread % self.parts[at].astype(np.uint64)).astype(np.int64)

    def near(self, block: int, radius: int) -> np.ndarray:
        """Blocks that may hold a fingerprint within the radius of one in ``block``."""
        gap = np.maximum(0, np.maximum(self.low - self.high[block], self.low[block] - self.high))
        return np.flatnonzero(gap.sum(axis=1) <= radius)


def _by_tile(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints in the order of their tiles, the tiles' counts and where they start."""
    counts = quarter_counts(prints)
    order = np.lexsort(counts.T[::-1])
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, (counts[1:] != counts[:-1]).any(axis=1))) if len(prints) else np.zeros(0, np.int64)
    return prints, counts[first], np.append(first, len(prints))


def joining_links(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Links between two lists of distinct fingerprints, no more than it takes to join all that are linked: (n, 2)."""
    xs, x_counts, x_at = _by_tile(left)
    ys, y_counts, y_at = _by_tile(right)
    y_sizes = np.diff(y_at)
    nodes, place = np.unique(np.concatenate([xs, ys]), return_inverse=True)
    x_node, y_node = place[: len(xs)], place[len(xs) :]
    label, above = np.arange(len(nodes)), {}
    found: list[tuple[int, int]] = []

    def root(c: int) -> int:
        while (up := above.get(c, c)) != c:
            above[c] = c = above.get(up, up)
        return c

    for tile, start, stop in zip(x_counts, x_at[:-1].tolist(), x_at[1:].tolist()):
        kept = np.flatnonzero(np.repeat(np.abs(y_counts - tile).sum(axis=1) <= radius, y_sizes))
        if not len(kept):
            continue
        near, near_node = ys[kept], y_node[kept]
        rows = max(1, STEP // len(near))
        for a in range(start, stop, rows):
            own = xs[a : min(stop, a + rows)]
            for b in range(0, len(near), STEP):
                hit = np.bitwise_count(own[:, None] ^ near[None, b : b + STEP]) <= radius
                if not hit.any():
                    continue
                i, j = np.nonzero(hit)
                i, j = x_node[a + i], near_node[b + j]
                p, q = label[i], label[j]
                apart = np.flatnonzero(p != q)
                if not len(apart):
                    continue
                _, once = np.unique(p[apart] * len(nodes) + q[apart], return_index=True)
                for n in apart[once].tolist():
                    u, v = root(int(p[n])), root(int(q[n]))
                    if u != v:
                        above[max(u, v)] = min(u, v)
                        found.append((int(nodes[i[n]]), int(nodes[j[n]])))
                old = np.unique(np.concatenate([p[apart], q[apart]]))
                new = np.array([root(c) for c in old.tolist()])
                changed = np.arange(len(nodes))
                changed[old] = new
                label = changed[label]
    return np.array(found, np.uint64).reshape(-1, 2)


def _dealt(prints: DataFrame, layout: Layout, radius: int) -> DataFrame:
    """``i, j, print``: each fingerprint once for every meeting of blocks (``i <= j``) that its own takes part in."""
    sent = prints.sparkSession.sparkContext.broadcast(layout)  # at most 17 ** 4 tiles, and blocks as BLOCKS bounds them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            block = sent.value.block(own.view(np.uint64))
            order = np.argsort(block, kind="stable")
            numbers, first = np.unique(block[order], return_index=True)
            for b, rows in zip(numbers.tolist(), np.split(own[order], first[1:])):
                near = sent.value.near(b, radius)
                step = max(1, (1 << 20) // len(rows))
                for at in range(0, len(near), step):
                    other = np.repeat(near[at : at + step], len(rows)).astype(np.int32)
                    columns = [np.minimum(other, b).astype(np.int32), np.maximum(other, b).astype(np.int32), np.tile(rows, len(near[at : at + step]))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "print"])

    return prints.mapInArrow(run, "i int, j int, print long")


def links(nodes: DataFrame, radius: int = RADIUS, block: int | None = None) -> DataFrame:
    """``a, b``: links among the distinct fingerprints in ``nodes`` (column ``print``), enough to join all that are linked."""
    prints = nodes.select("print")
    quarter = lambda n: F.bit_count(F.shiftrightunsigned("print", 16 * n).bitwiseAND(F.lit(0xFFFF))).alias(f"q{n}")
    tiles = prints.groupBy(*map(quarter, range(4))).count().toArrow()
    counts = np.stack([tiles[f"q{n}"].to_numpy().astype(np.int64) for n in range(4)], axis=1)
    sizes = tiles["count"].to_numpy()
    layout = Layout(counts, sizes, block or int(min(MOST_BLOCK, max(LEAST_BLOCK, sizes.sum() // BLOCKS))))
    sent = prints.sparkSession.sparkContext.broadcast(layout)

    def meet(key: tuple[int, int], rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["print"].to_numpy().view(np.uint64)
        side = sent.value.block(own)
        out = joining_links(own[side == key[0]], own[side == key[1]], radius)
        return pd.DataFrame(out.view(np.int64), columns=["a", "b"])

    return _dealt(prints, layout, radius).groupBy("i", "j").applyInPandas(meet, "a long, b long")


def near_copies(docs: DataFrame, k: int = K, radius: int = RADIUS, block: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (``doc_id, text``).

    Rows whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest id reachable.
    Texts that are null, empty or without words have fingerprint zero and are linked like any other.  Repeated rows are
    equal fingerprints.  A row without id takes part; a component of only such rows has none.  Other columns aren't read;
    an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    raw = saved(fingerprints(docs, k), "fingerprints")
    classes = saved(raw.groupBy("print").agg(F.min("doc_id").alias("rep")), "prints")
    joined = components(links(classes, radius, block), "simhash").withColumnsRenamed({"node": "print", "component": "joined"})
    placed = classes.join(joined, "print", "left").withColumn("component", F.coalesce("joined", "print"))
    named = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = placed.join(named, "component").select("print", "component_id")
    return raw.join(by_class, "print").select("doc_id", hex_digits("print").alias("fingerprint"), "component_id")
