"""Grouped prefix join: documents whose sets of word shingles are alike, as connected components.

Equal sets are one class from the start.  All sets are put into one order: tokens known to be frequent last, else by
hash.  Two sets as alike as asked share a token of their prefixes, the first ``n - ceil(t n) + 1`` tokens.  Classes of
equal size and prefix form a group, and only groups meet: under each prefix token, sorted by size.  What meets is
filtered by size and by a bound on the overlap from small counting sketches; what passes is verified on whole sets.

Dense neighbourhoods aren't enumerated.  Where few groups share a token, all pairs are tried; where many do, each is
tried against a centre of its size, and whole sets of a long list against each other in blocks of bounded size, every set
in two blocks.  Links found so far make components.  Then all pairs of a long list meet that are in different components,
but only by finer sketches; whole sets move again for those whose sketches still allow the similarity, to blocks that
return only links that join components.  No pair of different components is left untried, so the result is exact up to
collisions of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, claim, saved
from tidewheel.llm.components import components
from tidewheel.llm.idsets import bits_of, hits, places

#: Words in a shingle, and the similarity asked for, in hundredths.
K, PERCENT = 3, 90
#: A token in the first part (by hash) of more sets than this goes to the end of the order; so many such tokens at most,
#: the most frequent ones.  The order decides speed, never the result.
FREQUENT, MOST_FREQUENT = 16, 1 << 20
#: Groups under a token up to which all pairs are tried at once; whole sets, and sketches, of one side of a block.
FEW, BLOCK, MEMBERS = 16, 512, 2048
#: Tokens in a bucket of a fine sketch, at most; lists of a set that are its homes, the longest ones, and those of them in
#: which whole sets are tried at once.
FINE, HOMES, TRIED = 3, 4, 2
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word ``k``-grams of each text; a shorter text is one shingle, if it has words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    stops = split.offsets.to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in names], np.uint64)
    blank = np.array([not w for w in names], bool)
    at = coded.indices.to_numpy()
    kept = ~blank[at] if len(at) else np.zeros(0, bool)
    text = np.repeat(np.arange(len(texts)), np.diff(stops))[kept]
    words = hashes[at[kept]] if len(at) else np.zeros(0, np.uint64)
    sizes = np.bincount(text, minlength=len(texts))
    ends = np.cumsum(sizes)
    prime = np.uint64(_MIX[0])
    grams = np.zeros(len(words), np.uint64)
    for j in range(min(k, len(words))):
        grams[: len(words) - j] = grams[: len(words) - j] * prime + words[j:]
    grams = _mixed(grams)
    out = []
    for size, end in zip(sizes.tolist(), ends.tolist()):
        if size >= k:
            own = np.sort(grams[end - size : end - k + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif size:
            one = np.array([size], np.uint64)
            for w in words[end - size : end]:
                one = one * prime + w
            out.append(_mixed(one))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def needed(n: int, percent: int = PERCENT) -> int:
    """Least overlap of a set of ``n`` with any set as alike as asked."""
    return -(-percent * n // 100)


def _buckets(n: int) -> int:
    return 1 << min(12, max(4, math.ceil(math.log2(max(1, n) / 24 + 1e-9)))) if n > 24 else 16


def sketch(tokens: np.ndarray) -> bytes:
    """How many tokens fall into each of some buckets; more buckets for larger sets."""
    counts = np.bincount((tokens & np.uint64(_buckets(len(tokens)) - 1)).astype(np.int64), minlength=_buckets(len(tokens)))
    return counts.astype("<u2" if counts.max() < 1 << 16 else "<u4").tobytes()


def _counts(n: int, data: bytes) -> np.ndarray:
    b = _buckets(n)
    return np.frombuffer(data, "<u2" if len(data) == 2 * b else "<u4").astype(np.int64)


def overlap_bound(n: int, a: np.ndarray, m: int, b: np.ndarray) -> int:
    """At least the size of the intersection: sum of the smaller counts, buckets folded to the coarser sketch."""
    if len(a) > len(b):
        a = a.reshape(-1, len(b)).sum(axis=0)
    elif len(b) > len(a):
        b = b.reshape(-1, len(a)).sum(axis=0)
    return int(np.minimum(a, b).sum())


def _fine_buckets(n: int) -> int:
    return min(1 << 12, max(64, 1 << (n // FINE).bit_length()))


def fine_sketch(tokens: np.ndarray) -> bytes:
    """Like :func:`sketch`, with more buckets: it tells sets apart that are nearly as alike as asked."""
    b = _fine_buckets(len(tokens))
    counts = np.bincount((tokens & np.uint64(b - 1)).astype(np.int64), minlength=b)
    return counts.astype(next(t for t in ("<u1", "<u2", "<u4") if counts.max() <= np.iinfo(t).max)).tobytes()


class _Sketches:
    """The fine sketches of some sets, as matrices of equally many buckets."""

    def __init__(self, n: np.ndarray, data: list[bytes]) -> None:
        self.buckets = np.array([_fine_buckets(int(x)) for x in n], np.int64)
        self.data = data
        self.kind = np.min_scalar_type(int(n.max(initial=0)))  # no count is larger
        self.matrices: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, buckets: int, rows: np.ndarray) -> np.ndarray:
        """Counts of ``rows``, none of which has fewer ``buckets``."""
        if buckets not in self.matrices:
            has = np.flatnonzero(self.buckets >= buckets)
            counts = np.zeros((len(has), buckets), self.kind)
            for at, i in enumerate(has):
                own = np.frombuffer(self.data[i], f"<u{len(self.data[i]) // self.buckets[i]}")
                counts[at] = own.reshape(-1, buckets).sum(axis=0, dtype=self.kind)
            place = np.full(len(self.data), -1)
            place[has] = np.arange(len(has))
            self.matrices[buckets] = place, counts
        place, counts = self.matrices[buckets]
        return counts[place[rows]]


def overlap_bounds(a: _Sketches, i: np.ndarray, b: _Sketches, j: np.ndarray) -> np.ndarray:
    """At least the sizes of the intersections of the sets ``i`` of ``a`` and ``j`` of ``b``, pair by pair."""
    out = np.zeros(len(i), np.int64)
    buckets = np.minimum(a.buckets[i], b.buckets[j])
    for width in np.unique(buckets).tolist():
        at = np.flatnonzero(buckets == width)
        for own in np.array_split(at, -(-len(at) * width // (1 << 20))):
            out[own] = np.minimum(a.at(width, i[own]), b.at(width, j[own])).sum(axis=1, dtype=np.int64)
    return out


def _enough(overlap, n, m, percent: int):
    """Whether ``overlap / union >= percent / 100``."""
    return (100 + percent) * overlap >= percent * (n + m)


def frequent_tokens(docs: DataFrame, k: int, first_part: float) -> np.ndarray:
    """Tokens that stand in the first part, by hash, of more than ``FREQUENT`` sets; sorted, ``MOST_FREQUENT`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

        for batch in batches:
            held += [s[: int(first_part * len(s)) + 1] for s in shingle_sets(batch.column(0), k) if len(s)]
            if sum(map(len, held)) > 1 << 21:
                yield flush()
        if held:
            yield flush()

    counts = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = saved(counts.where(F.col("n") > FREQUENT), "frequent")
    # the least count that keeps the list within its bound, to a power of two
    steps = found.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, 0
    for step, n in steps:
        total += n
        if total > MOST_FREQUENT:
            least = 1 << (step + 1)
            break
    return np.sort(np.array([r[0] for r in found.where(F.col("n") >= least).select("token").collect()], np.int64).view(np.uint64))


RAW = "doc_id long, n long, node long, sig binary, prefix_key binary, prefix array<long>, sketch binary"


def _described(docs: DataFrame, frequent, k: int, percent: int) -> DataFrame:
    """What the join needs of each document's set: size, digest, prefix, sketch."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MOST_FREQUENT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        last = sent.value
        for batch in batches:
            rows = []
            for doc_id, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), k)):
                if not len(own):
                    rows.append((doc_id, 0, None, None, None, None, None))
                    continue
                data = own.tobytes()
                sig = xxhash.xxh3_128_digest(data)
                size = len(own) - needed(len(own), percent) + 1
                prefix = _prefix(own, size, last)
                rows.append(
                    (doc_id, len(own), int.from_bytes(sig[:8], "little", signed=True), sig,
                     xxhash.xxh3_128_digest(prefix.tobytes() + len(own).to_bytes(8, "little")), prefix.view(np.int64), sketch(own))
                )
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "n", "node", "sig", "prefix_key", "prefix", "sketch"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, RAW)


def _prefix(own: np.ndarray, size: int, last: np.ndarray) -> np.ndarray:
    """The first ``size`` tokens in the order: tokens of ``last`` after all others, each part by hash."""
    if not len(last):
        return own[:size]
    early: list[np.ndarray] = []
    at = found = 0
    while at < len(own) and found < size:
        step = own[at : at + max(64, 2 * (size - found))]
        at += len(step)
        place = np.minimum(np.searchsorted(last, step), len(last) - 1)
        early.append(step[last[place] != step])
        found += len(early[-1])
    first = np.concatenate(early)[:size]
    if len(first) == size:
        return first
    place = np.minimum(np.searchsorted(last, own), len(last) - 1)
    return np.append(first, own[last[place] == own][: size - len(first)])


def _meetings(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups that meet under a token, and the groups under tokens with many.

    ``postings``: ``token, n, node``.  Rows with ``b`` are pairs, rows without are members of a long list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_token, sizes, nodes = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        centre: tuple[int, int] | None = None  # of a list part of which is done

        def close(token: int, n: np.ndarray, node: np.ndarray, begun: tuple[int, int] | None, out: list) -> tuple[int, int] | None:
            if begun is None and len(n) < 2:
                return None
            if begun is None and len(n) <= FEW:
                for i in range(len(n)):
                    for j in range(i + 1, len(n)):
                        if 100 * n[i] >= percent * n[j]:
                            out.append((token, int(node[i]), int(node[j]), False))
                return None
            for size, own in zip(n.tolist(), node.tolist()):
                out.append((token, own, None, True))
                if begun is not None and 100 * begun[0] >= percent * size:
                    out.append((token, begun[1], own, True))
                else:
                    begun = (size, own)
            return begun

        def emit(out: list) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["token", "a", "b", "long"])

        for batch in batches:
            token, n, node = (c.to_numpy() for c in batch.columns)
            if not len(token):
                continue
            out: list = []
            first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            ends = np.append(first[1:], len(token))
            start = 0
            if open_token is not None:
                if token[0] == open_token:
                    sizes, nodes = np.append(sizes, n[: ends[0]]), np.append(nodes, node[: ends[0]])
                    start = 1
                    if len(first) == 1 and len(sizes) > 1 << 16:
                        centre = close(open_token, sizes, nodes, centre, out)
                        sizes, nodes = sizes[:0], nodes[:0]
                if len(first) > start:
                    close(open_token, sizes, nodes, centre, out)
                    open_token, centre = None, None
            # all but the last run are complete; single ones meet nobody
            for i in range(start, len(first) - 1):
                if ends[i] - first[i] > 1:
                    close(int(token[first[i]]), n[first[i] : ends[i]], node[first[i] : ends[i]], None, out)
            if len(first) > start:
                open_token = int(token[-1])
                sizes, nodes = n[first[-1] :].copy(), node[first[-1] :].copy()
            if out:
                yield emit(out)
        if open_token is not None:
            out = []
            close(open_token, sizes, nodes, centre, out)
            if out:
                yield emit(out)

    rows = postings.repartition("token").sortWithinPartitions("token", "n", "node").select("token", "n", "node")
    return rows.mapInArrow(run, "token long, a long, b long, long boolean")


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a, b``) whose sizes and sketches allow the similarity, with the ids of documents that hold their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            n_a, s_a, n_b, s_b = (batch.column(i).to_pylist() for i in (2, 3, 5, 6))
            for i, (n, x, m, y) in enumerate(zip(n_a, s_a, n_b, s_b)):
                if _enough(min(n, m), n, m, percent) and _enough(overlap_bound(n, _counts(n, x), m, _counts(m, y)), n, m, percent):
                    kept.append(i)
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([own.column(i) for i in (0, 1, 4, 7)], ["a", "b", "a_doc", "b_doc"])

    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"), F.col("rep").alias(f"{x}_doc"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where((100 + percent) * F.least("n_a", "n_b") >= percent * (F.col("n_a") + F.col("n_b")))
    return both.select("a", "b", "n_a", "s_a", "a_doc", "n_b", "s_b", "b_doc").mapInArrow(run, "a long, b long, a_doc long, b_doc long")


def _sets(docs: DataFrame, wanted: DataFrame, k: int, name: str) -> DataFrame:
    """``node, tokens``: whole sets of the nodes in ``wanted`` (``node, doc``), worked out again from their texts.

    A bit filter over the ids of documents that hold them keeps the other texts from moving.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bits_of(wanted, "doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = hits(bits.value, batch.column(1).to_numpy(), batch.column(2).to_numpy())
            texts = batch.column(0).filter(pa.array(hit))
            sets = [s for s in shingle_sets(texts, k) if len(s)] if len(texts) else []
            nodes = [int.from_bytes(xxhash.xxh3_128_digest(s.tobytes())[:8], "little", signed=True) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "tokens"]
            )

    sets = docs.select("text", *places(F.col("doc_id"))).mapInArrow(run, "node long, tokens array<long>")
    return saved(sets.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), f"{name}-sets")


def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (``a, b``) that are as alike as asked, by their whole sets; ``a_doc`` and ``b_doc`` name their documents."""
    pairs = saved(pairs, "pairs")
    ends = F.array(*(F.struct(F.col(x).alias("node"), F.col(f"{x}_doc").alias("doc")) for x in "ab"))
    sets = _sets(docs, pairs.select(F.inline(ends)).distinct(), k, "pair")
    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    both = both.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    alike = (100 + percent) * common >= percent * (F.size("x") + F.size("y"))
    return saved(both.where(alike).select("a", "b"), "links")


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``, or else of ``left``, as products of
    incidence matrices."""
    sets = [*left, *(right or ())]
    distinct, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[column] > 1
    number = np.cumsum(times > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    others = slice(0 if right is None else len(left), None)
    out = np.zeros((len(left), len(sets[others])), np.float32)
    width = 4096
    for start in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        out += part[: len(left)] @ part[others].T
    return out


def _block_links(percent: int):
    """Links between the two sides of a block that join components which nothing in the block has joined yet.

    A block without ``left`` is one of sets that are compared with each other.
    """

    def links(block: pd.DataFrame) -> pd.DataFrame:
        sided = "left" in block
        xs, ys = (block[block["left"]], block[~block["left"]]) if sided else (block, block)
        found: list[tuple[int, int]] = []
        c_x, c_y = xs["component"].to_numpy(), ys["component"].to_numpy()
        if len(xs) and len(ys) and (c_x.min() != c_y.max() or c_x.max() != c_y.min()):
            n_x, n_y = xs["tokens"].map(len).to_numpy(), ys["tokens"].map(len).to_numpy()
            common = overlaps(list(xs["tokens"]), list(ys["tokens"]) if sided else None)
            alike = _enough(common, n_x[:, None], n_y[None, :], percent)
            v_x, v_y = xs["node"].to_numpy(), ys["node"].to_numpy()
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while (above := parent.get(c, c)) != c:
                    parent[c] = c = parent.get(above, above)
                return c

            for i, j in zip(*(z.tolist() for z in np.nonzero(alike & (c_x[:, None] != c_y[None, :])))):
                a, b = root(int(c_x[i])), root(int(c_y[j]))
                if a != b:
                    parent[a] = b
                    found.append((int(v_x[i]), int(v_y[j])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return links


def _lists(met: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``list, group`` of the lists in which sets of groups still have to meet, and the ``homes`` of each ``group``.

    They are the long lists of groups under a token; groups of several sets in none of these, whose sets meet each other;
    and two groups that met under a short list, if one has several sets, as only their first sets have been compared.
    """
    long_lists = met.where("b IS NULL").select(F.col("token").alias("list"), F.col("a").alias("group"))
    sizes = long_lists.groupBy("list").agg(F.count("*").alias("m"))
    ordered = F.sort_array(F.collect_list(F.struct("m", "list")), asc=False)  # as many as a prefix has tokens, at most
    homes = long_lists.join(sizes, "list").groupBy("group").agg(F.transform(F.slice(ordered, 1, HOMES), lambda x: x["list"]).alias("homes"))
    several = members.where("members > 1").select("group").distinct()
    own = several.join(homes, "group", "left_anti").select(F.xxhash64(F.lit("group"), "group").alias("list"), "group")
    pairs = met.where("NOT long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    with_several = lambda x: pairs.join(several.select(F.col("group").alias(x)), x, "left_semi").select("a", "b")
    short = with_several("a").unionByName(with_several("b")).distinct()
    short = short.select(F.xxhash64(F.lit("pair"), "a", "b").alias("list"), F.explode(F.array("a", "b")).alias("group"))
    lists = saved(long_lists.unionByName(own).unionByName(short), "lists")
    return lists, homes.unionByName(own.select("group", F.array("list").alias("homes")))


def _tried(listed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between sets that share a home, tried in blocks; a set is in ``TRIED`` blocks at most."""
    placed = listed.select("node", F.explode(F.slice("homes", 1, TRIED)).alias("home"))
    sizes = placed.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("b"), F.count("*").alias("m")).where("m > 1").drop("m")
    dealt = placed.join(sizes, "home").select("home", F.pmod(F.xxhash64("node", "home"), "b").alias("i"), "node", F.col("node").alias("component"))
    return dealt.join(sets, "node").groupBy("home", "i").applyInPandas(_block_links(percent), "a long, b long")


def _block_suspects(percent: int):
    """Sets of a block that are in a pair of different components whose sizes and fine sketches allow the similarity.

    ``left`` is true for the one whose component is smaller.  Two sets with homes in common are tried in the first of them only.
    """

    def suspects(block: pd.DataFrame) -> pd.DataFrame:
        this = int(block["list"].iat[0])
        alone = block["i"].iat[0] == block["j"].iat[0]
        block = block.sort_values("n", kind="stable")
        n, c, w, node = (block[x].to_numpy() for x in ("n", "component", "weight", "node"))
        homes = [() if h is None else h for h in block["homes"]]
        codes, home = np.unique(np.array([this, *(x for h in homes for x in h)], np.int64), return_inverse=True)
        at = home[0]
        table, start = np.full((len(n), HOMES), -1), 1
        for row, h in zip(table, homes):
            row[: len(h)] = home[start : start + len(h)]
            start += len(h)
        sketches = _Sketches(n, list(block["fine"]))
        left = np.flatnonzero(block["left"].to_numpy())
        right = left if alone else np.flatnonzero(~block["left"].to_numpy())
        found = np.zeros((2, len(n)), bool)
        for begin in range(0, len(left), 128):
            x = left[begin : begin + 128]
            low = np.searchsorted(n[right], -(-percent * n[x[0]] // 100))
            y = right[max(low, begin + 1 if alone else 0) : np.searchsorted(n[right], 100 * n[x[-1]] // percent, "right")]
            untried = (c[x][:, None] != c[y]) & _enough(np.minimum(n[x][:, None], n[y]), n[x][:, None], n[y], percent)
            if alone:
                untried &= x[:, None] < y
            common, before = np.zeros((2, *untried.shape), bool)
            for a in table[x].T:
                for b in table[y].T:
                    same = (a[:, None] == b) & (a >= 0)[:, None]
                    common |= same
                    before |= same & (a < at)[:, None]
            here = (table[x] == at).any(axis=1)[:, None] & (table[y] == at).any(axis=1)
            i, j = np.nonzero(untried & ~np.where(here, before, common))
            i, j = x[i], y[j]
            alike = _enough(overlap_bounds(sketches, i, sketches, j), n[i], n[j], percent)
            i, j = i[alike], j[alike]
            smaller = (w[i] < w[j]) | (w[i] == w[j]) & (c[i] < c[j])
            found[0, np.where(smaller, i, j)] = found[1, np.where(smaller, j, i)] = True
        side, row = np.nonzero(found)
        return pd.DataFrame({"list": np.full(len(row), this), "node": node[row], "left": side == 0})

    return suspects


def _crowded(listed: DataFrame, lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that the first round left apart, among the sets of a list.

    All pairs of a list that is in several components meet by their fine sketches, in blocks.  Whole sets then move for
    suspects only: those of smaller components on one side of a block, those of larger ones on the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for batch in batches:
            stops, tokens = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy().view(np.uint64)
            fine = [fine_sketch(tokens[a:b]) for a, b in zip(stops[:-1], stops[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fine, pa.binary())], ["node", "fine"])

    fine = sets.select("node", "tokens").mapInArrow(run, "node long, fine binary")
    listed = saved(listed.select("node", "n", "group", "homes", "component", "weight").join(fine, "node"), "fine")
    spread = lists.join(listed.select("group", "component"), "group").groupBy("list").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / MEMBERS).cast("int").alias("b")
    ).where("low < high").select("list", "b")
    own = lambda b: F.pmod(F.xxhash64("node", "list"), F.col(b)).cast("int")
    every = lambda b: F.explode(F.sequence(F.lit(0), F.col(b) - 1))
    met = lists.join(spread, "list").join(listed, "group").select("*", own("b").alias("own"), every("b").alias("other"))
    met = met.select(
        "list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("left"),
        "node", "n", "component", "weight", "homes", "fine",
    )
    suspects = met.groupBy("list", "i", "j").applyInPandas(_block_suspects(percent), "list long, node long, left boolean")
    suspects = saved(suspects.distinct(), "suspects")
    blocks = lambda left: F.ceil(F.count_if(F.col("left") == left) / BLOCK).cast("int")
    sizes = suspects.groupBy("list").agg(blocks(True).alias("b_left"), blocks(False).alias("b_right"))
    dealt = suspects.join(sizes, "list").join(listed.select("node", "component"), "node")
    side = lambda left, i, j: dealt.where(F.col("left") == left).select("list", "node", "component", "left", i.alias("i"), j.alias("j"))
    dealt = side(True, own("b_left"), every("b_right")).unionByName(side(False, every("b_left"), own("b_right")))
    return dealt.join(sets, "node").groupBy("list", "i", "j").applyInPandas(_block_links(percent), "a long, b long")


def link(docs: DataFrame, k: int = K, percent: int = PERCENT, batch: str = "4m") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``).

    Documents whose sets have ``100 * intersection >= percent * union`` are linked, and ``component_id`` is the smallest
    id reachable by links.  Null and empty texts have size 0 and stay alone.  Repeated rows are equal sets like any
    other; a row without id takes part, and a component of only such rows has none.  Other columns are not read; an empty
    table gives an empty one.  Workers take about ``batch`` bytes of rows at a time.
    """
    bounded_batches(docs.sparkSession, batch)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    raw = saved(_described(docs, frequent_tokens(docs, k, 1.4 * (100 - percent) / 100), k, percent), "described")
    some = raw.where("n > 0")
    classes = saved(
        some.groupBy("n", "sig").agg(
            F.first("node").alias("node"), F.min("doc_id").alias("rep"), F.first("prefix_key").alias("prefix_key"), F.first("sketch").alias("sketch")
        ), "classes",
    )
    # groups of equal size and prefix, named by one of their classes
    groups = some.groupBy("n", "prefix_key").agg(F.min("node").alias("node"), F.first("prefix").alias("prefix"))
    met = saved(_meetings(groups.select("n", "node", F.explode("prefix").alias("token")), percent), "meetings")
    named = classes.groupBy("n", "prefix_key").agg(F.min("node").alias("group"), F.count("*").alias("members"))
    members = saved(classes.join(named, ["n", "prefix_key"]).select("node", "n", "group", "members"), "members")
    group_pairs = met.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "long")
    within = members.where("node <> group").select(F.least("node", "group").alias("a"), F.greatest("node", "group").alias("b"))
    tried = group_pairs.select("a", "b").unionByName(within).distinct()
    links = _verified(_bounded(tried, classes, percent), docs, k, percent)
    lists, homes = _lists(met, members)
    in_lists = members.join(lists.select("group").distinct(), "group", "left_semi").join(homes, "group", "left")
    listed = saved(in_lists.join(classes.select("node", "rep"), "node"), "listed")
    sets = _sets(docs, listed.select("node", F.col("rep").alias("doc")), k, "listed")
    found = components(links.unionByName(saved(_tried(listed, sets, percent), "tried-links")), "first-components")
    placed = saved(members.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "placed")
    weights = placed.groupBy("component").agg(F.count("*").alias("weight"))
    more = saved(_crowded(listed.join(placed.join(weights, "component"), "node"), lists, sets, percent), "crowd-links")
    every = placed.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    final = components(every.unionByName(more), "last-components")
    labelled = classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = labelled.join(named, "component").select("n", "sig", "component_id")
    out = raw.select("doc_id", "n", "sig").join(by_class, ["n", "sig"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
