"""Best-fit packing of token sequences, certified by lower bounds.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.  Whole pieces are sequences by themselves.
The others are dealt out by hash into groups of about ``group_rows`` rows; each group is packed by best-fit decreasing
and compared with the largest of several dual-feasible-function lower bounds.  A group whose bin count equals its bound
is certified: it gives back its emptiest bin only (no packing of this group alone is better, but a mix with others may
be).  A group with a gap gives back the emptier half of its open bins.  What comes back from all groups is dealt out
anew into fewer groups, and so on until one group is left or ``rounds`` are over.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, claim, saved, worker_cache

if TYPE_CHECKING:
    from tokenizers import Tokenizer

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", row long, sequence_id long, offset long"
#: About so many bytes of words with their ids are kept by a worker (twice, as the ones before are kept too), what a word
#: counts for, and the longest such word in bytes.
KEPT_BYTES, WORD_BYTES, LONG_WORD = 80 << 20, 200, 48
_encoders: dict[tuple, WordEncoder | TextEncoder] = worker_cache()


#: Fixed values of the tokenizer files with word ends: how they cut text, and what closes the last id of a cut.
CUTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
#: Words that keep their cuts when lower-cased and normalised: plain Latin letters, no dotted capital I, no added token.
PLAIN = regex.compile("[\x21-\u012F\u0131-\u024F--<]+", regex.V1)


class WordEncoder:
    """Ids of texts, by a tokenizer whose cuts never span white space: ids of a word are looked up once.

    New words are encoded many at a time, joined by spaces; where ids of one word stop shows in the ids that close a
    cut.  Words that are not plain Latin, and any block in which the counts differ, are encoded one by one.
    """

    def __init__(self, tokenizer: Tokenizer, most: int) -> None:
        self.tokenizer, self.most = tokenizer, most
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[n for t, n in vocabulary.items() if t.endswith(WORD_END)]] = True

    def single(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def block(self, words: list[str]) -> list[bytes]:
        """Ids of plain words."""
        cuts = np.cumsum([1 if w.isalpha() else len(CUTS.findall(w.lower())) for w in words])
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.closes[ids])
        if len(ends) != cuts[-1]:
            return self.single(words)
        stops = (4 * (ends[cuts - 1] + 1)).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def keep(self, found: dict[bytes, bytes]) -> None:
        """Remember the ids of words, but for very long ones."""
        self.known.update(found)
        self.held += WORD_BYTES * len(found)
        for w in [w for w in found if len(w) > LONG_WORD]:
            del self.known[w]

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words: those of the lower-cased word without a final comma or full stop, and those of that mark."""
        lows = [w if b"<|" in w else w.lower() for w in words]
        cores = [low[:-1] if low[-1:] in (b",", b".") and low[-2:-1].isalpha() else low for low in lows]
        known, older = self.known, self.older
        ids = {c: known.get(c) or older.get(c) for c in cores}
        ids |= {m: None for m in (b",", b".")}
        new = [c for c, held in ids.items() if held is None]
        texts = [c.decode("utf-8", "replace") for c in new]
        found = dict(zip(texts, new))
        plain = [t for t in texts if t.isascii() and "<|" not in t or PLAIN.fullmatch(t)]
        odd = list(set(texts).difference(plain))
        for some, encode in ((plain, self.block), (odd, self.single)):
            for at in range(0, len(some), 4096):
                block = some[at : at + 4096]
                ids.update(zip([found[t] for t in block], encode(block)))
        out = {w: ids[c] if len(c) == len(w) else ids[c] + ids[w[-1:]] for w, c in zip(words, cores)}
        self.keep(out)
        return out

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text: words are cut and numbered by Arrow, looked up once per batch and laid out by numpy."""
        words = pc.ascii_split_whitespace(texts)
        stops = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        if self.held > self.most:
            self.known, self.older, self.held = {b"": b""}, self.known, 0
        found = list(map(self.known.get, distinct))
        missing = [i for i, ids in enumerate(found) if ids is None]
        again = {distinct[i]: ids for i in missing if (ids := self.older.get(distinct[i])) is not None}
        self.keep(again)
        again |= self.learn([distinct[i] for i in missing if distinct[i] not in again])
        for i in missing:
            found[i] = again[distinct[i]]
        length = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        start = np.cumsum(length) - length
        pool = np.frombuffer(b"".join(found), "<u4")
        at = coded.indices.to_numpy()
        own = length[at]
        upto = np.concatenate([[0], np.cumsum(own)])
        laid = pool[np.repeat(start[at] - upto[:-1], own) + np.arange(upto[-1])]
        return np.split(laid, upto[stops[1:-1]]) if len(texts) else []


class TextEncoder:
    """Ids of texts by any tokenizer: whole texts, one after the other."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4") for t in texts.to_pylist()]


def by_words(rules: dict) -> bool:
    """Whether a tokenizer file lower-cases text, cuts it as ``CUTS`` does and marks word ends: then words can be encoded apart."""
    steps = lambda part, inner: (rules.get(part) or {}).get(inner, [rules.get(part) or {}])
    lowers = any(s.get("type") == "Lowercase" for s in steps("normalizer", "normalizers"))
    cuts = [s["pattern"].get("Regex") for s in steps("pre_tokenizer", "pretokenizers") if s.get("type") == "Split"]
    return lowers and cuts == [CUTS.pattern] and rules["model"].get("end_of_word_suffix") == WORD_END


def encoder(path: str, most: int = KEPT_BYTES) -> WordEncoder | TextEncoder:
    """One encoder per worker process and file."""
    claim(_encoders)
    if (path, most) not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _encoders[(path, most)] = WordEncoder(tokenizer, most) if by_words(json.loads(tokenizer.to_str())) else TextEncoder(tokenizer)
    return _encoders[(path, most)]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, kept_bytes: int = KEPT_BYTES, batch: str = "4m") -> DataFrame:
    """One row per piece: the ids of the text and ``end_id``, cut every ``capacity`` ids.

    ``tokenizer`` is the path of a ``tokenizers`` file that every executor can open; a worker remembers about twice
    ``kept_bytes`` of words and takes about ``batch`` bytes of text at a time, which changes its speed and memory only.  A
    null text counts as empty and gives one piece of one id.  Repeated rows give repeated pieces.  Other columns aren't read;
    an empty table gives an empty one.
    """
    import zlib

    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer, kept_bytes)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for key, found in zip(keys, words.ids(batch.column(1))):
                ids = found.tobytes() + end
                for n, at in enumerate(range(0, len(ids), width)):
                    own = ids[at : at + width]
                    rows.append((key, n, at // 4, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    bounded_batches(docs.sparkSession, batch)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(cut, PIECES)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Fewest bins any packing needs: the best of the volume bound and two families of dual feasible functions.

    For a cut ``a`` up to half a bin, items above ``capacity - a`` count as whole bins and items below ``a`` as nothing;
    for a whole ``k``, an item counts ``floor((k + 1) size / capacity) / k`` bins, or its size where that is exact.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    volume = np.concatenate([[0], np.cumsum(count * size)])
    a = np.arange(0, capacity // 2 + 1)
    middle = volume[capacity - a + 1] - volume[a]
    cuts = above[capacity - a + 1] + -(-middle // capacity)
    best = max(best, int(cuts.max()))
    for k in range(1, 21):
        steps, rest = np.divmod((k + 1) * size, capacity)
        worth = np.where(rest == 0, size * k, steps * capacity)  # in units of 1 / (k * capacity) bins
        best = max(best, -(-int((count * worth).sum()) // (k * capacity)))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item: largest first, into the fullest bin that still takes it.

    ``room`` has bit r set if an open bin has r left, so the tightest bin is the lowest bit from the item's size on.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = opened = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = room >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            chosen = open_bins[left].pop()
            if not open_bins[left]:
                room ^= 1 << left
        else:
            left, chosen = capacity, opened
            opened += 1
        bins[i], offsets[i] = chosen, capacity - left
        left -= size
        if left:
            open_bins[left].append(chosen)
            room |= 1 << left
    return bins, offsets


def _packed_group(capacity: int, number: int, last: bool):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "start", "ids_crc32", "row"], kind="stable").reset_index(drop=True)
        sizes = rows["length"].to_numpy(np.int64)
        bins, offsets = best_fit(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        back = np.zeros(len(fill), bool)
        if not last:
            emptiest = np.argsort(fill, kind="stable")
            emptiest = emptiest[fill[emptiest] < capacity]
            gap = len(fill) - lower_bound(sizes, capacity)
            back[emptiest[: 1 if gap == 0 else max(1, len(emptiest) // 2)]] = True
        rows["sequence_id"] = (number << 56) + (rows["slot"].to_numpy(np.int64) << 24) + bins
        rows["offset"] = offsets
        rows["back"] = back[bins]
        return rows.drop(columns="slot")

    return pack


def pack(pieces: DataFrame, capacity: int = 2048, group_rows: int = 20_000, rounds: int = 4) -> DataFrame:
    """Place pieces (``doc_id, piece, start, length, ids_crc32``) into sequences of at most ``capacity`` tokens.

    Adds ``sequence_id`` and ``offset``.  Repeated rows are placed one by one; an empty table gives an empty one; other
    columns are not read.  Jobs run when it is called: pieces are written once, then a table per round.
    """
    # rows are numbered, so that repeated ones are dealt out like any others
    numbered = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", F.monotonically_increasing_id().alias("row"))
    pieces = saved(numbered, "pieces")
    whole = pieces.where(F.col("length") == capacity)
    done = [
        whole.withColumn("sequence_id", F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62))).withColumn("offset", F.lit(0).cast("long"))
    ]
    rest = pieces.where(F.col("length") < capacity)
    before = None
    for number in range(rounds):
        groups = max(1, math.ceil(rest.count() / group_rows))
        if before is not None and groups >= before:
            groups = max(1, before // 2)
        before, last = groups, number == rounds - 1 or groups == 1
        dealt = rest.withColumn("slot", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups)).cast("long"))
        placed = saved(
            dealt.groupBy("slot").applyInPandas(_packed_group(capacity, number, last), PLACED + ", back boolean"), f"packed-{number}"
        )
        done.append(placed.where(~F.col("back")).drop("back"))
        rest = placed.where("back").select("doc_id", "piece", "start", "length", "ids_crc32", "row")
        if last:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("row")
