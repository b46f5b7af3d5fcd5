"""Chat formatting by columnar byte assembly.

Turns are sorted by conversation across the cluster.  In a task, all turns of an Arrow batch are assembled at once: the
lengths of all segments (markers, roles, texts) give their offsets by one running sum, and contents are copied by
scatter indices into one preallocated buffer, which becomes the data of an Arrow string array.  A conversation that
spans batches or tasks gives several pieces, in order of (part, piece).

Every turn is ``<|turn|>role<|says|>text<|over|>``.  Control strings inside roles and texts, the template's own and
common foreign ones, get a backslash after their first character, and one more if some stand there already; taking one
off restores the text exactly, and no control string is left inside.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches

TURN, SAYS, OVER = "<|turn|>", "<|says|>", "<|over|>"
#: Control strings that may not stand in a formatted role or text.
CONTROLS = (
    TURN, SAYS, OVER, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|system|>", "<|user|>", "<|assistant|>", "<|startoftext|>", "<|endoftext|>",
)
_RESTS = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
ESCAPE = rf"([<\[])(\\*)({_RESTS})"
UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?=(?:{_RESTS}))")
PIECES = "conv_id long, part int, piece int, n_turns int, formatted string, loss_start array<int>, loss_length array<int>"
TURNS = "conv_id long, part int, piece int, place int, role string, text string, loss string"
SPAN_BYTES = 4 << 20


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=ESCAPE, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and where each value starts in them (one more than values)."""
    texts = texts.cast(pa.large_string()) if len(texts) else pa.array([], pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All turns as one byte buffer, the start of each turn in it (one more than turns) and of each text."""
    n = len(roles)
    marks = [np.frombuffer(m.encode(), np.uint8) for m in (TURN, SAYS, OVER)]
    role_data, role_at = _bytes(roles)
    text_data, text_at = _bytes(texts)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = map(len, marks)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths)
    starts = (ends - lengths.ravel()).reshape(n, 5)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    for column, mark in zip((0, 2, 4), marks):
        out[starts[:, column, None] + np.arange(len(mark))] = mark
    for column, data, at in ((1, role_data, role_at), (3, text_data, text_at)):
        own = lengths[:, column]
        total = int(own.sum())
        if total:
            # where the first byte of each value goes, less where it comes from
            moved = np.repeat(starts[:, column] - at[:-1], own)
            source = np.arange(at[0], at[0] + total)
            out[source + moved] = data[source]
    return out, np.append(starts[:, 0], len(out)), starts[:, 3]


def format_chat(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Format ``conv_id, turn, role, text`` rows; other columns are not read.

    Null roles and texts count as empty; rows without ``conv_id`` are one conversation of their own; a null turn comes
    first; turns with equal numbers follow each other by role and text, and repeated rows are kept.  Output rows are
    pieces of conversations: ``formatted``, with the byte ranges of ``loss_roles`` texts in it as ``loss_start`` and
    ``loss_length``.  Range partitioning splits a hot conversation over tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, piece = None, 0
        for batch in batches:
            roles, texts = escape(batch.column(1)), escape(batch.column(2))
            size = pc.add(pc.binary_length(roles), pc.binary_length(texts)).to_numpy(zero_copy_only=False).astype(np.int64)
            spans = np.cumsum(size) // SPAN_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(spans)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                conv = batch.column(0)[a:b]
                keys = conv.fill_null(0).to_numpy()
                missing = conv.is_null().to_numpy(zero_copy_only=False)
                fresh = np.append(True, (keys[1:] != keys[:-1]) | (missing[1:] != missing[:-1]))
                first = np.flatnonzero(fresh)
                buffer, at, text_at = assemble(roles[a:b], texts[a:b])
                offsets = at[np.append(first, b - a)]
                formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(buffer)).cast(pa.string())
                under = pc.is_in(batch.column(1)[a:b], pa.array(loss_roles, pa.string())).to_numpy(zero_copy_only=False)
                group = np.cumsum(fresh) - 1
                per = np.append(0, np.cumsum(np.bincount(group[under], minlength=len(first)))).astype(np.int32)
                text_len = np.diff(_bytes(texts[a:b])[1])
                start = (text_at - offsets[group])[under].astype(np.int32)
                ids = conv.take(pa.array(first))
                pieces = np.zeros(len(first), np.int32)
                same = (ids[0].as_py(),) == last
                piece = piece + 1 if same else 0
                pieces[0] = piece
                last = (ids[-1].as_py(),)
                piece = int(pieces[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.full(len(first), part, np.int32)), pa.array(pieces),
                        pa.array(np.diff(np.append(first, b - a)).astype(np.int32)), formatted,
                        pa.ListArray.from_arrays(pa.array(per), pa.array(start)),
                        pa.ListArray.from_arrays(pa.array(per), pa.array(text_len[under].astype(np.int32))),
                    ],
                    ["conv_id", "part", "piece", "n_turns", "formatted", "loss_start", "loss_length"],
                )

    bounded_batches(turns.sparkSession)
    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"), F.col("turn").cast("long").alias("turn"),
    )
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PIECES)


def parse_piece(formatted: str, starts: list[int], lengths: list[int]) -> Iterator[tuple[str, str, str | None]]:
    """``role, text, loss`` of each turn of a piece, unescaped; ``loss`` is what the mask covers of it, or None."""
    data = formatted.encode()
    masked = iter(zip(starts, lengths))
    mask, at = next(masked, None), 0
    for turn in formatted.split(OVER)[:-1]:
        head, text = turn[len(TURN) :].split(SAYS, 1)
        at += len(turn.encode()) + len(OVER)
        loss = None
        if mask is not None and mask[0] < at:
            loss = unescape(data[mask[0] : mask[0] + mask[1]].decode())
            mask = next(masked, None)
        yield unescape(head), unescape(text), loss


def read_chat(pieces: DataFrame) -> DataFrame:
    """The turns that :func:`format_chat` wrote, read back from its pieces: ``role, text, loss`` by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("place", pa.int32()),
             ("role", pa.string()), ("text", pa.string()), ("loss", pa.string())]
        )
        for batch in batches:
            rows: list[tuple] = []
            for conv, part, piece, text, starts, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(conv, part, piece, n, *turn) for n, turn in enumerate(parse_piece(text, starts, lengths))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 7, schema)], schema=schema)

    return pieces.select("conv_id", "part", "piece", "formatted", "loss_start", "loss_length").mapInArrow(run, TURNS)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation: digests over what is read back from its pieces, in order.

    A digest runs over a whole conversation, so one task follows it, piece by piece and in constant memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
             ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        )
        open_key: tuple | None = None
        n = loss_chars = chars = 0
        turns, losses = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            rows: list[tuple] = []
            for conv, text, starts, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                if open_key != (conv,):
                    if open_key is not None:
                        rows.append((*open_key, n, turns.hexdigest(), loss_chars, losses.hexdigest(), chars))
                    open_key, n, loss_chars, chars = (conv,), 0, 0, 0
                    turns, losses = hashlib.sha256(), hashlib.sha256()
                for role, said, loss in parse_piece(text, starts, lengths):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                    if loss is not None:
                        loss_chars += len(loss)
                        losses.update(loss.encode())
                chars += len(text)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 6, schema)], schema=schema)
        if open_key is not None:
            row = (*open_key, n, turns.hexdigest(), loss_chars, losses.hexdigest(), chars)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    bounded_batches(pieces.sparkSession)
    return (
        pieces.select("conv_id", "part", "piece", "formatted", "loss_start", "loss_length")
        .repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
        .select("conv_id", "formatted", "loss_start", "loss_length").mapInArrow(run, DIGESTS)
    )
