"""Sets of ids as bit filters of fixed size, to keep rows from moving that need not."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A filter has 2 ** BITS bits (8 MB), however many ids there are; two of them are set per id.
BITS = 26


def places(id_: Column) -> list[Column]:
    """The two bits of an id."""
    return [F.shiftrightunsigned(F.xxhash64(id_, F.lit(seed)), 64 - BITS) for seed in (1, 2)]


def bits_of(ids: DataFrame, id_: str) -> np.ndarray:
    """The filter of a column of ids, put together by Spark word by word."""
    bit = F.col("bit").bitwiseAND(F.lit(63)).cast("int")
    words = ids.select(F.explode(F.array(*places(F.col(id_)))).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")
    )
    out = np.zeros(1 << (BITS - 6), np.int64)
    rows = words.toArrow()
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def hits(words: np.ndarray, *at: np.ndarray) -> np.ndarray:
    """Whether all given bits are set."""
    out = np.ones(len(at[0]), bool)
    for p in at:
        out &= (words[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def without(docs: DataFrame, dropped: DataFrame, id_: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``dropped`` (distinct ids); rows without id stay.

    Only rows the filter cannot clear are joined, so the others are not shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bits_of(dropped, id_))

    @F.pandas_udf("boolean")
    def perhaps(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(hits(sent.value, first.to_numpy(), second.to_numpy()))

    found = perhaps(*places(F.col(id_)))
    return docs.where(~found).unionByName(docs.where(found).join(dropped.select(id_), id_, "left_anti").select(*docs.columns))
