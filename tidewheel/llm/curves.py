"""Approximate nearest neighbours along shifted space-filling curves.

Each of several curves projects the vectors to a few random directions, shifts them by a random offset, lays a grid over
them and numbers its cells along a Hilbert curve.  Rows are range-partitioned by (curve, cell number) and get their
positions in that order; a query looks at the ``window`` positions on both sides of its own, on every curve, with exact
inner products, and the curves' finds are merged.  Inner products become distances by one more coordinate that brings
all candidates to the length of the longest one.

Equal vectors are one class, so that copies cannot fill a window; a class is searched once and its members are put in
afterwards.  Work per query is ``curves * 2 * window`` products.  A window of fixed size finds less and less as a table
grows, so the window is measured: for some queries the true neighbours are worked out over all vectors, and the window is
as large as it takes to hold the share ``RECALL`` of them on one curve or another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, by_hash, saved
from tidewheel.session import parallelism

#: Curves, directions per curve, bits per direction, and positions looked at on each side at least.
CURVES, DIRECTIONS, BITS, REACH = 12, 6, 8, 2_500
#: Vectors that place and scale the grids (those whose ids have the smallest hashes), and where random numbers start.
SAMPLE, SEED = 10_000, 7
#: Queries (those whose ids have the smallest hashes) whose true neighbours set the window, and the share it has to hold.
CHECKED, RECALL = 100, 0.93
#: Finds kept beyond those asked for before they are ranked by exact sums.
SPARE = 12


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Number along the Hilbert curve of each row of ``cells`` (integers of ``bits`` bits), as an int64."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:  # undo the rotations of all coarser cells
        below = level - 1
        for i in range(len(x)):
            inverted = (x[i] & level) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(inverted, x[0] ^ below, x[0] ^ swapped)
            if i:
                x[i] = x[i] ^ swapped
        level >>= 1
    for i in range(1, len(x)):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    flip, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        flip = np.where((x[-1] & level) != 0, flip ^ (level - 1), flip)
        level >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for part in x:
            key = (key << 1) | (((part ^ flip) >> bit) & 1)
    return key


class Grid:
    """Directions, shifts and scale of all curves, placed by a sample."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int, directions: int, bits: int) -> None:
        rng = np.random.default_rng(SEED)
        d = sample.shape[1] + 1
        self.longest, self.bits, self.directions = longest, bits, min(directions, d)
        self.axes = np.stack([np.linalg.qr(rng.standard_normal((d, d)))[0][:, : self.directions] for _ in range(curves)])
        shifts = rng.uniform(-0.5, 0.5, (curves, self.directions))
        seen = np.einsum("nd,cdk->cnk", self.lifted(sample), self.axes)
        spread = np.maximum(seen.std(axis=1).mean(axis=1), 1e-12)[:, None]
        self.start = seen.mean(axis=1) - spread * (3.5 + shifts)
        self.step = 7.0 * spread / (1 << bits)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0.0)
        return np.column_stack([vectors, np.sqrt(rest)])

    def aimed(self, vectors: np.ndarray) -> np.ndarray:
        """Queries at the length of the longest candidate, without a further coordinate."""
        return np.column_stack([vectors * (self.longest / np.linalg.norm(vectors, axis=1))[:, None], np.zeros(len(vectors))])

    def keys(self, points: np.ndarray) -> Iterator[np.ndarray]:
        top = (1 << self.bits) - 1
        for axes, start, step in zip(self.axes, self.start, self.step):
            yield hilbert(np.clip(np.floor((points @ axes - start) / step), 0, top).astype(np.int64), self.bits)


def _usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of rows that take part, components as doubles."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0)).distinct()
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0][0] if sizes else 0))


def _double(data) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<f8") for x in data])


def _search_block(most: int, reach: int):
    """Of one block of positions, the best ``most`` candidates of each query that stand within its reach."""

    def search(block: pd.DataFrame) -> pd.DataFrame:
        queries, rows = block[block["query"]], block[~block["query"]].sort_values("position", kind="stable")
        if not len(queries) or not len(rows):
            return pd.DataFrame({"q": np.zeros(0, np.int64), "c": np.zeros(0, np.int64), "score": np.zeros(0)})
        x, position, ids = _double(rows["data"]), rows["position"].to_numpy(), rows["class_id"].to_numpy()
        out: list[tuple] = []
        for own, data, at in zip(queries["class_id"], queries["data"], queries["position"]):
            a, b = np.searchsorted(position, [at - reach, at + reach + 1])
            q = np.frombuffer(data, "<f8")
            near = x[a:b] @ q
            if len(near) > most + SPARE:
                some = np.argpartition(-near, most + SPARE)[: most + SPARE]
            else:
                some = np.arange(len(near))
            # the order of a matrix product's sums may differ from block to block; this one does not
            exact = (x[a:b][some] * q).sum(axis=1)
            for i in np.lexsort((ids[a:b][some], -exact))[:most].tolist():
                out.append((own, int(ids[a + some[i]]), float(exact[i])))
        q, c, score = zip(*out) if out else ((), (), ())
        return pd.DataFrame({"q": np.array(q, np.int64), "c": np.array(c, np.int64), "score": np.array(score, float)})

    return search


def _needed_reach(classes: DataFrame, positioned: DataFrame, most: int) -> int:
    """Positions on each side that hold the share ``RECALL`` of the true neighbours of some queries.

    What comes to the driver is bounded: ``CHECKED`` queries, ``most`` neighbours of each, and their positions.
    """
    asked = by_hash(classes.where("query"), CHECKED, "class_id").select("class_id", "v").collect()
    ids, x = np.array([r[0] for r in asked], np.int64), np.array([r[1] for r in asked], float)
    if not len(ids):
        return 0

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            score = np.array(batch.column(1).to_pylist(), float) @ x.T
            score[own[:, None] == ids[None, :]] = -np.inf
            top = np.argpartition(-score, min(most, len(own)) - 1, axis=0)[:most]
            q = np.broadcast_to(ids, top.shape).ravel()
            best, c = np.take_along_axis(score, top, axis=0).ravel(), own[top].ravel()
            kept = best > -np.inf
            yield pa.RecordBatch.from_arrays([pa.array(q[kept]), pa.array(c[kept]), pa.array(best[kept])], ["q", "c", "score"])

    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    found = classes.select("class_id", "v").mapInArrow(nearest, "q long, c long, score double")
    true = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= most).select("q", "c").toPandas()
    if not len(true):
        return 0
    wanted = classes.sparkSession.createDataFrame([(int(i),) for i in np.union1d(true["q"], true["c"])], "class_id long")
    at = positioned.join(F.broadcast(wanted), "class_id").select("curve", "class_id", "query", "position").toPandas()
    queries, others = (at[at["query"] == kind].drop(columns="query").rename(columns={"class_id": x}) for kind, x in ((True, "q"), (False, "c")))
    pairs = true.merge(queries, on="q").merge(others, on=["c", "curve"], suffixes=("_q", "_c"))
    gaps = (pairs["position_q"] - pairs["position_c"]).abs().groupby([pairs["q"], pairs["c"]]).min()
    return int(np.quantile(gaps, RECALL, method="higher"))


def search(
    vectors: DataFrame, is_query: Column, most: int = 20, curves: int = CURVES, directions: int = DIRECTIONS, reach: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``most`` rows with the largest inner product found.

    ``vectors`` has ``vec_id, embedding``; ``is_query`` is a condition on ``vec_id``.  Every row but the query's own is a
    candidate; equal scores go by ``vec_id``.  Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows without id and vectors of another size than most have; repeated rows count once.  Other columns
    are not read; an empty table gives an empty one.  Without ``reach`` it is ``REACH``, or more where that holds too few
    of the true neighbours of some queries.
    """
    spark = vectors.sparkSession
    rows = saved(_usable(vectors), "vectors")
    classes = rows.groupBy("v").agg(F.min("vec_id").alias("class_id"), F.max(is_query).alias("query"))
    classes = saved(classes.select("class_id", "query", "v"), "vector-classes")
    longest = classes.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    result = "query_id long, rank int, vec_id long, score double"
    if longest is None:
        return spark.createDataFrame([], result)
    sample = by_hash(classes, SAMPLE, "class_id").select("v").toArrow()["v"].to_pylist()
    grid = Grid(np.array(sample), float(longest), curves, directions, BITS)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.array(batch.column(2).to_pylist(), float)
            ids, asked = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            data = pa.array([x.tobytes() for x in v], pa.binary())
            for query in (False, True):
                kept = np.flatnonzero(asked) if query else np.arange(len(v))
                if not len(kept):
                    continue
                points = grid.aimed(v[kept]) if query else grid.lifted(v)
                take = pa.array(kept)
                for curve, keys in enumerate(grid.keys(points)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(kept), curve, np.int32)), pa.array(keys), ids.take(take), pa.array(np.full(len(kept), query)), data.take(take)],
                        ["curve", "key", "class_id", "query", "data"],
                    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            candidate = ~batch.column(2).to_numpy(zero_copy_only=False)
            upto = np.cumsum(candidate)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(done + upto - candidate)],
                ["curve", "class_id", "query", "data", "part", "place"],
            )
            done += int(upto[-1]) if len(upto) else 0

    bounded_batches(spark)
    order = ["curve", "key", "class_id", "query"]
    numbered = classes.select("class_id", "query", "v").mapInArrow(number, "curve int, key long, class_id long, query boolean, data binary")
    lined = numbered.repartitionByRange(2 * parallelism(spark), *order).sortWithinPartitions(*order)
    lined = saved(lined.select("curve", "class_id", "query", "data").mapInArrow(place, "curve int, class_id long, query boolean, data binary, part int, place long"), "lined")
    # one count per partition turns places into positions along all curves
    counts = dict(lined.where("NOT query").groupBy("part").count().collect())
    starts = [0]
    for part in range(max(counts, default=0) + 1):
        starts.append(starts[-1] + counts.get(part, 0))
    first = spark.createDataFrame(list(enumerate(starts)), "part int, first long")
    position = F.col("first") + F.col("place")
    # one row per partition
    positioned = lined.join(F.broadcast(first), "part").select("curve", "class_id", "query", "data", position.alias("position"))
    if reach is None:
        reach = max(REACH, _needed_reach(classes, positioned, most)) if starts[-1] > curves * REACH else REACH
    width = 4 * min(reach, REACH)
    block = F.floor(F.col("position") / width).cast("long")
    reached = F.sequence(F.floor((F.col("position") - reach) / width).cast("long"), F.floor((F.col("position") + reach) / width).cast("long"))
    # blocks have the same size however far queries reach: a query goes to all that it reaches into
    dealt = positioned.select("*", F.explode(F.when(F.col("query"), reached).otherwise(F.array(block))).alias("block"))
    finds = dealt.groupBy("curve", "block").applyInPandas(_search_block(most + 1, reach), "q long, c long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    nearest = finds.distinct().withColumn("r", F.row_number().over(best)).where(F.col("r") <= most + 1).select("q", "c", "score")
    # members of the classes found: no more of a class than could be asked for
    by_id = Window.partitionBy("v").orderBy("vec_id")
    members = rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= most + 1)
    members = members.select(F.min("vec_id").over(Window.partitionBy("v")).alias("c"), "vec_id")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = nearest.join(members, "c").withColumn("r", F.row_number().over(best)).where(F.col("r") <= most + 1)
    lists = lists.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    asked = rows.where(is_query).join(classes.where("query").select("v", F.col("class_id").alias("q")), "v").select("q", F.col("vec_id").alias("query_id"))
    own = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, most)
    return asked.join(lists, "q").select("query_id", F.posexplode(own).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )
