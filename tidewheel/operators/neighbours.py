"""Exact nearest neighbours inside groups, without comparing every pair of a group.

Space is cut into cells by a k-d tree grown on a bounded hash sample; a cell is what one call searches, and there its
vectors are cut again, into leaves.  Every query first searches the leaf nearest to it, which bounds the distance to its
k-th neighbour, then the leaves of its cell that this ball touches.  It is sent only to those other cells that the
ball, narrowed by then, still touches.  Equal vectors are merged with their count beforehand, so copies cannot pile up
in a cell.  Cells that attract many queries are served by several tasks, each with its own copy of the cell.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.session import parallelism, shared_dir

#: Vectors of the sample for each cell, and at most for each of ``max_cells``.
SAMPLE_PER_CELL, LEAST_SAMPLE = 64, 8
CELL_ROWS = 8_192
QUERIES_PER_TASK = 50_000
BLOCK = 1 << 20


class CellTree:
    """One k-d tree per group, flattened: inner nodes hold a cut, cells hold a box."""

    def __init__(self, dims: int) -> None:
        self.roots: dict[str | None, int] = {}
        self.cut_dim: list[int] | np.ndarray = []
        self.cut_at: list[float] | np.ndarray = []
        self.children: list[tuple[int, int]] | np.ndarray = []
        self.low: list[np.ndarray] | np.ndarray = []
        self.high: list[np.ndarray] | np.ndarray = []
        self.dims = dims

    def grow(self, group: str | None, sample: np.ndarray, depth: int) -> None:
        self.roots[group] = self._node(sample, depth, np.full(self.dims, -np.inf), np.full(self.dims, np.inf))

    def _node(self, points: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray) -> int:
        node = len(self.children)
        self.cut_dim.append(0)
        self.cut_at.append(0.0)
        self.children.append((-1, -1))
        self.low.append(low)
        self.high.append(high)
        spread = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(self.dims)
        dim = int(np.argmax(spread))
        if depth == 0 or spread[dim] == 0:
            return node
        ordered = np.sort(points[:, dim])
        cut = ordered[(len(ordered) - 1) // 2]
        if cut == ordered[-1]:
            cut = ordered[ordered < cut][-1]
        below = points[:, dim] <= cut
        left_high, right_low = high.copy(), low.copy()
        left_high[dim] = right_low[dim] = cut
        left = self._node(points[below], depth - 1, low, left_high)
        right = self._node(points[~below], depth - 1, right_low, high)
        self.cut_dim[node], self.cut_at[node], self.children[node] = dim, float(cut), (left, right)
        return node

    def packed(self) -> CellTree:
        """The same as arrays, which are sent to the workers."""
        for name in ("cut_dim", "cut_at", "children", "low", "high"):
            setattr(self, name, np.array(getattr(self, name)))
        return self

    def locate(self, group: str | None, points: np.ndarray) -> np.ndarray:
        """Cell of each point; a group without a tree is a cell of its own, numbered below zero by its name."""
        if group not in self.roots:
            return np.full(len(points), -1 - zlib.crc32((group or "").encode()), dtype=np.int64)
        out = np.empty(len(points), dtype=np.int64)
        todo = [(self.roots[group], np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            left, right = self.children[node]
            if left < 0:
                out[rows] = node
            elif len(rows):
                below = points[rows, self.cut_dim[node]] <= self.cut_at[node]
                todo += [(left, rows[below]), (right, rows[~below])]
        return out

    def touched(self, group: str | None, own: int, points: np.ndarray, radius2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``points``, other cell of the group) such that the cell's box has a point within the row's ball."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        todo = [(self.roots[group], np.arange(len(points)))] if group in self.roots else []
        while todo:
            node, rows = todo.pop()
            left, right = self.children[node]
            if left < 0:
                if node != own:
                    rows = rows[gaps(points[rows], self.low[node][None], self.high[node][None])[:, 0] <= radius2[rows]]
                    found.append((rows, np.full(len(rows), node, np.int64)))
            elif len(rows):
                away = points[rows, self.cut_dim[node]] - self.cut_at[node]
                near = away * away <= radius2[rows]
                todo += [(left, rows[(away <= 0) | near]), (right, rows[(away >= 0) | near])]
        return tuple(map(np.concatenate, zip(*found)))


def gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point from every box, added up as :func:`Leaves._squares` does, so never above that of a point in it."""
    total = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        at = points[:, d, None]
        gap = np.maximum(np.maximum(low[:, d] - at, at - high[:, d]), 0.0)
        gap *= gap
        total += gap
    return total


class Leaves:
    """The points of a cell, cut into leaves of ``leaf_rows`` at most by halving their widest side."""

    def __init__(self, points: np.ndarray, copies: np.ndarray, leaf_rows: int) -> None:
        # by vector, so that equal distances are settled alike in every cell
        order = np.lexsort(points.T[::-1])
        self.points, self.copies = points[order], copies[order]
        parts, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf_rows:
                parts.append(rows)
                continue
            side = self.points[rows]
            half = np.argpartition(side[:, int(np.argmax(np.ptp(side, axis=0)))], len(rows) // 2)
            todo += [rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]]
        self.rows = np.full((len(parts), max(map(len, parts))), -1)
        for i, rows in enumerate(parts):
            self.rows[i, : len(rows)] = rows
        self.low = np.stack([self.points[rows].min(axis=0) for rows in parts])
        self.high = np.stack([self.points[rows].max(axis=0) for rows in parts])

    def _squares(self, points: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """Squared distances of each point from the rows of its leaf."""
        rows = self.rows[leaves]
        total = np.where(rows < 0, np.inf, 0.0)
        for d in range(points.shape[1]):
            delta = points[:, d, None] - self.points[rows, d]
            delta *= delta
            total += delta
        return total

    def _best(self, query: np.ndarray, row: np.ndarray, square: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per query the nearest rows that cover k+1 copies, equal distances by row; and whether a row completes them."""
        order = np.lexsort((row, square, query))
        query, row, square = query[order], row[order], square[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
        copies = self.copies[row]
        upto = np.cumsum(copies)
        before = upto - copies - np.repeat(upto[first] - copies[first], np.diff(np.r_[first, len(query)]))
        kept = before <= k
        return query[kept], row[kept], square[kept], (before + copies > k)[kept]

    def nearest(self, queries: np.ndarray, radius2: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Blocks of (query, row, squared distance, whether k+1 copies are covered with this row), nearest rows first.

        For each query they are the nearest rows within its ball that cover k+1 copies (itself included).
        """
        step = max(1, BLOCK // len(self.rows))
        pairs = max(1, BLOCK // self.rows.shape[1])
        for start in range(0, len(queries), step):
            points, radius = queries[start : start + step], radius2[start : start + step].copy()
            gap = gaps(points, self.low, self.high)
            own = np.argmin(gap, axis=1)
            best = tuple(np.empty(0, t) for t in (np.int64, np.int64, float, bool))
            for nearest_leaf in (True, False):
                if nearest_leaf:
                    asked, leaves = np.arange(len(points)), own
                else:
                    near = gap <= radius[:, None]
                    near[np.arange(len(points)), own] = False
                    asked, leaves = np.nonzero(near)
                for at in range(0, len(asked), pairs):
                    some, leaf = asked[at : at + pairs], leaves[at : at + pairs]
                    square = self._squares(points[some], leaf)
                    i, j = np.nonzero((square <= radius[some, None]) & (self.rows[leaf] >= 0))
                    new = some[i], self.rows[leaf[i], j], square[i, j]
                    best = self._best(*(np.concatenate(both) for both in zip(best[:3], new)), k)
                    done = best[3]
                    radius[best[0][done]] = best[2][done]
            yield (best[0] + start, *best[1:])


_FOUND = "array<struct<d:double,vec:array<double>,m:bigint>>"


def _matrix(vectors: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows; a null component counts as not a number."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return pc.fill_null(vectors.flatten(), float("nan")).to_numpy(zero_copy_only=False).reshape(len(vectors), dims)


def _lists(points: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1) * points.shape[1], pa.int32()), pa.array(points.ravel()))


def _offsets(of: np.ndarray, n: int) -> pa.Array:
    """Where the entries of each of ``n`` rows start, for entries in order of the row they are ``of``."""
    return pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())


def _found(leaves: Leaves, query: np.ndarray, row: np.ndarray, square: np.ndarray, n: int) -> pa.Array:
    fields = [pa.array(square), _lists(leaves.points[row]), pa.array(leaves.copies[row])]
    return pa.ListArray.from_arrays(_offsets(query, n), pa.StructArray.from_arrays(fields, ["d", "vec", "m"]))


def nearest_in_group(
    df: DataFrame, group: str, vector: str, wanted: str, k: int = 5, leaf_rows: int = 64, max_cells: int = 65_536,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Rows (group, vector, neighbours) for every distinct vector with at least one row where ``wanted`` is true.

    ``neighbours`` lists the vectors of the k nearest other rows of the same group, nearest first, a vector repeated
    once per copy; it is shorter when the group has fewer rows.  Equal distances go by vector.  A vector with a null or
    non-finite component has no neighbours and is none; a null group is one like any other.  Only a sample of at most
    ``max_cells * 8`` vectors reaches the driver.  The merged vectors and the first search are checkpointed, since
    several later steps read them.
    """
    spark = df.sparkSession
    shared_dir(spark)
    g, v = F.col(group).cast("string"), F.col(vector)
    merged = df.groupBy(g.alias("_g"), v.alias("vec")).agg(
        F.count(F.lit(1)).alias("m"), F.max(wanted).alias("query")
    ).checkpoint()
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    usable = merged.where(finite)
    total = usable.count()
    tree = _grow(usable, total, max(cell_rows, 2 * k + 2), max_cells)
    dims, least = tree.dims, max(leaf_rows, 2 * k + 2)
    # so few tasks that a small table isn't torn into empty ones; what a task gets doesn't follow from bytes
    tasks = min(parallelism(spark), max(1, 2 * total // cell_rows + 1))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("vec"), dims)
            names = batch.column("_g").dictionary_encode(null_encoding="encode")
            codes, cell = names.indices.to_numpy(), np.empty(batch.num_rows, dtype=np.int64)
            for code, name in enumerate(names.dictionary.to_pylist()):
                rows = np.flatnonzero(codes == code)
                cell[rows] = tree.locate(name, points[rows])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    placed = usable.mapInArrow(assign, "_g string, vec array<double>, m bigint, query boolean, cell bigint")

    def search_own(rows: pa.Table) -> pa.Table:
        points = _matrix(rows["vec"], dims)
        asked = points[pc.fill_null(rows["query"], False).to_numpy(zero_copy_only=False).astype(bool)]
        name, cell = rows["_g"][0].as_py(), rows["cell"][0].as_py()
        leaves = Leaves(points, rows["m"].to_numpy(), least)
        tables = []
        for query, row, square, done in leaves.nearest(asked, np.full(len(asked), np.inf), k):
            own, at = np.unique(query, return_inverse=True)
            radius = np.full(len(own), np.inf)
            radius[at[done]] = square[done]
            visitor, other = tree.touched(name, cell, asked[own], radius)
            order = np.lexsort((other, visitor))
            visit = pa.ListArray.from_arrays(_offsets(visitor[order], len(own)), pa.array(other[order]))
            tables.append(pa.table({
                "_g": pa.array([name] * len(own), pa.string()), "vec": _lists(asked[own]), "found": _found(leaves, at, row, square, len(own)),
                "visit": visit, "radius": radius,
            }))
        return pa.concat_tables(tables) if tables else _OWN.empty_table()

    own = placed.repartition(tasks, "_g", "cell").groupBy("_g", "cell").applyInArrow(
        search_own, f"_g string, vec array<double>, found {_FOUND}, visit array<bigint>, radius double"
    ).checkpoint()
    visits = own.select("_g", "vec", "radius", F.explode("visit").alias("cell"))
    # a row per cell
    load = F.broadcast(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).alias("shares")))
    asked = visits.join(load, "cell").withColumn("share", F.pmod(F.xxhash64("vec"), F.col("shares")))
    served = placed.join(load, "cell").withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)))

    def search_visited(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return _VISITED.empty_table()
        leaves = Leaves(_matrix(rows["vec"], dims), rows["m"].to_numpy(), least)
        vectors, name, tables = _matrix(queries["vec"], dims), queries["_g"][0].as_py(), []
        for query, row, square, _ in leaves.nearest(vectors, queries["radius"].to_numpy(), k):
            hit, at = np.unique(query, return_inverse=True)
            tables.append(pa.table({
                "_g": pa.array([name] * len(hit), pa.string()), "vec": _lists(vectors[hit]), "found": _found(leaves, at, row, square, len(hit)),
            }))
        return pa.concat_tables(tables)

    visited = (
        asked.select("cell", "share", "_g", "vec", "radius").repartition(tasks, "cell", "share").groupBy("cell", "share")
        .cogroup(served.select("cell", "share", "vec", "m").repartition(tasks, "cell", "share").groupBy("cell", "share"))
        .applyInArrow(search_visited, f"_g string, vec array<double>, found {_FOUND}")
    )
    # the query itself is one of the copies at distance 0
    others = lambda c, me: F.when((c["d"] == 0) & (c["vec"] == me), c["m"] - 1).otherwise(c["m"])
    away = F.size("visit") > 0
    merged_found = (
        own.where(away).select("_g", "vec", "found")
        .unionByName(visited)
        .groupBy("_g", "vec")
        .agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    )
    alone = merged.where(~finite & F.col("query")).select("_g", "vec", F.array().cast(_FOUND).alias("found"))
    ranked = own.where(~away).select("_g", "vec", "found").unionByName(merged_found).unionByName(alone)
    neighbours = F.slice(
        F.flatten(
            F.transform("found", lambda c: F.array_repeat(c["vec"], F.least(others(c, F.col("vec")), F.lit(k)).cast("int")))
        ),
        1,
        k,
    )
    return ranked.select(F.col("_g").alias(group), F.col("vec").alias(vector), neighbours.alias("neighbours"))


_VECTOR = pa.list_(pa.float64())
_VISITED = pa.schema({
    "_g": pa.string(), "vec": _VECTOR, "found": pa.list_(pa.struct({"d": pa.float64(), "vec": _VECTOR, "m": pa.int64()})),
})
_OWN = _VISITED.append(pa.field("visit", pa.list_(pa.int64()))).append(pa.field("radius", pa.float64()))


def _grow(merged: DataFrame, total: int, cell_rows: int, max_cells: int) -> CellTree:
    """A tree per group, from vectors with small hashes; a group too small to be among them needs none.

    Rows that cannot be in the sample are filtered out by their hash before anything moves, so about twice the sample
    is all that is ordered, however many partitions there are.
    """
    cells = int(min(max_cells, max(1, -(-total // cell_rows))))
    wanted = min(cells * SAMPLE_PER_CELL, max_cells * LEAST_SAMPLE)
    place = F.pmod(F.xxhash64("_g", "vec"), F.lit(1 << 40))
    share = min(1.0, (2 * wanted + 100) / max(1, total))
    picked = (
        merged.select("_g", "vec", place.alias("place"))
        .where(F.col("place") <= int((1 << 40) * share))
        .orderBy("place", "_g", "vec")
        .limit(wanted)
        .toPandas()
    )
    tree = CellTree(len(picked["vec"].iloc[0]) if len(picked) else 1)
    for name, rows in picked.groupby("_g", dropna=False):
        count = cells * len(rows) / len(picked)
        if count >= 2:
            tree.grow(name if isinstance(name, str) else None, np.stack(rows["vec"]), int(np.ceil(np.log2(count))))
    return tree.packed()


def feature_vector(columns: Sequence[str]):
    return F.array(*(F.col(c).cast("double") for c in columns))
