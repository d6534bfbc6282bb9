"""Exact top-k by integer inner product: a Voronoi join of queries and data.

Components become ``floor(scale * x)`` as 64-bit integers. Pivots, the centres of a bounded sample, cut space into Voronoi
cells of queries and of data. With p the pivot of a query q at a distance of at most R from it, any data row s has
``p.s - R|s| <= q.s <= p.s + R|s|``, and a cell of data has such bounds as a whole:

1. Summaries of the cells: how many queries each has and how far they reach (R); how far its data rows reach and the
   largest norm among them; and, of all data rows, the k + 1 highest lower bounds against each cell of queries.
2. Bounds: every query of a cell has k rows other than its own that score at least the (k + 1)-th of these lower bounds.
   Cells of data whose upper bound is less are of no use to the cell, nor are single rows whose upper bound is less.
3. Replication: cells are merged into groups of near cells with a bounded number of queries (a larger cell is split). A
   data row is sent only to groups with a cell that may need it.
4. Local solution: the rows of a group are dealt into blocks of bounded bytes, each block is multiplied with the group's
   queries, and the best k of the blocks are merged.

Summaries have a row per pivot, whatever the input. Where cells are wide, as among random vectors of many dimensions, the
bounds exclude little; the result is exact all the same, and what a task holds stays bounded.

Vectors that are null or hold a null or non-finite component take no part. Vectors of other lengths count as padded with
zeros, the empty one too. Every row is a vector of its own, whether its id is null (never a query; last among ties) or
shared. Integers and scores beyond 64 bits saturate. No vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.store import bounded_batches, kept
from tablegate.llm.text import mix

PIVOTS = 128
SAMPLE_ROWS = 4096  # pivots are fitted on at most as many rows; every row is searched
BLOCK_BYTES = 4 << 20  # of the vectors that one task multiplies, and of the queries it holds
SLACK = 1e-6  # of what bounds are made of; they are off by far less
LEAST, MOST = -(1 << 62), (1 << 62) - 1


def integers(df: DataFrame, vectors: str, scale: float) -> DataFrame:
    """Rows with ``ints``, the vector as little-endian 64-bit integers, and ``dims``; other columns but vectors stay."""
    x = F.transform(F.col(vectors), lambda v: v.cast("double"))
    odd = F.exists("__x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.withColumn("__x", x).filter(F.col("__x").isNotNull()).filter(~odd).drop(vectors)
    names = [c for c in rows.columns if c != "__x"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(names))
            flat = column.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(column.offsets.to_numpy().astype(np.int64))
            body = np.clip(np.floor(scale * flat), LEAST, MOST).astype("<i8")
            offsets = np.concatenate([[0], np.cumsum(lengths * 8)]).astype(np.int64)
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
            extra = [packed.cast(pa.binary()), pa.array(lengths.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *extra], [*names, "ints", "dims"])

    return bounded_batches(rows.select(*names, "__x")).mapInArrow(run, f"{kinds}, ints binary, dims int")


def matrix(column: pa.Array | list[bytes], width: int = 0) -> np.ndarray:
    """Vectors as rows of integers, padded with zeros to the longest one or to width."""
    bodies = column if isinstance(column, list) else column.to_pylist()
    lengths = {len(b) for b in bodies}
    width = max([width, *(n // 8 for n in lengths)])
    if lengths == {width * 8}:
        return np.frombuffer(b"".join(bodies), "<i8").reshape(len(bodies), width)
    return np.frombuffer(b"".join(b + bytes(width * 8 - len(b)) for b in bodies), "<i8").reshape(len(bodies), width)


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Integer inner products of two matrices; in floating point only where that is exact."""
    most = [float(np.abs(m.astype(float)).max(initial=0)) for m in (queries, data)]
    bound = most[0] * most[1] * max(1, queries.shape[1])
    if bound < 2**53:
        return (queries.astype(float) @ data.astype(float).T).astype(np.int64)
    if bound < 2**63:
        return queries @ data.T
    exact = queries.astype(object) @ data.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


class Space:
    """The pivots of a table, and where its vectors lie."""

    def __init__(self, sample: np.ndarray, pivots: int = PIVOTS) -> None:
        self.width = sample.shape[1]
        points = np.unique(sample, axis=0).astype(float)
        draw = np.random.default_rng(7)
        centres = points[np.sort(draw.permutation(len(points))[:pivots])]
        for _ in range(6):  # Lloyd's iterations; a centre that loses all its points stays
            near = _distances(points, centres).argmin(1)
            counts = np.bincount(near, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, near, points)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        self.pivots = centres

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector and its distance to the pivot."""
        away = _distances(vectors.astype(float), self.pivots)
        cell = away.argmin(1)
        return cell, away[np.arange(len(cell)), cell]


def _chained(pivots: np.ndarray, cells: list[int]) -> list[int]:
    """Cells so that near ones follow each other: from the outermost always to the nearest one left."""
    left, order = set(cells), []
    at = max(cells, key=lambda c: float(((pivots[c] - pivots[cells].mean(0)) ** 2).sum()))
    while left:
        order.append(at)
        left.discard(at)
        if left:
            rest = sorted(left)
            at = rest[int(((pivots[rest] - pivots[at]) ** 2).sum(1).argmin())]
    return order


def top_k(df: DataFrame, key: str, vectors: str, is_query: Column, k: int, scale: float = 256.0, pivots: int = PIVOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of the highest inner products with each query, itself left out.

    Queries are the rows of ``df`` that ``is_query`` names; every other row is a candidate. Equal scores go by ascending
    id. Only ``key``, ``vectors`` and what the condition names are looked at.
    """
    own = df.select(F.col(key).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(vectors).alias("__v"))
    rows = kept(integers(own, "__v", scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    schema = "query_id long, rank int, vec_id long, score long"

    size = rows.agg(F.count("row").alias("n"), F.count_if("asks").alias("asking"), F.max("dims").alias("dims")).first()
    if not size.asking:
        return df.sparkSession.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("ints").collect()
    space = Space(matrix([bytes(r.ints) for r in sample], size.dims), pivots)
    bytes_each = 8 * max(1, size.dims)
    blocks = ceil(size.n / max(1, block_bytes // bytes_each))
    at_most = max(1, block_bytes // bytes_each)  # queries of a group

    def reaches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a task, by cell: its queries and their reach, the reach of its data, and their largest norm."""
        found = np.zeros((4, len(space.pivots)))
        for batch in batches:
            vectors_ = matrix(batch.column(1), space.width)
            cell, away = space.cells(vectors_)
            asks = batch.column(0).to_numpy(zero_copy_only=False)
            found[0] += np.bincount(cell[asks], minlength=found.shape[1])
            np.maximum.at(found[1], cell[asks], away[asks])
            np.maximum.at(found[2], cell, away)
            np.maximum.at(found[3], cell, np.sqrt((vectors_.astype(float) ** 2).sum(1)))
        columns = [pa.array(np.arange(found.shape[1])), *map(pa.array, found)]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "queries", "reach", "data_reach", "norm"])

    told = rows.select("asks", "ints").mapInArrow(reaches, "cell long, queries double, reach double, data_reach double, norm double")
    told = told.groupBy("cell").agg(F.sum("queries").alias("queries"), *[F.max(c).alias(c) for c in ("reach", "data_reach", "norm")]).orderBy("cell").collect()
    asking, reach, data_reach, norm = (np.array([r[c] for r in told]) for c in ("queries", "reach", "data_reach", "norm"))
    lengths = np.sqrt((space.pivots**2).sum(1))
    slack = SLACK * (norm.max() + 1) * (norm.max() + reach.max() + 1)

    def bounded(vectors_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell): products with pivots, and how far queries of the cells may be off them."""
        v = vectors_.astype(float)
        return v @ space.pivots.T, np.sqrt((v**2).sum(1))[:, None] * reach[None]

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a task, the k + 1 highest lower bounds against each cell of queries."""
        highest = np.empty((0, len(space.pivots)))
        for batch in batches:
            middle, off = bounded(matrix(batch.column(0), space.width))
            highest = np.sort(np.vstack([highest, middle - off]), axis=0)[-k - 1 :]
        at, cell = np.nonzero(np.isfinite(highest))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(highest[at, cell])], ["cell", "low"])

    lows = rows.select("ints").mapInArrow(lowest, "cell long, low double")
    nth = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("low")))
    least = np.full(len(told), -np.inf)  # fewer than k + 1 rows bound nothing
    for r in lows.withColumn("nth", nth).filter(F.col("nth") <= k + 1).filter(F.col("nth") == k + 1).collect():
        least[r.cell] = r.low - slack
    least[asking == 0] = np.inf
    # (cell of queries, cell of data): p.p' + |p| R' + R n' bounds every product of the two.
    useful = space.pivots @ space.pivots.T + lengths[:, None] * data_reach[None] + reach[:, None] * norm[None] + slack >= least[:, None]
    cells = [c for c in range(len(told)) if asking[c]]
    first, parts, groups, filled = np.zeros(len(told), np.int64), np.ones(len(told), np.int64), 0, 0
    for cell in _chained(space.pivots, cells):
        n = int(asking[cell])
        if filled and filled + n > at_most:
            groups, filled = groups + 1, 0
        first[cell], parts[cell] = groups, ceil(n / at_most)
        groups, filled = groups + parts[cell] - 1, filled + n if parts[cell] == 1 else at_most

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data rows, once for every group that may need them."""
        for batch in batches:
            vectors_ = matrix(batch.column(2), space.width)
            middle, off = bounded(vectors_)
            rows_, cell = np.nonzero(useful[:, space.cells(vectors_)[0]].T & (middle + off >= least))
            spread = parts[cell]
            at = np.repeat(np.arange(len(cell)), spread)
            group = first[cell][at] + np.arange(len(at)) - np.repeat(np.cumsum(spread) - spread, spread)
            pair = np.unique(np.column_stack([rows_[at], group]), axis=0)
            taken = batch.take(pa.array(pair[:, 0]))
            block = mix(taken.column(0).to_numpy().astype(np.uint64)) % np.uint64(blocks)
            extra = [pa.array(pair[:, 1]), pa.array(block.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*taken.columns, *extra], ["row", "vec_id", "ints", "part", "block"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, _ = space.cells(matrix(batch.column(2), space.width))
            number = mix(batch.column(0).to_numpy().astype(np.uint64)) % parts[cell].astype(np.uint64)
            group = first[cell] + number.astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group)], ["row", "vec_id", "ints", "part"])

    def solved(queries: pa.Table, data: pa.Table) -> pa.Table:
        q_rows = queries.column("row").to_numpy()
        data = data.sort_by([("vec_id", "ascending"), ("row", "ascending")])  # nulls last
        rows_ = data.column("row").to_numpy()
        found: list[tuple[int, int, int]] = []
        if len(data) and len(queries):
            width = max(len(b) for c in (queries, data) for b in c.column("ints").to_pylist()) // 8
            scores = products(matrix(queries.column("ints").to_pylist(), width), matrix(data.column("ints").to_pylist(), width))
            for i, row in enumerate(q_rows):
                others = np.flatnonzero(rows_ != row)
                values = scores[i][others]
                if len(values) > k:
                    least = np.partition(values, len(values) - k)[len(values) - k]
                    above = np.flatnonzero(values > least)
                    best = np.concatenate([above, np.flatnonzero(values == least)[: k - len(above)]])
                else:
                    best = np.arange(len(values))
                found += [(i, int(others[b]), int(values[b])) for b in best]
        which = pa.array([f[0] for f in found], pa.int64())
        at = pa.array([f[1] for f in found], pa.int64())
        columns = [queries.column("row").take(which), queries.column("vec_id").take(which), data.column("row").take(at), data.column("vec_id").take(at), pa.array([f[2] for f in found], pa.int64())]
        return pa.Table.from_arrays(columns, ["query", "query_id", "row", "vec_id", "score"])

    body = rows.select("row", "vec_id", "ints")
    data = body.mapInArrow(dealt, "row long, vec_id long, ints binary, part long, block long")
    queries = rows.filter("asks").select("row", "vec_id", "ints").mapInArrow(asked, "row long, vec_id long, ints binary, part long")
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    local = queries.groupBy("part", "block").cogroup(data.groupBy("part", "block"))
    local = local.applyInArrow(solved, "query long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
