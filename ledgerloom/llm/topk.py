"""Exact top-k search by a Voronoi kNN join.

Queries and data are grouped by their nearest pivot. A summary of each group (how many, how far from
the pivot) is all that comes to the driver; its size is bounded by the number of pivots. Each group
of queries is first solved against the data of its own group. The k-th score found there is a bound
for the rest: with q within R of pivot p, the inner product of q and x is at most p.x + R * |x|, and
at most p.v + |p| * r + R * (|v| + r) for all data within r of pivot v. Groups, and then vectors,
whose bound stays below the worst k-th score of a query group are not sent to it; all others are, and
are solved there. The results of both steps are merged. In high dimensions these bounds may leave
most data; the result is exact either way.

Groups are cut into blocks of bounded size, so a place that holds a third of all rows is many tasks.

Components are floor(scale * x) and scores integer inner products. Vectors that are NULL or empty, or
hold NULL, NaN or infinity, take no part. Vectors of another length than the query's don't either.
Rows with the same id are different candidates; only the query's own row is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import held, share, stored
from ledgerloom.llm.vectors import matrix, usable

TOP = 10
SCALE = 1024
#: Pivots: one for so many queries, within these limits.
QUERIES_A_PIVOT, PIVOTS = 64, (8, 256)
BLOCK = 4096
_MORE = 1 + 1e-9


def _assign(pivots: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nearest pivot of each vector, and how far it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = held(pivots)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch.column("vector"))
            square = (rows * rows).sum(axis=1)
            far = square[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (rows @ points.T)
            cell = far.argmin(axis=1)
            radius = np.sqrt(((rows - points[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(radius), pa.array(np.sqrt(square))], names=[*batch.schema.names, "cell", "radius", "norm"])

    return run


def _needed(pivots: object, bounds: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each vector with every other group of queries that may need it."""
    schema = pa.schema([("row", pa.int64()), ("into", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, (reach, floor, passes) = held(pivots), held(bounds)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, norm, cell = matrix(batch.column("vector")), np.asarray(batch.column("norm")), np.asarray(batch.column("cell"))
            most = rows @ points.T + reach[None, :] * norm[:, None]
            slack = (np.abs(most) + 1) * 1e-9
            wanted = (most + slack >= floor[None, :]) & passes[:, cell].T
            wanted[np.arange(len(rows)), cell] = False
            at, into = np.nonzero(wanted)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(at)), pa.array(into.astype(np.int32))], schema=schema)

    return run


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if float(most) ** 2 * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _solve(top: int) -> Callable[[pa.Table], pa.Table]:
    """Best candidates of one block of queries within one block of data."""
    schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])

    def ints(column: pa.ChunkedArray) -> np.ndarray:
        one = column.combine_chunks()
        return np.asarray(one.flatten()).astype(np.int64).reshape(len(one), -1)

    def run(table: pa.Table) -> pa.Table:
        asks = table.filter(table.column("asks"))
        data = table.filter(pa.compute.invert(table.column("asks"))).sort_by([("vec_id", "ascending"), ("row", "ascending")])
        if not asks.num_rows or not data.num_rows:
            return schema.empty_table()
        own, rows, ids = np.asarray(asks.column("row")), np.asarray(data.column("row")), data.column("vec_id").combine_chunks()
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        points = ints(data.column("vector"))
        queries = ints(asks.column("vector"))
        for low in range(0, len(own), 256):
            scores = _scores(queries[low:low + 256], points)
            for k, score in enumerate(scores):
                others = np.flatnonzero(rows != own[low + k])
                if len(others) > top:
                    least = np.partition(score[others], len(others) - top)[len(others) - top]
                    others = others[score[others] >= least]
                # Data go by id, so the sort leaves ties in that order.
                best = others[np.argsort(-score[others], kind="stable")[:top]]
                found.append((own[low + k], best, score[best]))
        at = np.concatenate([b for _, b, _ in found])
        return pa.table([
            pa.array(np.repeat([q for q, _, _ in found], [len(b) for _, b, _ in found]).astype(np.int64)), ids.take(pa.array(at)), pa.array(rows[at]), pa.array(np.concatenate([s for _, _, s in found])),
        ], schema=schema)

    return run


def _join(asks: DataFrame, data: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    """Solve queries and data that share `into`, in blocks. sizes: into, data blocks n, query blocks m."""
    block = lambda count: F.pmod(F.xxhash64("row"), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["into", "row", "vec_id", "vector"]
    left = asks.join(sizes, "into").select(*columns, F.lit(True).alias("asks"), block("m").alias("b"), each("n").alias("a"))
    right = data.join(sizes, "into").select(*columns, F.lit(False).alias("asks"), block("n").alias("a"), each("m").alias("b"))
    both = left.unionByName(right)
    return both.groupBy("into", "a", "b").applyInArrow(_solve(top), "query long, vec_id long, row long, score long")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _of_length(rows: DataFrame, top: int) -> DataFrame:
    """Best candidates of all queries among rows (row, vec_id, vector, asks) of one length."""
    spark = rows.sparkSession
    asking = rows.filter("asks").count()
    wanted = min(max(-(-asking // QUERIES_A_PIVOT), PIVOTS[0]), PIVOTS[1])
    chosen = rows.select("vector", F.xxhash64("vector").alias("h")).distinct().orderBy("h", "vector").limit(wanted).collect()
    points = np.array([r["vector"] for r in chosen], dtype=np.float64)
    pivots = share(spark, points)
    fields = "row long, vec_id long, vector array<bigint>, asks boolean, cell int, radius double, norm double"
    placed = stored(rows.select("row", "vec_id", "vector", "asks").mapInArrow(_assign(pivots), fields), "placed")
    count = len(points)
    n, m, r, reach = np.zeros(count), np.zeros(count), np.zeros(count), np.zeros(count)
    summary = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.count_if("asks").alias("m"), F.max("radius").alias("r"), F.max(F.when(F.col("asks"), F.col("radius"))).alias("reach"))
    for s in summary.collect():
        n[s["cell"]], m[s["cell"]], r[s["cell"]], reach[s["cell"]] = s["n"], s["m"], s["r"], s["reach"] or 0.0

    def blocks(data: np.ndarray) -> DataFrame:
        return spark.createDataFrame(
            [(i, max(1, -(-int(data[i]) // BLOCK)), max(1, -(-int(m[i]) // BLOCK))) for i in range(count) if m[i]], "into int, n int, m int")

    asks = placed.filter("asks").withColumnRenamed("cell", "into")
    near = stored(_best(_join(asks, placed.withColumnRenamed("cell", "into"), blocks(n), top), top), "near")
    kth = near.groupBy("query").agg(F.min("score").alias("kth"), F.count("*").alias("found"))
    kth = asks.join(kth, asks["row"] == kth["query"], "left").groupBy("into").agg(
        F.min(F.when(F.col("found") == top, F.col("kth")).otherwise(F.lit(None))).alias("kth"), F.count_if(F.coalesce("found", F.lit(0)) < top).alias("open"))
    floor = np.full(count, np.inf)
    for s in kth.collect():
        floor[s["into"]] = -np.inf if s["open"] else s["kth"]
    length = np.sqrt((points * points).sum(axis=1))
    reach, r = reach * _MORE, r * _MORE
    most = points @ points.T + np.outer(length, r) + reach[:, None] * (length + r)[None, :]
    passes = (most + (np.abs(most) + 1) * 1e-9 >= floor[:, None]) & (m > 0)[:, None] & (n > 0)[None, :]
    bounds = share(spark, (reach, floor, passes))
    into = placed.mapInArrow(_needed(pivots, bounds), "row long, into int")
    sent = (passes * n[None, :]).sum(axis=1)
    far = _join(asks, into.join(placed.select("row", "vec_id", "vector"), "row"), blocks(sent), top)
    return _best(near.drop("rank").unionByName(far), top)


def search(vectors: DataFrame, asks: Column, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """vectors: vec_id, embedding; `asks` marks the queries. (query_id, rank, vec_id, score), best first, ties to smaller ids."""
    good = vectors.filter(usable(F.col("embedding"))).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    # Numbers of rows are settled by writing them.
    rows = stored(good.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = None
    for size in rows.filter("asks").select(F.size("vector").alias("n")).distinct().collect():
        part = _of_length(rows.filter(F.size("vector") == size["n"]), top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    names = rows.filter("asks").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return found.join(names, "query").select("query_id", "rank", "vec_id", "score")
