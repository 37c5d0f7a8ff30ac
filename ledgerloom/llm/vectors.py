"""Near-duplicate vectors by a PCA-ordered tiled comparison.

Unit vectors are turned onto their principal axes, which keeps inner products and puts most of every
product into the leading dimensions. A tile of vectors is compared with another one by the leading
dimensions first; what the others can add is at most the product of the two suffix norms, and a pair
that cannot reach the threshold any more is dropped, after 8 dimensions, 24, and so on. Pairs that
stay are decided by the cosine of the vectors as given, in double precision.

Vectors within the threshold are close on the first two axes too, so vectors are dealt into cells of
a grid there, and each cell meets only its neighbours. Cells are cut into tiles of bounded size:
however many vectors share a label or a place, no task holds more than two tiles. Equal vectors are
one class with a count. Tasks return links counted and a spanning forest, never all pairs.

Vectors are compared only if their labels are equal and not NULL and their lengths agree. Vectors
that are NULL, empty or zero, or hold NULL, NaN or infinity link with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.arrays import in_rows
from ledgerloom.llm.common import components, held, share, stored

THRESHOLD = 0.98
TILE = 2048
#: Dimensions after which pairs are dropped; all of them in the end.
STOPS = (8, 24)
_PAIRS = 100_000
_SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Not NULL, not empty, only finite numbers."""
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    flat = np.asarray(column.flatten()).astype(np.float64)
    return flat.reshape(len(column), -1)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Axes (columns) of the second moments of the unit vectors, the longest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                rows = units(matrix(batch.column("vector")))
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size, dtype=np.int32)), pa.array(total.reshape(-1))], names=["cell", "value"])

    found = vectors.select("vector").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    moments = np.zeros(size * size)
    for row in found:
        moments[row["cell"]] = row["value"]
    moments = moments.reshape(size, size)
    return np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1].copy()


def _places(axes: object, width: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The cell of each vector, and the later neighbours that it also visits."""
    schema = pa.schema([("key", pa.string()), ("x", pa.int32()), ("y", pa.int32()), ("visits", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned = held(axes)[:, :2]
        for batch in batches:
            if not batch.num_rows:
                continue
            at = units(matrix(batch.column("vector"))) @ turned
            at = np.pad(at, ((0, 0), (0, 2 - at.shape[1])))
            cell = np.floor(at / width).astype(np.int32)
            keys = batch.column("key")
            for dx, dy in ((0, 0), (1, -1), (1, 0), (1, 1), (0, 1)):
                # Distance from the vector to the neighbour, on the two axes.
                far = np.zeros(len(at))
                for axis, step in enumerate((dx, dy)):
                    if step:
                        border = (cell[:, axis] + (step > 0)) * width
                        far += (border - at[:, axis]) ** 2
                near = np.flatnonzero(far <= (width * (1 + _SLACK)) ** 2)
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(near)), pa.array(cell[near, 0] + np.int32(dx)), pa.array(cell[near, 1] + np.int32(dy)),
                    pa.array(np.full(len(near), bool(dx or dy))),
                ], schema=schema)

    return run


def linked_pairs(left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs whose cosine reaches the threshold; of one tile with itself each pair once."""
    a, b = units(left), units(right)
    x, y = a @ axes, b @ axes
    size = x.shape[1]
    stops = [s for s in STOPS if s < size] + [size]
    rest = [[np.sqrt((v[:, s:] ** 2).sum(axis=1)) for s in stops] for v in (x, y)]
    least, found = threshold - _SLACK, ([], [])
    first = stops[0]
    # The leading dimensions of whole tiles at once.
    reach = x[:, :first] @ y[:, :first].T
    possible = reach + rest[0][0][:, None] * rest[1][0][None, :] >= least
    if same:
        possible = np.triu(possible, 1)
    i, j = np.nonzero(possible)
    for at in range(0, len(i), _PAIRS):
        p, q = i[at:at + _PAIRS], j[at:at + _PAIRS]
        product, done = reach[p, q], first
        for k, stop in enumerate(stops[1:], 1):
            product = product + np.einsum("ij,ij->i", x[p, done:stop], y[q, done:stop])
            keep = product + rest[0][k][p] * rest[1][k][q] >= least
            p, q, product, done = p[keep], q[keep], product[keep], stop
        keep = np.einsum("ij,ij->i", a[p], b[q]) >= threshold
        found[0].append(p[keep])
        found[1].append(q[keep])
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *found[0]]), np.concatenate([none, *found[1]])


def forest(nodes: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A root for each node: the smallest number of its component."""
    root = np.arange(nodes)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[root]
        if (new == root).all():
            return root
        root = new


def _compare(axes: object, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of two tiles: for each vector their number, and a vector of the same component."""
    schema = pa.schema([("key", pa.string()), ("root", pa.string()), ("links", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        second = np.asarray(table.column("second").combine_chunks())
        same = not second.any() and table.column("a")[0].as_py() == table.column("b")[0].as_py()
        vectors = matrix(table.column("vector").combine_chunks())
        weight, keys = np.asarray(table.column("copies").combine_chunks()), table.column("key").to_pylist()
        one, two = np.flatnonzero(~second), np.flatnonzero(second)
        if same:
            two = one
        if not len(one) or not len(two):
            return schema.empty_table()
        i, j = linked_pairs(vectors[one], vectors[two], held(axes), threshold, same)
        i, j = one[i], two[j]
        links = np.bincount(i, weight[j], len(keys)) + np.bincount(j, weight[i], len(keys))
        root = forest(len(keys), i, j)
        rows = [(keys[k], keys[root[k]], int(links[k])) for k in np.flatnonzero(links)]
        return pa.Table.from_batches(list(in_rows(rows, schema)), schema)

    return run


def _links(classes: DataFrame, size: int, threshold: float, tile: int) -> DataFrame:
    """(key, root, links) over classes (key, label, vector, copies) of vectors of one length."""
    axes = share(classes.sparkSession, principal_axes(classes, size))
    width = math.sqrt(max(2 - 2 * threshold, 0.0)) or 1e-9
    placed = classes.select("key", "vector").mapInArrow(_places(axes, width), "key string, x int, y int, visits boolean")
    full = stored(placed.join(classes, "key").select("label", "x", "y", "visits", "key", "vector", "copies"), "cells")
    cell = ["label", "x", "y"]
    sizes = full.groupBy(*cell).agg(F.count_if(~F.col("visits")).alias("own"), F.count_if("visits").alias("guests")).filter("own > 0")
    sizes = sizes.select(*cell, F.ceil(F.col("own") / tile).cast("int").alias("n"), F.ceil(F.col("guests") / tile).cast("int").alias("m"))
    dealt = full.join(sizes, cell)
    own = F.pmod(F.xxhash64("key"), F.col("n")).cast("int")
    guest = F.pmod(F.xxhash64("key"), F.col("m")).cast("int")
    each = lambda n: F.sequence(F.lit(0), n - 1)
    # Own tile k meets the own tiles from k on, and all tiles of guests; b tells them apart.
    meets = F.when(F.col("visits"), F.transform(each(F.col("n")), lambda k: F.struct(k.alias("a"), (-1 - guest).alias("b"), F.lit(True).alias("second")))).otherwise(F.concat(
        F.transform(each(F.col("n")), lambda k: F.struct(F.least(k, own).alias("a"), F.greatest(k, own).alias("b"), (own > k).alias("second"))),
        F.when(F.col("m") > 0, F.transform(each(F.col("m")), lambda k: F.struct(own.alias("a"), (-1 - k).alias("b"), F.lit(False).alias("second")))).otherwise(F.array()),
    ))
    tiles = dealt.select(*cell, "key", "vector", "copies", F.explode(meets).alias("t")).select(*cell, "t.*", "key", "vector", "copies")
    return tiles.groupBy(*cell, "a", "b").applyInArrow(_compare(axes, threshold), "key string, root string, links long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """vectors: vec_id, embedding, label. A row per row: vec_id, n_links, component_id, kept.

    n_links counts the other rows linked directly; component_id is the smallest vec_id reachable.
    """
    good = F.col("label").isNotNull() & usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    key = F.when(good, F.concat(*[F.hex(F.xxhash64(F.lit(k), "label", "embedding")) for k in (1, 2)]))
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector"), key.alias("key"))
    grouped = rows.filter("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = stored(grouped, "vectors")
    found = None
    for row in classes.select(F.size("vector").alias("n")).distinct().collect():
        part = _links(classes.filter(F.size("vector") == row["n"]), row["n"], threshold, tile)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, "pairs")
    counted = found.groupBy("key").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    named = classes.select("key", "copies", "least").join(counted, "key", "left").join(parts, "key", "left")
    named = named.withColumn("component", F.coalesce("component", "key"))
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
    named = named.join(smallest, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "smallest")
    out = rows.join(named, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("smallest")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
