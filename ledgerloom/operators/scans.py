"""Ordered scans within a key that survive a key holding a large share of all rows.

Rows are dealt by range over the key and the whole order, ties included, and written down in that
order. A row's place in the files is its POSITION, and so many rows in a row are a SLICE: a key of
any size, and rows of one moment too, are cut by their number. Each slice of a key is scanned on its own.
Only keys that reach over a border of slices, at most one per border, need more: one summary row for
each of their slices is scanned over the key, and what earlier slices hand over is joined back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..sources.store import COMPRESSION, shared_root

#: Rows of a slice.
ROWS = 1 << 16
KEY, SLICE, POSITION = "__key", "__slice", "__position"
_FILE_BITS = 36


@dataclass(frozen=True)
class Ordered:
    """Rows with KEY, SLICE and POSITION, and the keys that begin a slice."""

    rows: DataFrame
    shared: DataFrame

    @property
    def along(self) -> WindowSpec:
        return Window.partitionBy(KEY, SLICE).orderBy(POSITION)

    def finish(self, scanned: DataFrame) -> DataFrame:
        return scanned.drop(KEY, SLICE, POSITION)


def in_order(df: DataFrame, key: str, order: Sequence[str], rows: int = ROWS) -> Ordered:
    """Write `df` in the order of its key and `order`, NULLs of which come last.

    The order of rows that agree in all of it follows from their other columns.
    """
    spark = df.sparkSession
    base = f"{shared_root(spark)}/scan-{uuid.uuid4().hex}"
    line = [F.col(key).asc_nulls_first(), *(F.col(c).asc_nulls_last() for c in order), F.xxhash64(*df.columns).asc()]
    # One file for each range, whatever the session says, so that its number tells the range.
    written = df.repartitionByRange(*line).sortWithinPartitions(*line).write.option("maxRecordsPerFile", 0)
    written.option("compression", COMPRESSION).parquet(f"{base}/rows")
    read = spark.read.schema(df.schema).parquet(f"{base}/rows")
    place = read.metadataColumn("_metadata")
    first = F.shiftleft(F.split(place["file_name"], "-")[1].cast("bigint"), _FILE_BITS)
    # A struct equals another with the same NULLs, so all keys meet in plain equality.
    placed = read.select(
        *df.columns, F.struct(F.col(key).alias("key")).alias(KEY), (first + F.floor(place["row_index"] / rows)).alias(SLICE),
        (first + place["row_index"]).alias(POSITION), (place["row_index"] % rows == 0).alias("__begins"))
    placed.filter("__begins").select(KEY).write.parquet(f"{base}/shared")
    shared = spark.read.schema(placed.select(KEY).schema).parquet(f"{base}/shared")
    return Ordered(placed.drop("__begins"), shared)


def with_carry(
    ordered: Ordered, local: Callable[[DataFrame], DataFrame], summary: Sequence[Column],
    carry: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Rows after `local`, with the columns that `carry` finds for their slice; NULL where a key has one slice.

    `local` sees slices apart, `summary` aggregates the rows of a key's slice after it, and `carry` selects
    KEY, SLICE and more from the summaries, given the window over a key's slices.
    """
    shared = local(ordered.rows.join(ordered.shared, KEY, "left_semi"))
    slices = shared.groupBy(KEY, SLICE).agg(*summary)
    carried = carry(slices, Window.partitionBy(KEY).orderBy(SLICE))
    return local(ordered.rows).join(carried, [KEY, SLICE], "left")


def before(across: WindowSpec) -> WindowSpec:
    """All earlier slices of the key."""
    return across.rowsBetween(Window.unboundedPreceding, -1)


def scan(
    ordered: Ordered, previous: Mapping[str, Column] | None = None, running: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Several scans of the same rows in one pass; each adds a column for each name.

    `previous`: the value of the key's row before, NULL on the first one; the value is never NULL.
    `running`: the sum of a number, never NULL, up to and including this row.
    `latest`: the last value that is not NULL, up to and including this row.
    """
    previous, running, latest = previous or {}, running or {}, latest or {}
    values = {f"__value{k}": value for k, value in enumerate([*previous.values(), *running.values(), *latest.values()])}
    named = dict(zip([*previous, *running, *latest], values, strict=True))
    upto = ordered.along.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def local(rows: DataFrame) -> DataFrame:
        return rows.withColumns(values).withColumns({
            **{n: F.lag(named[n]).over(ordered.along) for n in previous},
            **{n: F.sum(named[n]).over(upto) for n in running},
            **{n: F.last(named[n], ignorenulls=True).over(upto) for n in latest},
        })

    summary = [
        *(F.max_by(named[n], POSITION).alias(n) for n in previous), *(F.sum(named[n]).alias(n) for n in running),
        *(F.max_by(F.col(named[n]), F.when(F.col(named[n]).isNotNull(), F.col(POSITION))).alias(n) for n in latest),
    ]

    def carry(slices: DataFrame, across: WindowSpec) -> DataFrame:
        return slices.select(
            KEY, SLICE, *(F.lag(n).over(across).alias(f"__carried_{n}") for n in previous),
            *(F.sum(n).over(before(across)).alias(f"__carried_{n}") for n in running),
            *(F.last(n, ignorenulls=True).over(before(across)).alias(f"__carried_{n}") for n in latest))

    carried = with_carry(ordered, local, summary, carry)
    done = carried.withColumns({
        **{n: F.coalesce(F.col(n), F.col(f"__carried_{n}")) for n in (*previous, *latest)},
        **{n: F.col(n) + F.coalesce(F.col(f"__carried_{n}"), F.lit(0)) for n in running},
    })
    return ordered.finish(done.drop(*values, *(f"__carried_{n}" for n in named)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the right keys are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, match, how).drop(*[f"__r_{k}" for k in keys])
