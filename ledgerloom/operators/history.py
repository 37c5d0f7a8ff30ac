"""Type-2 history: build versions, look them up by time, and count interval matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from .scans import KEY, POSITION, ROWS, SLICE, before, in_order, scan, with_carry


def _numbered(df: DataFrame, key: str, at: str, tiebreak: str, attributes: Sequence[str], rows: int) -> DataFrame:
    """Every observation with `starts_new_version`, `version` and `__last`, the attributes of the key's row before.

    Within a slice a row's attributes are compared with those of the row before. A slice of a longer key
    hands over its first and last attributes and its number of changes; from these follow, over the
    slices of the key, whether a slice opens with a new version and how many there were before.
    """
    ordered = in_order(df.select(key, at, tiebreak, *attributes), key, [at, tiebreak], rows)
    seen = F.struct(*attributes)

    def differs(one: Column, other: Column) -> Column:
        unequal = F.lit(False)
        for name in attributes:
            unequal = unequal | ~one[name].eqNullSafe(other[name])
        return unequal

    def local(part: DataFrame) -> DataFrame:
        linked = part.withColumns({"__seen": seen, "__previous": F.lag(seen).over(ordered.along)})
        first = F.col("__previous").isNull()
        changed = F.when(first, 0).otherwise(differs(F.col("__seen"), F.col("__previous")).cast("int"))
        marked = linked.withColumns({"__first": first, "__changed": changed})
        return marked.withColumn("__changes", F.sum("__changed").over(ordered.along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    summary = [
        F.first(F.when(F.col("__first"), F.col("__seen")), ignorenulls=True).alias("head"),
        F.max_by("__seen", POSITION).alias("tail"), F.sum("__changed").alias("inner"),
    ]

    def carry(slices: DataFrame, across: WindowSpec) -> DataFrame:
        linked = slices.withColumn("__tail", F.lag("tail").over(across))
        opened = linked.withColumn("__opens", F.when(F.col("__tail").isNull() | differs(F.col("head"), F.col("__tail")), 1).otherwise(0))
        return opened.select(KEY, SLICE, "__opens", "__tail", F.sum(F.col("inner") + F.col("__opens")).over(before(across)).alias("__earlier"))

    carried = with_carry(ordered, local, summary, carry)
    opens = F.coalesce("__opens", F.lit(1))
    return carried.select(
        key, at, tiebreak, *attributes, F.when(F.col("__first"), opens).otherwise(F.col("__changed")).alias("starts_new_version"),
        (F.coalesce("__earlier", F.lit(0)) + opens + F.col("__changes")).cast("bigint").alias("version"),
        F.coalesce("__previous", "__tail").alias("__last"))


def sessions(
    df: DataFrame, key: str, at: str, tiebreak: str, attributes: Sequence[str], rows: int = ROWS
) -> DataFrame:
    """Every observation with `starts_new_version` and its running `version` number."""
    return _numbered(df, key, at, tiebreak, attributes, rows).drop("__last")


def version_history(
    df: DataFrame, key: str, at: str, tiebreak: str, attributes: Sequence[str], rows: int = ROWS
) -> DataFrame:
    """One row per run of equal attributes: half-open [valid_from, valid_to) and row count.

    Returning to an earlier state opens a new version. Attributes are constant inside a version, so
    they are grouping columns. The first row of a version also counts, as its end, with the version before:
    one hash aggregate gives starts and ends.
    """
    numbered = _numbered(df, key, at, tiebreak, attributes, rows)
    none = F.lit(None).cast(df.schema[at].dataType)
    own = F.struct("version", *attributes, F.col(at).alias("at"), none.alias("end"), F.lit(1).alias("n"))
    ended = F.struct(
        (F.col("version") - 1).alias("version"), *[F.col("__last")[a].alias(a) for a in attributes], none.alias("at"), F.col(at).alias("end"), F.lit(0).alias("n"))
    begins = (F.col("starts_new_version") == 1) & (F.col("version") > 1)
    told = numbered.select(key, F.inline(F.when(begins, F.array(own, ended)).otherwise(F.array(own))))
    return told.groupBy(key, "version", *attributes).agg(
        F.min("at").alias("valid_from"), F.sum("n").alias("observations"), F.max("end").alias("valid_to"))


def version_gaps(dim: DataFrame, key: str, version: str, rows: int = ROWS) -> DataFrame:
    """Add the version's expected number and whether it starts where its predecessor ended."""
    scanned = scan(
        in_order(dim, key, [version], rows), previous={"__ended": F.struct("valid_to")}, running={"expected_version": F.lit(1)})
    broken = (
        F.col("__ended").isNotNull() & F.col("valid_from").isNotNull()
        & ~F.col("valid_from").eqNullSafe(F.col("__ended")["valid_to"])
    )
    return scanned.withColumn("breaks_adjacency", broken).drop("__ended")


def inside(at: Column, valid_from: Column, valid_to: Column) -> Column:
    """Half-open membership."""
    return (at >= valid_from) & (valid_to.isNull() | (at < valid_to))


def asof_lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    payload: Sequence[str],
    version: str,
    rows: int = ROWS,
    ident: str | None = None,
) -> DataFrame:
    """Attach `payload` of the version valid at `at`; facts without one are dropped.

    `ident` names a column that tells facts apart, if there is one. Then only key, time and it go
    through the scan, and the other columns of a fact are joined to what was found.

    Versions of a key must not overlap (see `match_counts` for the check). Facts and version
    starts are merged in time order and the last start wins, which costs one pass per key instead
    of comparing every fact with every version of its key.
    """
    starts = dim.filter(F.col(key).isNotNull()).select(
        F.col(key),
        F.col("valid_from").alias("__at"),
        F.lit(0).alias("__side"),
        F.col(version).alias("__version"),
        F.struct(*dict.fromkeys(["valid_from", "valid_to", *payload])).alias("__start"),
    )
    arrivals = facts.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumns(
        {"__at": F.col(at), "__side": F.lit(1)}
    )
    if ident is not None:
        arrivals = arrivals.select(ident, key, "__at", "__side")
    merged = arrivals.unionByName(starts, allowMissingColumns=True)
    found = scan(in_order(merged, key, ["__at", "__side", "__version"], rows), latest={"__valid": F.col("__start")})
    valid = F.col("__valid")
    matched = found.filter(
        (F.col("__side") == 1) & inside(F.col("__at"), valid["valid_from"], valid["valid_to"])
    )
    if ident is None:
        return matched.select(*facts.columns, *[valid[p].alias(p) for p in payload])
    hits = matched.select(F.col(ident).alias("__ident"), *[valid[p].alias(p) for p in payload])
    return facts.join(hits, F.col(ident) == F.col("__ident")).drop("__ident")


def _proper(dim: DataFrame, key: str) -> DataFrame:
    """Intervals that can contain a point."""
    return dim.filter(
        F.col(key).isNotNull()
        & F.col("valid_from").isNotNull()
        & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    )


def match_counts(
    facts: DataFrame, dim: DataFrame, key: str, at: str, rows: int = ROWS
) -> DataFrame:
    """Add `matches`, the number of intervals of the key that contain `at`.

    Exact for gapped, overlapping and reversed intervals: every proper interval adds one at its
    start and takes one away at its end, and a running sum reads the balance at each fact.
    """
    proper = _proper(dim, key)
    opens = proper.select(F.col(key), F.col("valid_from").alias("__at"), F.lit(1).alias("__step"))
    closes = proper.filter(F.col("valid_to").isNotNull()).select(
        F.col(key), F.col("valid_to").alias("__at"), F.lit(-1).alias("__step")
    )
    steps = opens.unionByName(closes).withColumn("__side", F.lit(0))
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    points = facts.filter(placed).withColumns(
        {"__at": F.col(at), "__step": F.lit(0), "__side": F.lit(1)}
    )
    merged = points.unionByName(steps, allowMissingColumns=True)
    counted = scan(in_order(merged, key, ["__at", "__side"], rows), running={"__balance": F.col("__step")}).filter("__side = 1")
    result = counted.select(*facts.columns, F.col("__balance").cast("bigint").alias("matches"))
    unplaced = facts.filter(~placed).withColumn("matches", F.lit(0).cast("bigint"))
    return result.unionByName(unplaced)


def interval_usage(
    facts: DataFrame, dim: DataFrame, key: str, at: str, ident: str, rows: int = ROWS
) -> DataFrame:
    """(ident, uses): facts inside each interval of `dim`; intervals without facts give 0.

    The count inside [from, to) is the number of facts before `to` less the number before `from`;
    both are read from one running count.
    """
    proper = _proper(dim, key)
    side = F.lit(0).alias("__side")
    none = F.lit(0).alias("__fact")
    before = proper.select(
        F.col(key), F.col("valid_from").alias("__at"), side, none,
        F.lit(-1).alias("__sign"), F.col(ident),
    )
    after = proper.select(
        F.col(key), F.col("valid_to").alias("__at"), side, none,
        F.lit(1).alias("__sign"), F.col(ident),
    )
    points = facts.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key), F.col(at).alias("__at"), F.lit(1).alias("__side"), F.lit(1).alias("__fact")
    )
    merged = before.unionByName(after).unionByName(points, allowMissingColumns=True)
    marks = scan(in_order(merged, key, ["__at", "__side"], rows), running={"__before": F.col("__fact")}).filter("__side = 0")
    return marks.groupBy(ident).agg(
        F.sum(F.col("__sign") * F.col("__before")).cast("bigint").alias("uses")
    )
