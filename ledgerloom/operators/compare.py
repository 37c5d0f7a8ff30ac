"""Comparison operators for checks: set difference, spines, reconciliations, metric rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import differs


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, paired up so that analysis stays cheap for many frames."""
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i:i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]


def symmetric_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """EXCEPT ALL both ways in one shuffle; `side` names the input holding the surplus row."""
    columns = expected.columns
    weighted = expected.withColumn("__w", F.lit(1)).unionByName(
        actual.select(*columns).withColumn("__w", F.lit(-1))
    )
    surplus = weighted.groupBy(*columns).agg(F.sum("__w").alias("__w")).filter("__w <> 0")
    copies = F.explode(F.array_repeat(F.lit(1), F.abs("__w").cast("int")))
    return surplus.select(
        *columns, F.when(F.col("__w") > 0, "expected").otherwise("actual").alias("side"), copies.alias("__c")
    ).drop("__c")


def spine_check(
    left: DataFrame, right: DataFrame, key: str, missing: str, unexpected: str
) -> DataFrame:
    """Keys on one side only, labelled, each key once; NULL is a key.

    Keys meet where they lie, if both sides lie alike, and only those without a partner are moved, for NULL meets nothing.
    """
    one, none = F.lit(1), F.lit(0)
    lefts, rights = (df.groupBy(key).agg(F.max(one).alias(n)) for df, n in ((left, "__l"), (right, "__r")))
    alone = lefts.join(rights, key, "full_outer").filter(F.col("__l").isNull() | F.col("__r").isNull())
    seen = alone.groupBy(key).agg(F.max(F.coalesce("__l", none)).alias("__l"), F.max(F.coalesce("__r", none)).alias("__r"))
    label = F.when(F.col("__r") == 0, missing).otherwise(unexpected)
    return seen.filter("__l <> __r").select(key, label.alias("issue"))


def full_outer(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], null_safe: bool = False, within: str | None = None
) -> DataFrame:
    """Full outer join with every column prefixed `e_` / `a_` plus presence flags.

    With `within`, one of the keys, rows meet by it alone, so tables in buckets of it move nothing; each row is
    then compared with all that share it, which must be few.
    """
    left = expected.select(*[F.col(c).alias(f"e_{c}") for c in expected.columns], F.lit(True).alias("in_e"))
    right = actual.select(*[F.col(c).alias(f"a_{c}") for c in actual.columns], F.lit(True).alias("in_a"))
    match: Column | None = None
    for k in keys:
        e, a = F.col(f"e_{k}"), F.col(f"a_{k}")
        part = e.eqNullSafe(a) if null_safe else e == a
        if within is not None and k != within:
            # Equal, but not in a form by which rows are dealt.
            part = (e <= a) & (e >= a)
        match = part if match is None else match & part
    return left.join(right, match, "full_outer")


def any_differs(measures: Mapping[str, str] | Sequence[str]) -> Column:
    """True when any expected measure differs from its actual counterpart (NULL-safe)."""
    pairs = measures.items() if isinstance(measures, Mapping) else [(m, m) for m in measures]
    return reduce(
        lambda acc, pair: acc | differs(F.col(f"e_{pair[0]}"), F.col(f"a_{pair[1]}")), pairs, F.lit(False)
    )


def one_sided() -> Column:
    return F.col("in_e").isNull() | F.col("in_a").isNull()


def mismatched_groups(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], measures: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Groups that are one-sided or differ in a measure."""
    return full_outer(expected, actual, keys, null_safe).filter(one_sided() | any_differs(measures))


def field_recon(
    source: DataFrame, target: DataFrame, keys: Sequence[str], fields: Sequence[str], unexpected: str,
    within: str | None = None,
) -> DataFrame:
    """Rows missing from or different in the target, and target rows without a source."""
    joined = full_outer(source, target, keys, within=within)
    broken = joined.filter(one_sided() | any_differs(fields))
    label = F.when(F.col("in_e").isNull(), unexpected).otherwise("missing_or_mismatched")
    named = [F.coalesce(f"e_{k}", f"a_{k}").alias(k) for k in keys]
    return broken.select(*named, label.alias("violation"))


def metric_rows(df: DataFrame, names: Sequence[str], prefix: str = "") -> DataFrame:
    """Turn a one-row aggregate into (metric, value) rows."""
    pairs = [f"named_struct('metric', '{prefix}{n}', 'value', cast(`{n}` as bigint))" for n in names]
    return df.selectExpr(f"inline(array({', '.join(pairs)}))")


def aggregate_metrics(df: DataFrame, metrics: Mapping[str, Column], prefix: str = "") -> DataFrame:
    """Several aggregates of one table in one scan, as (metric, value) rows."""
    row = df.agg(*[c.alias(n) for n, c in metrics.items()])
    return metric_rows(row, list(metrics), prefix)


def count_metric(name: str, violations: DataFrame) -> DataFrame:
    """(metric, value) with the number of rows."""
    return violations.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")


def named_values(rows: DataFrame, names: Sequence[str], kind: str = "bigint") -> DataFrame:
    """(metric, value) rows to one row with a column per metric; no join needed."""
    picked = [
        F.max(F.when(F.col("metric") == n, F.col("value"))).cast(kind).alias(n) for n in names
    ]
    return rows.agg(*picked)
