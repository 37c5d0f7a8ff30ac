"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source of size s that shall hold the share w of the mixture is repeated w * total / s times on
average. Each document draws its own number of copies: a uniform number hashed from the seed, its id
and its text is sent through the inverse of the Poisson distribution with that mean. The copies are
exploded and the whole result is dealt out and sorted by another hash, which is a global shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import fresh, stored

SEED = "mix-1"
#: Means above this are drawn as sums of independent draws, so that exp(-mean) stays far from zero.
STRAND = 64.0


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits from the MD5 of seed and parts; NULL is marked."""
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    text = F.concat_ws("|", F.lit(seed), *marked)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_table(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... as an array, up to where 52 bits see no more difference.

    The terms are summed upwards from exp(-mean); mean + 12 * sqrt(mean) + 30 terms leave a tail
    far below 2**-52.
    """
    last = F.ceil(mean + F.sqrt(mean) * 12 + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), (state["c"] + p).alias("c"), F.concat(state["all"], F.array(state["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["all"])


def draw(table: Column, u: Column) -> Column:
    """Inverse of the distribution: the first k with u < P(X <= k)."""
    return F.size(F.filter(table, lambda c: c <= u))


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None, total: float | None, source: str, size: Column) -> DataFrame:
    """A row per source: its size, share of the mixture and mean repetition rate.

    Without `weights` all sources weigh the same. A source that `weights` doesn't name has weight 0.
    Only weights of sources that hold something count, so the shares sum to one.
    """
    sizes = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).cast("double").alias("size"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            if value < 0:
                raise ValueError("a weight must not be negative")
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    sizes = stored(sizes, "sizes")
    weights_sum = sizes.agg(F.sum("weight")).scalar()
    share = F.when(weights_sum > 0, F.col("weight") / weights_sum).otherwise(0.0)
    wanted = sizes.agg(F.sum("size")).scalar() if total is None else F.lit(float(total))
    return sizes.select(
        "source", "size", share.alias("share"),
        F.when(F.col("size") > 0, share * wanted / F.col("size")).otherwise(0.0).alias("rate"),
    )


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, total: float | None = None, seed: str = SEED,
    source: str = "source", doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The mixture: every column of `docs`, and copy_no (from 1), n_copies and shuffle_key.

    Sizes are characters of text (NULL: none), `total` those of the result on average (by default as
    many as there are). A NULL source is a source of its own. Documents of sources without any text
    or with weight 0 get no copy. Repeated rows draw the same number. Rows come in the order of
    shuffle_key within each partition, and partitions hold random parts of the whole.
    """
    mean, table, far, at = (fresh(docs, n) for n in ("mean", "table", "strands", "at"))
    added = ("copy_no", "n_copies", "shuffle_key")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    found = rates(docs, weights, total, source, F.coalesce(F.char_length(F.col(f"`{text}`")), F.lit(0)))
    strands = F.greatest(F.ceil(F.col("rate") / STRAND), F.lit(1)).cast("int")
    found = found.select(
        F.col("source").alias(at), strands.alias(far), poisson_table(F.col("rate") / strands).alias(table))
    joined = docs.join(found, F.col(f"`{source}`").eqNullSafe(F.col(at)), "left")
    fixed = (F.col(f"`{doc_id}`"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    many = F.aggregate(
        F.sequence(F.lit(1), F.col(far)), F.lit(0), lambda sum_, k: sum_ + draw(F.col(table), uniform(seed, k, *fixed)))
    drawn = joined.select(*kept, many.alias("n_copies")).filter("n_copies > 0")
    copies = drawn.select("*", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy_no"))
    keyed = copies.withColumn("shuffle_key", uniform(f"{seed}:order", F.col("copy_no"), *fixed))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
