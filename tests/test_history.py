"""Heavy and ordinary keys give the same history; interval operators equal brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.history import (
    asof_lookup, interval_usage, match_counts, sessions, version_gaps, version_history,
)
from ledgerloom.operators.scans import POSITION, SLICE, in_order, scan

START = datetime(2025, 1, 1)


def observations(seed: int, n: int = 240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        at = START + timedelta(hours=rng.randrange(60))
        rows.append((key, at, f"o{i:04d}", rng.choice([1, 2, None]), rng.choice(["x", "y"])))
    return rows


SCHEMA = "k string, at timestamp_ntz, id string, zip int, city string"


def brute_history(rows):
    out = set()
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        runs = []
        for _, at, _, zip_, city in mine:
            if runs and runs[-1][:2] == [zip_, city]:
                runs[-1][3] += 1
            else:
                runs.append([zip_, city, at, 1])
        for i, (zip_, city, at, n) in enumerate(runs):
            end = runs[i + 1][2] if i + 1 < len(runs) else None
            out.add((key, i + 1, zip_, city, at, end, n))
    return out


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_version_history(spark, size):
    rows = observations(size)
    got = version_history(spark.createDataFrame(rows, SCHEMA), "k", "at", "id", ["zip", "city"], size)
    found = {(r.k, r.version, r.zip, r.city, r.valid_from, r.valid_to, r.observations) for r in got.collect()}
    assert found == brute_history(rows)


def test_hot_moment_with_a_common_prefix(spark):
    """A third of all rows in one key, one moment and ids that begin alike: cut by number all the same."""
    rng, rows = random.Random(2), []
    for i in range(900):
        hot = i % 3 == 0
        at = START if hot else START + timedelta(seconds=rng.randrange(90), microseconds=rng.randrange(3))
        rows.append(("bulk" if hot else f"k{rng.randrange(40)}", at, f"order_{i:04d}", rng.choice([1, 2, None]), rng.choice(["x", "y"])))
    df = spark.createDataFrame(rows, SCHEMA)
    found = version_history(df, "k", "at", "id", ["zip", "city"], 20)
    assert {(r.k, r.version, r.zip, r.city, r.valid_from, r.valid_to, r.observations) for r in found.collect()} == brute_history(rows)
    ordered = in_order(df, "k", ["at", "id"], 20)
    bulk = ordered.rows.filter("k = 'bulk'").groupBy(SLICE).count().collect()
    assert len(bulk) >= 15 and max(r["count"] for r in bulk) <= 20
    assert ordered.rows.select(POSITION).distinct().count() == 900
    # With many partitions, the scan of the hot key runs in many tasks of few rows each.
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = sessions(df, "k", "at", "id", ["zip", "city"], 20)
        tasks = numbered.filter("k = 'bulk'").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("version")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) >= 6 and max(r["n"] for r in tasks) <= 100


@pytest.mark.parametrize("size", [1, 3, 10_000])
def test_three_scans_in_one_pass(spark, size):
    rng = random.Random(size)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(20), i, rng.choice([None, None, f"v{i}"]), rng.randrange(9)) for i in range(150)]
    ordered = in_order(spark.createDataFrame(rows, "k string, at long, id long, text string, n int"), "k", ["at", "id"], size)
    done = scan(ordered, {"before": F.struct("id")}, {"total": F.col("n"), "number": F.lit(1)}, {"seen": F.col("text")})
    assert done.columns == ["k", "at", "id", "text", "n", "before", "total", "number", "seen"]
    found, want = {r.id: (r.before and r.before.id, r.total, r.number, r.seen) for r in done.collect()}, {}
    for key in ("a", "b", None):
        last, total, seen = None, 0, None
        for number, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3]), 1):
            total, seen = total + r[4], r[3] or seen
            want[r[2]] = (last, total, number, seen)
            last = r[2]
    assert found == want


def test_scans_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert version_history(empty, "k", "at", "id", ["zip", "city"]).collect() == []
    assert scan(in_order(empty, "k", ["at"]), running={"n": F.lit(1)}).collect() == []


@pytest.mark.parametrize("size", [5, 10_000])
def test_sessions_cover_every_row(spark, size):
    rows = observations(5)
    got = sessions(spark.createDataFrame(rows, SCHEMA), "k", "at", "id", ["zip", "city"], size)
    per_version = got.groupBy("k", "version").agg(F.count("*").alias("n"), F.sum("starts_new_version").alias("s"))
    assert {(r.k, r.version, r.n) for r in per_version.collect()} == {(b[0], b[1], b[6]) for b in brute_history(rows)}
    assert per_version.filter("s <> 1").count() == 0


def intervals(seed: int):
    """Gapped, overlapping, reversed, empty and open intervals."""
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        start = START + timedelta(hours=rng.randrange(60))
        end = rng.choice([None, start, start + timedelta(hours=rng.randrange(-5, 20))])
        rows.append((rng.choice(["hot", "hot", "a", None]), f"s{i}", start, end))
    return rows


@pytest.mark.parametrize("size", [5, 10_000])
def test_counts_in_malformed_intervals(spark, size):
    facts, dims = observations(7, 120), intervals(8)
    f = spark.createDataFrame(facts, SCHEMA)
    d = spark.createDataFrame(dims, "k string, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz")

    def contains(fact, dim):
        return fact[0] is not None and fact[0] == dim[0] and dim[2] <= fact[1] and (dim[3] is None or fact[1] < dim[3])

    got = {r.id: r.matches for r in match_counts(f.select("k", "at", "id"), d, "k", "at", size).collect()}
    assert got == {x[2]: sum(contains(x, y) for y in dims) for x in facts}
    used = {r.sk: r.uses for r in interval_usage(f, d, "k", "at", "sk", size).collect()}
    for y in dims:
        assert used.get(y[1], 0) == sum(contains(x, y) for x in facts)


@pytest.mark.parametrize("size", [5, 10_000])
def test_asof_lookup(spark, size):
    rows = observations(11)
    history = version_history(spark.createDataFrame(rows, SCHEMA), "k", "at", "id", ["zip", "city"])
    facts = observations(12)
    rows_in = spark.createDataFrame(facts, SCHEMA)
    got = asof_lookup(rows_in.select("k", "at", "id"), history, "k", "at", ["version"], "version", size)
    wide = asof_lookup(rows_in, history, "k", "at", ["version"], "version", size, ident="id")
    assert wide.columns == [*rows_in.columns, "version"]
    assert sorted(tuple(r) for r in wide.select("id", "version").collect()) == sorted(tuple(r) for r in got.select("id", "version").collect())
    brute = {
        (x[2], v[1]) for x in facts for v in brute_history(rows)
        if x[0] is not None and x[0] == v[0] and v[4] <= x[1] and (v[5] is None or x[1] < v[5])
    }
    assert {(r.id, r.version) for r in got.collect()} == brute


@pytest.mark.parametrize("size", [5, 10_000])
def test_version_gaps(spark, size):
    t = [START + timedelta(days=i) for i in range(4)]
    rows = [("a", 1, t[0], t[1]), ("a", 2, t[2], t[3]), ("a", 4, t[3], None), ("b", 1, t[0], None)]
    d = spark.createDataFrame(rows, "k string, v bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = {(r.k, r.v): (r.expected_version, r.breaks_adjacency) for r in version_gaps(d, "k", "v", size).collect()}
    assert got == {("a", 1): (1, False), ("a", 2): (2, True), ("a", 4): (3, False), ("b", 1): (1, False)}


def test_rows_are_shuffled_once_for_all_scans(spark):
    df = spark.createDataFrame(observations(3), SCHEMA)
    plan = sessions(df, "k", "at", "id", ["zip", "city"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 8 and "Cartesian" not in plan and "scalar-subquery" not in plan
