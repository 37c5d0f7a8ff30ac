"""Repeatable timing of queries and an evidence record."""

from __future__ import annotations

import hashlib
import platform
import statistics
import time
from collections.abc import Callable, Mapping

import pyspark
from pyspark.sql import DataFrame


MOST_RUNS = 100


class UnstableResult(RuntimeError):
    """Two runs of one query returned different rows: its time says nothing."""


def timed(action: Callable[[], object], runs: int) -> tuple[list[float], list[object]]:
    """Milliseconds and outcomes of `runs` runs after one that is not counted."""
    if runs not in range(1, MOST_RUNS + 1):
        raise ValueError(f"runs is {runs}; it goes from 1 to {MOST_RUNS}")
    clock = [time.perf_counter_ns()]
    outcomes = []
    for _ in range(runs + 1):
        outcomes.append(action())
        clock.append(time.perf_counter_ns())
    return [(b - a) / 1e6 for a, b in zip(clock[1:], clock[2:], strict=False)], outcomes


def measure(build: Callable[[], DataFrame], repetitions: int = 5) -> dict[str, float]:
    """Time a query whose small result comes to the driver, and make sure that it is the same every time."""
    times, results = timed(lambda: build().collect(), repetitions)
    if len({tuple(sorted(map(repr, rows))) for rows in results}) > 1:
        raise UnstableResult("the rows differ from run to run")
    return summary(times)


def measure_write(build: Callable[[], DataFrame], repetitions: int = 3) -> dict[str, float]:
    """Time a query with a large result: every row is computed and dropped by the executors."""
    return summary(timed(lambda: build().write.format("noop").mode("overwrite").save(), repetitions)[0])


def summary(samples: list[float]) -> dict[str, float]:
    return {
        "repetitions": len(samples), "min_ms": min(samples),
        "median_ms": statistics.median(samples), "max_ms": max(samples),
    }


def evidence(results: Mapping[str, Mapping[str, float]], sql: Mapping[str, str]) -> dict[str, object]:
    """Timings with the fingerprint of each query's SQL and the environment."""
    return {
        "schema_version": 1,
        "environment": {
            "python": platform.python_version(), "pyspark": pyspark.__version__, "platform": platform.platform(),
        },
        "queries": {
            name: {**timing, "sql_sha256": hashlib.sha256(" ".join(sql[name].split()).encode()).hexdigest()}
            for name, timing in results.items() if name in sql
        },
        "limitations": ["Caches and machine load are not controlled."],
    }
