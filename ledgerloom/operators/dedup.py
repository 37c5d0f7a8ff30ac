"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_wins(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep one row per key, the first one in descending order of `newest_first`.

    Catalyst turns the `= 1` filter into a window-group limit that runs before the shuffle, so
    many copies of one key collapse on the map side.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")
