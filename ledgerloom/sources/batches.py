"""Partitioned, write-once batches with a content fingerprint and an event ledger."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .store import remove_folder, swap_folder

CREATED = "CREATED"
IDENTICAL_REPLAY = "IDENTICAL_REPLAY"
CONFLICT = "PROTECTED_BATCH_CONFLICT"
MISMATCH = "REMOTE_CONTENT_MISMATCH"

LEDGER_SCHEMA = "event_time timestamp_ntz, operation string, outcome string, dataset string, batch_id string, fingerprint string"
LEDGER_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
REQUIRED = ("event_time", "operation", "outcome", "dataset", "batch_id", "fingerprint")
ENVIRONMENTS = ("dev", "ci", "prod")


def batch_path(root: str, environment: str, source: str, entity: str) -> str:
    """`<root>/<environment>/raw/<source>/<entity>`."""
    if environment not in ENVIRONMENTS:
        raise ValueError(f"{environment!r} is no environment; it is one of {ENVIRONMENTS}")
    for part in (source, entity):
        if not re.fullmatch(r"[A-Za-z0-9_-]+", part):
            raise ValueError(f"Invalid path part: {part!r}")
    return f"{root}/{environment}/raw/{source}/{entity}"


def require_date(text: str) -> str:
    """A calendar date written as yyyy-mm-dd, or an error."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"{text!r} is no date written as yyyy-mm-dd")
    date.fromisoformat(text)
    return text


def write_partitioned(df: DataFrame, path: str, ingest_date: str | None = None) -> None:
    """Write by ingest_date and batch_id; `ingest_date`, if given, is checked and put into every row.

    The rebalance hint joins small partitions and splits large ones, so one big batch is written
    by many tasks and a small one does not leave a file per task.
    """
    if ingest_date is not None:
        df = df.withColumn("ingest_date", F.lit(require_date(ingest_date)))
    spread = df.hint("rebalance", "ingest_date", "batch_id")
    spread.write.partitionBy("ingest_date", "batch_id").mode("append").parquet(path)


def fingerprint_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Aggregates `rows` and `content`: independent of row order, file layout and compression."""
    names = sorted(columns or df.columns)
    parts = [p for c in names for p in (F.col(c), F.col(c).isNull())]
    digest = F.xxhash64(*parts).cast("decimal(38,0)")
    return [
        F.count("*").alias("rows"),
        F.coalesce(F.sum(digest), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("content"),
    ]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (rows, content)."""
    return df.agg(*fingerprint_columns(df, columns))


def _text(values: Mapping[str, object]) -> str:
    return f"{values['rows']}:{values['content']}"


def _stored_value(df: DataFrame, path: str) -> str:
    return _text(fingerprint(df.sparkSession.read.schema(df.schema).parquet(path)).first().asDict())


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_batch_once(df: DataFrame, path: str) -> str:
    """Create a batch, or say how it relates to the one already there; never overwrite.

    The source is computed once: its rows are fingerprinted on their way into a folder beside the
    batch, which then takes the batch's place or is dropped. A batch counts as present once its
    `_SUCCESS` marker exists: a run that died half-way is written again.
    """
    spark = df.sparkSession
    staged, seen = f"{path}.tmp-{uuid.uuid4().hex}", Observation()
    try:
        df.observe(seen, *fingerprint_columns(df)).write.parquet(staged)
        wanted = _text(seen.get)
        if _exists(spark, f"{path}/_SUCCESS"):
            return IDENTICAL_REPLAY if _stored_value(df, path) == wanted else CONFLICT
        if _stored_value(df, staged) != wanted:
            return MISMATCH
        swap_folder(spark, staged, path)
        return CREATED
    finally:
        remove_folder(spark, staged)


def append_events(events: DataFrame, path: str) -> None:
    """Append to the JSON-lines ledger; events without a required field are refused."""
    broken = invalid_events(events).limit(1).count()
    if broken:
        raise ValueError("Ledger events need " + ", ".join(REQUIRED))
    events.write.mode("append").option("timestampNTZFormat", LEDGER_TIME).json(path)


def invalid_events(events: DataFrame) -> DataFrame:
    wrong = F.lit(False)
    for name in REQUIRED:
        wrong = wrong | F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")
    return events.filter(wrong)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).option("timestampNTZFormat", LEDGER_TIME).json(path, mode="FAILFAST")
