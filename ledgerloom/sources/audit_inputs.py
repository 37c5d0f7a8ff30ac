"""Audit tables derived from the driver's events and customers (FIXTURES.md, section 5)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.scans import in_order, scan
from ..plans.audit import QUALITY_TEST, AuditTables, reconciliation_rows
from .commerce import ENTITIES, days, seconds

PIPELINE = "raw_ingestion"
STAGE = "raw_load"


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _run_id() -> Column:
    return F.concat(F.lit("run_"), F.col("user_id").cast("string"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def numbered_events(events: DataFrame) -> DataFrame:
    """Events with their attempt number within (user, type)."""
    keyed = events.withColumn("__chain", F.struct("user_id", "event_type"))
    return scan(in_order(keyed, "__chain", ["ts", "event_id"]), running={"attempt": F.lit(1)}).drop("__chain")


def event_audit(table: Callable[[str], DataFrame]) -> AuditTables:
    events = table("events")
    user, whole = F.col("user_id"), F.floor("value")
    runs = events.groupBy("user_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("last")).select(
        _run_id().alias("run_id"),
        F.when(user % 3 == 0, "orders").otherwise("items").alias("pipeline_name"),
        F.when(user % 2 == 0, "dev").otherwise("ci").alias("environment"),
        F.concat(F.lit("batch_"), user.cast("string")).alias("batch_id"),
        "started_at", (F.col("last") + seconds(F.lit(1))).alias("ended_at"),
        F.when(user % 5 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        _null().alias("error_type"), _null().alias("error_message"),
    )
    stages = numbered_events(events).select(
        _text("event_id").alias("stage_attempt_id"), _run_id().alias("run_id"),
        F.col("event_type").alias("stage_name"), F.col("attempt").cast("int").alias("attempt_number"),
        F.col("ts").alias("started_at"), (F.col("ts") + seconds(whole)).alias("ended_at"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("event_type") == "error", "RuntimeError").alias("error_type"), _null().alias("error_message"),
    )
    tested = events.filter(F.col("event_type").isin("view", "click"))
    quality = tested.select(
        _text("event_id").alias("quality_result_id"), _run_id().alias("run_id"),
        _text("event_id").alias("stage_attempt_id"), F.col("event_type").alias("test_name"),
        _null().alias("entity_name"), F.when(F.col("value") < 50, "PASS").otherwise("FAIL").alias("status"),
        F.col("ts").alias("executed_at"),
    )
    counted = events.filter("event_type = 'purchase'").select(
        _text("event_id").alias("reconciliation_result_id"), _run_id().alias("run_id"),
        _text("event_id").alias("stage_attempt_id"), F.lit("orders").alias("entity_name"),
        F.concat(F.lit("batch_"), user.cast("string")).alias("batch_id"),
        whole.alias("source_rows"), (whole - F.col("event_id") % 2).alias("target_rows"),
        F.col("ts").alias("executed_at"),
    )
    found = F.col("event_id") % 3 != 0
    faults = events.filter("event_type = 'signup'").select(
        _text("event_id").alias("fault_result_id"), _run_id().alias("run_id"),
        F.lit("row_loss").alias("fault_type"), F.col("event_type").alias("injection_stage"),
        F.lit("reconciliation").alias("expected_control"), found.alias("detected"),
        F.when(found, F.col("event_type")).alias("detection_stage"), F.when(found, F.col("ts")).alias("detection_time"),
        F.col("ts").alias("executed_at"),
    )
    return AuditTables(runs, stages, quality, reconciliation_rows(counted), faults)


def lifecycle_events(runs: DataFrame) -> DataFrame:
    """Start and finish events of finished runs."""
    started = runs.select("run_id", F.col("started_at").alias("event_at"), F.lit(1).alias("sequence"), F.lit("RUNNING").alias("status"))
    finished = runs.select("run_id", F.col("ended_at").alias("event_at"), F.lit(2).alias("sequence"), "status")
    return started.unionByName(finished)


def evidence_audit(
    table: Callable[[str], DataFrame], entities: Sequence[str] = ENTITIES
) -> tuple[AuditTables, DataFrame, DataFrame, DataFrame]:
    """One ingestion run per customer with every kind of damage: (tables, requests, expected, raw verdicts)."""
    people = table("customer").select("c_custkey", "c_acctbal")
    key = F.col("c_custkey")
    text = key.cast("string")
    run, stage, batch = (F.concat(F.lit(p), text) for p in ("run_", "stage_", "batch_"))
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    run_status = F.when(key % 11 == 0, "SUCCESS").otherwise("RUNNING")
    runs = people.select(
        run.alias("run_id"), F.when(key % 31 == 0, "other").otherwise(PIPELINE).alias("pipeline_name"),
        F.lit("dev").alias("environment"), F.when(key % 13 == 0, "batch_x").otherwise(batch).alias("batch_id"),
        start.alias("started_at"), F.when(key % 11 == 0, start + days(1)).alias("ended_at"),
        run_status.alias("status"), _null().alias("error_type"), _null().alias("error_message"),
    )
    stage_status = F.when(key % 2 == 0, "RUNNING").otherwise("SUCCESS")

    def stage_rows(df: DataFrame, ident: Column, number: int) -> DataFrame:
        return df.select(
            ident.alias("stage_attempt_id"), run.alias("run_id"), F.lit(STAGE).alias("stage_name"),
            F.lit(number).alias("attempt_number"), start.alias("started_at"),
            F.when(key % 2 != 0, start + days(1)).alias("ended_at"), stage_status.alias("status"),
            _null().alias("error_type"), _null().alias("error_message"),
        )

    stages = stage_rows(people.filter(key % 17 != 0), stage, 1).unionByName(
        stage_rows(people.filter(key % 19 == 0), F.concat(stage, F.lit("_b")), 2)
    )
    listed = people.select("c_custkey", F.posexplode(F.array(*map(F.lit, entities))).alias("pos", "entity"))
    i, name = F.col("pos"), F.col("entity")
    rows = (key + i).cast("bigint")
    shown = (
        F.when((key % 37 == 0) & (i == 8), entities[0]).when((key % 43 == 0) & (i == 8), "refunds").otherwise(name)
    )
    counts = listed.filter(~((key % 29 == 0) & (i == 5))).select(
        F.concat_ws("_", text, i.cast("string")).alias("reconciliation_result_id"), run.alias("run_id"),
        stage.alias("stage_attempt_id"), shown.alias("entity_name"),
        F.when((key % 41 == 0) & (i == 2), "batch_y").otherwise(batch).alias("batch_id"),
        F.when((key % 37 == 0) & (i == 8), key).otherwise(rows).alias("source_rows"),
        F.when((key % 23 == 0) & (i == 3), rows - 1).when((key % 37 == 0) & (i == 8), key).otherwise(rows)
        .alias("target_rows"),
        (start + seconds(i)).alias("executed_at"),
    )

    def quality_rows(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            F.concat(F.lit(f"quality{suffix}_"), text).alias("quality_result_id"), run.alias("run_id"),
            stage.alias("stage_attempt_id"), F.lit(QUALITY_TEST).alias("test_name"), _null().alias("entity_name"),
            F.when(key % 53 == 0, "FAIL").otherwise("PASS").alias("status"), start.alias("executed_at"),
        )

    quality = quality_rows(people.filter(key % 47 != 0), "").unionByName(quality_rows(people.filter(key % 59 == 0), "_b"))
    no_faults = people.limit(0).select(run.alias("run_id"), F.lit(True).alias("detected"))
    requests = people.select(run.alias("run_id"), stage.alias("stage_attempt_id"), batch.alias("batch_id"))
    expected = listed.select(
        run.alias("run_id"), name.alias("entity_name"),
        F.when((key % 61 == 0) & (i == 6), rows + 1).otherwise(rows).alias("expected_rows"),
    )
    solvent = F.col("c_acctbal") >= 0
    verdicts = people.select(
        run.alias("run_id"), solvent.alias("raw_verified"),
        F.when(solvent, "RAW_BATCH_VERIFIED").otherwise("ROW_COUNT_MISMATCH:orders").alias("raw_reason"),
    )
    tables = AuditTables(runs, stages, quality, reconciliation_rows(counts), no_faults)
    return tables, requests, expected, verdicts
