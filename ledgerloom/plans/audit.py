"""Audit tables: invariants, run state, attempts, scorecards, evidence and recovery."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import rate
from ..operators.compare import aggregate_metrics, union_all
from ..operators.history import match_counts
from ..operators.scans import ROWS, in_order, scan

# Status domains.
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED")
QUALITY_STATUSES = ("PASS", "WARN", "FAIL", "SKIP")
RECONCILIATION_STATUSES = ("PASS", "FAIL")


@dataclass(frozen=True)
class AuditTables:
    pipeline_runs: DataFrame
    stage_runs: DataFrame
    quality: DataFrame
    reconciliation: DataFrame
    faults: DataFrame


def reconciliation_rows(counts: DataFrame) -> DataFrame:
    """Difference is target less source; only zero passes."""
    gap = F.col("target_rows") - F.col("source_rows")
    return counts.withColumns({
        "difference_rows": gap,
        "status": F.when(F.coalesce(gap == 0, F.lit(False)), "PASS").otherwise("FAIL"),
    })


def _lifecycle_rules() -> dict[str, Column]:
    ended, status = F.col("ended_at"), F.col("status")
    running_open = (status == "RUNNING") & ended.isNull()
    terminal_closed = status.isin("SUCCESS", "FAILED") & ended.isNotNull()
    return {
        "status_domain": F.count_if(~F.coalesce(status.isin(*RUN_STATUSES), F.lit(False))),
        "terminal_iff_ended": F.count_if(~F.coalesce(running_open | terminal_closed, F.lit(False))),
        "ended_before_started": F.count_if(ended < F.col("started_at")),
        "success_with_error": F.count_if(
            (status == "SUCCESS") & (F.col("error_type").isNotNull() | F.col("error_message").isNotNull())
        ),
    }


def _required(*names: str) -> Column:
    missing = F.lit(False)
    for n in names:
        missing = missing | F.col(n).isNull()
    return F.count_if(missing)


def _repeated(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    again = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return again.agg(F.count("*").alias("value")).select(F.lit(rule).alias("metric"), "value")


def _orphans(df: DataFrame, runs: DataFrame) -> DataFrame:
    per_run = df.groupBy("run_id").agg(F.count("*").alias("n"))
    alone = per_run.join(runs.select("run_id"), "run_id", "left_anti")
    return alone.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value")).select(F.lit("unknown_run").alias("metric"), "value")


def audit_invariants(t: AuditTables) -> DataFrame:
    """(table_name, invariant, violations)."""
    in_domain = lambda values: F.count_if(~F.coalesce(F.col("status").isin(*values), F.lit(False)))
    rules = {
        "pipeline_runs": [
            aggregate_metrics(t.pipeline_runs, {
                **_lifecycle_rules(), "required": _required("run_id", "pipeline_name", "environment", "started_at"),
            }),
            _repeated(t.pipeline_runs, ["run_id"], "duplicate_id"),
        ],
        "stage_runs": [
            aggregate_metrics(t.stage_runs, {
                **_lifecycle_rules(), "required": _required("stage_attempt_id", "run_id", "stage_name", "started_at"),
                "attempt_below_one": F.count_if(F.col("attempt_number") < 1),
            }),
            _repeated(t.stage_runs, ["stage_attempt_id"], "duplicate_id"),
            _repeated(t.stage_runs, ["run_id", "stage_name", "attempt_number"], "duplicate_attempt"),
            _orphans(t.stage_runs, t.pipeline_runs),
        ],
        "data_quality_results": [
            aggregate_metrics(t.quality, {
                "status_domain": in_domain(QUALITY_STATUSES),
                "required": _required("quality_result_id", "run_id", "test_name", "executed_at"),
            }),
            _repeated(t.quality, ["quality_result_id"], "duplicate_id"),
            _orphans(t.quality, t.pipeline_runs),
        ],
        "reconciliation_results": [
            aggregate_metrics(t.reconciliation, {
                "status_domain": in_domain(RECONCILIATION_STATUSES),
                "required": _required("reconciliation_result_id", "run_id", "entity_name", "executed_at"),
                "negative_source_rows": F.count_if(F.col("source_rows") < 0),
                "negative_target_rows": F.count_if(F.col("target_rows") < 0),
                "status_contradicts_difference": F.count_if(
                    (F.col("status") == "PASS") != F.coalesce(F.col("difference_rows") == 0, F.lit(False))
                ),
            }),
            _repeated(t.reconciliation, ["reconciliation_result_id"], "duplicate_id"),
            _orphans(t.reconciliation, t.pipeline_runs),
        ],
        "fault_injection_results": [
            aggregate_metrics(t.faults, {
                "required": _required(
                    "fault_result_id", "run_id", "fault_type", "injection_stage", "expected_control", "detected", "executed_at"),
                "undetected_with_detection": F.count_if(
                    ~F.col("detected") & (F.col("detection_stage").isNotNull() | F.col("detection_time").isNotNull())
                ),
            }),
            _repeated(t.faults, ["fault_result_id"], "duplicate_id"),
            _orphans(t.faults, t.pipeline_runs),
        ],
    }
    return union_all([
        union_all(frames).select(
            F.lit(table).alias("table_name"), F.col("metric").alias("invariant"), F.col("value").alias("violations")
        )
        for table, frames in rules.items()
    ])


def current_state(events: DataFrame, subject: str) -> DataFrame:
    """State per subject; events are (subject, event_at, sequence, status, ...).

    Without event ids it is the latest event. Events with an id come from writers that may do the same at
    the same time: of several ends the first counts, by time and then by id.
    """
    rest = [c for c in events.columns if c != subject]
    over, whole = F.col("status") != "RUNNING", F.struct(*rest)
    state = F.max_by(whole, F.struct("event_at", "sequence"))
    if "event_id" in rest:
        place = F.struct("event_at", "event_id")
        state = F.coalesce(F.min_by(whole, F.when(over, place)), F.min_by(whole, place))
    started = F.min(F.when(~over, F.col("event_at")))
    return events.groupBy(subject).agg(state.alias("e"), started.alias("started_at")).select(
        subject, "e.status", "started_at",
        F.when(F.col("e.status") != "RUNNING", F.col("e.event_at")).alias("ended_at"),
    )


def transition_violations(events: DataFrame, subject: str, rows: int = ROWS) -> DataFrame:
    """(subject, event_at, violation): only START then FINISH is allowed."""
    before = F.col("__previous")["status"]
    problem = (
        F.when((F.col("status") == "RUNNING") & before.isNotNull(), "started_twice")
        .when((F.col("status") != "RUNNING") & before.isNull(), "finished_without_start")
        .when((F.col("status") != "RUNNING") & (before != "RUNNING"), "finished_twice")
    )
    ordered = in_order(events, subject, ["event_at", "sequence"], rows)
    scanned = scan(ordered, previous={"__previous": F.struct("status")})
    return scanned.select(subject, "event_at", problem.alias("violation")).filter("violation is not null")


def run_state(runs_events: DataFrame, stages: DataFrame, rows: int = ROWS) -> DataFrame:
    """Current run state and the stages still active when the run finished."""
    state = current_state(runs_events, "run_id")
    intervals = stages.select(
        "run_id", F.col("started_at").alias("valid_from"), F.col("ended_at").alias("valid_to")
    )
    counted = match_counts(state, intervals, "run_id", "ended_at", rows)
    return counted.select(
        "run_id", "status", "started_at", "ended_at", F.col("matches").alias("active_stages"),
        ((F.col("status") == "RUNNING") | (F.col("matches") == 0)).alias("valid_finish"),
    )


def stage_attempts(stages: DataFrame, rows: int = ROWS) -> DataFrame:
    """Expected attempt number and whether the attempt was allowed (first, or after a failure)."""
    keyed = stages.select(
        "run_id", "stage_name", "stage_attempt_id", "attempt_number", "started_at", "status",
        F.struct("run_id", "stage_name").alias("__chain"),
    )
    ordered = in_order(keyed, "__chain", ["started_at", "attempt_number"], rows)
    scanned = scan(ordered, previous={"__before": F.struct("status")}, running={"expected_attempt": F.lit(1)})
    before = F.col("__before")["status"]
    return scanned.select(
        "run_id", "stage_name", "stage_attempt_id", "attempt_number",
        F.col("expected_attempt").cast("bigint").alias("expected_attempt"), before.alias("previous_status"),
        (F.col("__before").isNull() | F.coalesce(before == "FAILED", F.lit(False))).alias("allowed"),
    )


def run_scorecard(t: AuditTables) -> DataFrame:
    """One row per run with stage, quality, reconciliation and fault metrics."""
    status = F.col("status")
    stages = t.stage_runs.groupBy("run_id").agg(
        F.count("*").alias("stage_attempts"),
        F.count_if(status == "SUCCESS").alias("successful_stage_attempts"),
        F.count_if(status == "FAILED").alias("failed_stage_attempts"),
        F.count_if(status.isin("SUCCESS", "FAILED")).alias("completed_stage_attempts"),
        F.sum(F.col("attempt_number") - 1).cast("bigint").alias("retry_count"),
    )
    quality = t.quality.groupBy("run_id").agg(
        F.count("*").alias("quality_results"), F.count_if(status == "PASS").alias("quality_passes"),
        F.count_if(status.isin("PASS", "WARN", "FAIL")).alias("evaluated_quality_results"),
    )
    reconciliation = t.reconciliation.groupBy("run_id").agg(
        F.count("*").alias("reconciliation_results"), F.count_if(status == "PASS").alias("reconciliation_passes"),
        F.sum(F.abs("difference_rows")).cast("bigint").alias("absolute_row_difference"),
    )
    faults = t.faults.groupBy("run_id").agg(
        F.count("*").alias("fault_injections"), F.count_if("detected").alias("detected_faults")
    )
    card = t.pipeline_runs
    for part in (stages, quality, reconciliation, faults):
        card = card.join(part, "run_id", "left")
    # The times have no zone, and neither has their distance: whole days and the time within them.
    def millis_of(name: str) -> Column:
        at, day = F.col(name), F.to_date(name)
        clock = (F.hour(at) * 3600 + F.minute(at) * 60) * 1000 + F.floor(F.extract(F.lit("SECOND"), at) * 1000)
        return F.unix_date(day).cast("bigint") * 86_400_000 + clock

    millis = millis_of("ended_at") - millis_of("started_at")
    counters = [c for part in (stages, quality, reconciliation, faults) for c in part.columns if c != "run_id"]
    return card.select(
        "run_id", "pipeline_name", "environment", "batch_id", "status", "started_at", "ended_at",
        (millis.cast("double") / 1000.0).alias("duration_seconds"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counters],
    )


def historical_scorecard(card: DataFrame) -> DataFrame:
    """Totals and rates per pipeline and environment."""
    status = F.col("status")
    completed = status.isin("SUCCESS", "FAILED")

    def summed(name: str) -> Column:
        return F.sum(name).cast("bigint")

    totals = (
        "stage_attempts", "failed_stage_attempts", "completed_stage_attempts", "retry_count",
        "quality_results", "quality_passes", "reconciliation_results", "reconciliation_passes",
        "absolute_row_difference", "fault_injections", "detected_faults",
    )
    return card.groupBy("pipeline_name", "environment").agg(
        F.count("*").alias("total_runs"), F.count_if(completed).alias("completed_runs"),
        F.count_if(status == "SUCCESS").alias("successful_runs"),
        F.count_if(status == "FAILED").alias("failed_runs"),
        rate(F.count_if(status == "SUCCESS"), F.count_if(completed)).alias("pipeline_success_rate"),
        *[summed(t).alias(t) for t in totals],
        rate(summed("failed_stage_attempts"), summed("completed_stage_attempts")).alias("stage_failure_rate"),
        rate(summed("quality_passes"), summed("evaluated_quality_results")).alias("quality_pass_rate"),
        rate(summed("reconciliation_passes"), summed("reconciliation_results")).alias("reconciliation_pass_rate"),
        rate(summed("detected_faults"), summed("fault_injections")).alias("fault_detection_rate"),
        F.round(F.avg(F.when(completed, F.col("duration_seconds"))), 6).alias("average_duration_seconds"),
    )


# --- evidence -------------------------------------------------------------------------------

QUALITY_TEST = "raw_batch_integrity"


def _beside(left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the number of attempts: sorted and merged, never sent whole to the driver.

    The planner takes rows times tables for no larger than the rows, and would broadcast them by that size.
    """
    return left.join(right.hint("merge"), key, how)


@dataclass(frozen=True)
class Workflow:
    """The only pipeline and stage whose runs may be finalised after a crash."""

    pipeline_name: str
    stage_name: str
    tables: Sequence[str]


def _identity(t: AuditTables, requests: DataFrame) -> DataFrame:
    """Requests with the state of the one run and stage they name."""
    runs = t.pipeline_runs.select(
        "run_id", "pipeline_name", F.col("status").alias("run_status"), F.col("batch_id").alias("recorded_batch")
    )
    stages = t.stage_runs.select("run_id", "stage_attempt_id", "stage_name", F.col("status").alias("stage_status"))
    found = _beside(runs, stages, "run_id").groupBy("run_id", "stage_attempt_id").agg(
        F.count("*").alias("identities"),
        *[F.first(c).alias(c) for c in ("pipeline_name", "run_status", "recorded_batch", "stage_name", "stage_status")],
    )
    return _beside(requests, found, ["run_id", "stage_attempt_id"], "left")


def _reconciliation_reasons(
    t: AuditTables, requests: DataFrame, expected: DataFrame, tables: Sequence[str]
) -> DataFrame:
    """(run_id, stage_attempt_id, reconciliation_reason) per request; NULL when all rows pass.

    Single rows matter only where the row count is right, so they are examined in groups of at
    most one row per expected table.
    """
    key = ["run_id", "stage_attempt_id"]
    n = len(tables)
    counted = t.reconciliation.groupBy(*key).agg(F.count("*").alias("rows"))
    complete = counted.filter(F.col("rows") == n).select(*key)
    wanted = requests.select(*key, F.col("batch_id").alias("wanted_batch"))
    rows = _beside(_beside(t.reconciliation, complete, key, "left_semi"), wanted, key)
    rows = _beside(rows, expected, ["run_id", "entity_name"], "left")
    entity = F.col("entity_name")
    position = F.struct("executed_at", "reconciliation_result_id")
    first = rows.groupBy(*key, "entity_name").agg(F.min(position).alias("__first"))
    placed = _beside(rows, first, [*key, "entity_name"])
    failed = ~F.coalesce(
        (F.col("source_rows") == F.col("expected_rows")) & (F.col("target_rows") == F.col("expected_rows"))
        & (F.col("difference_rows") == 0) & (F.col("status") == "PASS"), F.lit(False)
    )
    reason = (
        F.when(~entity.isin(list(tables)), "UNEXPECTED_RECONCILIATION_ENTITY")
        .when(position != F.col("__first"), "DUPLICATE_RECONCILIATION_ENTITY")
        .when(~F.col("batch_id").eqNullSafe(F.col("wanted_batch")), F.concat(F.lit("RECONCILIATION_BATCH_MISMATCH:"), entity))
        .when(failed, F.concat(F.lit("RECONCILIATION_FAILED:"), entity))
    )
    judged = placed.withColumn("__reason", reason)
    bad = F.col("__reason").isNotNull()
    per_attempt = judged.groupBy(*key).agg(
        F.min_by("__reason", F.when(bad, position)).alias("first_reason"), F.count_if(bad).alias("failures"),
        F.count_distinct("entity_name").alias("entities"),
    )
    verdict = (
        F.when(~F.coalesce(F.col("rows") == n, F.lit(False)), "RECONCILIATION_COUNT_MISMATCH")
        .when(F.col("failures") > 0, F.col("first_reason"))
        .when(F.col("entities") != n, "RECONCILIATION_COVERAGE_INCOMPLETE")
    )
    return _beside(_beside(requests.select(*key), counted, key, "left"), per_attempt, key, "left").select(
        *key, verdict.alias("reconciliation_reason")
    )


def _quality_counts(t: AuditTables) -> DataFrame:
    passing = (F.col("status") == "PASS") & F.col("entity_name").isNull()
    return t.quality.filter(F.col("test_name") == QUALITY_TEST).groupBy("run_id", "stage_attempt_id").agg(
        F.count("*").alias("quality_rows"), F.count_if(passing).alias("quality_passing")
    )


def _judged(
    t: AuditTables, requests: DataFrame, expected: DataFrame, tables: Sequence[str]
) -> DataFrame:
    key = ["run_id", "stage_attempt_id"]
    reasons = _reconciliation_reasons(t, requests, expected, tables)
    return _beside(_beside(_identity(t, requests), reasons, key, "left"), _quality_counts(t), key, "left")


def _not(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def _verdict(judged: DataFrame, reason: Column, success: str) -> DataFrame:
    return judged.select(
        "run_id", "stage_attempt_id", reason.isNull().alias("verified"),
        F.coalesce(reason, F.lit(success)).alias("reason"),
    )


def ingestion_evidence(
    t: AuditTables, requests: DataFrame, expected: DataFrame, tables: Sequence[str]
) -> DataFrame:
    """(run_id, stage_attempt_id, verified, reason) for every requested attempt.

    `requests` is (run_id, stage_attempt_id, batch_id); `expected` is (run_id, entity_name,
    expected_rows). The first failing rule names the reason.
    """
    c = F.col
    reason = (
        F.when(_not(c("identities") == 1), "RUN_STAGE_IDENTITY_MISMATCH")
        .when(_not((c("run_status") == "RUNNING") & (c("stage_status") == "RUNNING")), "AUDIT_STAGE_NOT_ACTIVE")
        .when(~c("recorded_batch").eqNullSafe(c("batch_id")), "PIPELINE_BATCH_MISMATCH")
        .when(c("reconciliation_reason").isNotNull(), c("reconciliation_reason"))
        .when(_not(c("quality_rows") == 1), "RAW_BATCH_QUALITY_COUNT_MISMATCH")
        .when(_not(c("quality_passing") == 1), "RAW_BATCH_QUALITY_NOT_PASSING")
    )
    return _verdict(_judged(t, requests, expected, tables), reason, "INGESTION_EVIDENCE_VERIFIED")


def recovery_evidence(
    t: AuditTables, requests: DataFrame, expected: DataFrame, workflow: Workflow
) -> DataFrame:
    """As `ingestion_evidence`, for a run still RUNNING whose single stage already succeeded."""
    c = F.col
    per_run = t.stage_runs.groupBy("run_id").agg(
        F.count("*").alias("run_stages"),
        F.count_if((c("stage_name") == workflow.stage_name) & (c("status") == "SUCCESS")).alias("good_stages"),
    )
    judged = _beside(_judged(t, requests, expected, workflow.tables), per_run, "run_id", "left")
    named = (c("pipeline_name") == workflow.pipeline_name) & (c("stage_name") == workflow.stage_name)
    reason = (
        F.when(_not(c("identities") == 1), "RUN_STAGE_IDENTITY_MISMATCH")
        .when(_not(named), "INGESTION_IDENTITY_MISMATCH")
        .when(_not((c("run_status") == "RUNNING") & (c("stage_status") == "SUCCESS")), "RECOVERY_LIFECYCLE_MISMATCH")
        .when(~c("recorded_batch").eqNullSafe(c("batch_id")), "PIPELINE_BATCH_MISMATCH")
        .when(_not((c("run_stages") == 1) & (c("good_stages") == 1)), "UNEXPECTED_STAGE_ATTEMPTS")
        .when(c("reconciliation_reason").isNotNull(), c("reconciliation_reason"))
        .when(_not((c("quality_rows") == 1) & (c("quality_passing") == 1)), "RAW_BATCH_QUALITY_NOT_PASSING")
    )
    return _verdict(judged, reason, "PIPELINE_RECOVERY_EVIDENCE_VERIFIED")


FINALIZED = "PIPELINE_RECOVERY_FINALIZED"


def recovery_decisions(evidence: DataFrame, raw_verdicts: DataFrame, stages: DataFrame) -> DataFrame:
    """(run_id, recoverable, decision): RAW first, then evidence, then active stages.

    `raw_verdicts` is (run_id, raw_verified, raw_reason).
    """
    active = stages.groupBy("run_id").agg(F.count_if(F.col("status") == "RUNNING").alias("active"))
    joined = _beside(_beside(evidence, raw_verdicts, "run_id", "left"), active, "run_id", "left")
    refused = (
        F.when(_not(F.col("raw_verified")), F.concat(
            F.lit("RAW_VERIFICATION_FAILED:"), F.coalesce("raw_reason", F.lit("RAW_DATABASE_MISSING"))))
        .when(~F.col("verified"), F.concat(F.lit("AUDIT_EVIDENCE_REJECTED:"), F.col("reason")))
        .when(F.coalesce("active", F.lit(0)) > 0, "ACTIVE_STAGE_ATTEMPTS_PRESENT")
    )
    return joined.select(
        "run_id", refused.isNull().alias("recoverable"), F.coalesce(refused, F.lit(FINALIZED)).alias("decision")
    )


def finish_events(decisions: DataFrame, at: str) -> DataFrame:
    """Lifecycle events that finalise the recoverable runs."""
    return decisions.filter("recoverable").select(
        "run_id", F.lit(at).cast("timestamp_ntz").alias("event_at"), F.lit(2).alias("sequence"),
        F.lit("SUCCESS").alias("status"),
    )
