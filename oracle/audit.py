"""Oracle SQL for audit queries."""

from __future__ import annotations

from .base import with_ctes
from .ingestion import ENTITIES

EVENT_TABLES = {
    "a_runs": """
    SELECT 'run_' || user_id AS run_id, CASE WHEN user_id % 3 = 0 THEN 'orders' ELSE 'items' END AS pipeline_name,
        CASE WHEN user_id % 2 = 0 THEN 'dev' ELSE 'ci' END AS environment, 'batch_' || user_id AS batch_id,
        min(ts) AS started_at, max(ts) + INTERVAL 1 SECOND AS ended_at,
        CASE WHEN user_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
    FROM events GROUP BY user_id""",
    "a_stages": """
    SELECT CAST(event_id AS VARCHAR) AS stage_attempt_id, 'run_' || user_id AS run_id, event_type AS stage_name,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS attempt_number,
        ts AS started_at, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS ended_at,
        CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status
    FROM events""",
    "a_quality": """
    SELECT CAST(event_id AS VARCHAR) AS id, 'run_' || user_id AS run_id,
        CASE WHEN value < 50 THEN 'PASS' ELSE 'FAIL' END AS status FROM events WHERE event_type IN ('view', 'click')""",
    "a_recon": """
    SELECT CAST(event_id AS VARCHAR) AS reconciliation_result_id, 'run_' || user_id AS run_id,
        CAST(event_id AS VARCHAR) AS stage_attempt_id, 'orders' AS entity_name, 'batch_' || user_id AS batch_id,
        CAST(floor(value) AS BIGINT) AS source_rows, CAST(floor(value) AS BIGINT) - event_id % 2 AS target_rows,
        ts AS executed_at, -(event_id % 2) AS difference_rows,
        CASE WHEN event_id % 2 = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM events WHERE event_type = 'purchase'""",
    "a_faults": """
    SELECT 'run_' || user_id AS run_id, event_id % 3 <> 0 AS detected FROM events WHERE event_type = 'signup'""",
    "a_card": """
    WITH s AS (SELECT run_id, count(*) AS stage_attempts,
            count(*) FILTER (WHERE status = 'SUCCESS') AS successful_stage_attempts,
            count(*) FILTER (WHERE status = 'FAILED') AS failed_stage_attempts,
            count(*) FILTER (WHERE status IN ('SUCCESS', 'FAILED')) AS completed_stage_attempts,
            sum(attempt_number - 1) AS retry_count FROM a_stages GROUP BY run_id),
        q AS (SELECT run_id, count(*) AS quality_results, count(*) FILTER (WHERE status = 'PASS') AS quality_passes,
            count(*) FILTER (WHERE status IN ('PASS', 'WARN', 'FAIL')) AS evaluated_quality_results
            FROM a_quality GROUP BY run_id),
        r AS (SELECT run_id, count(*) AS reconciliation_results,
            count(*) FILTER (WHERE status = 'PASS') AS reconciliation_passes,
            sum(abs(difference_rows)) AS absolute_row_difference FROM a_recon GROUP BY run_id),
        f AS (SELECT run_id, count(*) AS fault_injections, count(*) FILTER (WHERE detected) AS detected_faults
            FROM a_faults GROUP BY run_id)
    SELECT p.run_id, pipeline_name, environment, batch_id, p.status, started_at, ended_at,
        date_diff('millisecond', started_at, ended_at) / 1000.0 AS duration_seconds,
        coalesce(stage_attempts, 0) AS stage_attempts,
        coalesce(successful_stage_attempts, 0) AS successful_stage_attempts,
        coalesce(failed_stage_attempts, 0) AS failed_stage_attempts,
        coalesce(completed_stage_attempts, 0) AS completed_stage_attempts,
        CAST(coalesce(retry_count, 0) AS BIGINT) AS retry_count, coalesce(quality_results, 0) AS quality_results,
        coalesce(quality_passes, 0) AS quality_passes,
        coalesce(evaluated_quality_results, 0) AS evaluated_quality_results,
        coalesce(reconciliation_results, 0) AS reconciliation_results,
        coalesce(reconciliation_passes, 0) AS reconciliation_passes,
        CAST(coalesce(absolute_row_difference, 0) AS BIGINT) AS absolute_row_difference,
        coalesce(fault_injections, 0) AS fault_injections, coalesce(detected_faults, 0) AS detected_faults
    FROM a_runs p LEFT JOIN s USING (run_id) LEFT JOIN q USING (run_id) LEFT JOIN r USING (run_id)
    LEFT JOIN f USING (run_id)""",
}
TOTALS = ["stage_attempts", "failed_stage_attempts", "completed_stage_attempts", "retry_count", "quality_results",
          "quality_passes", "reconciliation_results", "reconciliation_passes", "absolute_row_difference",
          "fault_injections", "detected_faults"]


def _rate(a: str, b: str, name: str) -> str:
    return f"round(CAST(sum({a}) AS DOUBLE) / nullif(sum({b}), 0), 6) AS {name}"


HISTORY = f"""
    SELECT pipeline_name, environment, count(*) AS total_runs,
        count(*) FILTER (WHERE status IN ('SUCCESS', 'FAILED')) AS completed_runs,
        count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
        count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
        round(CAST(count(*) FILTER (WHERE status = 'SUCCESS') AS DOUBLE)
            / nullif(count(*) FILTER (WHERE status IN ('SUCCESS', 'FAILED')), 0), 6) AS pipeline_success_rate,
        {', '.join(f'CAST(sum({t}) AS BIGINT) AS {t}' for t in TOTALS)},
        {_rate('failed_stage_attempts', 'completed_stage_attempts', 'stage_failure_rate')},
        {_rate('quality_passes', 'evaluated_quality_results', 'quality_pass_rate')},
        {_rate('reconciliation_passes', 'reconciliation_results', 'reconciliation_pass_rate')},
        {_rate('detected_faults', 'fault_injections', 'fault_detection_rate')},
        round(avg(duration_seconds) FILTER (WHERE status IN ('SUCCESS', 'FAILED')), 6) AS average_duration_seconds
    FROM a_card GROUP BY 1, 2"""

INVARIANTS = {
    "pipeline_runs": {
        "status_domain": "0", "terminal_iff_ended": "SELECT count(*) FROM a_runs WHERE ended_at IS NULL",
        "ended_before_started": "SELECT count(*) FROM a_runs WHERE ended_at < started_at", "success_with_error": "0",
        "required": "SELECT count(*) FROM a_runs WHERE run_id IS NULL OR started_at IS NULL",
        "duplicate_id": "SELECT count(*) - count(DISTINCT run_id) FROM a_runs",
    },
    "stage_runs": {
        "status_domain": "0", "terminal_iff_ended": "SELECT count(*) FROM a_stages WHERE ended_at IS NULL",
        "ended_before_started": "SELECT count(*) FROM a_stages WHERE ended_at < started_at", "success_with_error": "0",
        "required": "SELECT count(*) FROM a_stages WHERE run_id IS NULL OR stage_name IS NULL OR started_at IS NULL",
        "attempt_below_one": "SELECT count(*) FROM a_stages WHERE attempt_number < 1",
        "duplicate_id": "SELECT count(*) - count(DISTINCT stage_attempt_id) FROM a_stages",
        "duplicate_attempt": "SELECT count(*) - count(DISTINCT (run_id, stage_name, attempt_number)) FROM a_stages",
        "unknown_run": "SELECT count(*) FROM a_stages WHERE run_id NOT IN (SELECT run_id FROM a_runs)",
    },
    "data_quality_results": {
        "status_domain": "0", "required": "0",
        "duplicate_id": "SELECT count(*) - count(DISTINCT id) FROM a_quality",
        "unknown_run": "SELECT count(*) FROM a_quality WHERE run_id NOT IN (SELECT run_id FROM a_runs)",
    },
    "reconciliation_results": {
        "status_domain": "0", "required": "0",
        "negative_source_rows": "SELECT count(*) FROM a_recon WHERE source_rows < 0",
        "negative_target_rows": "SELECT count(*) FROM a_recon WHERE target_rows < 0",
        "status_contradicts_difference": "0",
        "duplicate_id": "SELECT count(*) - count(DISTINCT reconciliation_result_id) FROM a_recon",
        "unknown_run": "SELECT count(*) FROM a_recon WHERE run_id NOT IN (SELECT run_id FROM a_runs)",
    },
    "fault_injection_results": {
        "required": "0", "undetected_with_detection": "0", "duplicate_id": "0",
        "unknown_run": "SELECT count(*) FROM a_faults WHERE run_id NOT IN (SELECT run_id FROM a_runs)",
    },
}

NAMES = ", ".join(f"({i}, '{e}')" for i, e in enumerate(ENTITIES))
EVIDENCE_TABLES = {
    "v_runs": """
    SELECT c_custkey AS c, 'run_' || c_custkey AS run_id,
        CASE WHEN c_custkey % 31 = 0 THEN 'other' ELSE 'raw_ingestion' END AS pipeline_name,
        CASE WHEN c_custkey % 13 = 0 THEN 'batch_x' ELSE 'batch_' || c_custkey END AS recorded,
        CASE WHEN c_custkey % 11 = 0 THEN 'SUCCESS' ELSE 'RUNNING' END AS status, c_acctbal FROM customer""",
    "v_stages": """
    SELECT c_custkey AS c, 'stage_' || c_custkey AS stage_attempt_id,
        CASE WHEN c_custkey % 2 = 0 THEN 'RUNNING' ELSE 'SUCCESS' END AS status FROM customer WHERE c_custkey % 17 <> 0
    UNION ALL SELECT c_custkey, 'stage_' || c_custkey || '_b',
        CASE WHEN c_custkey % 2 = 0 THEN 'RUNNING' ELSE 'SUCCESS' END FROM customer WHERE c_custkey % 19 = 0""",
    "v_recon": f"""
    SELECT c_custkey AS c, i, CASE WHEN c_custkey % 37 = 0 AND i = 8 THEN '{ENTITIES[0]}'
            WHEN c_custkey % 43 = 0 AND i = 8 THEN 'refunds' ELSE e END AS entity,
        CASE WHEN c_custkey % 41 = 0 AND i = 2 THEN 'batch_y' ELSE 'batch_' || c_custkey END AS batch,
        CASE WHEN c_custkey % 37 = 0 AND i = 8 THEN c_custkey ELSE c_custkey + i END AS src,
        CASE WHEN c_custkey % 23 = 0 AND i = 3 THEN c_custkey + i - 1
             WHEN c_custkey % 37 = 0 AND i = 8 THEN c_custkey ELSE c_custkey + i END AS tgt
    FROM customer CROSS JOIN (VALUES {NAMES}) AS n(i, e) WHERE NOT (c_custkey % 29 = 0 AND i = 5)""",
    "v_expected": f"""
    SELECT c_custkey AS c, e AS entity,
        CASE WHEN c_custkey % 61 = 0 AND i = 6 THEN c_custkey + i + 1 ELSE c_custkey + i END AS expected
    FROM customer CROSS JOIN (VALUES {NAMES}) AS n(i, e)""",
    "v_rows": """
    SELECT r.c, r.i, CASE WHEN x.expected IS NULL THEN 'UNEXPECTED_RECONCILIATION_ENTITY'
        WHEN row_number() OVER (PARTITION BY r.c, r.entity ORDER BY r.i) > 1 THEN 'DUPLICATE_RECONCILIATION_ENTITY'
        WHEN r.batch <> 'batch_' || r.c THEN 'RECONCILIATION_BATCH_MISMATCH:' || r.entity
        WHEN r.src <> x.expected OR r.tgt <> x.expected OR r.src <> r.tgt THEN 'RECONCILIATION_FAILED:' || r.entity END
        AS reason
    FROM v_recon r LEFT JOIN v_expected x ON r.c = x.c AND r.entity = x.entity""",
    "v_reasons": """
    SELECT c, CASE WHEN count(*) <> 9 THEN 'RECONCILIATION_COUNT_MISMATCH' ELSE arg_min(reason, i) END AS reason
    FROM v_rows GROUP BY c""",
    "v_quality": """
    SELECT c_custkey AS c, CASE WHEN c_custkey % 53 = 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM customer
        WHERE c_custkey % 47 <> 0
    UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 53 = 0 THEN 'FAIL' ELSE 'PASS' END FROM customer
        WHERE c_custkey % 59 = 0""",
    "v_joined": """
    SELECT p.c, p.run_id, 'stage_' || p.c AS stage_attempt_id, p.pipeline_name, p.recorded, p.status AS run_status,
        c_acctbal, s.status AS stage_status, r.reason AS recon,
        (SELECT count(*) FROM v_stages a WHERE a.c = p.c) AS run_stages,
        (SELECT count(*) FROM v_stages a WHERE a.c = p.c AND a.status = 'SUCCESS') AS good_stages,
        (SELECT count(*) FROM v_stages a WHERE a.c = p.c AND a.status = 'RUNNING') AS active,
        (SELECT count(*) FROM v_quality q WHERE q.c = p.c) AS q_rows,
        (SELECT count(*) FROM v_quality q WHERE q.c = p.c AND q.status = 'PASS') AS q_pass
    FROM v_runs p LEFT JOIN v_stages s ON s.stage_attempt_id = 'stage_' || p.c LEFT JOIN v_reasons r ON r.c = p.c""",
    "v_recovery": """
    SELECT *, reason IS NULL AS verified FROM (
        SELECT *, CASE WHEN stage_status IS NULL THEN 'RUN_STAGE_IDENTITY_MISMATCH'
            WHEN pipeline_name <> 'raw_ingestion' THEN 'INGESTION_IDENTITY_MISMATCH'
            WHEN run_status <> 'RUNNING' OR stage_status <> 'SUCCESS' THEN 'RECOVERY_LIFECYCLE_MISMATCH'
            WHEN recorded <> 'batch_' || c THEN 'PIPELINE_BATCH_MISMATCH'
            WHEN run_stages <> 1 OR good_stages <> 1 THEN 'UNEXPECTED_STAGE_ATTEMPTS'
            WHEN recon IS NOT NULL THEN recon
            WHEN q_rows <> 1 OR q_pass <> 1 THEN 'RAW_BATCH_QUALITY_NOT_PASSING' END AS reason
        FROM v_joined)""",
}


def audit_sql() -> dict[str, str]:
    everything = {**EVENT_TABLES, **EVIDENCE_TABLES}

    def sql(body: str) -> str:
        return with_ctes(body, everything)

    invariants = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS invariant, CAST(({q}) AS BIGINT) AS violations"
        for t, rules in INVARIANTS.items() for n, q in rules.items())
    return {
        "audit_invariants": sql(invariants),
        "run_state": sql("""
    SELECT *, active_stages = 0 AS valid_finish FROM (SELECT run_id, status, started_at, ended_at,
        (SELECT count(*) FROM a_stages s WHERE s.run_id = r.run_id AND s.started_at <= r.ended_at
            AND s.ended_at > r.ended_at) AS active_stages FROM a_runs r)"""),
        "stage_attempts": sql("""
    SELECT run_id, stage_name, stage_attempt_id, CAST(attempt_number AS INTEGER) AS attempt_number,
        attempt_number AS expected_attempt, previous_status,
        attempt_number = 1 OR previous_status = 'FAILED' AS allowed
    FROM (SELECT *, lag(status) OVER (PARTITION BY run_id, stage_name ORDER BY attempt_number) AS previous_status
          FROM a_stages)"""),
        "reconciliation_rows": sql("SELECT * FROM a_recon"),
        "run_scorecard": sql("SELECT * FROM a_card"),
        "historical_scorecard": sql(HISTORY),
        "ingestion_evidence": sql("""
    SELECT run_id, stage_attempt_id, reason IS NULL AS verified, coalesce(reason, 'INGESTION_EVIDENCE_VERIFIED') AS reason
    FROM (SELECT run_id, stage_attempt_id, CASE WHEN stage_status IS NULL THEN 'RUN_STAGE_IDENTITY_MISMATCH'
            WHEN run_status <> 'RUNNING' OR stage_status <> 'RUNNING' THEN 'AUDIT_STAGE_NOT_ACTIVE'
            WHEN recorded <> 'batch_' || c THEN 'PIPELINE_BATCH_MISMATCH' WHEN recon IS NOT NULL THEN recon
            WHEN q_rows <> 1 THEN 'RAW_BATCH_QUALITY_COUNT_MISMATCH'
            WHEN q_pass <> 1 THEN 'RAW_BATCH_QUALITY_NOT_PASSING' END AS reason FROM v_joined)"""),
        "recovery_evidence": sql("""
    SELECT run_id, stage_attempt_id, verified, coalesce(reason, 'PIPELINE_RECOVERY_EVIDENCE_VERIFIED') AS reason
    FROM v_recovery"""),
        "recoverable_runs": sql("""
    SELECT run_id, d IS NULL AS recoverable, coalesce(d, 'PIPELINE_RECOVERY_FINALIZED') AS decision FROM (
        SELECT run_id, CASE WHEN c_acctbal < 0 THEN 'RAW_VERIFICATION_FAILED:ROW_COUNT_MISMATCH:orders'
            WHEN NOT verified THEN 'AUDIT_EVIDENCE_REJECTED:' || reason
            WHEN active > 0 THEN 'ACTIVE_STAGE_ATTEMPTS_PRESENT' END AS d FROM v_recovery)"""),
    }
