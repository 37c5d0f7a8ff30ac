"""Audit log rules, scorecard, governed load and recovery."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import audit, benchmark, governed
from ledgerloom.sources import audit_log
from ledgerloom.sources.audit_log import AuditError, AuditLog
from ledgerloom.sources.commerce import ENTITIES
from tests.golden import BATCH, golden_raw

WORKFLOW = audit.Workflow("raw_ingestion", "raw_load", ENTITIES)


def test_lifecycle_rules(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path))
    run = log.start_run("p", "dev", "b")
    first = log.start_stage(run, "load")
    with pytest.raises(AuditError, match="at work"):
        log.finish_run(run, "SUCCESS")
    with pytest.raises(AuditError, match="the stage is RUNNING"):
        log.start_stage(run, "load")
    with pytest.raises(AuditError, match="only a failure"):
        log.finish_stage(run, first, "SUCCESS", "Boom")
    log.finish_stage(run, first, "FAILED", "Boom", "it broke")
    second = log.start_stage(run, "load")
    attempts = {r.stage_attempt_id: r.attempt_number for r in log.stages(run).collect()}
    assert attempts == {first: 1, second: 2}
    with pytest.raises(AuditError, match="missed"):
        log.record_fault(run, second, "loss", "load", "count", False, "load")
    log.record_fault(run, second, "loss", "load", "count", True, "load")
    log.record_fault(run, second, "dup", "load", "count", False)
    log.finish_stage(run, second, "SUCCESS")
    log.finish_run(run, "SUCCESS")
    with pytest.raises(AuditError, match="the run is SUCCESS"):
        log.finish_run(run, "FAILED")
    with pytest.raises(AuditError, match="the run is SUCCESS"):
        log.start_stage(run, "other")
    with pytest.raises(AuditError, match="stage_id"):
        log.record_quality(run, None, "t", "PASS")
    assert audit.audit_invariants(log.tables()).filter("violations <> 0").count() == 0
    card = audit.run_scorecard(log.tables())
    row = card.first()
    assert (row.stage_attempts, row.failed_stage_attempts, row.retry_count, row.fault_injections) == (2, 1, 1, 2)
    assert audit.historical_scorecard(card).first().fault_detection_rate == 0.5


def test_opening_a_log_writes_nothing(spark, tmp_path):
    for _ in range(2):
        log = AuditLog(spark, str(tmp_path / "log"))
        assert log.runs().count() == 0 and log.tables("some run").quality.count() == 0
    assert not (tmp_path / "log").exists()


def test_a_run_reads_and_compacts_its_own_folder(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path))
    runs = [log.start_run("p", "dev") for _ in range(2)]
    stage = log.start_stage(runs[0], "s")
    log.finish_stage(runs[0], stage, "FAILED", "E", "x" * 5000)
    assert {f.split("of_run=")[1].split("/")[0] for f in log.read("run_events", runs[1]).inputFiles()} == {runs[1]}
    log.compact("stage_events", runs[0])
    assert len(log.read("stage_events").inputFiles()) == 1
    assert log.stages(runs[0]).first().error_message == "x" * 5000


def test_state_from_events(spark):
    events = spark.createDataFrame(
        [("a", 1, 1, "RUNNING"), ("a", 5, 2, "SUCCESS"), ("b", 2, 1, "RUNNING"), ("c", 3, 2, "FAILED"),
         ("d", 1, 1, "RUNNING"), ("d", 2, 2, "FAILED"), ("d", 3, 2, "SUCCESS"), ("e", 1, 1, "RUNNING"), ("e", 2, 1, "RUNNING")],
        "run_id string, h int, sequence int, status string",
    ).select("run_id", (F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours="h")).alias("event_at"), "sequence", "status")
    state = {r.run_id: r.status for r in audit.current_state(events, "run_id").collect()}
    assert state == {"a": "SUCCESS", "b": "RUNNING", "c": "FAILED", "d": "SUCCESS", "e": "RUNNING"}
    for size in (2, 1000):
        wrong = {r.run_id: r.violation for r in audit.transition_violations(events, "run_id", size).collect()}
        assert wrong == {"c": "finished_without_start", "d": "finished_twice", "e": "started_twice"}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("governed")
    log = AuditLog(spark, str(root / "audit"))
    raw = golden_raw(spark)
    run = governed.governed_load(spark, raw, str(root / "raw"), log, BATCH, WORKFLOW)
    return root, log, raw, run


def test_governed_load(loaded):
    root, log, raw, run = loaded
    rows = governed.load_outcome(log, run).collect()
    assert len(rows) == 9 and {(r.status, r.run_status, r.difference_rows) for r in rows} == {("PASS", "SUCCESS", 0)}


def test_failed_load_is_recorded(spark, loaded):
    root, log, raw, _ = loaded
    broken = {**raw, "orders": raw["orders"].withColumn("order_id", F.raise_error(F.lit("boom")).cast("string"))}
    with pytest.raises(Exception, match="boom"):
        governed.governed_load(spark, broken, str(root / "raw"), log, BATCH, WORKFLOW)
    assert log.runs().filter("status = 'FAILED' and error_type is not null").count() == 1
    assert spark.read.parquet(str(root / "raw" / "orders")).count() == 7


def test_audit_failure_after_publish_stays_running_and_recovers(spark, loaded, monkeypatch):
    root, log, raw, _ = loaded
    monkeypatch.setattr(log, "finish_run", lambda *a: (_ for _ in ()).throw(OSError("audit store lost")))
    with pytest.raises(governed.UnfinishedAudit):
        governed.governed_load(spark, raw, str(root / "raw2"), log, BATCH, WORKFLOW)
    monkeypatch.undo()
    run = log.runs().filter("status = 'RUNNING'").first().run_id
    stage = log.stages(run).first().stage_attempt_id
    expected = spark.createDataFrame([(e, raw[e].count()) for e in ENTITIES], "entity string, expected_rows bigint")
    stored = {e: spark.read.parquet(str(root / "raw2" / e)) for e in ENTITIES}
    wrong = expected.withColumn("expected_rows", F.col("expected_rows") + 1)
    assert governed.recover(spark, log, run, stage, BATCH, stored, wrong, WORKFLOW).startswith("RAW_VERIFICATION_FAILED:ROW_COUNT")
    assert governed.recover(spark, log, run, stage, BATCH, stored, expected, WORKFLOW) == audit.FINALIZED
    assert log.runs(run).first().status == "SUCCESS"
    again = governed.recover(spark, log, run, stage, BATCH, stored, expected, WORKFLOW)
    assert again == "AUDIT_EVIDENCE_REJECTED:RECOVERY_LIFECYCLE_MISMATCH"


def test_measure(spark):
    timing = benchmark.measure(lambda: spark.range(3), 2)
    assert timing["repetitions"] == 2 and timing["min_ms"] <= timing["median_ms"] <= timing["max_ms"]
    with pytest.raises(benchmark.UnstableResult):
        benchmark.measure(lambda: spark.range(1).select(F.rand()), 2)
    with pytest.raises(ValueError):
        benchmark.measure(lambda: spark.range(1), 0)
    record = benchmark.evidence({"q": timing}, {"q": "select  1"})
    assert len(record["queries"]["q"]["sql_sha256"]) == 64


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_duration_does_not_depend_on_the_session_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        runs = spark.sql("""SELECT 'r' AS run_id, 'p' AS pipeline_name, 'dev' AS environment, 'b' AS batch_id, 'SUCCESS' AS status,
            TIMESTAMP_NTZ'2025-03-09 01:00:00' AS started_at, TIMESTAMP_NTZ'2025-03-09 04:00:00.250' AS ended_at""")
        none = spark.sql("""SELECT 'x' AS run_id, 'SUCCESS' AS status, 1 AS attempt_number, 0L AS difference_rows, true AS detected""").limit(0)
        card = audit.run_scorecard(audit.AuditTables(runs, none, none, none, none))
        assert card.first().duration_seconds == 10800.25
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


class Overtaken(AuditLog):
    """A writer to whom something happens between the check of a move and its event."""

    def __init__(self, *args, meanwhile):
        super().__init__(*args)
        self.meanwhile = [meanwhile]

    def _append_row(self, name, *values):
        while self.meanwhile:
            self.meanwhile.pop()()
        super()._append_row(name, *values)


def test_two_writers_at_once_have_one_winner(spark, tmp_path, monkeypatch):
    """Both find their move allowed; the earlier one counts, the other one is told."""
    clock = iter(datetime(2026, 1, 1) + timedelta(seconds=k) for k in range(100))
    monkeypatch.setattr(audit_log, "_now", lambda: next(clock))
    between = iter(datetime(2026, 1, 1) + timedelta(milliseconds=k) for k in range(500, 600))
    log = AuditLog(spark, str(tmp_path))
    run_id = log.start_run("p", "dev")
    late = [AuditError]

    def quick(act):
        """Done by another writer, with an earlier time than the one that is waiting."""
        monkeypatch.setattr(audit_log, "_now", lambda: next(between))
        try:
            late[0] = act()
        finally:
            monkeypatch.setattr(audit_log, "_now", lambda: next(clock))

    # Two first attempts of one stage.
    with pytest.raises(AuditError, match="another writer"):
        Overtaken(spark, str(tmp_path), meanwhile=lambda: quick(lambda: log.start_stage(run_id, "load"))).start_stage(run_id, "load")
    stages = log.stages(run_id).collect()
    assert [(r.stage_attempt_id, r.attempt_number, r.status) for r in stages] == [(late[0], 1, "RUNNING")]
    # Two ends of the attempt, then of the run.
    with pytest.raises(AuditError, match="another writer"):
        Overtaken(spark, str(tmp_path), meanwhile=lambda: quick(lambda: log.finish_stage(run_id, late[0], "SUCCESS"))).finish_stage(run_id, late[0], "FAILED", "E", "late")
    row = log.stages(run_id).first()
    assert (row.status, row.error_type) == ("SUCCESS", None)
    with pytest.raises(AuditError, match="another writer"):
        Overtaken(spark, str(tmp_path), meanwhile=lambda: quick(lambda: log.finish_run(run_id, "SUCCESS"))).finish_run(run_id, "FAILED", "E", "late")
    assert log.runs(run_id).first().status == "SUCCESS"
    # One winner in the derived state as well, and the loser in the list of violations.
    state = audit.run_state(log.read("run_events"), log.stages()).collect()
    assert [(r.run_id, r.status) for r in state] == [(run_id, "SUCCESS")]
    assert [r.violation for r in audit.transition_violations(log.read("run_events"), "run_id").collect()].count("finished_twice") == 1


def test_a_writer_overtaken_later_learns_with_its_next_move(spark, tmp_path, monkeypatch):
    """An event with an earlier time that arrives afterwards takes the place of the first one."""
    log = AuditLog(spark, str(tmp_path))
    run_id = log.start_run("p", "dev")
    mine = log.start_stage(run_id, "load")
    monkeypatch.setattr(audit_log, "_now", lambda: datetime(2020, 1, 1))
    log._append_row("stage_events", "theirs", run_id, "load", 1, datetime(2020, 1, 1), 1, "RUNNING", None, None, "e")
    with pytest.raises(AuditError, match="the stage is unknown"):
        log.finish_stage(run_id, mine, "SUCCESS")
    assert [r.stage_attempt_id for r in log.stages(run_id).collect()] == ["theirs"]


def test_evidence_sends_no_side_that_grows_to_the_driver(spark):
    from ledgerloom.sources.audit_inputs import evidence_audit

    people = spark.range(1, 2001).selectExpr("id as c_custkey", "cast(id % 7 - 1 as double) as c_acctbal")
    tables, requests, expected, verdicts = evidence_audit(lambda name: people)
    workflow = audit.Workflow("raw_ingestion", "raw_load", ENTITIES)
    recovery = audit.recovery_evidence(tables, requests, expected, workflow)
    found = (
        audit.ingestion_evidence(tables, requests, expected, ENTITIES), recovery,
        audit.recovery_decisions(recovery, verdicts, tables.stage_runs))
    for df in found:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 2000
