"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ..operators.history import asof_lookup, sessions
from ..sources.audit_inputs import PIPELINE, STAGE, event_audit, evidence_audit, lifecycle_events
from ..sources.commerce import ENTITIES, driver_table, raw_entities
from ..sources.store import shared_root, table_writer
from . import audit, faults, public, quality, reports, staging, suites
from .ingest_queries import ingest_queries
from .marts import GEOGRAPHY, monthly_revenue
from .model import INTERMEDIATE, MARTS, Model

Query = Callable[[SparkSession, str], DataFrame]
_models: dict[tuple[str, str], Model] = {}


def lazy_model(spark: SparkSession, sf_dir: str) -> Model:
    """Every table as a view: one plan from the source files to the result."""
    return Model(raw_entities(spark, sf_dir))


def stored_model(spark: SparkSession, sf_dir: str) -> Model:
    """Tables written once per session and input folder, as the pipeline does in production."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        _models[key] = Model(raw_entities(spark, sf_dir), table_writer(spark))
    return _models[key]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue in one plan over orders and items."""
    return monthly_revenue(lazy_model(spark, sf_dir)["order_values"])


def _view(name: str) -> Query:
    return lambda spark, sf_dir: lazy_model(spark, sf_dir)[name]


def _table(name: str) -> Query:
    return lambda spark, sf_dir: stored_model(spark, sf_dir)[name]


def pipeline_queries() -> dict[str, Query]:
    found: dict[str, Query] = {f"stg_{e}": _view(f"stg_{e}") for e in staging.STAGES}
    found |= {name: _view(name) for name in INTERMEDIATE}
    found |= {name: _table(name) for name in MARTS}
    found["monthly_revenue"] = flagship
    return found


def _of(build: Callable[[Model], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stored_model(spark, sf_dir))


def history_queries() -> dict[str, Query]:
    customer, at = "customer_unique_id", "order_purchased_at"
    return {
        "customer_sessions": _of(lambda m: sessions(m["orders_enriched"], customer, at, "order_id", GEOGRAPHY)),
        "scd2_asof_join": _of(lambda m: asof_lookup(
            m["orders_enriched"].select("order_id", customer, at), m["dim_customer"], customer, at,
            ["customer_sk", "customer_version", "valid_from", "valid_to"], "customer_version",
        )),
    }


# Publication parameters for the driver's data; expected values are those of scale factor 0.01.
RULES = public.PublicRules(
    launch_label="1995 launch period", launch_start="1995-01-01", launch_end="1995-04-01",
    last_month="2001-08-01",
    expected_rows={"executive_kpis": 1, "payment_reconciliation": 5, "repeat_customers": 2},
    expected_orders=4878,
    expected_totals=(Decimal("789706597.65"), Decimal("378025.00"), Decimal("790084622.65")),
    expected_statuses={"exact_match": 4919},
    expected_customers={True: 1248, False: 174},
)
#: For data of any size: nothing is compared with values known beforehand, and these data have groups below ten.
OPEN_RULES = public.PublicRules(RULES.launch_label, RULES.launch_start, RULES.launch_end, minimum_group=1)
STATES = ("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8")


def public_data(m: Model) -> dict[str, DataFrame]:
    return public.build(
        m["fct_orders"], m["fct_order_items"], m["dim_product"], m["category_revenue"],
        m["customer_revenue"], RULES,
    )


def published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All datasets from one table, which is built in one pass over the marts and stored."""
    m = stored_model(spark, sf_dir)
    table = public.long_table(
        m["fct_orders"], m["fct_order_items"], m["dim_product"], m["category_revenue"], m["customer_revenue"], RULES)
    return public.datasets(table_writer(spark)("public", table))


def _strict_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_root(spark)}/export-{uuid.uuid4().hex}"
    public.export_csv(published(spark, sf_dir), folder, OPEN_RULES)
    return public.as_long_table(public.strict_load(spark, folder, OPEN_RULES))


def public_queries() -> dict[str, Query]:
    found = {
        f"pub_{name}": _of(lambda m, name=name: public_data(m)[name]) for name in public.SCHEMAS
    }
    found["pub_validation"] = lambda spark, sf_dir: public.validation(
        spark, published(spark, sf_dir), RULES
    )
    found["pub_csv_roundtrip"] = lambda spark, sf_dir: public.csv_roundtrip(
        spark, published(spark, sf_dir), shared_root(spark), OPEN_RULES
    )
    found["pub_strict_load"] = _strict_load
    return found


def report_queries() -> dict[str, Query]:
    def filtered(m: Model) -> DataFrame:
        return reports.filtered_orders(m["fct_orders"], "1996-03-01", "1999-10-01", STATES)

    def everyone(m: Model) -> DataFrame:
        return reports.filtered_orders(m["fct_orders"], None, None, None)

    return {
        "rep_filtered_kpis": _of(lambda m: reports.filtered_kpis(filtered(m))),
        "rep_monthly": _of(lambda m: reports.monthly(filtered(m))),
        "rep_top_states": _of(lambda m: reports.top_states(everyone(m))),
        "rep_recon_status": _of(lambda m: reports.reconciliation_statuses(m["fct_orders"])),
        "rep_top_categories": _of(lambda m: reports.top_categories(m["category_revenue"])),
        "rep_top_sellers": _of(lambda m: reports.top_sellers(m["seller_revenue"])),
        "rep_repeat": _of(lambda m: reports.repeat_distribution(m["customer_revenue"])),
        "rep_periods": _of(lambda m: reports.period_table(
            public_data(m)["revenue_periods"], RULES.launch_label, RULES.launch_end, "merchandise")),
        "rep_topn_categories": _of(lambda m: reports.topn_categories(
            public_data(m)["product_categories"], "freight", 5)),
        "rep_recon_detail": _of(lambda m: reports.reconciliation_detail(public_data(m)["payment_reconciliation"])),
        "rep_repeat_share": _of(lambda m: reports.repeat_share(public_data(m)["repeat_customers"])),
        "bench_delivered_kpis": _of(lambda m: reports.delivered_kpis(m["fct_orders"])),
        "bench_monthly_mart": _of(lambda m: reports.monthly_mart(m["monthly_revenue"])),
    }


def quality_queries() -> dict[str, Query]:
    """Generic tests and singular checks run on damaged tables; the two suites on clean ones."""
    found: dict[str, Query] = {
        f"dq_{t}": _of(lambda m, t=t: quality.generic_suite(faults.damaged_inputs(m), (t,)))
        for t in ("not_null", "unique", "relationships", "accepted_values", "nonnegative")
    }
    found["dq_suite"] = _of(quality.generic_suite)
    found["dq_singular"] = _of(quality.singular_suite)
    for name, check in quality.CHECKS.items():
        found[name] = _of(lambda m, name=name, check=check: check(faults.FAULTS[name](m)))
    found["scd2_control_totals"] = _of(quality.scd2_control_totals)
    found["delivered_controls"] = _of(quality.delivered_controls)
    return found


def suite_queries() -> dict[str, Query]:
    documented = {"delivered_orders": 4878, "gross": Decimal("790084622.65")}
    return {
        "scd2_suite": _of(suites.scd2_suite),
        "marts_suite": _of(suites.marts_suite),
        "lineage_suite": _of(suites.lineage_suite),
        "order_profile": _of(lambda m: suites.order_profile(m["fct_orders"])),
        "order_profile_assess": _of(
            lambda m: suites.assess_profile(suites.order_profile(m["fct_orders"]), documented)),
        "mart_parity": _of(suites.mart_parity),
        "revenue_summary": _of(lambda m: suites.revenue_summary(m["fct_orders"])),
        "payment_tolerance": _of(lambda m: suites.payment_tolerance(m["fct_orders"])),
        "acceptance_gate": _of(lambda m: suites.acceptance_gate(suites.mart_parity(m))),
    }


def audit_queries() -> dict[str, Query]:
    def tables(spark: SparkSession, sf_dir: str) -> audit.AuditTables:
        return event_audit(driver_table(spark, sf_dir))

    def attempts(build: Callable[..., DataFrame]) -> Query:
        return lambda spark, sf_dir: build(*evidence_audit(driver_table(spark, sf_dir)))

    workflow = audit.Workflow(PIPELINE, STAGE, ENTITIES)
    return {
        "audit_invariants": lambda s, d: audit.audit_invariants(tables(s, d)),
        "run_state": lambda s, d: audit.run_state(
            lifecycle_events(tables(s, d).pipeline_runs), tables(s, d).stage_runs),
        "stage_attempts": lambda s, d: audit.stage_attempts(tables(s, d).stage_runs),
        "reconciliation_rows": lambda s, d: tables(s, d).reconciliation,
        "run_scorecard": lambda s, d: audit.run_scorecard(tables(s, d)),
        "historical_scorecard": lambda s, d: audit.historical_scorecard(audit.run_scorecard(tables(s, d))),
        "ingestion_evidence": attempts(
            lambda t, requests, expected, _: audit.ingestion_evidence(t, requests, expected, ENTITIES)),
        "recovery_evidence": attempts(
            lambda t, requests, expected, _: audit.recovery_evidence(t, requests, expected, workflow)),
        "recoverable_runs": attempts(lambda t, requests, expected, verdicts: audit.recovery_decisions(
            audit.recovery_evidence(t, requests, expected, workflow), verdicts, t.stage_runs)),
    }


def all_queries() -> dict[str, Query]:
    return {
        **pipeline_queries(), **history_queries(), **public_queries(), **report_queries(),
        **quality_queries(), **suite_queries(), **ingest_queries(),
        **audit_queries(),
    }
