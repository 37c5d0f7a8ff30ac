"""Every check fires on its damaged table and names the damage."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.compare import spine_check, symmetric_diff
from ledgerloom.plans import public, quality, suites
from ledgerloom.plans.catalog import public_data, stored_model
from ledgerloom.plans.faults import FAULTS, damaged_inputs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def small(spark):
    return stored_model(spark, SF)


@pytest.mark.parametrize("name", sorted(quality.CHECKS))
def test_check_fires(small, name):
    assert quality.CHECKS[name](FAULTS[name](small)).limit(1).count() == 1


@pytest.mark.parametrize("test", ["not_null", "unique", "relationships", "accepted_values", "nonnegative"])
def test_generic_test_fires(small, test):
    clean = quality.generic_suite(small, (test,)).filter("status = 'FAIL'").count()
    damaged = quality.generic_suite(damaged_inputs(small), (test,)).filter("status = 'FAIL'").count()
    assert damaged > clean


def _metrics(df):
    return {r.metric: r.value for r in df.collect()}


def test_scd2_suite_fires(golden):
    dim = golden["dim_customer"]
    gap = F.when(F.col("customer_version") == 1, F.col("valid_from") + F.expr("interval 1 hour")).otherwise(F.col("valid_to"))
    got = _metrics(suites.scd2_suite(golden.replace(
        dim_customer=dim.withColumns({"valid_to": gap, "customer_sk": F.concat("customer_sk", F.lit("x"))}))))
    assert got["dimension.interval_adjacency_mismatches"] == 1
    assert got["dimension.surrogate_key_mismatches"] == dim.count()
    assert got["fact.customer_sk_missing_dimension"] == 7
    assert got["fact.incorrect_customer_sk"] == 7
    got = _metrics(suites.scd2_suite(golden.replace(
        dim_customer=dim.withColumns({"valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)}))))
    assert got["fact.missing_or_multiple_historical_matches"] == 1
    assert got["fact.incorrect_customer_sk"] == 1
    assert got["dimension.version_order_count_mismatches"] == 1
    got = _metrics(suites.scd2_suite(golden.replace(dim_customer=dim.unionByName(dim.filter("customer_version = 2")))))
    assert got["dimension.duplicate_surrogate_keys"] == 1
    assert got["dimension.nonsequential_versions"] == 1


def test_marts_and_lineage_suites_fire(golden):
    items, facts = golden["fct_order_items"], golden["fct_orders"]
    changed = items.filter("order_id <> 'O3'").withColumn(
        "merchandise_value", (F.col("merchandise_value") + F.when(F.col("order_id") == "O2", 1).otherwise(0)).cast("decimal(18,2)")
    ).unionByName(items.filter("order_id = 'O7'"))
    got = _metrics(suites.marts_suite(golden.replace(fct_order_items=changed)))
    assert got["order_items.duplicate_keys"] == 1
    assert got["order_items.missing_from_staging"] == 1
    assert got["order_items.field_mismatches"] == 1
    assert got["seller_revenue.mismatched_groups"] == 2
    lost = facts.filter("order_id <> 'O1'").unionByName(facts.filter("order_id = 'O2'"))
    got = _metrics(suites.lineage_suite(golden.replace(fct_orders=lost)))
    assert got["order_reconciliation->fct_orders.missing"] == 1
    assert got["fct_orders.duplicate_keys"] == 1
    assert got["monthly_mart.mismatched_months"] == 2


def test_parity_and_gate(golden):
    gate = {r.area: r.status for r in suites.acceptance_gate(suites.mart_parity(golden)).collect()}
    assert gate["overall"] == "PASS_WITH_LIMITATIONS" and gate["net_revenue"] == "NOT_VERIFIED"
    broken = golden.replace(seller_revenue=golden["seller_revenue"].limit(1))
    gate = {r.area: r.status for r in suites.acceptance_gate(suites.mart_parity(broken)).collect()}
    assert gate["overall"] == gate["cross_mart_parity"] == "FAIL"


def test_controls(golden):
    totals = quality.scd2_control_totals(golden)
    assert quality.deviates(totals, {"dimension_rows": 7, "persistent_customers": 6}).count() == 0
    assert quality.deviates(totals, {"max_customer_version": 4}).count() == 1


def test_known_exceptions(small):
    assert quality.known_exceptions(small, {"UNLISTED": 100}, 100).count() == 0
    rows = {r.product_category_name: r.orphan_rows for r in quality.known_exceptions(small, {"UNLISTED": 1}, 1).collect()}
    assert set(rows) == {"UNLISTED", "__TOTAL_ORPHAN_ROWS__"}


def test_set_operators(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert sorted((r.k, r.side) for r in symmetric_diff(a, b).collect()) == [(1, "expected"), (2, "expected"), (3, "actual")]
    assert sorted((r.k, r.issue) for r in spine_check(a, b, "k", "m", "u").collect()) == [(2, "m"), (3, "u")]


RULES = public.PublicRules("launch", "2025-01-01", "2025-02-01", "2025-04-01", minimum_group=1)


def _public(m):
    return public.build(
        m["fct_orders"], m["fct_order_items"], m["dim_product"], m["category_revenue"], m["customer_revenue"], RULES)


def test_public_validation(spark, golden):
    data = _public(golden)
    assert public.validation(spark, data, RULES).filter("violations <> 0").collect() == []
    public.require_valid(public.validation(spark, data, RULES))
    worse = {**data, "customer_states": data["customer_states"].withColumn("gross", F.col("gross") + F.lit(1).cast("decimal(38,2)"))}
    bad = {(r.dataset, r.rule) for r in public.validation(spark, worse, RULES).filter("violations <> 0").collect()}
    assert bad == {("customer_states", "money_balance"), ("customer_states", "money_parity")}
    with pytest.raises(public.PublicationError, match="money_parity"):
        public.require_valid(public.validation(spark, worse, RULES))
    short = {**data, "revenue_periods": data["revenue_periods"].filter("reporting_period <> '2025-03'")}
    bad = {r.rule for r in public.validation(spark, short, RULES).filter("violations <> 0").collect()}
    assert {"period_set", "order_parity", "money_parity"} <= bad
    with pytest.raises(ValueError, match="the columns of customer_states"):
        public.validation(spark, {**data, "customer_states": data["customer_states"].drop("gross")}, RULES)


def test_folding(small, spark):
    folded = {r.public_category for r in public_data(small)["product_categories"].collect()}
    assert "UNLISTED" not in folded or "RARE" not in folded
    everything = public.product_categories(
        small["fct_order_items"], small["dim_product"], small["category_revenue"], 10**9).collect()
    assert [r.public_category for r in everything] == [public.FOLDED]
    named = {r.public_category for r in public.product_categories(
        small["fct_order_items"], small["dim_product"], small["category_revenue"], 0).collect()}
    assert public.UNCATEGORIZED in named


def test_export_and_strict_load(spark, golden, tmp_path):
    data = _public(golden)
    rows = public.csv_roundtrip(spark, data, str(tmp_path), RULES).collect()
    assert all(r.value == 0 for r in rows if r.metric == "differing_rows")
    folder = str(tmp_path / "export")
    public.export_csv(data, folder, RULES)
    with pytest.raises(public.PublicationError, match="already exists"):
        public.export_csv(data, folder, RULES)
    assert public.strict_load(spark, folder, RULES)["repeat_customers"].schema["is_repeat_customer"].dataType.simpleString() == "boolean"
    cases = {"SP,x,1.00,1.00,2.00": "invalid_integer", "SP,1,1.005,1.00,2.00": "invalid_money",
             "SP,1,,1.00,2.00": "empty_field", f"{'S' * 5000},1,1.00,1.00,2.00": "oversized_field"}
    for i, (line, rule) in enumerate(cases.items()):
        bad = tmp_path / f"bad{i}"
        _copy_with(tmp_path / "export", bad, "customer_states", line)
        with pytest.raises(public.PublicationError, match=rule):
            public.strict_load(spark, str(bad), RULES)


def _copy_with(folder, to, name, *lines):
    """A copy of an export with other lines below the header of one dataset."""
    shutil.copytree(folder, to, ignore=shutil.ignore_patterns("*.crc", "_SUCCESS"))
    (file,) = (to / f"{name}.csv").glob("part-*")
    file.write_text("\n".join([file.read_text().splitlines()[0], *lines, ""]))


def test_publication_is_gated(spark, golden, tmp_path):
    data = _public(golden)
    wrong = {**data, "customer_states": data["customer_states"].withColumn("gross", F.col("gross") + F.lit(1).cast("decimal(38,2)"))}
    with pytest.raises(public.PublicationError, match="money_balance"):
        public.export_csv(wrong, str(tmp_path / "wrong"), RULES)
    assert list(tmp_path.iterdir()) == []
    (tmp_path / "taken").mkdir()
    with pytest.raises(public.PublicationError, match="already exists"):
        public.export_csv(data, str(tmp_path / "taken"), RULES)
    good = tmp_path / "good"
    public.export_csv(data, str(good), RULES)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["good", "taken"]
    shutil.copytree(good, tmp_path / "more")
    shutil.copytree(good / "customer_states.csv", tmp_path / "more" / "extra.csv")
    with pytest.raises(public.PublicationError, match="inventory"):
        public.strict_load(spark, str(tmp_path / "more"), RULES)
    (file,) = (good / "repeat_customers.csv").glob("part-*")
    _copy_with(good, tmp_path / "yes", "repeat_customers", *[x.replace("True", "yes") for x in file.read_text().splitlines()[1:]])
    with pytest.raises(public.PublicationError, match="invalid_boolean"):
        public.strict_load(spark, str(tmp_path / "yes"), RULES)
    (file,) = (good / "customer_states.csv").glob("part-*")
    _copy_with(good, tmp_path / "less", "customer_states", *file.read_text().splitlines()[1:-1])
    with pytest.raises(public.PublicationError, match="order_parity"):
        public.strict_load(spark, str(tmp_path / "less"), RULES)


def test_number_of_generic_assertions():
    """The oracle takes the list from the engine, so a lost assertion would change both sides."""
    count = {kind: sum(len(spec.get(kind, ())) for spec in quality.GENERIC_TESTS.values()) for kind in (
        "not_null", "unique", "relationships", "accepted_values", "nonnegative")}
    assert count == {"not_null": 134, "unique": 20, "relationships": 17, "accepted_values": 10, "nonnegative": 28}
