"""Golden scenario: statuses, history, marts, and latest-wins staging."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.values import money, require_exact_money, whole
from ledgerloom.operators.compare import symmetric_diff
from ledgerloom.operators.dedup import latest_wins
from ledgerloom.plans import quality, reports, suites
from ledgerloom.plans.model import Model
from tests.golden import golden_raw, golden_rows


def test_reconciliation_statuses(spark, golden):
    expected = spark.createDataFrame([
        ("O1", "exact_match", D("165.00"), D("165.00"), D("0.00")),
        ("O2", "within_one_cent", D("22.00"), D("22.01"), D("0.01")),
        ("O3", "payment_above_item_plus_freight", D("33.00"), D("40.00"), D("7.00")),
        ("O4", "payment_below_item_plus_freight", D("44.00"), D("40.00"), D("-4.00")),
        ("O5", "missing_payment", D("55.00"), None, None),
        ("O6", "missing_items", None, D("12.00"), None),
        ("O7", "exact_match", D("77.00"), D("77.00"), D("0.00")),
    ], "order_id string, reconciliation_status string, item_plus_freight decimal(38,2), "
       "payment_value decimal(38,2), payment_item_difference decimal(38,2)")
    actual = golden["order_reconciliation"].select(*expected.columns)
    assert symmetric_diff(expected, actual).collect() == []


def test_customer_history(golden):
    rows = golden["dim_customer"].filter("customer_unique_id = 'shared'").orderBy("customer_version").collect()
    got = [(r.customer_version, r.customer_zip_code_prefix, r.customer_city, r.customer_state, r.valid_from,
            r.valid_to, r.is_current, r.orders_in_version) for r in rows]
    january, february = datetime(2025, 1, 1, 10), datetime(2025, 2, 1, 10)
    assert got == [
        (1, 10001, "city_a", "SP", january, february, False, 1),
        (2, 20002, "city_b", "RJ", february, None, True, 1),
    ]


def test_marts(golden):
    kpi = reports.delivered_kpis(golden["fct_orders"]).first()
    assert (kpi.orders, kpi.merchandise, kpi.freight, kpi.gross) == (4, D("240.00"), D("24.00"), D("264.00"))
    assert golden["monthly_revenue"].count() == 4
    counts = {r.product_category_name: r.distinct_delivered_orders for r in golden["category_revenue"].collect()}
    assert counts == {"livros": 3, "brinquedos": 2}
    shared = golden["customer_revenue"].filter("customer_unique_id = 'shared'").first()
    assert shared.is_repeat_customer and shared.purchase_span_days == 31
    assert shared.customer_city == "city_b"


def test_products_round_halves_to_even(golden):
    assert {r.product_id: r.product_weight_g for r in golden["dim_product"].collect()} == {"P1": 10, "P2": 12}


def test_all_checks_pass_on_golden(golden):
    assert quality.singular_suite(golden).filter("status = 'FAIL'").collect() == []
    for suite in (suites.scd2_suite, suites.marts_suite, suites.lineage_suite):
        assert suites.issues(suite(golden)).collect() == []
    assert quality.generic_suite(golden).filter("status = 'FAIL'").collect() == []
    assert quality.generic_suite(golden).count() == 209


def test_simultaneous_orders_of_one_customer(spark):
    """An empty interval is kept and reported; both orders map to the later version."""
    rows = golden_rows()
    rows["orders"][1] = (*rows["orders"][1][:3], rows["orders"][0][3], *rows["orders"][1][4:])
    raw = golden_raw(spark, rows)
    m = Model(lambda n: raw[n])
    values = {r.metric: r.value for r in suites.scd2_suite(m).collect()}
    assert values["dimension.invalid_intervals"] == 1
    assert values["dimension.version_order_count_mismatches"] == 2
    shared = m["fct_orders"].filter("customer_unique_id = 'shared'").select("customer_sk").distinct()
    assert shared.count() == 1


def test_latest_wins(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "old"), ("a", 2, 1, "tie"), ("a", 2, 2, "new"), (None, 1, 1, "null key"), ("b", None, 9, "only")],
        "k string, loaded int, row int, v string",
    )
    kept = {(r.k, r.v) for r in latest_wins(df, ["k"], ["loaded", "row"]).collect()}
    assert kept == {("a", "new"), (None, "null key"), ("b", "only")}


def test_casts(spark):
    df = spark.createDataFrame([(1.005, 10.5), (0.285, 11.5), (-1.005, -1.5), (10.125, 10.7)], "m double, w double")
    got = df.select(money(df, "m").alias("m"), whole(df, "w").alias("w")).collect()
    assert [r.m for r in got] == [D("1.00"), D("0.28"), D("-1.00"), D("10.13")]
    assert [r.w for r in got] == [10, 12, -2, 11]
    with pytest.raises(ValueError, match="Floating-point"):
        require_exact_money(df, "m")


def test_profile_rejects_float_money(golden):
    damaged = golden["fct_orders"].withColumn("merchandise_value", F.col("merchandise_value").cast("double"))
    with pytest.raises(ValueError, match="merchandise_value"):
        suites.order_profile(damaged)
