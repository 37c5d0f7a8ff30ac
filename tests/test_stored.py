"""What stored tables and order-level aggregates move."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame, functions as F

from ledgerloom.plans import intermediate, quality, suites
from ledgerloom.plans.model import BUCKETS
from ledgerloom.sources.store import table_writer


@pytest.fixture
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def shuffles(df: DataFrame) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def items(spark) -> DataFrame:
    day, cents = dt.datetime(2020, 1, 1), Decimal("0.01")
    rows = [
        # Two products from two sellers each, one of them common; then unknown products and sellers; an unknown order.
        ("a", 1, "p", "s"), ("a", 2, "p", "t"), ("a", 3, "q", "s"), ("a", 4, "q", "u"), ("a", 5, "q", "u"),
        ("b", 1, None, "s"), ("b", 2, None, None), ("b", 3, "p", None), ("c", 1, None, None), (None, 1, "p", "s"), (None, 2, "p", "s"),
    ]
    schema = "order_id string, order_item_id bigint, product_id string, seller_id string, shipping_limit_at timestamp_ntz, price decimal(18,2), freight_value decimal(18,2)"
    return spark.createDataFrame([(*r, day + dt.timedelta(days=k), cents * (k + 1), None if k == 6 else cents) for k, r in enumerate(rows)], schema)


def test_items_are_dealt_once_and_counted_right(spark):
    found = intermediate.items_by_order(items(spark))
    assert shuffles(found) == 1
    got = {r["order_id"]: r for r in found.collect()}
    counts = {k: (r["item_count"], r["distinct_product_count"], r["distinct_seller_count"]) for k, r in got.items()}
    assert counts == {"a": (5, 2, 3), "b": (3, 1, 1), "c": (1, 0, 0), None: (2, 1, 1)}
    b = got["b"]
    assert (b["item_revenue"], b["freight_revenue"], b["item_plus_freight"]) == (Decimal("0.21"), Decimal("0.02"), Decimal("0.16"))
    assert (b["first_shipping_limit_at"], b["last_shipping_limit_at"]) == (dt.datetime(2020, 1, 6), dt.datetime(2020, 1, 8))


def test_payments_are_dealt_once(spark):
    rows = [("a", 1, "x", 1, Decimal("1.00")), ("a", 2, "x", 3, Decimal("2.00")), ("a", 3, None, 2, None), (None, 1, "y", 1, Decimal("4.00"))]
    paid = intermediate.payments_by_order(spark.createDataFrame(
        rows, "order_id string, payment_sequence bigint, payment_type string, payment_installments bigint, payment_value decimal(18,2)"))
    assert shuffles(paid) == 1
    assert {tuple(r) for r in paid.collect()} == {("a", 3, 1, 3, 3, Decimal("3.00")), (None, 1, 1, 1, 1, Decimal("4.00"))}


def test_stored_tables_meet_by_order_without_a_shuffle(spark, golden, no_broadcast):
    assert shuffles(golden["orders_enriched"].join(golden["fct_orders"], "order_id")) == 0
    assert shuffles(golden["fct_orders"].groupBy("order_id").count()) == 0
    for name, key in BUCKETS.items():
        assert golden[name].filter(f"{key} is not null").groupBy(key).count().filter("count > 1").isEmpty(), name


def test_lineage_shuffles_only_what_was_not_stored_by_order(spark, golden, no_broadcast):
    # Seven when every layer, and both sides of each comparison, were dealt by order.
    assert shuffles(suites.lineage_suite(golden)) <= 3
    assert suites.issues(suites.lineage_suite(golden)).isEmpty()


def test_a_table_in_buckets_is_read_back_whole(spark, tmp_path):
    write = table_writer(spark, str(tmp_path))
    df = spark.range(1000).selectExpr("nullif(id, 7) as id", "cast(id as string) as text", "timestamp_ntz'2020-01-01 00:00:00' as at")
    back = write("some", df, "id")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_matches_are_counted_without_the_surrogate_key(golden, monkeypatch):
    seen = []
    count = quality.match_counts
    monkeypatch.setattr(quality, "match_counts", lambda facts, *rest: seen.append(facts.columns) or count(facts, *rest))
    assert quality.scd2_mapping(golden).isEmpty()
    assert seen == [["order_id", "customer_unique_id", "order_purchased_at"]]


def test_items_are_compared_before_their_order_is_looked_up(spark, golden, no_broadcast):
    facts = golden["fct_order_items"]
    first = facts.selectExpr("min(struct(order_id, order_item_id)) as k").first()["k"]
    wrong = (F.col("order_id") == first["order_id"]) & (F.col("order_item_id") == first["order_item_id"])
    odd = facts.withColumn("merchandise_value", F.when(wrong, F.col("merchandise_value") + 1).otherwise(F.col("merchandise_value")).cast("decimal(18,2)"))
    odd = odd.withColumn("is_delivered", F.when(F.col("order_id") == first["order_id"], ~F.col("is_delivered")).otherwise(F.col("is_delivered")))
    suite = suites.marts_suite(golden.replace(fct_order_items=odd))
    found = {r["metric"]: r["value"] for r in suite.collect()}
    assert found["order_items.field_mismatches"] == facts.filter(F.col("order_id") == first["order_id"]).count()
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(suite._jdf.queryExecution(), "formatted")
    widths = [int(n) for n in re.findall(r"Exchange\nInput \[(\d+)\]: .*\nArguments: hashpartitioning\(a_order_id#\d+, ", plan) if n]
    assert 3 in widths, widths
