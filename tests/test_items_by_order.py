"""Items lie by their order: what is asked of an order's items moves nothing, and gives what moving them gave."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.compare import field_recon, spine_check
from ledgerloom.plans import intermediate, marts, quality

from .test_stored import no_broadcast, shuffles  # noqa: F401

DAY = dt.datetime(2020, 1, 1)


def test_items_of_stored_tables_are_not_moved(spark, golden, no_broadcast):  # noqa: F811
    staged, facts = golden["stg_order_items"], golden["fct_order_items"]
    assert shuffles(intermediate.items_by_order(staged)) == 0
    assert shuffles(marts.fct_order_items(staged, golden["fct_orders"])) == 0
    assert shuffles(quality.items_grain(golden)) == 0
    # One for the totals of a seller.
    assert shuffles(marts.seller_totals(facts)) == 1
    # Two for orders of many lines, of which there are none.
    assert shuffles(quality.item_recon(golden)) == 2


def test_reviews_are_dealt_once(spark):
    rows = [("r", "a", 1, DAY), ("s", "a", 4, DAY), (None, "a", None, DAY), ("r", None, 2, None)]
    reviews = spark.createDataFrame([(*r, None) for r in rows], "review_id string, order_id string, review_score bigint, review_created_at timestamp_ntz, review_answered_at timestamp_ntz")
    found = intermediate.reviews_by_order(reviews)
    assert shuffles(found) == 1
    got = {(r["order_id"], r["review_record_count"], r["distinct_review_count"], r["minimum_review_score"], r["average_review_score"]) for r in found.collect()}
    assert got == {("a", 3, 2, 1, 2.5), (None, 1, 1, 2, 2.0)}


def tables(spark) -> dict:
    """Orders of one line and of many; lines that are absent, unexpected, different, repeated or without a number."""
    cents = Decimal("0.01")
    staged = [
        ("a", 1, "p", "s"), ("a", 2, "p", "s"), ("a", 2, "q", "s"), ("a", None, "p", "s"), ("b", 1, "p", None), ("c", 1, "p", "s"),
        (None, 1, "p", "s"), ("gone", 1, "p", "s"), *[("long", n, "p", "s") for n in range(9)],
    ]
    stored = [
        ("a", 1, "p", "s"), ("a", 1, "p", "s"), ("a", 2, "p", "s"), ("a", 2, "p", "s"), ("a", None, "p", "s"), ("b", 1, "p", None),
        ("c", 1, "p", "t"), ("c", 3, "p", "s"), (None, 1, "p", "s"), (None, None, "p", "s"), *[("long", n, "q" if n == 3 else "p", "s") for n in range(1, 9)],
    ]
    key = "order_id string, order_item_id bigint, product_id string, seller_id string, "
    items = spark.createDataFrame(
        [(*r, DAY, cents, cents) for r in staged], key + "shipping_limit_at timestamp_ntz, price decimal(18,2), freight_value decimal(18,2)")
    orders = spark.createDataFrame(
        [(o, DAY, "delivered", True) for o in ("a", "b", "c", "long")], "order_id string, order_purchased_at timestamp_ntz, order_status string, is_delivered boolean")
    facts = spark.createDataFrame(
        [(*r, DAY, "delivered", True, DAY, cents, cents, 2 * cents) for r in stored],
        key + "order_purchased_at timestamp_ntz, order_status string, is_delivered boolean, shipping_limit_at timestamp_ntz, merchandise_value decimal(18,2), freight_value decimal(18,2), item_gross_value decimal(18,2)")
    return {"stg_order_items": items, "fct_orders": orders, "fct_order_items": facts}


@pytest.mark.parametrize("few", (0, 2, 5, 100))
def test_items_are_compared_alike_in_short_and_long_orders(spark, few):
    m = tables(spark)
    source = marts.fct_order_items(m["stg_order_items"], m["fct_orders"])
    plain = field_recon(source, m["fct_order_items"], ["order_id", "order_item_id"], quality.ITEM_FIELDS, "unexpected_item")
    expected = sorted(map(tuple, plain.collect()), key=str)
    assert ("c", 1, "missing_or_mismatched") in expected and (None, 1, "unexpected_item") in expected and ("long", 3, "missing_or_mismatched") in expected
    assert sorted(map(tuple, quality.item_recon(m, few).collect()), key=str) == expected


def test_attributions_count_groups_of_every_kind(spark):
    rows = [("a", "s", "p"), ("a", "s", "q"), ("a", "t", "x"), ("b", None, "p"), ("b", "s", None), (None, "s", "p"), (None, "s", "p"), ("c", "u", "x")]
    items = spark.createDataFrame([(*r, r[0] != "c") for r in rows], "order_id string, seller_id string, product_id string, is_delivered boolean")
    products = spark.createDataFrame(
        [("p", "books", None, "unmatched_translation"), ("q", None, None, "missing_source_category"), ("z", "toys", "toys", "translated")],
        "product_id string, product_category_name string, product_category_name_english string, category_translation_status string")
    found = quality._attributions(items, products).first().asDict()
    assert found == {
        "order_orders": 2, "order_items": 7, "seller_orders": 5, "seller_items": 7, "category_orders": 4, "category_items": 5}
    none = quality._attributions(items.filter(F.lit(False)), products).first()
    assert set(none) == {0}


@pytest.mark.parametrize("check", (quality.fact_spine, quality.reconciliation_spine, quality.enriched_spine))
def test_only_orders_of_one_table_are_moved(golden, no_broadcast, check):  # noqa: F811
    plan = check(golden)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("Join")


@pytest.mark.parametrize("left, right, expected", (
    (["a", "a", "b"], ["b", "c", "c"], {("a", "missing"), ("c", "unexpected")}),
    (["a", None, None], ["a", None], set()),
    (["a", None], ["a"], {(None, "missing")}),
    (["a"], [None, None], {("a", "missing"), (None, "unexpected")}),
))
def test_keys_of_one_side_are_told_once(spark, left, right, expected):
    sides = (spark.createDataFrame([(k, 1) for k in keys], "k string, v int") for keys in (left, right))
    found = [tuple(r) for r in spine_check(*sides, "k", "missing", "unexpected").collect()]
    assert len(found) == len(expected) and set(found) == expected
