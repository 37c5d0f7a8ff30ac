"""Order-level aggregates, the enriched order spine and payment reconciliation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.values import differs, total


def items_by_order(items: DataFrame) -> DataFrame:
    """Items are dealt by order once, unless they lie that way; sums and distinct counts are then taken where they lie.

    Staged items of an order differ in their item number, so copies do not gather there. A product or seller counts
    with the first of its items in the order: two distinct counts would copy every item and deal the copies out anew.
    """
    gross = F.col("price") + F.col("freight_value")

    def counts(name: str, then: str) -> Column:
        before = F.lag(name).over(Window.partitionBy("order_id").orderBy(name, then))
        return F.col(name).isNotNull() & differs(F.col(name), before)

    dealt = items.withColumns({
        "__product": counts("product_id", "seller_id"), "__seller": counts("seller_id", "product_id"),
    })
    return dealt.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.count_if("__product").alias("distinct_product_count"),
        F.count_if("__seller").alias("distinct_seller_count"),
        total("price").alias("item_revenue"),
        total("freight_value").alias("freight_revenue"),
        total(gross).alias("item_plus_freight"),
        F.min("shipping_limit_at").alias("first_shipping_limit_at"),
        F.max("shipping_limit_at").alias("last_shipping_limit_at"),
    )


def payments_by_order(payments: DataFrame) -> DataFrame:
    """Dealt by order once, as items are; staged payments of an order differ in their sequence."""
    return payments.repartition("order_id").groupBy("order_id").agg(
        F.count("*").alias("payment_record_count"),
        F.count_distinct("payment_type").alias("payment_type_count"),
        F.max("payment_sequence").alias("max_payment_sequence"),
        F.max("payment_installments").alias("max_payment_installments"),
        total("payment_value").alias("payment_value"),
    )


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    """Dealt by order once, as payments are; staged reviews of an order differ in their id."""
    return reviews.repartition("order_id").groupBy("order_id").agg(
        F.count("*").alias("review_record_count"),
        F.count_distinct("review_id").alias("distinct_review_count"),
        F.min("review_score").alias("minimum_review_score"),
        F.max("review_score").alias("maximum_review_score"),
        F.avg("review_score").alias("average_review_score"),
        F.min("review_created_at").alias("first_review_created_at"),
        F.max("review_created_at").alias("last_review_created_at"),
        F.max("review_answered_at").alias("last_review_answered_at"),
    )


def orders_enriched(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Order spine with everything known per order; what is unknown stays NULL."""
    people = customers.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    )
    joined = (
        orders.join(people, "customer_id", "left")
        .join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
    )
    return joined.select(
        "order_id", "customer_id",
        *[c for c in people.columns if c != "customer_id"],
        "order_status", "order_purchased_at", "order_approved_at", "delivered_to_carrier_at",
        "delivered_to_customer_at", "estimated_delivery_at",
        *[c for c in items.columns if c != "order_id"],
        *[c for c in payments.columns if c != "order_id"],
        *[c for c in reviews.columns if c != "order_id"],
    )


def payment_difference() -> Column:
    """NULL unless both sides exist."""
    return (F.col("payment_value") - F.col("item_plus_freight")).cast("decimal(38,2)")


def reconciliation_status() -> Column:
    cent = F.lit(Decimal("0.01"))
    gap = payment_difference()
    return (
        F.when(F.col("item_plus_freight").isNull(), "missing_items")
        .when(F.col("payment_value").isNull(), "missing_payment")
        .when(gap == 0, "exact_match")
        .when(F.abs(gap) <= cent, "within_one_cent")
        .when(gap > cent, "payment_above_item_plus_freight")
        .when(gap < -cent, "payment_below_item_plus_freight")
        .otherwise("unclassified")
    )


def order_reconciliation(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "order_id", "customer_id", "customer_unique_id", "order_status", "order_purchased_at",
        "item_count", "payment_record_count", "payment_type_count", "max_payment_sequence",
        "max_payment_installments", "item_revenue", "freight_revenue", "item_plus_freight",
        "payment_value",
        payment_difference().alias("payment_item_difference"),
        reconciliation_status().alias("reconciliation_status"),
    )
