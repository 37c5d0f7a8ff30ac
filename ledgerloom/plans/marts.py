"""Dimensions, facts and revenue marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import MONEY, month_of, total
from ..operators.history import asof_lookup, version_history
from ..operators.scans import ROWS
from .intermediate import payment_difference, reconciliation_status

GEOGRAPHY = ("customer_zip_code_prefix", "customer_city", "customer_state")


def surrogate_key(customer: Column, version: Column) -> Column:
    return F.md5(F.concat(customer, F.lit("|"), version.cast("string")))


def dim_customer(enriched: DataFrame, rows: int = ROWS) -> DataFrame:
    """Type-2 geography history, one version per run of equal geography."""
    versions = version_history(
        enriched, "customer_unique_id", "order_purchased_at", "order_id", GEOGRAPHY, rows
    )
    return versions.select(
        surrogate_key(F.col("customer_unique_id"), F.col("version")).alias("customer_sk"),
        "customer_unique_id",
        F.col("version").alias("customer_version"),
        *GEOGRAPHY,
        "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        F.col("observations").alias("orders_in_version"),
    )


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    known = translation.select(
        F.col("product_category_name").alias("__known"), "product_category_name_english"
    )
    status = (
        F.when(F.col("product_category_name").isNull(), "missing_source_category")
        .when(F.col("__known").isNull(), "unmatched_translation")
        .when(F.col("product_category_name_english").isNull(), "missing_english_translation")
        .otherwise("translated")
    )
    return products.join(known, F.col("product_category_name") == F.col("__known"), "left").select(
        "product_id", "product_category_name", "product_category_name_english",
        status.alias("category_translation_status"),
        "product_name_length", "product_description_length", "product_photos_quantity",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def is_delivered() -> Column:
    return F.coalesce(F.col("order_status") == "delivered", F.lit(False))


def fct_orders(enriched: DataFrame, customers: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per order with its reconciliation and the customer version valid at purchase.

    Reconciliation is a projection of the same row, so the 1:1 join on order_id is not needed.
    """
    facts = enriched.filter(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", "customer_unique_id", "order_status", "order_purchased_at",
        "order_approved_at", "delivered_to_carrier_at", "delivered_to_customer_at",
        "estimated_delivery_at", *GEOGRAPHY, "item_count",
        F.col("item_revenue").alias("merchandise_value"),
        F.col("freight_revenue").alias("freight_value"),
        F.col("item_plus_freight").alias("gross_order_value"),
        "payment_record_count", "payment_type_count", "payment_value",
        "review_record_count", "distinct_review_count", "average_review_score",
        payment_difference().alias("payment_item_difference"),
        reconciliation_status().alias("reconciliation_status"),
        is_delivered().alias("is_delivered"),
        (is_delivered() & F.col("delivered_to_customer_at").isNull()).alias(
            "is_delivery_timestamp_exception"
        ),
    )
    found = asof_lookup(
        facts, customers, "customer_unique_id", "order_purchased_at", ["customer_sk"],
        "customer_version", rows, ident="order_id",
    )
    leading = ["order_id", "customer_id", "customer_unique_id", "customer_sk"]
    return found.select(*leading, *[c for c in facts.columns if c not in leading])


def fct_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    parents = orders.select("order_id", "order_purchased_at", "order_status", "is_delivered")
    return items.join(parents, "order_id").select(
        "order_id", "order_item_id", "product_id", "seller_id",
        "order_purchased_at", "order_status", "is_delivered", "shipping_limit_at",
        F.col("price").alias("merchandise_value"), "freight_value",
        (F.col("price") + F.col("freight_value")).cast(MONEY).alias("item_gross_value"),
    )


def order_values(orders: DataFrame, items_by_order: DataFrame) -> DataFrame:
    """The order facts the monthly mart needs, straight from orders and items."""
    return orders.select("order_id", "order_status", "order_purchased_at").join(
        items_by_order.select(
            "order_id",
            F.col("item_revenue").alias("merchandise_value"),
            F.col("freight_revenue").alias("freight_value"),
            F.col("item_plus_freight").alias("gross_order_value"),
        ), "order_id", "left",
    )


def _order_totals() -> list[Column]:
    return [
        F.count("*").alias("delivered_orders"),
        total("merchandise_value").alias("gross_merchandise_revenue"),
        total("freight_value").alias("freight_value"),
        total("gross_order_value").alias("gross_order_value"),
    ]


def _item_totals() -> list[Column]:
    return [
        F.count("*").alias("delivered_item_rows"),
        F.count_distinct("order_id").alias("distinct_delivered_orders"),
        total("merchandise_value").alias("gross_merchandise_revenue"),
        total("freight_value").alias("freight_value"),
        total("item_gross_value").alias("gross_order_value"),
    ]


def monthly_revenue(orders: DataFrame) -> DataFrame:
    delivered = orders.filter("order_status = 'delivered'").withColumn(
        "purchase_month", month_of("order_purchased_at")
    )
    monthly = delivered.groupBy("purchase_month").agg(*_order_totals())
    average = F.col("gross_order_value").cast("double") / F.nullif(
        F.col("delivered_orders").cast("double"), F.lit(0.0)
    )
    cents = F.round(average * 100.0).cast("decimal(20,0)")
    return monthly.withColumn(
        "average_gross_order_value", (cents * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)
    )


def customer_revenue(orders: DataFrame, customers: DataFrame) -> DataFrame:
    earned = orders.filter("is_delivered").groupBy("customer_unique_id").agg(
        *_order_totals(),
        F.min("order_purchased_at").alias("first_delivered_purchase_at"),
        F.max("order_purchased_at").alias("last_delivered_purchase_at"),
    )
    current = customers.filter("is_current").select("customer_unique_id", *GEOGRAPHY)
    orders_n = F.col("delivered_orders")
    return earned.join(current, "customer_unique_id").select(
        "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix",
        "delivered_orders", (orders_n > 1).alias("is_repeat_customer"),
        "first_delivered_purchase_at", "last_delivered_purchase_at",
        F.datediff("last_delivered_purchase_at", "first_delivered_purchase_at")
        .cast("bigint").alias("purchase_span_days"),
        "gross_merchandise_revenue", "freight_value", "gross_order_value",
        (F.col("gross_order_value").cast("double") / F.nullif(orders_n.cast("double"), F.lit(0.0)))
        .alias("average_gross_order_value"),
    )


CATEGORY = ("product_category_name", "product_category_name_english", "category_translation_status")


def categorized_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Delivered items with their category; items of unknown products drop out."""
    return items.filter("is_delivered").join(products.select("product_id", *CATEGORY), "product_id")


def category_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    return categorized_items(items, products).groupBy(*CATEGORY).agg(*_item_totals())


category_revenue = category_totals


def seller_totals(items: DataFrame) -> DataFrame:
    return items.filter("is_delivered").groupBy("seller_id").agg(*_item_totals())


def seller_revenue(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items are summed per seller first, so the dimension join sees one row per seller."""
    return seller_totals(items).join(sellers, "seller_id").select(
        "seller_id", "seller_city", "seller_state", "seller_zip_code_prefix",
        "delivered_item_rows", "distinct_delivered_orders", "gross_merchandise_revenue",
        "freight_value", "gross_order_value",
    )
