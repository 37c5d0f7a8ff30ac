"""Staging: fixed types, clean names, latest row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import local_time, money, whole
from ..operators.dedup import latest_wins

NEWEST_FIRST = ("_loaded_at", "_file_row_number")


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _stage(df: DataFrame, columns: Sequence[Column], keys: Sequence[str], dealt_by: str | None = None) -> DataFrame:
    typed = df.select(
        *columns,
        _text("_source_file"),
        F.col("_file_row_number").cast("bigint").alias("_file_row_number"),
        "_loaded_at",
        _text("_batch_id"),
    )
    # Dealt by one of the keys, rows that agree in it lie together afterwards, and no other shuffle is needed.
    dealt = typed.repartition(dealt_by) if dealt_by else typed
    return latest_wins(dealt, keys, NEWEST_FIRST) if keys else dealt


def customers(raw: DataFrame) -> DataFrame:
    return _stage(raw, [
        _text("customer_id"), _text("customer_unique_id"),
        whole(raw, "customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        _text("customer_city"), _text("customer_state"),
    ], ["customer_id"])


def geolocation(raw: DataFrame) -> DataFrame:
    return _stage(raw, [
        whole(raw, "geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"),
        F.col("geolocation_lat").cast("double").alias("geolocation_latitude"),
        F.col("geolocation_lng").cast("double").alias("geolocation_longitude"),
        _text("geolocation_city"), _text("geolocation_state"),
    ], [])


def order_items(raw: DataFrame) -> DataFrame:
    return _stage(raw, [
        _text("order_id"), whole(raw, "order_item_id").alias("order_item_id"),
        _text("product_id"), _text("seller_id"),
        local_time("shipping_limit_date").alias("shipping_limit_at"),
        money(raw, "price").alias("price"), money(raw, "freight_value").alias("freight_value"),
    ], ["order_id", "order_item_id"], "order_id")


def orders(raw: DataFrame) -> DataFrame:
    return _stage(raw, [
        _text("order_id"), _text("customer_id"), _text("order_status"),
        local_time("order_purchase_timestamp").alias("order_purchased_at"),
        local_time("order_approved_at").alias("order_approved_at"),
        local_time("order_delivered_carrier_date").alias("delivered_to_carrier_at"),
        local_time("order_delivered_customer_date").alias("delivered_to_customer_at"),
        local_time("order_estimated_delivery_date").alias("estimated_delivery_at"),
    ], ["order_id"])


def payments(raw: DataFrame) -> DataFrame:
    return _stage(raw, [
        _text("order_id"), whole(raw, "payment_sequential").alias("payment_sequence"),
        _text("payment_type"), whole(raw, "payment_installments").alias("payment_installments"),
        money(raw, "payment_value").alias("payment_value"),
    ], ["order_id", "payment_sequence"])


def products(raw: DataFrame) -> DataFrame:
    renamed = {
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
        "product_photos_qty": "product_photos_quantity",
        "product_weight_g": "product_weight_g",
        "product_length_cm": "product_length_cm",
        "product_height_cm": "product_height_cm",
        "product_width_cm": "product_width_cm",
    }
    return _stage(raw, [
        _text("product_id"), _text("product_category_name"),
        *[whole(raw, old).alias(new) for old, new in renamed.items()],
    ], ["product_id"])


def reviews(raw: DataFrame) -> DataFrame:
    return _stage(raw, [
        _text("review_id"), _text("order_id"), whole(raw, "review_score").alias("review_score"),
        _text("review_comment_title"), _text("review_comment_message"),
        local_time("review_creation_date").alias("review_created_at"),
        local_time("review_answer_timestamp").alias("review_answered_at"),
    ], ["review_id", "order_id"])


def sellers(raw: DataFrame) -> DataFrame:
    return _stage(raw, [
        _text("seller_id"), whole(raw, "seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        _text("seller_city"), _text("seller_state"),
    ], ["seller_id"])


def translation(raw: DataFrame) -> DataFrame:
    return _stage(
        raw, [_text("product_category_name"), _text("product_category_name_english")],
        ["product_category_name"],
    )


STAGES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": customers, "geolocation": geolocation, "order_items": order_items,
    "orders": orders, "payments": payments, "products": products, "reviews": reviews,
    "sellers": sellers, "translation": translation,
}
