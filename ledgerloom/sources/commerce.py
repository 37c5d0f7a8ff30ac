"""Driver tables shaped as RAW commerce entities (FIXTURES.md, section 4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.values import MONEY
from ..operators.dedup import latest_wins

# Fixed value: the order in which RAW tables are checked.
ENTITIES = (
    "customers", "geolocation", "order_items", "payments", "reviews",
    "orders", "products", "sellers", "translation",
)
LINEAGE = ("_source_file", "_file_row_number", "_loaded_at", "_batch_id")
BATCH = "batch_0001"
LOADED = "2026-01-01 00:00:00"


def seconds(n: Column) -> Column:
    return F.make_dt_interval(secs=n)


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def with_lineage(df: DataFrame, file: str, row: Column, loaded: Column | None = None) -> DataFrame:
    moment = F.lit(LOADED) if loaded is None else loaded
    return df.withColumns({
        "_source_file": F.lit(file),
        "_file_row_number": row.cast("bigint"),
        "_loaded_at": moment.cast("timestamp_ntz"),
        "_batch_id": F.lit(BATCH),
    })


def _orders(t: Callable[[str], DataFrame]) -> DataFrame:
    key, day, state = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    offset = seconds(key % 86400)
    shipped = F.when(state == "F", day + days(3))
    arrived = F.when((state == "F") & (key % 500 != 1), day + days(10) + offset)
    status = (
        F.when(key % 97 == 0, "canceled").when(state == "F", "delivered")
        .when(state == "O", "shipped").otherwise("processing")
    )
    rows = t("orders").select(
        "o_orderkey", "o_orderdate",
        key.cast("string").alias("order_id"),
        F.concat(F.lit("C"), key.cast("string")).alias("customer_id"),
        status.alias("order_status"),
        (day + offset).alias("order_purchase_timestamp"),
        (day + offset + seconds(F.lit(3600))).alias("order_approved_at"),
        shipped.alias("order_delivered_carrier_date"),
        arrived.alias("order_delivered_customer_date"),
        (day + days(20)).alias("order_estimated_delivery_date"),
    )
    return with_lineage(rows, "orders", key + 1, day).drop("o_orderkey", "o_orderdate")


def _customers(t: Callable[[str], DataFrame]) -> DataFrame:
    era = (F.year("o_orderdate") - 1995) % 3
    joined = (
        t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    rows = joined.select(
        "o_orderkey", "o_orderdate",
        F.concat(F.lit("C"), key.cast("string")).alias("customer_id"),
        F.col("o_custkey").cast("string").alias("customer_unique_id"),
        (F.col("c_nationkey") * 1000 + era).cast("bigint").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), era.cast("string")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )
    return with_lineage(rows, "customers", key + 1, day).drop("o_orderkey", "o_orderdate")


def _order_items(t: Callable[[str], DataFrame]) -> DataFrame:
    arrival = F.col("l_partkey") * 1000000 + F.col("l_suppkey")
    rows = t("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
        "l_partkey", "l_suppkey",
    )
    return with_lineage(rows, "order_items", arrival, F.col("shipping_limit_date")).drop(
        "l_partkey", "l_suppkey"
    )


def _payments(t: Callable[[str], DataFrame]) -> DataFrame:
    worth = (F.col("price").cast(MONEY) + F.col("freight_value").cast(MONEY)).alias("__worth")
    lines = _order_items(t).select("order_id", "order_item_id", "_loaded_at", "_file_row_number", worth)
    items = latest_wins(lines.repartition("order_id"), ["order_id", "order_item_id"], ["_loaded_at", "_file_row_number"])
    gross = items.groupBy(F.col("order_id").alias("__id")).agg(F.sum("__worth").alias("__gross"))
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 6
    shift = (
        F.when(kind == 2, F.lit("0.01")).when(kind == 3, F.lit("7.00"))
        .when(kind == 4, F.lit("-4.00")).otherwise(F.lit("0.00")).cast(MONEY)
    )
    paid = (
        t("orders").select("o_orderkey", "o_orderdate")
        .join(gross, key.cast("string") == F.col("__id"), "left")
        .filter((kind != 0) | F.col("__gross").isNull())
    )
    method = F.element_at(F.array(*map(F.lit, ("credit_card", "boleto", "voucher"))), (key % 3 + 1).cast("int"))
    rows = paid.select(
        "o_orderkey", "o_orderdate",
        key.cast("string").alias("order_id"),
        F.lit(1).cast("bigint").alias("payment_sequential"),
        method.alias("payment_type"),
        (key % 4 + 1).alias("payment_installments"),
        F.coalesce(F.col("__gross") + shift, F.lit("12.00").cast(MONEY)).cast(MONEY).alias("payment_value"),
    )
    return with_lineage(rows, "payments", key + 1, F.col("o_orderdate")).drop("o_orderkey", "o_orderdate")


def _category() -> Column:
    key = F.col("p_partkey")
    return (
        F.when(key % 50 == 0, F.lit(None).cast("string")).when(key == 7, "RARE")
        .when(key % 97 == 0, "UNLISTED").otherwise(F.col("p_type"))
    )


def _products(t: Callable[[str], DataFrame]) -> DataFrame:
    measure = F.col("p_size").cast("double") + 0.5
    names = (
        "product_name_lenght", "product_description_lenght", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )
    rows = t("part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("product_id"),
        _category().alias("product_category_name"),
        *[measure.alias(n) for n in names],
    )
    return with_lineage(rows, "products", F.col("p_partkey") + 1).drop("p_partkey")


def _translation(t: Callable[[str], DataFrame]) -> DataFrame:
    names = t("part").select(_category().alias("product_category_name")).filter(
        F.col("product_category_name") != "UNLISTED"
    ).distinct()
    english = F.when(F.col("product_category_name") != "PROMO", F.lower("product_category_name"))
    return with_lineage(
        names.withColumn("product_category_name_english", english), "translation", F.lit(1)
    )


def _sellers(t: Callable[[str], DataFrame]) -> DataFrame:
    joined = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = joined.select(
        "s_suppkey",
        F.col("s_suppkey").cast("string").alias("seller_id"),
        (F.col("s_nationkey") * 1000).cast("bigint").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )
    return with_lineage(rows, "sellers", F.col("s_suppkey") + 1).drop("s_suppkey")


def _reviews(t: Callable[[str], DataFrame]) -> DataFrame:
    key = F.col("event_id")
    rows = t("events").select(
        "event_id",
        key.cast("string").alias("review_id"),
        (key - key % 2).cast("string").alias("order_id"),
        (key % 5 + 1).alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        (F.col("ts") + days(1)).alias("review_answer_timestamp"),
    )
    return with_lineage(rows, "reviews", key + 1).drop("event_id")


def _geolocation(t: Callable[[str], DataFrame]) -> DataFrame:
    joined = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = joined.select(
        "c_custkey",
        (F.col("c_nationkey") * 1000).cast("bigint").alias("geolocation_zip_code_prefix"),
        F.col("c_nationkey").cast("double").alias("geolocation_lat"),
        (-F.col("c_nationkey")).cast("double").alias("geolocation_lng"),
        F.concat(F.lit("city_"), F.col("c_nationkey").cast("string")).alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )
    return with_lineage(rows, "geolocation", F.col("c_custkey") + 1).drop("c_custkey")


_BUILDERS = {
    "orders": _orders, "customers": _customers, "order_items": _order_items, "payments": _payments,
    "products": _products, "translation": _translation, "sellers": _sellers, "reviews": _reviews,
    "geolocation": _geolocation,
}


def driver_table(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_entities(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """entity name -> RAW DataFrame."""
    tables = driver_table(spark, sf_dir)
    return lambda entity: _BUILDERS[entity](tables)
