"""Reporting queries over the marts and the public aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import month_of, rate, total

# Display labels of the public reconciliation statuses.
STATUS_LABELS = {
    "exact_match": "Exact match",
    "missing_payment_or_item_records": "Missing payment or item records",
    "within_one_cent": "Within one cent",
    "payment_above_item_plus_freight": "Payment above item + freight",
    "payment_below_item_plus_freight": "Payment below item + freight",
}


def _zero_if_empty(name: str) -> Column:
    return F.coalesce(total(name), F.lit(0).cast("decimal(38,2)"))


def filtered_orders(
    orders: DataFrame, first_month: str | None, last_month: str | None, states: Sequence[str] | None
) -> DataFrame:
    """Delivered orders in a purchase-month range and a list of states (all known by default)."""
    kept = orders.filter("is_delivered").withColumn("purchase_month", month_of("order_purchased_at"))
    state = F.col("customer_state")
    kept = kept.filter(state.isNotNull() if states is None else state.isin(list(states)))
    # A half-open range on the stored column reaches the scan; a condition on the month would not.
    at = F.col("order_purchased_at")
    if first_month:
        kept = kept.filter(at >= F.lit(_month_from(first_month)).cast("timestamp_ntz"))
    if last_month:
        kept = kept.filter(at < F.lit(_next_month(date.fromisoformat(last_month))).cast("timestamp_ntz"))
    return kept


def _next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def _month_from(text: str) -> date:
    """The first month that begins on or after a day."""
    day = date.fromisoformat(text)
    return day if day.day == 1 else _next_month(day)


def filtered_kpis(orders: DataFrame) -> DataFrame:
    sums = orders.agg(
        F.count("*").alias("delivered_orders"),
        _zero_if_empty("merchandise_value").alias("merchandise"),
        _zero_if_empty("freight_value").alias("freight"),
        _zero_if_empty("gross_order_value").alias("gross"),
    )
    balanced = F.col("merchandise") + F.col("freight") == F.col("gross")
    return sums.withColumn("is_reconciled", balanced)


def _gross_and_orders() -> list[Column]:
    return [
        total("gross_order_value").alias("gross_order_value"),
        F.count("order_id").alias("delivered_orders"),
    ]


def monthly(orders: DataFrame) -> DataFrame:
    return orders.groupBy("purchase_month").agg(*_gross_and_orders()).orderBy("purchase_month")


def top(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """Top-k report; the key breaks ties."""
    return df.orderBy(F.desc_nulls_last(measure), F.asc_nulls_last(key)).limit(n)


def top_states(orders: DataFrame, n: int = 15) -> DataFrame:
    return top(orders.groupBy("customer_state").agg(*_gross_and_orders()), "gross_order_value", "customer_state", n)


def reconciliation_statuses(orders: DataFrame) -> DataFrame:
    counted = orders.groupBy("reconciliation_status").agg(F.count("*").alias("orders"))
    return counted.orderBy(F.desc("orders"), "reconciliation_status")


def top_categories(categories: DataFrame, n: int = 15) -> DataFrame:
    name = F.coalesce(
        "product_category_name_english", "product_category_name", F.lit("(missing source category)")
    )
    shown = categories.select(
        name.alias("display_category"), "category_translation_status", "gross_order_value"
    )
    return top(shown, "gross_order_value", "display_category", n)


def top_sellers(sellers: DataFrame, n: int = 15) -> DataFrame:
    return top(sellers.select("seller_id", "seller_state", "gross_order_value"), "gross_order_value", "seller_id", n)


def repeat_distribution(customers: DataFrame) -> DataFrame:
    return customers.groupBy("is_repeat_customer").agg(
        F.count("customer_unique_id").alias("customers"),
        total("gross_order_value").alias("gross_order_value"),
    )


def period_table(
    periods: DataFrame, launch_label: str, first_month: str, measure: str,
    selected: Sequence[str] | None = None,
) -> DataFrame:
    """Periods in reporting order: the launch period first, then months counted from `first_month`."""
    name = F.col("reporting_period")
    months = F.substring(name, 1, 4).try_cast("int") * 12 + F.substring(name, 6, 2).try_cast("int")
    start = int(first_month[:4]) * 12 + int(first_month[5:7])
    position = F.when(name == launch_label, 0).otherwise(months - start + 1).cast("bigint")
    kept = periods if selected is None else periods.filter(name.isin(list(selected)))
    return kept.select(
        position.alias("position"), "reporting_period", "delivered_orders", F.col(measure).alias("amount")
    ).orderBy("position")


def topn_categories(categories: DataFrame, measure: str, n: int) -> DataFrame:
    return top(categories.select("public_category", measure), measure, "public_category", n)


def reconciliation_detail(statuses: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    """Non-exact statuses with display labels."""
    label = F.lit(None).cast("string")
    for status, text in STATUS_LABELS.items():
        label = F.when(F.col("public_status") == status, text).otherwise(label)
    kept = statuses.filter("public_status <> 'exact_match'")
    if selected is not None:
        kept = kept.filter(F.col("public_status").isin(list(selected)))
    return kept.select("public_status", label.alias("classification"), "orders").orderBy("orders")


def repeat_share(repeat: DataFrame) -> DataFrame:
    everyone = F.sum("customers").cast("bigint")
    returning = F.coalesce(F.sum(F.when(F.col("is_repeat_customer"), F.col("customers"))), F.lit(0))
    return repeat.agg(
        everyone.alias("customers"),
        returning.cast("bigint").alias("repeat_customers"),
        rate(returning, everyone).alias("repeat_share"),
    )


def delivered_kpis(orders: DataFrame) -> DataFrame:
    """Benchmark query 1."""
    return orders.filter("is_delivered").agg(
        F.count("*").alias("orders"), total("merchandise_value").alias("merchandise"),
        total("freight_value").alias("freight"), total("gross_order_value").alias("gross"),
    )


def monthly_mart(months: DataFrame) -> DataFrame:
    """Benchmark query 2."""
    return months.agg(
        F.count("*").alias("months"), F.sum("delivered_orders").cast("bigint").alias("orders"),
        total("gross_order_value").alias("gross"),
    )
