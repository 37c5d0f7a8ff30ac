"""Deliberately damaged tables: every check must report them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .model import Model

CENT = "0.01"


def _plus_cent(name: str) -> Column:
    return (F.col(name) + F.lit(CENT).cast("decimal(18,2)")).alias(name)


def _set(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Replace columns where the condition holds; types stay as they are."""
    types = dict(df.dtypes)
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)).cast(types[c]) for c, v in values.items()}
    )


def _without(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(~F.coalesce(condition, F.lit(False)))


def lost_and_changed_category(m: Model) -> Model:
    mart = _without(m["category_revenue"], F.col("product_category_name") == "RARE")
    unnamed = F.col("product_category_name").isNull()
    return m.replace(category_revenue=_set(
        mart, unnamed, delivered_item_rows=F.col("delivered_item_rows") + 1,
        gross_order_value=_plus_cent("gross_order_value"),
    ))


def repeated_category(m: Model) -> Model:
    mart = m["category_revenue"]
    again = mart.filter(F.col("product_category_name").isNull())
    return m.replace(category_revenue=_set(
        mart.unionByName(again), F.col("product_category_name") == "RARE",
        product_category_name_english=F.lit(None),
    ))


def lost_and_changed_seller(m: Model) -> Model:
    mart = _without(m["seller_revenue"], F.col("seller_state") == "NATION_0")
    return m.replace(seller_revenue=_set(
        mart, F.col("seller_state") == "NATION_1", gross_order_value=_plus_cent("gross_order_value"),
        distinct_delivered_orders=F.col("delivered_item_rows") + 1,
    ))


def changed_customer(m: Model) -> Model:
    mart = _without(m["customer_revenue"], F.col("customer_state") == "NATION_0")
    return m.replace(customer_revenue=_set(
        mart, ~F.col("is_repeat_customer"), gross_order_value=_plus_cent("gross_order_value")
    ))


def changed_months(m: Model) -> Model:
    early = F.year("purchase_month") == 1996
    extra = m["monthly_revenue"].filter(F.year("purchase_month") == 1997).withColumn(
        "purchase_month", F.add_months("purchase_month", 600)
    )
    mart = _without(m["monthly_revenue"], F.year("purchase_month") == 1995).unionByName(extra)
    return m.replace(monthly_revenue=_set(mart, early, freight_value=_plus_cent("freight_value")))


def changed_products(m: Model) -> Model:
    status = F.col("category_translation_status")
    dim = _without(m["dim_product"], status == "missing_source_category")
    dim = _set(dim, status == "unmatched_translation", category_translation_status=F.lit("translated"))
    invented = dim.filter("product_category_name = 'RARE'").withColumn(
        "product_id", F.concat(F.lit("X"), "product_id")
    )
    return m.replace(dim_product=dim.unionByName(invented))


def changed_sellers(m: Model) -> Model:
    state = F.col("seller_state")
    dim = _without(m["dim_seller"], state == "NATION_0")
    dim = _set(dim, state == "NATION_1", seller_city=F.upper("seller_city"))
    invented = dim.filter(state == "NATION_2").withColumn("seller_id", F.concat(F.lit("X"), "seller_id"))
    return m.replace(dim_seller=dim.unionByName(invented))


def changed_items(m: Model) -> Model:
    status = F.col("order_status")
    fact = _without(m["fct_order_items"], status == "processing")
    fact = _set(fact, status == "canceled", freight_value=_plus_cent("freight_value"))
    invented = fact.filter(status == "canceled").withColumn("order_id", F.concat(F.lit("X"), "order_id"))
    return m.replace(fct_order_items=fact.unionByName(invented))


def repeated_items(m: Model) -> Model:
    fact = m["fct_order_items"]
    return m.replace(fct_order_items=fact.unionByName(fact.filter("order_status = 'canceled'")))


def first_version_everywhere(m: Model) -> Model:
    """Facts point to version 1, and version 2 never ends."""
    first = F.md5(F.concat("customer_unique_id", F.lit("|1")))
    dim = _set(m["dim_customer"], F.col("customer_version") == 2, valid_to=F.lit(None))
    return m.replace(fct_orders=m["fct_orders"].withColumn("customer_sk", first), dim_customer=dim)


def broken_spine(table: str) -> Callable[[Model], Model]:
    def damage(m: Model) -> Model:
        status = F.col("order_status")
        kept = _without(m[table], status == "canceled")
        return m.replace(**{table: _set(
            kept, status == "processing", order_id=F.concat(F.lit("X"), "order_id")
        )})

    return damage


def wrong_statuses(m: Model) -> Model:
    status = F.col("reconciliation_status")
    return m.replace(order_reconciliation=_set(
        m["order_reconciliation"], status.isin("within_one_cent", "missing_payment"),
        reconciliation_status=F.lit("exact_match"),
    ))


def same(m: Model) -> Model:
    return m


FAULTS: dict[str, Callable[[Model], Model]] = {
    "chk_category_attribution": lost_and_changed_category,
    "chk_count_additivity": lost_and_changed_seller,
    "chk_financial_parity": changed_customer,
    "chk_dim_product": changed_products,
    "chk_dim_seller": changed_sellers,
    "chk_fct_items": changed_items,
    "chk_items_grain": repeated_items,
    "chk_scd2_mapping": first_version_everywhere,
    "chk_fct_spine": broken_spine("fct_orders"),
    "chk_category_grain": repeated_category,
    "chk_category_recon": lost_and_changed_category,
    "chk_customer_grain": changed_customer,
    "chk_customer_recon": changed_customer,
    "chk_monthly_recon": changed_months,
    "chk_seller_grain": lost_and_changed_seller,
    "chk_seller_recon": lost_and_changed_seller,
    "known_exceptions": same,
    "chk_recon_spine": broken_spine("order_reconciliation"),
    "chk_recon_status": wrong_statuses,
    "chk_enriched_spine": broken_spine("orders_enriched"),
}


def damaged_inputs(m: Model) -> Model:
    """Tables that break every kind of generic test."""
    orders = m["stg_orders"]
    canceled = F.col("order_status") == "canceled"
    orders = _set(orders, canceled, customer_id=F.lit(None)).unionByName(orders.filter(canceled))
    orders = _set(orders, F.col("order_status") == "processing", order_status=F.lit("lost"))
    items = _set(
        m["stg_order_items"], F.col("freight_value") == 50, freight_value=-F.col("freight_value")
    )
    products = _without(m["stg_products"], F.col("product_category_name") == "RARE")
    sellers = _without(m["stg_sellers"], F.col("seller_state") == "NATION_0")
    facts = broken_spine("fct_orders")(m)["fct_orders"]
    return m.replace(
        stg_orders=orders, stg_order_items=items, stg_products=products, stg_sellers=sellers, fct_orders=facts
    )

