"""Common table expressions: RAW adapter, staging, intermediate and marts in DuckDB SQL."""

from __future__ import annotations

import re


def _lineage(file: str, row: str, loaded: str = "TIMESTAMP '2026-01-01 00:00:00'") -> str:
    return (
        f"'{file}' AS _source_file, CAST({row} AS BIGINT) AS _file_row_number, "
        f"{loaded} AS _loaded_at, 'batch_0001' AS _batch_id"
    )


def _latest(columns: str, raw: str, keys: str) -> str:
    return f"""
    SELECT * FROM (SELECT {columns}, _source_file, _file_row_number, _loaded_at, _batch_id FROM {raw})
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY _loaded_at DESC, _file_row_number DESC) = 1"""


RECON_CASE = """CASE WHEN item_plus_freight IS NULL THEN 'missing_items'
        WHEN payment_value IS NULL THEN 'missing_payment'
        WHEN payment_value = item_plus_freight THEN 'exact_match'
        WHEN abs(payment_value - item_plus_freight) <= 0.01 THEN 'within_one_cent'
        WHEN payment_value - item_plus_freight > 0.01 THEN 'payment_above_item_plus_freight'
        WHEN payment_value - item_plus_freight < -0.01 THEN 'payment_below_item_plus_freight'
        ELSE 'unclassified' END"""

ITEM_TOTALS = """count(*) AS delivered_item_rows,
        count(DISTINCT order_id) AS distinct_delivered_orders,
        CAST(sum(merchandise_value) AS DECIMAL(38,2)) AS gross_merchandise_revenue,
        CAST(sum(freight_value) AS DECIMAL(38,2)) AS freight_value,
        CAST(sum(item_gross_value) AS DECIMAL(38,2)) AS gross_order_value"""

CTES: dict[str, str] = {
    "raw_orders": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'C' || o_orderkey AS customer_id,
        CASE WHEN o_orderkey % 97 = 0 THEN 'canceled' WHEN o_orderstatus = 'F' THEN 'delivered'
             WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
        o_orderdate + to_seconds(o_orderkey % 86400) AS order_purchase_timestamp,
        o_orderdate + to_seconds(o_orderkey % 86400) + INTERVAL 1 HOUR AS order_approved_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 3 DAY END AS order_delivered_carrier_date,
        CASE WHEN o_orderstatus = 'F' AND o_orderkey % 500 <> 1
             THEN o_orderdate + INTERVAL 10 DAY + to_seconds(o_orderkey % 86400) END
             AS order_delivered_customer_date,
        o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date,
        {_lineage('orders', 'o_orderkey + 1', 'o_orderdate')}
    FROM orders""",
    "raw_customers": f"""
    SELECT 'C' || o_orderkey AS customer_id, CAST(o_custkey AS VARCHAR) AS customer_unique_id,
        CAST(c_nationkey * 1000 + (year(o_orderdate) - 1995) % 3 AS BIGINT) AS customer_zip_code_prefix,
        'city_' || CAST((year(o_orderdate) - 1995) % 3 AS VARCHAR) AS customer_city,
        n_name AS customer_state, {_lineage('customers', 'o_orderkey + 1', 'o_orderdate')}
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "raw_order_items": f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
        CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
        l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_quantity AS freight_value,
        {_lineage('order_items', 'l_partkey * 1000000 + l_suppkey', 'l_shipdate')}
    FROM lineitem""",
    "stg_order_items": _latest(
        """order_id, order_item_id, product_id, seller_id,
        CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_at,
        CAST(price AS DECIMAL(18,2)) AS price, CAST(freight_value AS DECIMAL(18,2)) AS freight_value""",
        "raw_order_items", "order_id, order_item_id"),
    "items_by_order": """
    SELECT order_id, count(*) AS item_count, count(DISTINCT product_id) AS distinct_product_count,
        count(DISTINCT seller_id) AS distinct_seller_count,
        CAST(sum(price) AS DECIMAL(38,2)) AS item_revenue,
        CAST(sum(freight_value) AS DECIMAL(38,2)) AS freight_revenue,
        CAST(sum(price + freight_value) AS DECIMAL(38,2)) AS item_plus_freight,
        min(shipping_limit_at) AS first_shipping_limit_at, max(shipping_limit_at) AS last_shipping_limit_at
    FROM stg_order_items GROUP BY order_id""",
    "raw_payments": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
        CASE o_orderkey % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto' ELSE 'voucher' END AS payment_type,
        o_orderkey % 4 + 1 AS payment_installments,
        CAST(coalesce(item_plus_freight + CAST(CASE o_orderkey % 6 WHEN 2 THEN 0.01 WHEN 3 THEN 7.00
             WHEN 4 THEN -4.00 ELSE 0.00 END AS DECIMAL(18,2)), 12.00) AS DECIMAL(18,2)) AS payment_value,
        {_lineage('payments', 'o_orderkey + 1', 'o_orderdate')}
    FROM orders LEFT JOIN items_by_order ON order_id = CAST(o_orderkey AS VARCHAR)
    WHERE o_orderkey % 6 <> 0 OR item_plus_freight IS NULL""",
    "raw_products": f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
        CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey = 7 THEN 'RARE'
             WHEN p_partkey % 97 = 0 THEN 'UNLISTED' ELSE p_type END AS product_category_name,
        CAST(p_size AS DOUBLE) + 0.5 AS product_name_lenght,
        CAST(p_size AS DOUBLE) + 0.5 AS product_description_lenght,
        CAST(p_size AS DOUBLE) + 0.5 AS product_photos_qty,
        CAST(p_size AS DOUBLE) + 0.5 AS product_weight_g, CAST(p_size AS DOUBLE) + 0.5 AS product_length_cm,
        CAST(p_size AS DOUBLE) + 0.5 AS product_height_cm, CAST(p_size AS DOUBLE) + 0.5 AS product_width_cm,
        {_lineage('products', 'p_partkey + 1')}
    FROM part""",
    "raw_translation": f"""
    SELECT DISTINCT product_category_name,
        CASE WHEN product_category_name <> 'PROMO' THEN lower(product_category_name) END
            AS product_category_name_english, {_lineage('translation', '1')}
    FROM raw_products WHERE product_category_name <> 'UNLISTED'""",
    "raw_sellers": f"""
    SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey * 1000 AS BIGINT) AS seller_zip_code_prefix,
        s_name AS seller_city, n_name AS seller_state, {_lineage('sellers', 's_suppkey + 1')}
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_reviews": f"""
    SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(event_id - event_id % 2 AS VARCHAR) AS order_id,
        event_id % 5 + 1 AS review_score, event_type AS review_comment_title,
        props AS review_comment_message, ts AS review_creation_date,
        ts + INTERVAL 1 DAY AS review_answer_timestamp, {_lineage('reviews', 'event_id + 1')}
    FROM events""",
    "raw_geolocation": f"""
    SELECT CAST(c_nationkey * 1000 AS BIGINT) AS geolocation_zip_code_prefix,
        CAST(c_nationkey AS DOUBLE) AS geolocation_lat, CAST(-c_nationkey AS DOUBLE) AS geolocation_lng,
        'city_' || CAST(c_nationkey AS VARCHAR) AS geolocation_city, n_name AS geolocation_state,
        {_lineage('geolocation', 'c_custkey + 1')}
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "stg_customers": _latest(
        "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state",
        "raw_customers", "customer_id"),
    "stg_geolocation": """
    SELECT geolocation_zip_code_prefix, geolocation_lat AS geolocation_latitude,
        geolocation_lng AS geolocation_longitude, geolocation_city, geolocation_state,
        _source_file, _file_row_number, _loaded_at, _batch_id FROM raw_geolocation""",
    "stg_orders": _latest(
        """order_id, customer_id, order_status, order_purchase_timestamp AS order_purchased_at,
        order_approved_at, order_delivered_carrier_date AS delivered_to_carrier_at,
        order_delivered_customer_date AS delivered_to_customer_at,
        order_estimated_delivery_date AS estimated_delivery_at""", "raw_orders", "order_id"),
    "stg_payments": _latest(
        """order_id, payment_sequential AS payment_sequence, payment_type, payment_installments,
        payment_value""", "raw_payments", "order_id, payment_sequence"),
    "stg_products": _latest(
        """product_id, product_category_name, CAST(product_name_lenght AS BIGINT) AS product_name_length,
        CAST(product_description_lenght AS BIGINT) AS product_description_length,
        CAST(product_photos_qty AS BIGINT) AS product_photos_quantity,
        CAST(product_weight_g AS BIGINT) AS product_weight_g,
        CAST(product_length_cm AS BIGINT) AS product_length_cm,
        CAST(product_height_cm AS BIGINT) AS product_height_cm,
        CAST(product_width_cm AS BIGINT) AS product_width_cm""", "raw_products", "product_id"),
    "stg_reviews": _latest(
        """review_id, order_id, review_score, review_comment_title, review_comment_message,
        review_creation_date AS review_created_at, review_answer_timestamp AS review_answered_at""",
        "raw_reviews", "review_id, order_id"),
    "stg_sellers": _latest(
        "seller_id, seller_zip_code_prefix, seller_city, seller_state", "raw_sellers", "seller_id"),
    "stg_translation": _latest(
        "product_category_name, product_category_name_english", "raw_translation", "product_category_name"),
    "payments_by_order": """
    SELECT order_id, count(*) AS payment_record_count, count(DISTINCT payment_type) AS payment_type_count,
        max(payment_sequence) AS max_payment_sequence, max(payment_installments) AS max_payment_installments,
        CAST(sum(payment_value) AS DECIMAL(38,2)) AS payment_value
    FROM stg_payments GROUP BY order_id""",
    "reviews_by_order": """
    SELECT order_id, count(*) AS review_record_count, count(DISTINCT review_id) AS distinct_review_count,
        min(review_score) AS minimum_review_score, max(review_score) AS maximum_review_score,
        avg(review_score) AS average_review_score, min(review_created_at) AS first_review_created_at,
        max(review_created_at) AS last_review_created_at, max(review_answered_at) AS last_review_answered_at
    FROM stg_reviews GROUP BY order_id""",
    "orders_enriched": """
    SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city,
        c.customer_state, o.order_status, o.order_purchased_at, o.order_approved_at,
        o.delivered_to_carrier_at, o.delivered_to_customer_at, o.estimated_delivery_at,
        i.* EXCLUDE (order_id), p.* EXCLUDE (order_id), r.* EXCLUDE (order_id)
    FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
    LEFT JOIN items_by_order i ON o.order_id = i.order_id
    LEFT JOIN payments_by_order p ON o.order_id = p.order_id
    LEFT JOIN reviews_by_order r ON o.order_id = r.order_id""",
    "order_reconciliation": f"""
    SELECT order_id, customer_id, customer_unique_id, order_status, order_purchased_at, item_count,
        payment_record_count, payment_type_count, max_payment_sequence, max_payment_installments,
        item_revenue, freight_revenue, item_plus_freight, payment_value,
        CAST(payment_value - item_plus_freight AS DECIMAL(38,2)) AS payment_item_difference,
        {RECON_CASE} AS reconciliation_status
    FROM orders_enriched""",
    "version_assignment": """
    SELECT *, sum(starts_new_version) OVER (PARTITION BY customer_unique_id
        ORDER BY order_purchased_at, order_id ROWS UNBOUNDED PRECEDING) AS version
    FROM (
        SELECT customer_unique_id, order_id, order_purchased_at, customer_zip_code_prefix, customer_city,
            customer_state,
            CASE WHEN row_number() OVER w = 1
                OR customer_zip_code_prefix IS DISTINCT FROM lag(customer_zip_code_prefix) OVER w
                OR customer_city IS DISTINCT FROM lag(customer_city) OVER w
                OR customer_state IS DISTINCT FROM lag(customer_state) OVER w THEN 1 ELSE 0 END
                AS starts_new_version
        FROM orders_enriched
        WINDOW w AS (PARTITION BY customer_unique_id ORDER BY order_purchased_at, order_id))""",
    "version_rollup": """
    SELECT customer_unique_id, version,
        arg_min(customer_zip_code_prefix, {'t': order_purchased_at, 'o': order_id}) AS customer_zip_code_prefix,
        arg_min(customer_city, {'t': order_purchased_at, 'o': order_id}) AS customer_city,
        arg_min(customer_state, {'t': order_purchased_at, 'o': order_id}) AS customer_state,
        min(order_purchased_at) AS valid_from, count(*) AS orders_in_version
    FROM version_assignment GROUP BY customer_unique_id, version""",
    "dim_customer": """
    SELECT md5(customer_unique_id || '|' || CAST(version AS VARCHAR)) AS customer_sk, customer_unique_id,
        CAST(version AS BIGINT) AS customer_version, customer_zip_code_prefix, customer_city, customer_state,
        valid_from, valid_to, valid_to IS NULL AS is_current, orders_in_version
    FROM (SELECT *, lead(valid_from) OVER (PARTITION BY customer_unique_id ORDER BY version) AS valid_to
          FROM version_rollup)""",
    "dim_product": """
    SELECT p.product_id, p.product_category_name, t.product_category_name_english,
        CASE WHEN p.product_category_name IS NULL THEN 'missing_source_category'
             WHEN t.product_category_name IS NULL THEN 'unmatched_translation'
             WHEN t.product_category_name_english IS NULL THEN 'missing_english_translation'
             ELSE 'translated' END AS category_translation_status,
        p.product_name_length, p.product_description_length, p.product_photos_quantity, p.product_weight_g,
        p.product_length_cm, p.product_height_cm, p.product_width_cm
    FROM stg_products p LEFT JOIN stg_translation t ON p.product_category_name = t.product_category_name""",
    "dim_seller": "SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM stg_sellers",
    "fct_orders": """
    SELECT o.order_id, o.customer_id, o.customer_unique_id, d.customer_sk, o.order_status,
        o.order_purchased_at, o.order_approved_at, o.delivered_to_carrier_at, o.delivered_to_customer_at,
        o.estimated_delivery_at, o.customer_zip_code_prefix, o.customer_city, o.customer_state, o.item_count,
        o.item_revenue AS merchandise_value, o.freight_revenue AS freight_value,
        o.item_plus_freight AS gross_order_value, o.payment_record_count, o.payment_type_count,
        o.payment_value, o.review_record_count, o.distinct_review_count, o.average_review_score,
        r.payment_item_difference, r.reconciliation_status,
        coalesce(o.order_status = 'delivered', false) AS is_delivered,
        coalesce(o.order_status = 'delivered' AND o.delivered_to_customer_at IS NULL, false)
            AS is_delivery_timestamp_exception
    FROM orders_enriched o JOIN order_reconciliation r ON o.order_id = r.order_id
    JOIN dim_customer d ON o.customer_unique_id = d.customer_unique_id
        AND o.order_purchased_at >= d.valid_from
        AND (o.order_purchased_at < d.valid_to OR d.valid_to IS NULL)""",
    "fct_order_items": """
    SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, o.order_purchased_at, o.order_status,
        o.is_delivered, i.shipping_limit_at, i.price AS merchandise_value, i.freight_value,
        CAST(i.price + i.freight_value AS DECIMAL(18,2)) AS item_gross_value
    FROM stg_order_items i JOIN fct_orders o ON i.order_id = o.order_id""",
    "monthly_revenue": """
    SELECT purchase_month, delivered_orders, gross_merchandise_revenue, freight_value, gross_order_value,
        CAST(gross_order_value / nullif(delivered_orders, 0) AS DECIMAL(18,2)) AS average_gross_order_value
    FROM (SELECT CAST(date_trunc('month', order_purchased_at) AS DATE) AS purchase_month,
            count(*) AS delivered_orders,
            CAST(sum(merchandise_value) AS DECIMAL(38,2)) AS gross_merchandise_revenue,
            CAST(sum(freight_value) AS DECIMAL(38,2)) AS freight_value,
            CAST(sum(gross_order_value) AS DECIMAL(38,2)) AS gross_order_value
        FROM fct_orders WHERE order_status = 'delivered' GROUP BY 1)""",
    "customer_revenue": """
    SELECT r.customer_unique_id, c.customer_city, c.customer_state, c.customer_zip_code_prefix,
        r.delivered_orders, r.delivered_orders > 1 AS is_repeat_customer, r.first_delivered_purchase_at,
        r.last_delivered_purchase_at,
        date_diff('day', r.first_delivered_purchase_at, r.last_delivered_purchase_at) AS purchase_span_days,
        r.gross_merchandise_revenue, r.freight_value, r.gross_order_value,
        CAST(r.gross_order_value AS DOUBLE) / nullif(r.delivered_orders, 0) AS average_gross_order_value
    FROM (SELECT customer_unique_id, count(*) AS delivered_orders,
            min(order_purchased_at) AS first_delivered_purchase_at,
            max(order_purchased_at) AS last_delivered_purchase_at,
            CAST(sum(merchandise_value) AS DECIMAL(38,2)) AS gross_merchandise_revenue,
            CAST(sum(freight_value) AS DECIMAL(38,2)) AS freight_value,
            CAST(sum(gross_order_value) AS DECIMAL(38,2)) AS gross_order_value
        FROM fct_orders WHERE is_delivered GROUP BY customer_unique_id) r
    JOIN dim_customer c ON r.customer_unique_id = c.customer_unique_id AND c.is_current""",
    "category_revenue": f"""
    SELECT product_category_name, product_category_name_english, category_translation_status, {ITEM_TOTALS}
    FROM fct_order_items i JOIN dim_product p ON i.product_id = p.product_id
    WHERE i.is_delivered GROUP BY 1, 2, 3""",
    "seller_revenue": f"""
    SELECT s.seller_id, s.seller_city, s.seller_state, s.seller_zip_code_prefix, {ITEM_TOTALS}
    FROM fct_order_items i JOIN dim_seller s ON i.seller_id = s.seller_id
    WHERE i.is_delivered GROUP BY 1, 2, 3, 4""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` behind the CTEs it reads, directly or through other CTEs."""
    available = {**CTES, **(extra or {})}
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in available:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(available[name])

    visit(body)
    if body.lstrip().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    used = [f"{n} AS ({sql})" for n, sql in available.items() if n in needed]
    return ("WITH " + ",\n".join(used) + "\n" if used else "") + body


def whole_table(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}")
