"""Oracle SQL for ingestion queries."""

from __future__ import annotations

from .base import with_ctes

ENTITIES = ["customers", "geolocation", "order_items", "payments", "reviews", "orders", "products", "sellers", "translation"]
WIDTH = {"customers": 5, "geolocation": 5, "order_items": 7, "orders": 8, "payments": 5, "products": 9,
         "reviews": 7, "sellers": 4, "translation": 2}
# All columns of the entities, in alphabetical order; * marks floating-point numbers, $ amounts, @ times.
COLUMNS = {
    "customers": ["customer_city", "customer_id", "customer_state", "customer_unique_id", "customer_zip_code_prefix"],
    "geolocation": ["geolocation_city", "*geolocation_lat", "*geolocation_lng", "geolocation_state", "geolocation_zip_code_prefix"],
    "order_items": ["*freight_value", "order_id", "order_item_id", "*price", "product_id", "seller_id", "@shipping_limit_date"],
    "orders": ["customer_id", "@order_approved_at", "@order_delivered_carrier_date", "@order_delivered_customer_date",
               "@order_estimated_delivery_date", "order_id", "@order_purchase_timestamp", "order_status"],
    "payments": ["order_id", "payment_installments", "payment_sequential", "payment_type", "$payment_value"],
    "products": ["product_category_name", "*product_description_lenght", "*product_height_cm", "product_id", "*product_length_cm",
                 "*product_name_lenght", "*product_photos_qty", "*product_weight_g", "*product_width_cm"],
    "reviews": ["order_id", "@review_answer_timestamp", "review_comment_message", "review_comment_title", "@review_creation_date",
                "review_id", "review_score"],
    "sellers": ["seller_city", "seller_id", "seller_state", "seller_zip_code_prefix"],
    "translation": ["product_category_name", "product_category_name_english"],
}


def _as_text(column: str) -> str:
    name = column.strip("*@$")
    text = f"CAST({name} AS VARCHAR)"
    if column[0] == "*":
        # Whole part and twice 53 bits of the rest.
        scale = "9007199254740992.0::DOUBLE"
        one = f"(({name}::DOUBLE - floor({name}::DOUBLE)) * {scale})"
        two = f"(({one} - floor({one})) * {scale})"
        text = " || ':' || ".join(f"CAST(CAST(floor({x}) AS HUGEINT) AS VARCHAR)" for x in (f"{name}::DOUBLE", one, two))
    elif column[0] == "$":
        text = f"CAST(CAST({name} AS DECIMAL(18,2)) AS VARCHAR)"
    elif column[0] == "@":
        text = f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"coalesce(length({text}) || '=' || {text}, '-')"


TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
          "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _present(c: str) -> str:
    return f"CASE WHEN {c} IN ({', '.join(repr(t) for t in TOKENS)}) THEN NULL ELSE {c} END AS {c}"


# The damaged RAW tables: filter and batch expression per entity.
DAMAGE = {e: ("true", "_batch_id") for e in ENTITIES if e != "geolocation"}
DAMAGE["order_items"] = ("true", "CAST(NULL AS VARCHAR)")
DAMAGE["payments"] = ("payment_type <> 'voucher'", "_batch_id")
DAMAGE["products"] = ("true", "CASE WHEN product_category_name IS NOT NULL THEN _batch_id END")
DAMAGE["reviews"] = ("true", "CASE WHEN review_comment_title = 'error' THEN 'batch_0002' ELSE _batch_id END")
PROFILE = "\nUNION ALL ".join(
    f"SELECT '{e}' AS entity, count(*) AS rows, count(b) AS populated, count(DISTINCT b) AS distinct_batches, "
    f"min(b) AS batch_id, {'count(*)' if e == 'order_items' else 'count(*) FILTER (WHERE b IS NULL)'} AS null_lineage, "
    f"{str(e == 'order_items').lower()} AS no_column FROM (SELECT {b} AS b FROM raw_{e} WHERE {w})"
    for e, (w, b) in DAMAGE.items())
EXPECTED = "\nUNION ALL ".join(f"SELECT '{e}' AS entity, count(*) AS expected_rows FROM raw_{e}" for e in ENTITIES)
POSITIONS = ", ".join(f"({i}, '{e}')" for i, e in enumerate(ENTITIES))
VERIFY = f"""
    SELECT CAST(o.position AS INTEGER) AS position, o.entity, e.expected_rows, p.rows AS actual_rows,
        CASE WHEN p.rows IS NULL THEN 'TABLE_MISSING' WHEN no_column THEN 'BATCH_COLUMN_MISSING'
             WHEN p.rows IS DISTINCT FROM e.expected_rows THEN 'ROW_COUNT_MISMATCH' WHEN p.rows = 0 THEN NULL
             WHEN populated <> p.rows THEN 'NULL_BATCH_ID'
             WHEN distinct_batches <> 1 OR batch_id <> 'batch_0001' THEN 'BATCH_MISMATCH' END AS reason
    FROM (VALUES {POSITIONS}) AS o(position, entity) LEFT JOIN ({EXPECTED}) e ON o.entity = e.entity
    LEFT JOIN ({PROFILE}) p ON o.entity = p.entity"""


def ingestion_sql() -> dict[str, str]:
    entries = "\nUNION ALL ".join(
        f"SELECT '{e}.csv' AS f, sha256(count(*) || ':' || CAST(coalesce(sum(CAST('0x' || substr(md5(concat({', '.join(map(_as_text, c))})), 1, 15) "
        f"AS BIGINT)), 0) AS VARCHAR)) AS s FROM raw_{e}" for e, c in COLUMNS.items())
    names = [f"{e}.csv" for e in ENTITIES]
    intact = [n for n in names if n != "geolocation.csv"]
    return {
        "manifest_contract": """
    SELECT * FROM (VALUES ('geolocation.csv', 'missing_file'), ('refunds.csv', 'unexpected_file'),
        ('orders.csv', 'duplicate_file'), ('payments.csv', 'invalid_data_rows'),
        ('sellers.csv', 'invalid_size_bytes'), ('products.csv', 'invalid_sha256')) AS t(file_name, issue)""",
        "file_inventory": """
    SELECT * FROM (VALUES ('geolocation.csv', 'unexpected'), ('refunds.csv', 'missing')) AS t(file_name, issue)""",
        "file_integrity": "SELECT * FROM (VALUES " + ", ".join(
            f"('{n}', {str(n != 'sellers.csv').lower()}, {str(n != 'reviews.csv').lower()})" for n in intact
        ) + ") AS t(file_name, size_ok, sha256_ok)",
        "batch_id": with_ctes(
            f"SELECT 'commerce_' || substr(sha256(string_agg(f || ':' || s, '|' ORDER BY f)), 1, 16) AS batch_id FROM ({entries})"),
        "csv_landing": f"""
    SELECT doc_id, {_present('text')}, {_present('lang')}, {_present('source')}, n_chars,
        'batch_0001' AS _batch_id, true AS row_number_ok FROM documents""",
        "landing_report": with_ctes("\nUNION ALL ".join(
            f"SELECT '{e}' AS entity, count(*) AS rows, CAST({n} AS BIGINT) AS source_columns, "
            f"CAST({n + 4} AS BIGINT) AS output_columns, true AS has_bytes FROM raw_{e}" for e, n in WIDTH.items())),
        "batch_uniformity": with_ctes(f"""
    SELECT entity, rows, distinct_batches, CASE WHEN no_column THEN 'missing_lineage_columns'
        WHEN rows = 0 THEN 'empty' WHEN populated < rows THEN 'null_batch_id'
        WHEN distinct_batches <> 1 THEN 'several_batch_ids' END AS problem FROM ({PROFILE})
    UNION ALL SELECT '__all__', CAST(sum(rows) AS BIGINT), count(DISTINCT batch_id),
        CASE WHEN count(DISTINCT batch_id) <> 1 THEN 'several_batch_ids' END FROM ({PROFILE})"""),
        "load_reconciliation": with_ctes(f"""
    SELECT *, CASE WHEN difference_rows = 0 AND batch_ok THEN 'PASS' ELSE 'FAIL' END AS status FROM (
        SELECT e.entity, e.expected_rows AS source_rows, coalesce(p.rows, 0) AS target_rows,
            coalesce(p.rows, 0) - e.expected_rows AS difference_rows,
            coalesce(populated = rows AND distinct_batches = 1 AND batch_id = 'batch_0001', false) AS batch_ok
        FROM ({EXPECTED}) e LEFT JOIN ({PROFILE}) p ON e.entity = p.entity)"""),
        "raw_batch_verify": with_ctes(f"""
    SELECT * FROM ({VERIFY}) UNION ALL
    SELECT 9, '__verdict__', NULL, NULL, coalesce((SELECT reason || ':' || entity FROM ({VERIFY})
        WHERE reason IS NOT NULL ORDER BY position LIMIT 1), 'RAW_BATCH_VERIFIED')"""),
        "raw_vs_manifest": with_ctes(f"""
    SELECT p.entity, e.expected_rows, p.rows AS actual_rows, p.null_lineage, p.distinct_batches, p.batch_id,
        concat_ws(',', CASE WHEN p.rows <> e.expected_rows THEN 'row_count_differs' END,
            CASE WHEN null_lineage > 0 THEN 'null_lineage' END,
            CASE WHEN NOT (distinct_batches = 1 AND batch_id IS NOT NULL) THEN 'not_one_batch' END) AS issues
    FROM ({PROFILE}) p LEFT JOIN ({EXPECTED}) e ON p.entity = e.entity
    UNION ALL SELECT '__all__', NULL, NULL, NULL, n, NULL, CASE WHEN n > 1 THEN 'different_batches' ELSE '' END
    FROM (SELECT count(DISTINCT batch_id) FILTER (WHERE distinct_batches = 1) AS n FROM ({PROFILE}))"""),
        "schema_compat": with_ctes("""
    SELECT 'product_id' AS column_name, 'string' AS expected_type, 'string' AS actual_type,
        (SELECT count(*) FROM raw_products WHERE product_id IS NULL) AS null_rows, CAST(NULL AS VARCHAR) AS issue
    UNION ALL SELECT 'product_category_name', 'string', 'string',
        (SELECT count(*) FROM raw_products WHERE product_category_name IS NULL), 'nulls_in_required_column'
    UNION ALL SELECT 'product_name_lenght', 'bigint', 'double', 0, 'type_differs'
    UNION ALL SELECT 'product_weight_g', 'double', 'double', 0, NULL
    UNION ALL SELECT 'product_color', 'string', NULL, NULL, 'missing_column'
    UNION ALL SELECT '_batch_id', 'string', 'string', 0, NULL
    UNION ALL SELECT 'product_photos_qty', NULL, 'double', 0, 'unexpected_column'"""),
        "partitioned_batch": with_ctes("""
    SELECT make_date(year(order_purchase_timestamp), 1, 1) AS ingest_date,
        'batch_' || year(order_purchase_timestamp) AS batch_id, count(*) AS rows,
        min(order_purchase_timestamp) AS first_purchase, max(order_purchase_timestamp) AS last_purchase
    FROM raw_orders GROUP BY 1, 2"""),
        "idempotent_batch": with_ctes("""
    SELECT step, CASE WHEN step = 'first' THEN 'CREATED' WHEN n = rows THEN 'IDENTICAL_REPLAY' ELSE 'PROTECTED_BATCH_CONFLICT' END AS outcome,
        rows, canceled, first_purchase
    FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE order_status = 'canceled') AS canceled, min(order_purchase_timestamp) AS first_purchase FROM raw_orders),
        LATERAL (VALUES ('first', rows), ('replay', rows), ('changed', rows - canceled)) AS t(step, n)"""),
        "governed_load": with_ctes("\nUNION ALL ".join(
            f"SELECT '{e}' AS entity_name, count(*) AS source_rows, count(*) AS target_rows, "
            f"CAST(0 AS BIGINT) AS difference_rows, 'PASS' AS status, 'SUCCESS' AS run_status FROM raw_{e}"
            for e in ENTITIES)),
        "event_ledger": """
    SELECT ts AS event_time, event_type AS operation,
        CASE WHEN value < 50 THEN 'CREATED' ELSE 'IDENTICAL_REPLAY' END AS outcome,
        'user_' || user_id AS dataset, 'batch_' || event_id AS batch_id, props AS fingerprint FROM events""",
    }
