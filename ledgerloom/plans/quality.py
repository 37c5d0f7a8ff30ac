"""Generic data tests (fused per table) and singular checks; each check returns its violations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import differs, total
from ..operators.compare import (
    any_differs, count_metric, field_recon, full_outer, mismatched_groups, named_values,
    metric_rows, spine_check, symmetric_diff, union_all,
)
from ..operators.history import match_counts, version_gaps
from .marts import (
    CATEGORY, categorized_items, category_totals, dim_product, fct_order_items, monthly_revenue,
    seller_totals,
)
from .model import Model

# Domains.
ORDER_STATUSES = (
    "approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped", "unavailable",
)
RECONCILIATION_STATUSES = (
    "exact_match", "within_one_cent", "payment_above_item_plus_freight",
    "payment_below_item_plus_freight", "missing_items", "missing_payment",
)
TRANSLATION_STATUSES = (
    "translated", "missing_source_category", "unmatched_translation", "missing_english_translation",
)
MART_TRANSLATION_STATUSES = TRANSLATION_STATUSES[:3]
BOTH = (True, False)

# Per table, columns under each generic test.
GENERIC_TESTS: dict[str, dict[str, object]] = {
    "stg_customers": {
        "not_null": ("customer_id", "customer_unique_id", "_batch_id", "_loaded_at"),
        "unique": ["customer_id"],
    },
    "stg_geolocation": {
        "not_null": ("geolocation_zip_code_prefix", "geolocation_latitude", "geolocation_longitude", "_batch_id", "_loaded_at"),
    },
    "stg_order_items": {
        "not_null": ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_at", "_batch_id", "_loaded_at"),
        "unique": ["order_id || '-' || cast(order_item_id as string)"],
        "relationships": {
            "order_id": "stg_orders", "product_id": "stg_products", "seller_id": "stg_sellers",
        },
        "nonnegative": ("price", "freight_value"),
    },
    "stg_orders": {
        "not_null": ("order_id", "customer_id", "order_status", "order_purchased_at", "estimated_delivery_at", "_batch_id", "_loaded_at"),
        "unique": ["order_id"],
        "relationships": {"customer_id": "stg_customers"},
        "accepted_values": {"order_status": ORDER_STATUSES},
    },
    "stg_payments": {
        "not_null": ("order_id", "payment_sequence", "payment_type", "payment_installments", "payment_value", "_batch_id", "_loaded_at"),
        "unique": ["order_id || '-' || cast(payment_sequence as string)"],
        "relationships": {"order_id": "stg_orders"},
        "nonnegative": ("payment_value",),
    },
    "stg_products": {"not_null": ("product_id", "_batch_id", "_loaded_at"), "unique": ["product_id"]},
    "stg_reviews": {
        "not_null": ("review_id", "order_id", "review_score", "review_created_at", "review_answered_at", "_batch_id", "_loaded_at"),
        "unique": ["review_id || '-' || order_id"],
        "relationships": {"order_id": "stg_orders"},
        "accepted_values": {"review_score": (1, 2, 3, 4, 5)},
    },
    "stg_sellers": {"not_null": ("seller_id", "_batch_id", "_loaded_at"), "unique": ["seller_id"]},
    "stg_translation": {
        "not_null": ("product_category_name", "product_category_name_english", "_batch_id", "_loaded_at"),
        "unique": ["product_category_name"],
    },
    "items_by_order": {
        "not_null": (
            "order_id", "item_count", "distinct_product_count", "distinct_seller_count", "item_revenue", "freight_revenue",
            "item_plus_freight",
        ),
        "unique": ["order_id"],
        "relationships": {"order_id": "stg_orders"},
        "nonnegative": ("item_revenue", "freight_revenue", "item_plus_freight"),
    },
    "payments_by_order": {
        "not_null": ("order_id", "payment_record_count", "payment_type_count", "payment_value"),
        "unique": ["order_id"],
        "relationships": {"order_id": "stg_orders"},
        "nonnegative": ("payment_value",),
    },
    "reviews_by_order": {
        "not_null": (
            "order_id", "review_record_count", "distinct_review_count", "minimum_review_score", "maximum_review_score",
            "average_review_score",
        ),
        "unique": ["order_id"],
        "relationships": {"order_id": "stg_orders"},
    },
    "orders_enriched": {
        "not_null": ("order_id", "customer_id", "customer_unique_id", "order_status", "order_purchased_at"),
        "unique": ["order_id"],
        "relationships": {"customer_id": "stg_customers"},
    },
    "order_reconciliation": {
        "not_null": ("order_id", "customer_id", "customer_unique_id", "order_status", "reconciliation_status"),
        "unique": ["order_id"],
        "relationships": {"order_id": "orders_enriched"},
        "accepted_values": {"reconciliation_status": RECONCILIATION_STATUSES},
    },
    "fct_orders": {
        "not_null": (
            "order_id", "customer_id", "customer_unique_id", "customer_sk", "order_status", "order_purchased_at",
            "reconciliation_status", "is_delivered", "is_delivery_timestamp_exception",
        ),
        "unique": ["order_id"],
        "relationships": {"customer_sk": "dim_customer"},
        "accepted_values": {
            "reconciliation_status": RECONCILIATION_STATUSES,
            "is_delivered": BOTH, "is_delivery_timestamp_exception": BOTH,
        },
        "nonnegative": ("merchandise_value", "freight_value", "gross_order_value", "payment_value"),
    },
    "dim_customer": {
        "not_null": ("customer_sk", "customer_unique_id", "customer_version", "valid_from", "is_current", "orders_in_version"),
        "unique": ["customer_sk"],
        "accepted_values": {"is_current": BOTH},
    },
    "fct_order_items": {
        "not_null": ("order_id", "order_item_id", "product_id", "seller_id", "order_purchased_at", "order_status", "is_delivered"),
        "relationships": {"order_id": "fct_orders", "product_id": "dim_product", "seller_id": "dim_seller"},
        "accepted_values": {"is_delivered": BOTH},
        "nonnegative": ("merchandise_value", "freight_value", "item_gross_value"),
    },
    "dim_product": {
        "not_null": ("product_id", "category_translation_status"),
        "unique": ["product_id"],
        "relationships": {"product_id": "stg_products"},
        "accepted_values": {"category_translation_status": TRANSLATION_STATUSES},
    },
    "dim_seller": {
        "not_null": ("seller_id", "seller_city", "seller_state"),
        "unique": ["seller_id"],
        "relationships": {"seller_id": "stg_sellers"},
    },
    "customer_revenue": {
        "not_null": (
            "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix", "delivered_orders",
            "is_repeat_customer", "first_delivered_purchase_at", "last_delivered_purchase_at", "purchase_span_days",
            "gross_merchandise_revenue", "freight_value", "gross_order_value",
        ),
        "unique": ["customer_unique_id"],
        "nonnegative": ("delivered_orders", "purchase_span_days"),
    },
    "category_revenue": {
        "not_null": (
            "category_translation_status", "delivered_item_rows", "distinct_delivered_orders", "gross_merchandise_revenue",
            "freight_value", "gross_order_value",
        ),
        "accepted_values": {"category_translation_status": MART_TRANSLATION_STATUSES},
        "nonnegative": (
            "delivered_item_rows", "distinct_delivered_orders", "gross_merchandise_revenue", "freight_value", "gross_order_value",
        ),
    },
    "monthly_revenue": {
        "not_null": (
            "purchase_month", "delivered_orders", "gross_merchandise_revenue", "freight_value", "gross_order_value",
            "average_gross_order_value",
        ),
        "unique": ["purchase_month"],
        "nonnegative": ("delivered_orders", "gross_merchandise_revenue", "freight_value", "gross_order_value", "average_gross_order_value"),
    },
    "seller_revenue": {
        "not_null": (
            "seller_id", "seller_city", "seller_state", "seller_zip_code_prefix", "delivered_item_rows",
            "distinct_delivered_orders", "gross_merchandise_revenue", "freight_value", "gross_order_value",
        ),
        "unique": ["seller_id"],
        "nonnegative": ("delivered_item_rows", "distinct_delivered_orders"),
    },
}
SCAN_TESTS = ("not_null", "accepted_values", "nonnegative")


def _sql(value: object) -> str:
    """SQL literal of a string, boolean or integer."""
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"


def _as_rows(row: DataFrame, results: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row of counters m0, m1, ... to (table_name, column_name, test_name, failures)."""
    structs = [
        f"named_struct('table_name', {_sql(t)}, 'column_name', {_sql(c)}, 'test_name', {_sql(k)}, 'failures', m{i})"
        for i, (t, c, k) in enumerate(results)
    ]
    return row.selectExpr(f"inline(array({', '.join(structs)}))")


def _scan_checks(spec: Mapping[str, object], tests: Sequence[str]) -> list[tuple[str, str, str]]:
    """(column, test, failing-row condition) for the tests that need no other row."""
    found: list[tuple[str, str, str]] = []
    if "not_null" in tests:
        found += [(c, "not_null", f"{c} is null") for c in spec.get("not_null", ())]
    if "accepted_values" in tests:
        for c, values in spec.get("accepted_values", {}).items():
            found.append((c, "accepted_values", f"{c} not in ({', '.join(map(_sql, values))})"))
    if "nonnegative" in tests:
        found += [(c, "nonnegative", f"{c} < 0") for c in spec.get("nonnegative", ())]
    return found


def scan_tests(df: DataFrame, table: str, spec: Mapping[str, object], tests: Sequence[str]) -> DataFrame | None:
    """All row-level tests of a table in one scan."""
    checks = _scan_checks(spec, tests)
    if not checks:
        return None
    row = df.selectExpr(*[f"count_if({cond}) as m{i}" for i, (_, _, cond) in enumerate(checks)])
    return _as_rows(row, [(table, c, t) for c, t, _ in checks])


def key_tests(
    model: Model, tests: Sequence[str], specs: Mapping[str, Mapping[str, object]] = GENERIC_TESTS
) -> DataFrame | None:
    """All `unique` and `relationships` tests in one shuffle.

    Every tested key of every table is counted per value, next to the other tables' counts of the
    same key. `unique` failures are values counted more than once in a table; `relationships`
    failures are child rows whose value the parent does not have. Counting starts before the
    shuffle, so a value held by many rows costs no more than any other.
    """
    unique = [(t, e) for t, s in specs.items() if "unique" in tests for e in s.get("unique", [])]
    related = [
        (t, c, parent) for t, s in specs.items() if "relationships" in tests
        for c, parent in s.get("relationships", {}).items()
    ]
    members: dict[str, list[str]] = {}
    for table, key in [*unique, *[(t, c) for t, c, _ in related], *[(p, c) for _, c, p in related]]:
        listed = members.setdefault(key, [])
        if table not in listed:
            listed.append(table)
    if not members:
        return None
    domains = list(members)
    per_table: dict[str, list[str]] = {}
    for d, key in enumerate(domains):
        for i, table in enumerate(members[key]):
            per_table.setdefault(table, []).append(
                f"named_struct('domain', {d}, 'value', cast({key} as string), 'member', {i})"
            )
    keys = union_all([model[t].selectExpr(f"inline(array({', '.join(ks)}))") for t, ks in per_table.items()])
    width = max(len(tables) for tables in members.values())
    counted = keys.filter("value is not null").groupBy("domain", "value").agg(
        *[F.expr(f"count_if(member = {i})").alias(f"n{i}") for i in range(width)]
    )

    def rows_of(table: str, key: str) -> str:
        return f"n{members[key].index(table)}"

    measures: list[tuple[str, str, str, str]] = []
    for table, key in unique:
        measures.append((
            table, key, "unique", f"count_if(domain = {domains.index(key)} and {rows_of(table, key)} > 1)"
        ))
    for table, key, parent in related:
        orphans = f"if(domain = {domains.index(key)} and {rows_of(parent, key)} = 0, {rows_of(table, key)}, 0)"
        measures.append((table, key, "relationships", f"coalesce(sum({orphans}), 0)"))
    row = counted.selectExpr(*[f"{m} as m{i}" for i, (*_, m) in enumerate(measures)])
    return _as_rows(row, [(t, k, test) for t, k, test, _ in measures])


def generic_suite(
    model: Model, tests: Sequence[str] = (*SCAN_TESTS, "unique", "relationships"),
    specs: Mapping[str, Mapping[str, object]] = GENERIC_TESTS,
) -> DataFrame:
    """One row per assertion."""
    scanned = [scan_tests(model[table], table, spec, tests) for table, spec in specs.items()]
    results = union_all([df for df in (*scanned, key_tests(model, tests, specs)) if df is not None])
    return results.selectExpr("*", "if(failures = 0, 'PASS', 'FAIL') as status")


# --- singular checks ------------------------------------------------------------------------

ORDER_MEASURES = ("delivered_orders", "gross_merchandise_revenue", "freight_value", "gross_order_value")
ITEM_MEASURES = (
    "delivered_item_rows", "distinct_delivered_orders", "gross_merchandise_revenue", "freight_value",
    "gross_order_value",
)


def category_attribution(m: Model) -> DataFrame:
    columns = [*CATEGORY, "delivered_item_rows", "distinct_delivered_orders"]
    expected = category_totals(m["fct_order_items"], m["dim_product"]).select(*columns)
    return symmetric_diff(expected, m["category_revenue"].select(*columns))


def _metric(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.agg(value.cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")


def _attributions(items: DataFrame, products: DataFrame) -> DataFrame:
    """One row: `orders` and `items` of the delivered items as whole orders, orders by seller and orders by category.

    An item counts in one group of each kind; a group is an order together with a seller or a category. Orders and
    their sellers are counted where the items of an order lie; only categories need the items dealt by product.
    """
    number = F.count("*").alias("n")
    sellers = items.filter("is_delivered").groupBy("order_id", "seller_id").agg(number)
    orders = sellers.groupBy("order_id").agg(F.count("*").alias("sellers"), F.sum("n").alias("n"))
    categories = categorized_items(items, products).groupBy("order_id", *CATEGORY).agg(number)
    row = union_all([
        orders.agg(
            F.count("order_id").alias("order_orders"), F.sum("n").alias("order_items"),
            F.sum("sellers").alias("seller_orders"), F.sum("n").alias("seller_items"),
            *[F.lit(None).cast("bigint").alias(f"category_{c}") for c in ("orders", "items")]),
        categories.agg(
            *[F.lit(None).cast("bigint").alias(f"{k}_{c}") for k in ("order", "seller") for c in ("orders", "items")],
            F.count("*").alias("category_orders"), F.sum("n").alias("category_items")),
    ])
    return row.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in row.columns])


def count_additivity(m: Model) -> DataFrame:
    """(scope, measure, actual, expected): counts of a mart, or of the item fact, that do not add up to their source.

    Orders of a mart by month or customer are the delivered orders. A mart by seller or category has
    every delivered item, and every order once for each of its sellers or categories.
    """
    def value(df: DataFrame, labels: Sequence[tuple[str, str]], column: Column, side: str) -> DataFrame:
        """One number, as the actual or expected one of each (scope, measure)."""
        where = F.array(*[F.struct(F.lit(x).alias("scope"), F.lit(y).alias("measure")) for x, y in labels])
        return df.select(F.inline(where), column.cast("bigint").alias("value")).withColumn("side", F.lit(side))

    sources = m["fct_orders"].filter("is_delivered").agg(F.count("*").alias("n"))
    pairs = _attributions(m["fct_order_items"], m["dim_product"])
    counted = pairs.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("scope"), F.lit(y).alias("measure"), F.col(c).alias("value"), F.lit(side).alias("side"))
        for x, y, c, side in (
            ("items", "orders", "order_orders", "actual"), ("seller", "items", "order_items", "expected"), ("category", "items", "order_items", "expected"),
            ("seller", "orders", "seller_orders", "expected"), ("category", "orders", "category_orders", "expected"))])))
    parts = [value(sources, [(x, "orders") for x in ("monthly", "customer", "items")], F.col("n"), "expected"), counted]
    for scope in ("monthly", "customer"):
        own = m[f"{scope}_revenue"].agg(F.sum("delivered_orders").alias("n"))
        parts.append(value(own, [(scope, "orders")], F.col("n"), "actual"))
    for scope in ("seller", "category"):
        own = m[f"{scope}_revenue"].agg(F.sum("delivered_item_rows").alias("items"), F.sum("distinct_delivered_orders").alias("orders"))
        both = F.array(*[F.struct(F.lit(scope).alias("scope"), F.lit(y).alias("measure"), F.col(y).cast("bigint").alias("value"), F.lit("actual").alias("side")) for y in ("items", "orders")])
        parts.append(own.select(F.inline(both)))

    def side(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("value"))).alias(name)

    return union_all(parts).groupBy("scope", "measure").agg(side("actual"), side("expected")).filter(differs(F.col("actual"), F.col("expected")))


MART_NAMES = ("monthly", "category", "seller", "customer")


def mart_totals(m: Model) -> DataFrame:
    """(mart, merchandise, freight, gross) of the order fact and the four marts."""
    orders = m["fct_orders"].filter("is_delivered").agg(
        F.lit("orders").alias("mart"), total("merchandise_value").alias("merchandise"),
        total("freight_value").alias("freight"), total("gross_order_value").alias("gross"),
    )
    return union_all([orders, *[
        m[f"{mart}_revenue"].agg(
            F.lit(mart).alias("mart"), total("gross_merchandise_revenue").alias("merchandise"),
            total("freight_value").alias("freight"), total("gross_order_value").alias("gross"),
        )
        for mart in MART_NAMES
    ]])


def against_orders(totals: DataFrame) -> DataFrame:
    """Each mart's totals next to the order totals."""
    names = ("merchandise", "freight", "gross")

    def of(mart: str, c: str) -> Column:
        return F.max(F.when(F.col("mart") == mart, F.col(c)))

    wide = totals.agg(*[of(x, c).alias(f"{x}_{c}") for x in ("orders", *MART_NAMES) for c in names])
    rows = [
        F.struct(
            F.lit(x).alias("mart"),
            *[
                col for c in names
                for col in (F.col(f"{x}_{c}").alias(f"actual_{c}"), F.col(f"orders_{c}").alias(f"expected_{c}"))
            ],
        )
        for x in MART_NAMES
    ]
    return wide.select(F.inline(F.array(*rows)))


def financial_parity(m: Model) -> DataFrame:
    wrong = F.lit(False)
    for c in ("merchandise", "freight", "gross"):
        wrong = wrong | differs(F.col(f"actual_{c}"), F.col(f"expected_{c}"))
    return against_orders(mart_totals(m)).filter(wrong)


CONTROL_TOTALS = (
    "dimension_rows", "distinct_customer_sk", "persistent_customers", "current_rows",
    "noninitial_version_rows", "max_customer_version", "represented_orders",
    "customers_with_multiple_versions", "current_row_violations", "invalid_interval_violations",
    "boundary_violations", "order_mapping_violations",
)


def scd2_control_totals(m: Model) -> DataFrame:
    """One row of totals and violation counters."""
    c = F.col
    # The scan over versions carries all columns, so the dimension is read for it alone.
    checked = version_gaps(m["dim_customer"], "customer_unique_id", "customer_version")
    sums = {
        "current_rows": F.when(c("is_current"), 1).otherwise(0),
        "noninitial_version_rows": F.when(c("customer_version") > 1, 1).otherwise(0),
        "represented_orders": c("orders_in_version"),
        "invalid_interval_violations": F.when(c("valid_to") <= c("valid_from"), 1).otherwise(0),
        "boundary_violations": F.when(c("breaks_adjacency"), 1).otherwise(0),
    }
    numbers = [F.lit(1).alias("rows"), c("customer_version").alias("top"), *[v.cast("bigint").alias(n) for n, v in sums.items()]]
    nothing = [F.lit(0).alias("rows"), F.lit(None).cast("bigint").alias("top"), *[F.lit(0).cast("bigint").alias(n) for n in sums]]
    # Each version counts with its customer, and once more with its surrogate key.
    tagged = checked.select(F.inline(F.array(
        F.struct(F.lit("customer").alias("kind"), c("customer_unique_id").alias("id"), *numbers),
        F.struct(F.lit("key").alias("kind"), c("customer_sk").alias("id"), *nothing))))
    grouped = tagged.groupBy("kind", "id").agg(F.sum("rows").alias("rows"), F.max("top").alias("top"), *[F.sum(n).alias(n) for n in sums])
    person, known = c("kind") == "customer", c("id").isNotNull()
    of_dimension = grouped.agg(
        F.sum("rows").alias("dimension_rows"), F.count_if((c("kind") == "key") & known).alias("distinct_customer_sk"),
        F.count_if(person & known).alias("persistent_customers"), F.max("top").alias("max_customer_version"),
        F.count_if(person & (c("rows") > 1)).alias("customers_with_multiple_versions"),
        F.count_if(person & (c("current_rows") != 1)).alias("current_row_violations"), *[F.sum(n).alias(n) for n in sums])
    mapped = match_counts(
        m["orders_enriched"].select("order_id", "customer_unique_id", "order_purchased_at"),
        m["dim_customer"], "customer_unique_id", "order_purchased_at",
    ).groupBy("order_id").agg(F.sum("matches").alias("n")).agg(F.count_if(c("n") != 1).alias("order_mapping_violations"))
    rows = union_all([
        metric_rows(of_dimension, [n for n in CONTROL_TOTALS if n != "order_mapping_violations"]),
        metric_rows(mapped, ["order_mapping_violations"]),
    ])
    return named_values(rows, CONTROL_TOTALS)


def deviates(controls: DataFrame, expected: Mapping[str, object]) -> DataFrame:
    """The control row when it differs from the expected values."""
    wrong = F.lit(False)
    for name, value in expected.items():
        wrong = wrong | differs(F.col(name), F.lit(value))
    return controls.filter(wrong)


PRODUCT_FIELDS = (
    "product_category_name", "product_category_name_english", "category_translation_status",
    "product_name_length", "product_description_length", "product_photos_quantity",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)


def product_recon(m: Model) -> DataFrame:
    source = dim_product(m["stg_products"], m["stg_translation"])
    return field_recon(source, m["dim_product"], ["product_id"], PRODUCT_FIELDS, "unexpected_product")


def seller_recon_fields(m: Model) -> DataFrame:
    source = m["stg_sellers"].select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
    fields = ("seller_zip_code_prefix", "seller_city", "seller_state")
    return field_recon(source, m["dim_seller"], ["seller_id"], fields, "unexpected_seller")


ITEM_FIELDS = (
    "product_id", "seller_id", "order_purchased_at", "order_status", "is_delivered",
    "shipping_limit_at", "merchandise_value", "freight_value", "item_gross_value",
)


#: Lines up to which those of an order are compared with each other, without being dealt by their number.
FEW = 64


def item_recon(m: Model, few: int = FEW) -> DataFrame:
    """Staged and stored items are in buckets of their order and meet there; only orders of many lines are dealt by line."""
    key = ["order_id", "order_item_id"]
    staged, stored = m["stg_order_items"], m["fct_order_items"]
    source = fct_order_items(staged, m["fct_orders"])

    def lies_in_long(df: DataFrame) -> DataFrame:
        """`df` with __long, whether its order has many lines in either table; one lookup per table, as a union would move."""
        for name, t in (("__staged", staged), ("__stored", stored)):
            many = t.groupBy("order_id").agg(F.count("*").alias(name)).filter(F.col(name) > few)
            df = df.join(many, "order_id", "left")
        return df.withColumn("__long", F.col("__staged").isNotNull() | F.col("__stored").isNotNull()).drop("__staged", "__stored")

    sides = [lies_in_long(df) for df in (source, stored)]
    return union_all([
        field_recon(*[df.filter(picked).drop("__long") for df in sides], key, ITEM_FIELDS, "unexpected_item", within)
        for picked, within in ((~F.col("__long"), "order_id"), (F.col("__long"), None))
    ])


def items_grain(m: Model) -> DataFrame:
    grouped = m["fct_order_items"].groupBy("order_id", "order_item_id")
    return grouped.agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")


def scd2_mapping(m: Model) -> DataFrame:
    """Orders whose customer version is wrong, absent or ambiguous."""
    facts = m["fct_orders"].select("order_id", "customer_sk", "customer_unique_id", "order_purchased_at")
    dim = m["dim_customer"].select(
        F.col("customer_sk").alias("d_sk"), F.col("customer_unique_id").alias("d_customer"), "valid_from", "valid_to"
    )
    at = F.col("order_purchased_at")
    wrong = (
        F.col("d_sk").isNull() | differs(F.col("customer_unique_id"), F.col("d_customer"))
        | (at < F.col("valid_from")) | (F.col("valid_to").isNotNull() & (at >= F.col("valid_to")))
    )
    invalid = facts.join(dim, F.col("customer_sk") == F.col("d_sk"), "left").filter(wrong).select("order_id")
    counted = match_counts(
        facts.drop("customer_sk"), m["dim_customer"].filter("customer_sk is not null"), "customer_unique_id", "order_purchased_at"
    )
    ambiguous = counted.groupBy("order_id").agg(F.sum("matches").alias("n")).filter("n <> 1").select("order_id")
    return invalid.unionByName(ambiguous).distinct()


DELIVERED_CONTROLS = (
    "delivered_orders", "merchandise_value", "freight_value", "gross_order_value",
    "delivery_timestamp_exceptions",
)


def delivered_controls(m: Model) -> DataFrame:
    return m["fct_orders"].filter("is_delivered").agg(
        F.count("*").alias("delivered_orders"),
        total("merchandise_value").alias("merchandise_value"),
        total("freight_value").alias("freight_value"),
        total("gross_order_value").alias("gross_order_value"),
        F.count_if("is_delivery_timestamp_exception").alias("delivery_timestamp_exceptions"),
    )


def fact_spine(m: Model) -> DataFrame:
    return spine_check(
        m["orders_enriched"], m["fct_orders"], "order_id", "missing_from_mart", "unexpected_in_mart"
    ).select("order_id")


def category_grain(m: Model) -> DataFrame:
    mart = m["category_revenue"]
    name, english, status = (F.col(c) for c in CATEGORY)
    repeated = mart.groupBy("product_category_name").agg(F.count("*").alias("n")).filter("n > 1")
    invalid = mart.filter(
        ((status == "translated") & (name.isNull() | english.isNull()))
        | ((status == "missing_source_category") & (name.isNotNull() | english.isNotNull()))
        | ((status == "unmatched_translation") & (name.isNull() | english.isNotNull()))
    )
    return union_all([
        repeated.select(F.lit("duplicate_category").alias("violation"), "product_category_name"),
        invalid.select(F.lit("invalid_translation").alias("violation"), "product_category_name"),
    ])


def category_recon(m: Model) -> DataFrame:
    """Per category name, NULL being a name; attributes and measures must agree."""
    expected = category_totals(m["fct_order_items"], m["dim_product"])
    joined = full_outer(expected, m["category_revenue"], ["product_category_name"], null_safe=True)
    absent = F.col("e_category_translation_status").isNull() | F.col("a_category_translation_status").isNull()
    compared = ("product_category_name_english", "category_translation_status", *ITEM_MEASURES)
    return joined.filter(absent | any_differs(compared)).select(
        F.coalesce("e_product_category_name", "a_product_category_name").alias("product_category_name"),
        F.lit("category_reconciliation_mismatch").alias("violation"),
    )


def customer_grain(m: Model) -> DataFrame:
    checks = m["customer_revenue"].groupBy("customer_unique_id").agg(
        F.count("*").alias("row_count"), F.max("delivered_orders").alias("order_count"),
        F.max("first_delivered_purchase_at").alias("first_purchase_at"),
        F.max("last_delivered_purchase_at").alias("last_purchase_at"),
        F.max("purchase_span_days").alias("span_days"),
        F.max("gross_merchandise_revenue").alias("merchandise"),
        F.max("freight_value").alias("freight"), F.max("gross_order_value").alias("gross"),
    )
    return checks.filter(
        F.col("customer_unique_id").isNull() | (F.col("row_count") != 1) | (F.col("order_count") <= 0)
        | (F.col("first_purchase_at") > F.col("last_purchase_at")) | (F.col("span_days") < 0)
        | differs(F.col("gross"), F.col("merchandise") + F.col("freight"))
    )


def customer_expected(orders: DataFrame) -> DataFrame:
    return orders.filter("is_delivered").groupBy("customer_unique_id").agg(
        F.count("*").alias("delivered_orders"),
        F.min("order_purchased_at").alias("first_delivered_purchase_at"),
        F.max("order_purchased_at").alias("last_delivered_purchase_at"),
        total("merchandise_value").alias("gross_merchandise_revenue"),
        total("freight_value").alias("freight_value"),
        total("gross_order_value").alias("gross_order_value"),
    )


def customer_recon(m: Model) -> DataFrame:
    measures = ("first_delivered_purchase_at", "last_delivered_purchase_at", *ORDER_MEASURES)
    broken = mismatched_groups(
        customer_expected(m["fct_orders"]), m["customer_revenue"], ["customer_unique_id"], measures
    )
    return broken.select(
        F.coalesce("e_customer_unique_id", "a_customer_unique_id").alias("customer_unique_id"),
        F.col("e_delivered_orders").alias("expected_orders"), F.col("a_delivered_orders").alias("actual_orders"),
        F.col("e_gross_order_value").alias("expected_gross"), F.col("a_gross_order_value").alias("actual_gross"),
    )


def monthly_recon(m: Model) -> DataFrame:
    measures = (*ORDER_MEASURES, "average_gross_order_value")
    broken = mismatched_groups(
        monthly_revenue(m["fct_orders"]), m["monthly_revenue"], ["purchase_month"], measures
    )
    label = (
        F.when(F.col("e_purchase_month").isNull(), "unexpected_month")
        .when(F.col("a_purchase_month").isNull(), "missing_month").otherwise("metric_mismatch")
    )
    return broken.select(
        F.coalesce("e_purchase_month", "a_purchase_month").alias("purchase_month"), label.alias("violation")
    )


def seller_grain(m: Model) -> DataFrame:
    checks = m["seller_revenue"].groupBy("seller_id").agg(
        F.count("*").alias("row_count"), F.max("delivered_item_rows").alias("item_rows"),
        F.max("distinct_delivered_orders").alias("order_count"),
        F.max("gross_merchandise_revenue").alias("merchandise"),
        F.max("freight_value").alias("freight"), F.max("gross_order_value").alias("gross"),
    )
    return checks.filter(
        F.col("seller_id").isNull() | (F.col("row_count") != 1) | (F.col("item_rows") <= 0)
        | (F.col("order_count") <= 0) | (F.col("order_count") > F.col("item_rows"))
        | differs(F.col("gross"), F.col("merchandise") + F.col("freight"))
    )


def seller_recon(m: Model) -> DataFrame:
    known = m["dim_seller"].select("seller_id")
    expected = seller_totals(m["fct_order_items"]).join(known, "seller_id")
    broken = mismatched_groups(expected, m["seller_revenue"], ["seller_id"], ITEM_MEASURES)
    return broken.select(
        F.coalesce("e_seller_id", "a_seller_id").alias("seller_id"),
        F.col("e_delivered_item_rows").alias("expected_items"), F.col("a_delivered_item_rows").alias("actual_items"),
        F.col("e_gross_order_value").alias("expected_gross"), F.col("a_gross_order_value").alias("actual_gross"),
    )


# Documented untranslated categories and how many product rows each may have.
KNOWN_EXCEPTIONS = {"portateis_cozinha_e_preparadores_de_alimentos": 10, "pc_gamer": 3}
KNOWN_EXCEPTIONS_TOTAL = 13


def known_exceptions(
    m: Model, allowed: Mapping[str, int] = KNOWN_EXCEPTIONS, at_most: int = KNOWN_EXCEPTIONS_TOTAL
) -> DataFrame:
    """Untranslated categories beyond their allowance, and the total beyond its own."""
    name = F.col("product_category_name")
    counts = m["stg_products"].filter(name.isNotNull()).groupBy("product_category_name").agg(
        F.count("*").alias("orphan_rows")
    )
    known = m["stg_translation"].select(F.col("product_category_name").alias("__known"))
    unmatched = counts.join(known, name == F.col("__known"), "left_anti")
    over = ~name.isin(list(allowed))
    for value, limit in allowed.items():
        over = over | ((name == value) & (F.col("orphan_rows") > limit))
    everything = unmatched.agg(F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("orphan_rows")).filter(
        F.col("orphan_rows") > at_most
    )
    return union_all([
        unmatched.filter(over),
        everything.select(F.lit("__TOTAL_ORPHAN_ROWS__").alias("product_category_name"), "orphan_rows"),
    ])


def reconciliation_spine(m: Model) -> DataFrame:
    return spine_check(
        m["orders_enriched"], m["order_reconciliation"], "order_id",
        "missing_from_reconciliation", "unexpected_in_reconciliation",
    )


def enriched_spine(m: Model) -> DataFrame:
    return spine_check(
        m["stg_orders"], m["orders_enriched"], "order_id", "missing_from_enriched", "unexpected_in_enriched"
    )


def reconciliation_consistency(m: Model) -> DataFrame:
    """Rows whose status contradicts their numbers."""
    status, gap = F.col("reconciliation_status"), F.col("payment_item_difference")
    no_items, no_payment = F.col("item_plus_freight").isNull(), F.col("payment_value").isNull()
    cent = F.lit("0.01").cast("decimal(18,2)")
    one_missing = no_items | no_payment
    return m["order_reconciliation"].filter(
        ((status == "missing_items") & ~no_items)
        | ((status == "missing_payment") & (no_items | ~no_payment))
        | ((status == "exact_match") & (one_missing | (gap != 0)))
        | ((status == "within_one_cent") & (one_missing | (gap == 0) | (F.abs(gap) > cent)))
        | ((status == "payment_above_item_plus_freight") & (gap.isNull() | (gap <= cent)))
        | ((status == "payment_below_item_plus_freight") & (gap.isNull() | (gap >= -cent)))
    ).select("order_id", "item_plus_freight", "payment_value", "payment_item_difference", "reconciliation_status")


Check = Callable[[Model], DataFrame]
CHECKS: dict[str, Check] = {
    "chk_category_attribution": category_attribution,
    "chk_count_additivity": count_additivity,
    "chk_financial_parity": financial_parity,
    "chk_dim_product": product_recon,
    "chk_dim_seller": seller_recon_fields,
    "chk_fct_items": item_recon,
    "chk_items_grain": items_grain,
    "chk_scd2_mapping": scd2_mapping,
    "chk_fct_spine": fact_spine,
    "chk_category_grain": category_grain,
    "chk_category_recon": category_recon,
    "chk_customer_grain": customer_grain,
    "chk_customer_recon": customer_recon,
    "chk_monthly_recon": monthly_recon,
    "chk_seller_grain": seller_grain,
    "chk_seller_recon": seller_recon,
    "known_exceptions": known_exceptions,
    "chk_recon_spine": reconciliation_spine,
    "chk_recon_status": reconciliation_consistency,
    "chk_enriched_spine": enriched_spine,
}


def singular_suite(m: Model) -> DataFrame:
    """(check, violations, status) for every singular check."""
    counts = union_all([count_metric(name, check(m)) for name, check in CHECKS.items()])
    status = F.when(F.col("value") == 0, "PASS").otherwise("FAIL")
    return counts.select(F.col("metric").alias("check_name"), F.col("value").alias("violations"), status.alias("status"))
