"""Validation suites: named metrics, zero means pass; profiles, parity and the acceptance gate."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import differs, is_true, rate, require_exact_money, total
from ..operators.compare import (
    aggregate_metrics, any_differs, count_metric, full_outer, metric_rows, mismatched_groups, spine_check, union_all,
)
from ..operators.history import inside, version_gaps
from ..operators.scans import in_order, scan
from .marts import CATEGORY, category_totals, monthly_revenue, seller_totals, surrogate_key
from .model import Model
from .quality import ITEM_MEASURES, ORDER_MEASURES, against_orders, customer_expected, mart_totals


def issues(metrics: DataFrame) -> DataFrame:
    """Metrics that did not pass."""
    return metrics.filter("value <> 0")


def _history_events(dim: DataFrame, orders: DataFrame, facts: DataFrame) -> DataFrame:
    """Starts and ends of versions, orders and facts as rows of one table, to be read in time order.

    `step` opens or closes an interval, `keyed` only one with a surrogate key; `sign` takes the orders
    before a start away and adds those before an end. A version that can contain nothing has a start of no effect.
    """
    c, at = F.col, "timestamp_ntz"
    proper = F.coalesce(
        c("customer_unique_id").isNotNull() & c("valid_from").isNotNull() & (c("valid_to").isNull() | (c("valid_to") > c("valid_from"))), F.lit(False))
    key = c("customer_sk")

    def mark(kind: str, moment: str, counts: Column, sign: int) -> Column:
        step = F.when(counts, -sign).otherwise(0)
        return F.struct(
            F.lit(kind).alias("kind"), c(moment).cast(at).alias("at"), F.lit(0).alias("side"), F.lit(None).cast("string").alias("order_id"), key.alias("customer_sk"),
            step.alias("step"), F.when(key.isNotNull(), step).otherwise(0).alias("keyed"), F.when(proper, sign).otherwise(0).alias("sign"), F.lit(0).alias("point"),
            "valid_from", "valid_to", c("orders_in_version").alias("declared"))

    marks = F.when(proper, F.array(mark("start", "valid_from", proper, -1), mark("end", "valid_to", c("valid_to").isNotNull(), 1))).otherwise(
        F.array(mark("start", "valid_from", proper, -1)))
    versions = dim.select("customer_unique_id", F.inline(marks))

    def points(df: DataFrame, kind: str, sk: Column, point: int) -> DataFrame:
        rest = {n: F.lit(None).cast(versions.schema[n].dataType).alias(n) for n in ("valid_from", "valid_to", "declared")}
        return df.select(
            "customer_unique_id", F.lit(kind).alias("kind"), c("order_purchased_at").cast(at).alias("at"), F.lit(1).alias("side"), "order_id", sk.alias("customer_sk"),
            *[F.lit(0).alias(n) for n in ("step", "keyed", "sign")], F.lit(point).alias("point"), *rest.values())

    return versions.unionByName(points(orders, "order", F.lit(None).cast("string"), 1)).unionByName(points(facts, "fact", key, 0))


def scd2_suite(m: Model) -> DataFrame:
    """Interval, version, surrogate-key and assignment metrics of the customer history.

    Versions, orders and facts go through one ordered scan; everything else is read from what it has written.
    """
    c = F.col
    missing = F.lit(False)
    for name in ("customer_unique_id", "customer_sk", "customer_version", "valid_from", "is_current"):
        missing = missing | c(name).isNull()
    expected_sk = surrogate_key(c("customer_unique_id"), c("customer_version"))
    of_dimension = aggregate_metrics(version_gaps(m["dim_customer"], "customer_unique_id", "customer_version"), {
        "null_required_fields": F.count_if(missing),
        "duplicate_surrogate_keys": F.count("*") - F.count_distinct("customer_sk"),
        "nonpositive_versions": F.count_if(c("customer_version") < 1),
        "invalid_intervals": F.count_if(c("valid_to") <= c("valid_from")),
        "current_flag_mismatches": F.count_if(differs(c("is_current"), c("valid_to").isNull())),
        "surrogate_key_mismatches": F.count_if(differs(c("customer_sk"), expected_sk)),
        "nonsequential_versions": F.count_if(c("customer_version") != c("expected_version")),
        "interval_adjacency_mismatches": F.count_if(c("breaks_adjacency")),
    }, "dimension.")
    ordered = in_order(_history_events(m["dim_customer"], m["orders_enriched"], m["fct_orders"]), "customer_unique_id", ["at", "side"])
    placed = c("customer_unique_id").isNotNull() & c("at").isNotNull()
    # Intervals around each point, and orders before each start or end.
    value = (
        F.when(c("kind") == "order", F.when(placed, c("open_keyed")).otherwise(0))
        .when(c("kind") == "fact", F.when(placed, c("open")).otherwise(0)).otherwise(c("sign") * c("orders"))
    )
    counted = scan(ordered, running={"open": c("step"), "open_keyed": c("keyed"), "orders": F.when(placed, c("point")).otherwise(0)})
    about = F.when(c("kind").isin("start", "end"), "version").otherwise(c("kind"))
    ident = F.when(about == "version", c("customer_sk")).when(about == "order", c("order_id"))
    per_value = counted.groupBy(about.alias("about"), ident.alias("ident"), "declared").agg(
        F.sum(value).alias("n"), F.count_if(c("kind") == "start").alias("versions"))
    # Versions of one key can declare different numbers: each number comes with how many versions declare it.
    per_ident = per_value.groupBy("about", "ident").agg(
        F.sum("n").alias("n"), F.collect_list(F.when(c("versions") > 0, F.struct("declared", "versions"))).alias("declared"))
    uses = F.when(c("ident").isNotNull(), c("n")).otherwise(0)
    wrong = F.aggregate("declared", F.lit(0).cast("bigint"), lambda sum_, d: sum_ + F.when(d["declared"].eqNullSafe(uses), 0).otherwise(d["versions"]))
    of_scan = per_ident.agg(
        F.sum(F.when(c("about") == "version", wrong).otherwise(0)).alias("version_order_count_mismatches"),
        F.count_if((c("about") == "order") & (c("n") != 1)).alias("missing_or_multiple_historical_matches"),
        F.sum(F.when(c("about") == "fact", c("n")).otherwise(0)).alias("valid"))
    # A fact joined to every version valid at its time, less those that carry its own key.
    versions = ordered.rows.filter("kind = 'start'").select(
        c("customer_sk").alias("d_sk"), c("customer_unique_id").alias("d_id"), c("valid_from").alias("d_from"), c("valid_to").alias("d_to"))
    own = ordered.rows.filter("kind = 'fact'").join(versions, c("customer_sk") == c("d_sk"), "left")
    of_facts = own.agg(
        F.count_if((c("customer_unique_id") == c("d_id")) & inside(c("at"), c("d_from"), c("d_to"))).alias("right"),
        F.count_if(c("d_sk").isNull()).alias("customer_sk_missing_dimension"))

    def named(row: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("metric"), v.cast("bigint").alias("value")) for n, v in values.items()])))

    # Each row of totals is computed once; a metric with two parts is their sum.
    parts = [
        named(of_scan, {
            "dimension.version_order_count_mismatches": F.coalesce("version_order_count_mismatches", F.lit(0)),
            "fact.missing_or_multiple_historical_matches": c("missing_or_multiple_historical_matches"),
            "fact.incorrect_customer_sk": F.coalesce("valid", F.lit(0))}),
        named(of_facts, {"fact.incorrect_customer_sk": -c("right"), "fact.customer_sk_missing_dimension": c("customer_sk_missing_dimension")}),
    ]
    return of_dimension.unionByName(union_all(parts).groupBy("metric").agg(F.sum("value").alias("value")))


def marts_suite(m: Model) -> DataFrame:
    """Grain, coverage and rollup metrics of items, dimensions and revenue marts."""
    c = F.col
    key = ["order_id", "order_item_id"]
    staged = m["stg_order_items"].select(*key, F.lit(1).alias("s"), F.lit(0).alias("f"))
    stored = m["fct_order_items"].select(*key, F.lit(0).alias("s"), F.lit(1).alias("f"))
    per_key = staged.unionByName(stored).groupBy(*key).agg(F.sum("s").alias("s"), F.sum("f").alias("f"))
    alone = c("order_id").isNull() | c("order_item_id").isNull()
    of_items = aggregate_metrics(per_key, {
        "duplicate_keys": F.sum(F.greatest(c("f") - 1, F.lit(0))),
        "missing_from_staging": F.sum(F.when(alone | (c("f") == 0), c("s")).otherwise(0)),
        "unexpected_in_fact": F.sum(F.when(alone | (c("s") == 0), c("f")).otherwise(0)),
    }, "order_items.")
    source = m["stg_order_items"].select(
        *key, "product_id", "seller_id", c("price").alias("merchandise_value"), "freight_value",
        (c("price") + c("freight_value")).alias("item_gross_value"),
    )
    parents = m["fct_orders"].select("order_id", c("is_delivered").alias("p_delivered"))
    unequal = any_differs(("product_id", "seller_id", "merchandise_value", "freight_value", "item_gross_value"))
    # Fields are compared before their order is looked up, so that only the outcome goes there.
    both = full_outer(source, m["fct_order_items"], key).filter("in_e and in_a").select(
        "a_order_id", "a_is_delivered", unequal.alias("unequal")
    ).join(parents, c("a_order_id") == c("order_id"))
    broken = c("unequal") | differs(c("a_is_delivered"), c("p_delivered"))
    of_fields = aggregate_metrics(both, {"field_mismatches": F.count_if(broken)}, "order_items.")

    def dimension(table: str, staging: str, ident: str, prefix: str) -> list[DataFrame]:
        repeated = F.count("*") - F.count_distinct(ident)
        off = spine_check(m[staging], m[table], ident, "missing", "unexpected")
        return [
            aggregate_metrics(m[table], {"duplicate_keys": repeated}, f"{prefix}."),
            count_metric(f"{prefix}.missing_or_unexpected_keys", off),
        ]

    dim = m["dim_customer"]
    versions = F.count("*") - F.count_distinct(F.struct("customer_unique_id", "customer_version"))
    current = dim.groupBy("customer_unique_id").agg(F.count_if(is_true("is_current")).alias("n"))
    ids = spine_check(m["orders_enriched"], dim, "customer_unique_id", "missing", "unexpected")
    of_customers = [
        aggregate_metrics(dim, {"duplicate_versions": versions}, "customer_dimension."),
        count_metric("customer_dimension.current_version_exceptions", current.filter("n <> 1")),
        count_metric("customer_dimension.missing_unique_ids", ids.filter("issue = 'missing'")),
    ]
    groups = {
        "customer_revenue": mismatched_groups(
            customer_expected(m["fct_orders"]), m["customer_revenue"], ["customer_unique_id"], ORDER_MEASURES),
        "seller_revenue": mismatched_groups(
            seller_totals(m["fct_order_items"]), m["seller_revenue"], ["seller_id"], ITEM_MEASURES),
        "category_revenue": mismatched_groups(
            category_totals(m["fct_order_items"], m["dim_product"]), m["category_revenue"], CATEGORY,
            ITEM_MEASURES, null_safe=True),
    }
    return union_all([
        of_items, of_fields,
        *dimension("dim_product", "stg_products", "product_id", "product_dimension"),
        *dimension("dim_seller", "stg_sellers", "seller_id", "seller_dimension"),
        *of_customers,
        *[count_metric(f"{n}.mismatched_groups", df) for n, df in groups.items()],
    ])


ORDER_LAYERS = ("raw_orders", "stg_orders", "orders_enriched", "order_reconciliation", "fct_orders")


def lineage_suite(m: Model) -> DataFrame:
    """Key survival across five layers, field equality into the fact, and the monthly mart.

    Every layer is counted per order id where its rows lie, then all layers; all key metrics read that result.
    """
    c = F.col
    tagged = [
        m[layer].groupBy("order_id").agg(F.count("*").alias("n")).select(
            "order_id", *[(c("n") if i == j else F.lit(0).cast("bigint")).alias(f"n{j}") for j in range(len(ORDER_LAYERS))])
        for i, layer in enumerate(ORDER_LAYERS)
    ]
    counts = [f"n{j}" for j in range(len(ORDER_LAYERS))]
    per_id = union_all(tagged).groupBy("order_id").agg(*[F.sum(n).alias(n) for n in counts])
    unknown = c("order_id").isNull()
    metrics: dict[str, Column] = {}

    def total_of(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    for j, layer in enumerate(ORDER_LAYERS):
        n = c(f"n{j}")
        metrics[f"{layer}.null_keys"] = total_of(F.when(unknown, n).otherwise(0))
        metrics[f"{layer}.duplicate_keys"] = total_of(
            F.when(unknown, n).otherwise(F.greatest(n - 1, F.lit(0)))
        )
    for (i, left), (j, right) in pairwise(enumerate(ORDER_LAYERS)):
        a, b = c(f"n{i}"), c(f"n{j}")
        metrics[f"{left}->{right}.missing"] = total_of(F.when(unknown | (b == 0), a).otherwise(0))
        metrics[f"{right}->{left}.unexpected"] = total_of(F.when(unknown | (a == 0), b).otherwise(0))
    keys = aggregate_metrics(per_id, metrics)

    fact = m["fct_orders"]
    renamed = m["orders_enriched"].select(
        "order_id", "order_status", "customer_id", c("item_revenue").alias("merchandise_value"),
        c("freight_revenue").alias("freight_value"), c("item_plus_freight").alias("gross_order_value"),
        "payment_value",
    )
    money = ("order_status", "customer_id", "merchandise_value", "freight_value", "gross_order_value", "payment_value")
    outcome = ("reconciliation_status", "payment_item_difference")
    recon = m["order_reconciliation"].select("order_id", *outcome)

    def mismatch(name: str, source: DataFrame, fields: tuple[str, ...]) -> DataFrame:
        joined = full_outer(source, fact.select("order_id", *fields), ["order_id"]).filter("in_e and in_a")
        broken = F.lit(False)
        for f in fields:
            broken = broken | differs(c(f"e_{f}"), c(f"a_{f}"))
        return count_metric(name, joined.filter(broken))

    months = mismatched_groups(monthly_revenue(fact), m["monthly_revenue"], ["purchase_month"], ORDER_MEASURES)
    return union_all([
        keys,
        mismatch("enriched_to_fact.order_status_mismatch", renamed, money),
        mismatch("reconciliation_to_fact.status_mismatch", recon, outcome),
        count_metric("monthly_mart.mismatched_months", months),
    ])


def order_profile(facts: DataFrame) -> DataFrame:
    """Fifteen measures of the order fact in one pass."""
    c = F.col
    require_exact_money(facts, "merchandise_value", "freight_value", "gross_order_value", "payment_value")
    delivered = is_true("is_delivered")
    unpaid = c("payment_value").isNull()
    no_counts = c("payment_record_count").isNull() & c("payment_type_count").isNull()
    flagged = c("reconciliation_status") == "missing_payment"
    no_money = c("merchandise_value").isNull() | c("freight_value").isNull() | c("gross_order_value").isNull()

    def delivered_sum(name: str) -> Column:
        return total(F.when(delivered, c(name)))

    return facts.agg(
        F.count("*").alias("total_orders"),
        F.count_distinct("order_id").alias("distinct_order_ids"),
        F.count_if(c("order_id").isNull()).alias("null_order_ids"),
        F.count_if(delivered).alias("delivered_orders"),
        F.count_if(~delivered).alias("non_delivered_orders"),
        F.count_if(delivered & no_money).alias("delivered_null_money"),
        F.count_if(
            delivered & unpaid & (differs(c("reconciliation_status"), F.lit("missing_payment")) | ~no_counts)
        ).alias("unclassified_missing_payments"),
        F.count_if(delivered & flagged & (~unpaid | ~no_counts)).alias("inconsistent_missing_payment_status"),
        F.count_if(delivered & unpaid & flagged & no_counts).alias("classified_missing_payments"),
        F.count_if(
            delivered & (c("merchandise_value") + c("freight_value") != c("gross_order_value"))
        ).alias("delivered_row_mismatches"),
        delivered_sum("merchandise_value").alias("merchandise"),
        delivered_sum("freight_value").alias("freight"),
        delivered_sum("gross_order_value").alias("gross"),
        delivered_sum("payment_value").alias("payment"),
        F.count_if(delivered & is_true("is_delivery_timestamp_exception")).alias("delivery_timestamp_exceptions"),
    )


def assess_profile(profile: DataFrame, documented: Mapping[str, int | Decimal] | None = None) -> DataFrame:
    """(rule, passed) for an order profile; documented controls are compared only when given."""
    c = F.col
    rules: dict[str, Column] = {
        "mart_not_empty": c("total_orders") > 0,
        "order_grain_unique": c("total_orders") == c("distinct_order_ids"),
        "order_ids_present": c("null_order_ids") == 0,
        "status_partition_complete": c("delivered_orders") + c("non_delivered_orders") == c("total_orders"),
        "delivered_money_present": c("delivered_null_money") == 0,
        "missing_payments_classified": c("unclassified_missing_payments") == 0,
        "missing_payment_status_consistent": c("inconsistent_missing_payment_status") == 0,
        "delivered_rows_balance": c("delivered_row_mismatches") == 0,
        "delivered_totals_balance": c("merchandise") + c("freight") == c("gross"),
    }
    for name, value in (documented or {}).items():
        rules[f"documented_{name}"] = c(name) == F.lit(value)
    rows = [F.struct(F.lit(n).alias("rule"), F.coalesce(r, F.lit(False)).alias("passed")) for n, r in rules.items()]
    return profile.select(F.inline(F.array(*rows)))


def mart_parity(m: Model) -> DataFrame:
    """(mart, metric, expected, observed, matches); a missing total counts as zero."""
    zero = F.lit(0).cast("decimal(38,2)")
    names = {"merchandise": "gross_merchandise_revenue", "freight": "freight_value", "gross": "gross_order_value"}
    compared = against_orders(mart_totals(m))
    rows = [
        F.struct(
            F.col("mart"), F.lit(label).alias("metric"),
            F.coalesce(f"expected_{n}", zero).alias("expected"), F.coalesce(f"actual_{n}", zero).alias("observed"),
        )
        for n, label in names.items()
    ]
    marts = compared.select(F.inline(F.array(*rows)))
    own = m["fct_orders"].agg(
        total(F.when(is_true("is_delivered"), F.col("merchandise_value") )).alias("mv"),
        total(F.when(is_true("is_delivered"), F.col("freight_value"))).alias("fv"),
        total(F.when(is_true("is_delivered"), F.col("gross_order_value"))).alias("gv"),
        (F.count("*") - F.count_distinct("order_id")).cast("decimal(38,2)").alias("repeated"),
    )
    balance = (F.coalesce("mv", zero) + F.coalesce("fv", zero)).cast("decimal(38,2)")
    of_orders = own.select(F.inline(F.array(
        F.struct(F.lit("orders").alias("mart"), F.lit("arithmetic").alias("metric"),
                 F.coalesce("gv", zero).alias("expected"), balance.alias("observed")),
        F.struct(F.lit("orders").alias("mart"), F.lit("order_id_uniqueness").alias("metric"),
                 zero.alias("expected"), F.col("repeated").alias("observed")),
    )))
    return marts.unionByName(of_orders).withColumn("matches", F.col("expected") == F.col("observed"))


def revenue_summary(facts: DataFrame) -> DataFrame:
    """(section, item, value): totals, orders per status, exceptions and guard violations."""
    require_exact_money(facts, "merchandise_value", "freight_value", "gross_order_value")
    delivered = is_true("is_delivered")
    zero = F.lit(0).cast("decimal(38,2)")

    def amount(name: str) -> Column:
        return F.coalesce(total(F.when(delivered, F.col(name))), zero)

    row = facts.agg(
        F.count("*").alias("total_orders"),
        F.count_if(delivered).alias("delivered_orders"),
        F.count_if(delivered & is_true("is_delivery_timestamp_exception")).alias("delivery_timestamp_exceptions"),
        amount("merchandise_value").alias("merchandise_value"),
        amount("freight_value").alias("freight_value"),
        amount("gross_order_value").alias("gross_order_value"),
        (F.count("*") - F.count_distinct(F.struct("order_id"))).alias("duplicate_order_ids"),
    )
    unbalanced = F.col("merchandise_value") + F.col("freight_value") - F.col("gross_order_value")
    pairs = [
        ("orders", "total_orders", F.col("total_orders")),
        ("orders", "delivered_orders", F.col("delivered_orders")),
        ("orders", "delivery_timestamp_exceptions", F.col("delivery_timestamp_exceptions")),
        ("totals", "merchandise_value", F.col("merchandise_value")),
        ("totals", "freight_value", F.col("freight_value")),
        ("totals", "gross_order_value", F.col("gross_order_value")),
        ("guards", "duplicate_order_ids", F.col("duplicate_order_ids")),
        ("guards", "unbalanced_amount", unbalanced),
    ]
    summary = row.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("item"), v.cast("decimal(38,2)").alias("value"))
        for s, i, v in pairs
    ])))
    statuses = facts.groupBy("reconciliation_status").agg(F.count("*").cast("decimal(38,2)").alias("value"))
    return summary.unionByName(statuses.select(
        F.lit("status_counts").alias("section"), F.col("reconciliation_status").alias("item"), "value"
    ))


def payment_tolerance(facts: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Delivered payments against gross, with the relative difference."""
    sums = facts.filter("is_delivered").agg(
        total("gross_order_value").alias("gross"), total("payment_value").alias("payments")
    )
    gap = (F.col("payments") - F.col("gross")).cast("decimal(38,2)")
    relative = rate(F.abs(gap), F.col("gross"), 8)
    return sums.select(
        "gross", "payments", gap.alias("difference"), relative.alias("relative_difference"),
        F.coalesce(relative <= tolerance, F.lit(False)).alias("within_tolerance"),
    )


# Areas of the gate that this batch does not verify.
NOT_VERIFIED = (
    "audit_integrity", "owner_approval", "cloud_enforcement", "deletion_replay_prevention",
    "payment_settlement", "net_revenue", "live_alerting", "scheduled_recovery",
)


def acceptance_gate(parity: DataFrame) -> DataFrame:
    """(area, status) from the parity rows, and the overall outcome."""
    failed = parity.agg(F.count_if(~F.coalesce("matches", F.lit(False))).alias("failed"))
    verdict = F.when(F.col("failed") == 0, "PASS").otherwise("FAIL")
    overall = F.when(F.col("failed") == 0, "PASS_WITH_LIMITATIONS").otherwise("FAIL")
    rows = [("delivered_gross_value", verdict), ("cross_mart_parity", verdict)]
    rows += [(area, F.lit("NOT_VERIFIED")) for area in NOT_VERIFIED]
    rows.append(("overall", overall))
    return failed.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("area"), s.alias("status")) for a, s in rows
    ])))
