"""The pipeline as named tables: views compose lazily, tables are written once and read back."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from . import intermediate, marts, staging

STAGING = tuple(f"stg_{e}" for e in staging.STAGES)
INTERMEDIATE = (
    "items_by_order", "payments_by_order", "reviews_by_order", "orders_enriched", "order_reconciliation"
)
MARTS = (
    "dim_customer", "dim_product", "dim_seller", "fct_orders", "fct_order_items",
    "monthly_revenue", "customer_revenue", "category_revenue", "seller_revenue",
)
NODES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    **{f"stg_{e}": (fn, (f"raw_{e}",)) for e, fn in staging.STAGES.items()},
    "items_by_order": (intermediate.items_by_order, ("stg_order_items",)),
    "payments_by_order": (intermediate.payments_by_order, ("stg_payments",)),
    "reviews_by_order": (intermediate.reviews_by_order, ("stg_reviews",)),
    "orders_enriched": (
        intermediate.orders_enriched,
        ("stg_orders", "stg_customers", "items_by_order", "payments_by_order", "reviews_by_order"),
    ),
    "order_reconciliation": (intermediate.order_reconciliation, ("orders_enriched",)),
    "dim_customer": (marts.dim_customer, ("orders_enriched",)),
    "dim_product": (marts.dim_product, ("stg_products", "stg_translation")),
    "dim_seller": (marts.dim_seller, ("stg_sellers",)),
    "fct_orders": (marts.fct_orders, ("orders_enriched", "dim_customer")),
    "fct_order_items": (marts.fct_order_items, ("stg_order_items", "fct_orders")),
    "order_values": (marts.order_values, ("stg_orders", "items_by_order")),
    "monthly_revenue": (marts.monthly_revenue, ("fct_orders",)),
    "customer_revenue": (marts.customer_revenue, ("fct_orders", "dim_customer")),
    "category_revenue": (marts.category_revenue, ("fct_order_items", "dim_product")),
    "seller_revenue": (marts.seller_revenue, ("fct_order_items", "dim_seller")),
}
# Tables with several consumers downstream; everything else is a view.
WRITTEN = frozenset({*STAGING, *INTERMEDIATE, *MARTS} - {"stg_geolocation", "order_reconciliation", "dim_seller"})
# Written tables with one row per key: stored in buckets of the key that later steps join and group by.
BUCKETS = {
    "stg_customers": "customer_id",
    **dict.fromkeys(("stg_orders", "items_by_order", "payments_by_order", "reviews_by_order", "orders_enriched", "fct_orders"), "order_id"),
}
# Written tables with several rows per key, dealt by it: what is asked of an order's items is answered where they lie.
DEALT = dict.fromkeys(("stg_order_items", "fct_order_items"), "order_id")
# Written tables that need only tables of earlier groups; members of a group are independent.
BUILD_GROUPS = (
    tuple(n for n in STAGING if n in WRITTEN),
    ("items_by_order", "payments_by_order", "reviews_by_order", "dim_product"),
    ("orders_enriched",),
    ("dim_customer",),
    ("fct_orders",),
    ("fct_order_items", "monthly_revenue", "customer_revenue"),
    ("category_revenue", "seller_revenue"),
)


class Model:
    """`model["fct_orders"]` builds the table and what it needs, once per model."""

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        write: Callable[..., DataFrame] | None = None,
        written: Collection[str] = WRITTEN,
    ) -> None:
        self._raw = raw
        self._write = write
        self._written = written if write else ()
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name.startswith("raw_"):
                df = self._raw(name.removeprefix("raw_"))
            else:
                build, inputs = NODES[name]
                df = build(*(self[i] for i in inputs))
            self._built[name] = self._write(name, df, BUCKETS.get(name) or DEALT.get(name)) if name in self._written else df
        return self._built[name]

    def build_all(self, parallel: int = 4) -> None:
        """Write every table; independent ones at the same time, so small jobs fill idle cores."""
        with ThreadPoolExecutor(parallel) as pool:
            for group in BUILD_GROUPS:
                list(pool.map(self.__getitem__, group))

    def replace(self, **tables: DataFrame) -> Model:
        """This model with some tables swapped; all others, built or not, stay this model's own."""
        return _Replaced(self, tables)


class _Replaced(Model):
    def __init__(self, base: Model, tables: dict[str, DataFrame]) -> None:
        self._base = base
        self._built = tables

    def __getitem__(self, name: str) -> DataFrame:
        return self._built[name] if name in self._built else self._base[name]
