"""Ingestion jobs over files that Spark writes from the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from ..operators.compare import union_all
from ..sources import batches, landing, manifest
from ..sources.audit_inputs import PIPELINE, STAGE
from ..sources.audit_log import AuditLog
from ..sources.commerce import BATCH, ENTITIES, LINEAGE, LOADED, driver_table, raw_entities
from ..sources.store import shared_root
from . import audit, governed, ingestion

Query = Callable[[SparkSession, str], DataFrame]
SOURCE_FILES = tuple(f"{e}.csv" for e in ENTITIES)
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@dataclass(frozen=True)
class Landed:
    source: str
    manifest: str
    tables: str


_landed: dict[tuple[str, str], Landed] = {}


def _folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_root(spark)}/{kind}-{uuid.uuid4().hex}"


def export_source(spark: SparkSession, sf_dir: str) -> Landed:
    """Write the nine entities as CSV with a manifest, land and publish them; once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _landed:
        return _landed[key]
    raw = raw_entities(spark, sf_dir)
    root = _folder(spark, "landing")
    found = Landed(f"{root}/source", f"{root}/manifest", f"{root}/tables")
    counts = []
    for entity in ENTITIES:
        body = raw(entity).drop(*LINEAGE)
        # Rows are counted while they are written, so an entity is built once.
        seen = Observation()
        landing.write_csv(body.observe(seen, F.count(F.lit(1)).alias("data_rows")), f"{found.source}/{entity}.csv")
        counts.append((f"{entity}.csv", seen.get["data_rows"], len(body.columns), body.columns))
    files = manifest.dataset_files(spark, found.source)
    listed = spark.createDataFrame(counts, "file_name string, data_rows bigint, column_count int, columns array<string>")
    manifest.write_manifest(listed.join(files, "file_name"), found.manifest)
    tables = {
        e: landing.land(spark, f"{found.source}/{e}.csv", landing.RAW_SCHEMAS[e], BATCH, LOADED) for e in ENTITIES
    }
    landing.publish(spark, tables, found.tables)
    _landed[key] = found
    return found


def _damaged_entries(entries: DataFrame) -> DataFrame:
    """Wrong hash for reviews, wrong size for sellers, geolocation unlisted, refunds invented."""
    name = F.col("file_name")
    changed = entries.filter(name != "geolocation.csv").withColumns({
        "sha256": F.when(name == "reviews.csv", F.sha2(F.col("sha256"), 256)).otherwise(F.col("sha256")),
        "size_bytes": F.when(name == "sellers.csv", F.col("size_bytes") + 1).otherwise(F.col("size_bytes")),
    })
    invented = entries.filter(name == "orders.csv").withColumn("file_name", F.lit("refunds.csv"))
    return changed.unionByName(invented)


def manifest_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = manifest.read_manifest(spark, export_source(spark, sf_dir).manifest)
    name = F.col("file_name")
    again = _damaged_entries(entries).unionByName(entries.filter(name == "orders.csv"))
    broken = again.withColumns({
        "data_rows": F.when(name == "payments.csv", 0).otherwise(F.col("data_rows")),
        "size_bytes": F.when(name == "sellers.csv", -F.col("size_bytes")).otherwise(F.col("size_bytes")),
        "sha256": F.when(name == "products.csv", F.upper("sha256")).otherwise(F.col("sha256")),
    })
    return manifest.manifest_contract(broken, SOURCE_FILES)


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = export_source(spark, sf_dir)
    entries = _damaged_entries(manifest.read_manifest(spark, landed.manifest))
    return manifest.file_inventory(entries, manifest.dataset_files(spark, landed.source))


def file_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = export_source(spark, sf_dir)
    entries = _damaged_entries(manifest.read_manifest(spark, landed.manifest))
    return manifest.file_integrity(entries, manifest.dataset_files(spark, landed.source))


def exact_text(name: str, kind: T.DataType) -> Column:
    """A text that differs for any two different values, and is the same in every engine."""
    col = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # The whole part, then 53 bits of what is left at a time; every step is exact.
        rest, parts = col.cast("double"), []
        for _ in range(3):
            whole = F.floor(rest).cast("decimal(38,0)")
            parts.append(whole.cast("string"))
            rest = (rest - F.floor(rest).cast("double")) * float(1 << 53)
        split = (F.abs(col) < float(1 << 62)) & ((F.abs(col) >= 2.0**-50) | (col == 0))
        return F.when(split, F.concat_ws(":", *parts)).otherwise(F.lower(col.cast("string")))
    return col.cast("string")


def content_hash(df: DataFrame) -> DataFrame:
    """One row (n, s): rows, and the sum of 60 bits of every row's MD5 over all columns.

    A column counts with the length of its text before it, so no value runs into the next one; NULL has none.
    """
    def counted(name: str) -> Column:
        text = exact_text(name, df.schema[name].dataType)
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit("="), text), F.lit("-"))

    number = F.conv(F.substring(F.md5(F.concat(*[counted(c) for c in sorted(df.columns)])), 1, 15), 16, 10)
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(number.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("s"))


def batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch id over content hashes of all columns of the nine entities; lineage is no content."""
    raw = raw_entities(spark, sf_dir)
    entries = []
    for entity in sorted(ENTITIES):
        row = content_hash(raw(entity).drop(*LINEAGE))
        entries.append(row.select(
            F.lit(f"{entity}.csv").alias("file_name"),
            F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.col("s").cast("string")), 256).alias("sha256"),
        ))
    return manifest.deterministic_batch_id(union_all(entries), "commerce_")


def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through CSV: quotes and newlines survive, row numbers follow the file."""
    source = _folder(spark, "documents")
    docs = driver_table(spark, sf_dir)("documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    landing.write_csv(docs, source)
    landed = landing.land(spark, source, DOCUMENTS, BATCH, LOADED)
    # Files hold at most `rows_per_file` rows, so a window over one file is bounded.
    in_file = F.row_number().over(Window.partitionBy("_source_file").orderBy("doc_id"))
    return landed.select(
        "doc_id", "text", "lang", "source", "n_chars", "_batch_id",
        (in_file == F.col("_file_row_number")).alias("row_number_ok"),
    )


def landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = landing.landing_report(spark, export_source(spark, sf_dir).tables)
    return report.select(
        "entity", "rows", "source_columns", "output_columns", (F.col("parquet_bytes") > 0).alias("has_bytes")
    )


def _damaged_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """RAW tables: one absent, one without batch column, one short, one with NULL ids, one with two ids."""
    raw = raw_entities(spark, sf_dir)
    tables = {e: raw(e) for e in ENTITIES if e != "geolocation"}
    batch = F.col("_batch_id")
    tables["order_items"] = tables["order_items"].drop("_batch_id")
    tables["payments"] = tables["payments"].filter("payment_type <> 'voucher'")
    tables["products"] = tables["products"].withColumn(
        "_batch_id", F.when(F.col("product_category_name").isNotNull(), batch)
    )
    tables["reviews"] = tables["reviews"].withColumn(
        "_batch_id", F.when(F.col("review_comment_title") == "error", "batch_0002").otherwise(batch)
    )
    return tables


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_entities(spark, sf_dir)
    profile = ingestion.batch_profile({e: raw(e) for e in ENTITIES})
    return profile.select("entity", F.col("rows").alias("expected_rows"))


def batch_uniformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion.batch_uniformity(_damaged_raw(spark, sf_dir))


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_entities(spark, sf_dir)
    return ingestion.load_reconciliation({e: raw(e) for e in ENTITIES}, _damaged_raw(spark, sf_dir), BATCH)


def raw_batch_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    verified = ingestion.verify_raw_batch(
        spark, _damaged_raw(spark, sf_dir), _expected(spark, sf_dir), BATCH, ENTITIES
    )
    verdict = ingestion.batch_verdict(verified).select(
        F.lit(len(ENTITIES)).alias("position"), F.lit("__verdict__").alias("entity"),
        F.lit(None).cast("bigint").alias("expected_rows"), F.lit(None).cast("bigint").alias("actual_rows"), "reason",
    )
    return verified.unionByName(verdict)


def raw_vs_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion.raw_against_manifest(_damaged_raw(spark, sf_dir), _expected(spark, sf_dir))


REQUIRED_PRODUCTS = (
    "product_id string not null, product_category_name string not null, product_name_lenght bigint, "
    "product_weight_g double not null, product_color string, _batch_id string not null"
)


def schema_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = raw_entities(spark, sf_dir)("products").select(
        "product_id", "product_category_name", "product_name_lenght", "product_weight_g", "product_photos_qty", "_batch_id"
    )
    return ingestion.schema_compatibility(products, REQUIRED_PRODUCTS)


def partitioned_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per purchase year; reading one back touches only its partition."""
    path = batches.batch_path(_folder(spark, "object-store"), "dev", "commerce", "orders")
    orders = raw_entities(spark, sf_dir)("orders").drop("_batch_id")
    year = F.year("order_purchase_timestamp")
    batches.write_partitioned(orders.withColumns({
        "ingest_date": F.make_date(year, F.lit(1), F.lit(1)),
        "batch_id": F.concat(F.lit("batch_"), year.cast("string")),
    }), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("ingest_date", "batch_id").agg(
        F.count("*").alias("rows"), F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    )


def idempotent_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First write, replay in another order, replay without canceled orders; and what is stored afterwards."""
    path = _folder(spark, "protected-batch")
    orders = raw_entities(spark, sf_dir)("orders")
    steps = [
        ("first", batches.write_batch_once(orders, path)),
        ("replay", batches.write_batch_once(orders.repartition("order_status", "order_id"), path)),
        ("changed", batches.write_batch_once(orders.filter("order_status <> 'canceled'"), path)),
    ]
    stored = spark.read.schema(orders.schema).parquet(path).agg(
        F.count("*").alias("rows"), F.count_if(F.col("order_status") == "canceled").alias("canceled"),
        F.min("order_purchase_timestamp").alias("first_purchase"))
    listed = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(o).alias("outcome")) for s, o in steps])
    return stored.select(F.inline(listed), "rows", "canceled", "first_purchase")


def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended in two runs and read back with the ledger's schema."""
    path = _folder(spark, "ledger")
    event = F.col("event_id")
    events = driver_table(spark, sf_dir)("events").select(
        F.col("ts").alias("event_time"), F.col("event_type").alias("operation"),
        F.when(F.col("value") < 50, batches.CREATED).otherwise(batches.IDENTICAL_REPLAY).alias("outcome"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("dataset"),
        F.concat(F.lit("batch_"), event.cast("string")).alias("batch_id"),
        F.col("props").alias("fingerprint"),
    )
    batches.append_events(events.filter("operation = 'purchase'"), path)
    batches.append_events(events.filter("operation <> 'purchase'"), path)
    return batches.read_ledger(spark, path)


def governed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = export_source(spark, sf_dir)
    source = {e: spark.read.parquet(f"{landed.tables}/{e}") for e in ENTITIES}
    log = AuditLog(spark, _folder(spark, "audit"))
    workflow = audit.Workflow(PIPELINE, STAGE, ENTITIES)
    run_id = governed.governed_load(spark, source, _folder(spark, "raw"), log, BATCH, workflow)
    return governed.load_outcome(log, run_id)


def ingest_queries() -> dict[str, Query]:
    return {fn.__name__: fn for fn in (
        manifest_contract, file_inventory, file_integrity, batch_id, csv_landing, landing_report,
        batch_uniformity, load_reconciliation, raw_batch_verify, raw_vs_manifest, schema_compat,
        partitioned_batch, idempotent_batch, event_ledger, governed_load,
    )}
