"""RAW batch checks: uniform batches, load reconciliation, verification, schema compatibility."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.compare import union_all
from ..sources.commerce import LINEAGE

VERIFIED = "RAW_BATCH_VERIFIED"


def batch_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per entity: rows, populated batch ids, distinct ids, smallest id, NULL lineage rows."""
    out = []
    for name, df in tables.items():
        absent = [c for c in LINEAGE if c not in df.columns]
        batch = F.col("_batch_id") if "_batch_id" in df.columns else F.lit(None).cast("string")
        gap = F.lit(bool(absent))
        for c in LINEAGE:
            if c in df.columns:
                gap = gap | F.col(c).isNull()
        out.append(df.agg(
            F.lit(name).alias("entity"),
            F.count("*").alias("rows"), F.count(batch).alias("populated"),
            F.count_distinct(batch).alias("distinct_batches"), F.min(batch).alias("batch_id"),
            F.count_if(gap).alias("null_lineage"),
            F.lit(",".join(absent)).alias("missing_columns"),
        ))
    return union_all(out)


def batch_uniformity(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(entity, rows, distinct_batches, problem) and one row for the batch over all entities."""
    profile = batch_profile(tables)
    problem = (
        F.when(F.col("missing_columns") != "", "missing_lineage_columns")
        .when(F.col("rows") == 0, "empty")
        .when(F.col("populated") < F.col("rows"), "null_batch_id")
        .when(F.col("distinct_batches") != 1, "several_batch_ids")
        .when(F.trim("batch_id") == "", "blank_batch_id")
    )
    each = profile.select("entity", "rows", "distinct_batches", problem.alias("problem"))
    common = profile.agg(
        F.lit("__all__").alias("entity"), F.sum("rows").alias("rows"),
        F.count_distinct("batch_id").alias("distinct_batches"),
    ).withColumn("problem", F.when(F.col("distinct_batches") != 1, "several_batch_ids"))
    return each.unionByName(common)


def load_reconciliation(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], batch_id: str
) -> DataFrame:
    """(entity, source_rows, target_rows, difference, batch_ok, status) per loaded table."""
    before = batch_profile(source).select("entity", F.col("rows").alias("source_rows"))
    after = batch_profile(target).select(
        "entity", F.col("rows").alias("target_rows"), "populated", "distinct_batches", "batch_id"
    )
    counted = F.coalesce("target_rows", F.lit(0))
    batch_ok = F.coalesce(
        (F.col("populated") == F.col("target_rows")) & (F.col("distinct_batches") == 1)
        & (F.col("batch_id") == batch_id), F.lit(False)
    )
    joined = before.join(after, "entity", "left").select(
        "entity", "source_rows", counted.alias("target_rows"),
        (counted - F.col("source_rows")).alias("difference_rows"), batch_ok.alias("batch_ok"),
    )
    passed = (F.col("difference_rows") == 0) & F.col("batch_ok")
    return joined.withColumn("status", F.when(passed, "PASS").otherwise("FAIL"))


def verify_raw_batch(
    spark: SparkSession, tables: Mapping[str, DataFrame], expected_rows: DataFrame, batch_id: str,
    order: Sequence[str],
) -> DataFrame:
    """(position, entity, expected_rows, actual_rows, reason); NULL reason means the table passed.

    `expected_rows` is (entity, expected_rows); checks apply in a fixed order per table.
    """
    if not batch_id.strip():
        raise ValueError("batch_id is blank")
    positions = spark.createDataFrame(list(enumerate(order)), "position int, entity string")
    present = {n: df for n, df in tables.items() if n in order}
    profile = batch_profile(present).withColumnRenamed("rows", "actual_rows")
    no_column = F.array_contains(F.split("missing_columns", ","), "_batch_id")
    reason = (
        F.when(F.col("actual_rows").isNull(), "TABLE_MISSING")
        .when(no_column, "BATCH_COLUMN_MISSING")
        .when(~F.col("actual_rows").eqNullSafe(F.col("expected_rows")), "ROW_COUNT_MISMATCH")
        .when(F.col("actual_rows") == 0, F.lit(None))
        .when(F.col("populated") != F.col("actual_rows"), "NULL_BATCH_ID")
        .when((F.col("distinct_batches") != 1) | (F.col("batch_id") != batch_id), "BATCH_MISMATCH")
    )
    joined = positions.join(expected_rows, "entity", "left").join(profile, "entity", "left")
    return joined.select("position", "entity", "expected_rows", "actual_rows", reason.alias("reason"))


def batch_verdict(verified: DataFrame) -> DataFrame:
    """One row (verified, reason): the first failing table in table order decides."""
    failing = F.when(F.col("reason").isNotNull(), F.col("position"))
    first = F.min_by(F.concat_ws(":", "reason", "entity"), failing)
    return verified.agg(first.alias("first"), F.count(failing).alias("failures")).select(
        (F.col("failures") == 0).alias("verified"),
        F.when(F.col("failures") == 0, VERIFIED).otherwise(F.col("first")).alias("reason"),
    )


def raw_against_manifest(tables: Mapping[str, DataFrame], expected_rows: DataFrame) -> DataFrame:
    """Counts, lineage and batch per table next to the manifest, with the list of issues."""
    profile = batch_profile(tables).withColumnRenamed("rows", "actual_rows")
    one_batch = (F.col("distinct_batches") == 1) & F.col("batch_id").isNotNull()
    checks: list[tuple[str, Column]] = [
        ("row_count_differs", ~F.col("actual_rows").eqNullSafe(F.col("expected_rows"))),
        ("null_lineage", F.col("null_lineage") > 0),
        ("not_one_batch", ~one_batch),
    ]
    issues = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in checks])
    joined = profile.join(expected_rows, "entity", "left")
    each = joined.select(
        "entity", "expected_rows", "actual_rows", "null_lineage", "distinct_batches", "batch_id",
        issues.alias("issues"),
    )
    batches = F.count_distinct(F.when(one_batch, F.col("batch_id")))
    common = profile.agg(batches.alias("distinct_batches")).select(
        F.lit("__all__").alias("entity"), F.lit(None).cast("bigint").alias("expected_rows"),
        F.lit(None).cast("bigint").alias("actual_rows"), F.lit(None).cast("bigint").alias("null_lineage"),
        "distinct_batches", F.lit(None).cast("string").alias("batch_id"),
        F.when(F.col("distinct_batches") > 1, "different_batches").otherwise("").alias("issues"),
    )
    return each.unionByName(common)


def schema_compatibility(df: DataFrame, required: str) -> DataFrame:
    """(column_name, expected_type, actual_type, null_rows, issue) against a required schema.

    NOT NULL is compared with the data, in one scan: stored files do not enforce it.
    """
    wanted = {f.name: f for f in T.StructType.fromDDL(required).fields}
    actual = {f.name: f for f in df.schema.fields}
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in actual])
    rows = []
    for name in dict.fromkeys([*wanted, *actual]):
        w, a = wanted.get(name), actual.get(name)
        empty = F.col(f"`{name}`") if a else F.lit(None).cast("bigint")
        wanted_type = w.dataType.simpleString() if w else None
        actual_type = a.dataType.simpleString() if a else None
        if a is None:
            issue = F.lit("missing_column")
        elif w is None:
            issue = F.lit("unexpected_column")
        elif wanted_type != actual_type:
            issue = F.lit("type_differs")
        elif not w.nullable:
            issue = F.when(empty > 0, "nulls_in_required_column")
        else:
            issue = F.lit(None).cast("string")
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(wanted_type).cast("string").alias("expected_type"),
            F.lit(actual_type).cast("string").alias("actual_type"), empty.alias("null_rows"), issue.cast("string").alias("issue"),
        ))
    return nulls.select(F.inline(F.array(*rows)))
