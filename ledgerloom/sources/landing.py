"""CSV landing: typed Parquet with lineage columns, published all at once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F, types as T

from .store import remove_folder, shared_root, swap_folder

# Tokens that mean "missing" in the source files.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Column types of the RAW entities; dates stay text until staging.
RAW_SCHEMAS: dict[str, str] = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, customer_city string, customer_state string",
    "geolocation": "geolocation_zip_code_prefix bigint, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    "order_items": "order_id string, order_item_id bigint, product_id string, seller_id string, shipping_limit_date string, price decimal(18,2), freight_value decimal(18,2)",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string",
    "payments": "order_id string, payment_sequential bigint, payment_type string, payment_installments bigint, payment_value decimal(18,2)",
    "products": "product_id string, product_category_name string, product_name_lenght double, product_description_lenght double, product_photos_qty double, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double",
    "reviews": "review_id string, order_id string, review_score bigint, review_comment_title string, review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "sellers": "seller_id string, seller_zip_code_prefix bigint, seller_city string, seller_state string",
    "translation": "product_category_name string, product_category_name_english string",
}


def _present(name: str) -> Column:
    return F.when(~F.col(name).isin(*NA_TOKENS), F.col(name))


def with_states(rows: DataFrame, window: WindowSpec, outside: Column, inside: Column) -> DataFrame:
    """Add `before0` and `before1`, the state before each row by what it was before the window's first row."""
    turns = F.when((outside == 1) & (inside == 0), 1).otherwise(0)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.withColumn("__turned", F.sum(turns).over(upto))
    # What a settling row leaves behind, and how often the state was turned until then.
    left = F.when(outside == inside, F.struct(outside.alias("state"), F.col("__turned").alias("turned")))
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    known = counted.withColumn("__left", left).withColumns({
        "__settled": F.last("__left", ignorenulls=True).over(earlier), "__before": F.coalesce(F.lag("__turned").over(window), F.lit(0))})
    fixed = F.col("__settled")
    return known.withColumns({
        f"before{s}": F.when(fixed.isNull(), (F.lit(s) + F.col("__before")) % 2)
        .otherwise((fixed["state"] + F.col("__before") - fixed["turned"]) % 2).cast("int")
        for s in (0, 1)
    }).drop("__turned", "__left", "__settled", "__before")


def _leaves_open(line: Column) -> Column:
    """1 if a value is opened by a quote at its start and not closed, in a line that begins outside of values."""
    return F.regexp_replace(line, '(^|,)"[^"]*"', "$1").rlike('(^|,)"').cast("int")


def _along_blocks(path: Column, block: Column, outside: Column, inside: Column, filled: Column) -> Column:
    """Per line: `before0` and `before1`, the state before it by what it was before its block, and `n0` and `n1`,
    the records begun in the block until then in either case.

    A task reads the lines of a block one after the other, so nothing is moved or sorted, and what is held is a
    batch without its text and the state reached.
    """
    @F.arrow_udf("before0 int, before1 int, n0 bigint, n1 bigint")
    def along(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        import numpy as np
        from pyarrow import compute

        place, state, begun = None, [0, 1], [0, 0]
        for paths, starts, *columns in batches:
            out, back, some = (c.to_numpy(zero_copy_only=False) for c in columns)
            rows = len(paths)
            fresh = np.zeros(rows, bool)
            for c in (paths, starts):
                fresh[1:] |= compute.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            fresh[0] = place != (paths[0].as_py(), starts[0].as_py())
            place = (paths[rows - 1].as_py(), starts[rows - 1].as_py())
            before, begins = np.empty((2, rows), np.int32), np.empty((2, rows), np.int64)
            cuts = sorted({0, rows, *np.flatnonzero(fresh).tolist()})
            for first, end in zip(cuts, cuts[1:]):
                if fresh[first]:
                    state, begun = [0, 1], [0, 0]
                here = slice(first, end)
                settles = out[here] == back[here]
                turns = np.cumsum((out[here] == 1) & ~settles)
                # What a settling line leaves behind counts from then on, turned as often as lines did since.
                at = np.maximum.accumulate(np.where(settles, np.arange(end - first), -1))
                left = out[here][at] + turns - turns[at]
                for s in (0, 1):
                    after = np.where(at >= 0, left, state[s] + turns) % 2
                    before[s, here] = np.concatenate(([state[s]], after[:-1]))
                    begins[s, here] = begun[s] + np.cumsum((before[s, here] == 0) & some[here])
                    state[s], begun[s] = int(after[-1]), int(begins[s, end - 1])
            yield pa.StructArray.from_arrays([pa.array(x) for x in (*before, *begins)], ["before0", "before1", "n0", "n1"])

    return along.asNondeterministic()(path, block, outside, inside, filled)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of CSV files, written down: place, text and what is needed to tell where records begin.

    Files are read in blocks of the usual size. A line is judged for both cases, a quoted value being
    open before its block or not; `n0` and `n1` number the records that begin in the block in either case.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    place = text.metadataColumn("_metadata")
    # Two quotes in a row change nothing: they are one within a value, or a value of their own.
    plain = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    rest = F.substring(plain, F.locate('"', plain) + 1, F.length(plain))
    quoted = F.col("value").contains('"')
    lines = text.select(
        F.col("value"), place["file_path"].alias("path"), place["file_name"].alias("file"), place["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("line"), F.when(quoted, _leaves_open(plain)).otherwise(0).alias("outside"),
        F.when(quoted & plain.contains('"'), _leaves_open(F.concat(F.lit("x"), rest))).otherwise(1).alias("inside"))
    # A blank line between records is none.
    filled = ~F.col("value").isin("", "\r")
    judged = lines.withColumn("along", _along_blocks(*map(F.col, ("path", "block", "outside", "inside")), filled))
    return_to = f"{shared_root(spark)}/lines-{uuid.uuid4().hex}"
    numbered = judged.select(*lines.columns, "along.*")
    numbered.write.parquet(return_to)
    return spark.read.schema(numbered.schema).parquet(return_to)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, number, record): the records of CSV files, numbered from 1 in each file.

    Large files are read by many tasks; only records of several lines are put together by a shuffle.
    A file that ends within a quoted value is an error.
    """
    lines = scan_lines(spark, path)
    after = [F.when(F.col(f"before{s}") == 0, F.col("outside")).otherwise(F.col("inside")) for s in (0, 1)]
    blocks = lines.groupBy("path", "block").agg(
        *[F.max_by(after[s], "line").alias(f"after{s}") for s in (0, 1)], *[F.max(f"n{s}").alias(f"c{s}") for s in (0, 1)])
    along = Window.partitionBy("path").orderBy("block")
    entered = with_states(blocks, along, F.col("after0"), F.col("after1")).withColumnRenamed("before0", "open").drop("before1")
    chosen = F.when(F.col("open") == 0, F.col("c0")).otherwise(F.col("c1"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    last = F.lead("block").over(along).isNull() & (F.when(F.col("open") == 0, F.col("after0")).otherwise(F.col("after1")) == 1)
    placed = entered.select(
        F.col("path").alias("__p"), F.col("block").alias("__b"), "open", F.coalesce(F.sum(chosen).over(earlier), F.lit(0)).alias("first"),
        last.alias("torn")).withColumn("open", F.when(F.col("torn"), F.raise_error(F.concat(F.lit("A quoted value is not closed in "), F.col("__p"))).cast("int")).otherwise(F.col("open")))
    # One row per block of a file: the lines need not move to meet it.
    known = lines.join(F.broadcast(placed), (F.col("path") == F.col("__p")) & (F.col("block") == F.col("__b")))
    inside = F.when(F.col("open") == 0, F.col("before0")).otherwise(F.col("before1"))
    number = F.col("first") + F.when(F.col("open") == 0, F.col("n0")).otherwise(F.col("n1"))
    judged = known.select("path", "file", "block", "line", "value", inside.alias("in"), number.alias("number"), F.when(inside == 0, F.col("outside")).otherwise(F.col("inside")).alias("out"))
    judged = judged.filter((F.col("in") == 1) | ~F.col("value").isin("", "\r"))
    whole = (F.col("in") == 0) & (F.col("out") == 0)
    parts = judged.filter(~whole).groupBy("path", "file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
    joined = parts.select("path", "file", "number", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    records = judged.filter(whole).select("path", "file", "number", F.col("value").alias("record")).unionByName(joined)
    return records.withColumn("record", F.when(F.col("record").contains("\r"), F.regexp_replace("record", "\r$", "")).otherwise(F.col("record")))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read CSV text with quoted newlines, missing-value tokens as NULL, and cast to the schema.

    The header must name exactly the schema's columns. Adds `_source_file` and `_file_row_number`, which
    counts the file's rows from 1 on.
    """
    fields = T.StructType.fromDDL(schema).fields
    text = ", ".join(f"`{f.name}` string" for f in fields)
    record = F.col("record")
    parsed = F.from_csv(F.when(record.startswith("\ufeff"), F.substring(record, 2, F.length(record))).otherwise(record), text, {"escape": '"', "mode": "FAILFAST"})
    rows = csv_records(spark, path).withColumn("row", parsed)
    named = F.lit(True)
    for f in fields:
        named = named & F.col("row")[f.name].eqNullSafe(F.lit(f.name))
    wrong = F.raise_error(F.concat(F.lit("The header does not fit the schema: "), F.col("record"))).cast("boolean")
    body = rows.filter(F.when(F.col("number") > 1, True).when(named, False).otherwise(wrong))
    values = body.select(*[F.col("row")[f.name].alias(f.name) for f in fields], F.col("file").alias("_source_file"), (F.col("number") - 1).alias("_file_row_number"))
    return values.select(*[_present(f.name).cast(f.dataType).alias(f.name) for f in fields], "_source_file", "_file_row_number")


def land(spark: SparkSession, path: str, schema: str, batch_id: str, loaded_at: str) -> DataFrame:
    """Landed rows of one entity with the four lineage columns."""
    rows = read_csv(spark, path, schema)
    columns = [f.name for f in T.StructType.fromDDL(schema).fields]
    return rows.select(
        *columns, "_source_file", "_file_row_number",
        F.lit(loaded_at).cast("timestamp").alias("_loaded_at"), F.lit(batch_id).alias("_batch_id"),
    )


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write CSV part files that `read_csv` reads back unchanged."""
    options = {"maxRecordsPerFile": rows_per_file, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    df.write.options(**options).csv(path, header=True, escape='"', quote='"', emptyValue="")


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], target: str) -> None:
    """Replace `target` with all tables, or leave it as it was.

    Tables are written to a folder beside the target, which is swapped in only after the last one.
    """
    staged = f"{target}.tmp-{uuid.uuid4().hex}"
    try:
        for name, df in tables.items():
            df.write.parquet(f"{staged}/{name}", compression="snappy")
        swap_folder(spark, staged, target)
    except Exception:
        remove_folder(spark, staged)
        raise


def landing_report(spark: SparkSession, folder: str, schemas: Mapping[str, str] = RAW_SCHEMAS) -> DataFrame:
    """(entity, rows, source_columns, output_columns, parquet_bytes) of a published landing."""
    out = None
    for entity, schema in schemas.items():
        table = spark.read.parquet(f"{folder}/{entity}")
        sources = len(T.StructType.fromDDL(schema).fields)
        sizes = table.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
        per_file = sizes.groupBy("f", "s").agg(F.count("*").alias("n"))
        row = per_file.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("s"), F.lit(0)).alias("parquet_bytes")
        ).select(
            F.lit(entity).alias("entity"), "rows", F.lit(sources).cast("bigint").alias("source_columns"),
            F.lit(len(table.columns)).cast("bigint").alias("output_columns"), "parquet_bytes",
        )
        out = row if out is None else out.unionByName(row)
    return out
