"""Source manifests: what files should be there, and whether they are."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING, BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

if TYPE_CHECKING:
    import pyarrow as pa

#: Read at a time while a file is hashed.
BLOCK_BYTES = 4 << 20

MANIFEST_SCHEMA = (
    "manifest_version int, files array<struct<file_name: string, size_bytes: bigint, sha256: string, "
    "data_rows: bigint, column_count: int, columns: array<string>>>"
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file the manifest lists."""
    return spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=True).select(F.inline("files"))


def write_manifest(entries: DataFrame, path: str, version: int = 1) -> None:
    """One JSON document; entries are one per dataset, so the list is short."""
    fields = ("file_name", "size_bytes", "sha256", "data_rows", "column_count", "columns")
    listed = entries.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("files"))
    listed.select(F.lit(version).alias("manifest_version"), "files").coalesce(1).write.json(path)


def manifest_contract(entries: DataFrame, expected_files: Sequence[str]) -> DataFrame:
    """(file_name, issue) for every broken rule of the manifest itself."""
    name = F.col("file_name")
    per_name = entries.groupBy("file_name").agg(
        F.count("*").alias("n"),
        F.count_if(~F.coalesce(F.col("data_rows") > 0, F.lit(False))).alias("rows"),
        F.count_if(~F.coalesce(F.col("size_bytes") > 0, F.lit(False))).alias("size"),
        F.count_if(~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))).alias("sha"),
    )
    spark = entries.sparkSession
    wanted = spark.createDataFrame([(f,) for f in expected_files], "wanted string")
    joined = per_name.join(wanted, name == F.col("wanted"), "full_outer")
    problems: list[tuple[str, Column]] = [
        ("missing_file", name.isNull()),
        ("unexpected_file", F.col("wanted").isNull()),
        ("duplicate_file", F.col("n") > 1),
        ("invalid_data_rows", F.col("rows") > 0),
        ("invalid_size_bytes", F.col("size") > 0),
        ("invalid_sha256", F.col("sha") > 0),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(p)) for p, c in problems]), lambda x: x.isNotNull())
    return joined.select(F.coalesce(name, "wanted").alias("file_name"), F.explode(found).alias("issue"))


def hashed_files(files: DataFrame, opened: Callable[[str], BinaryIO] | None = None) -> DataFrame:
    """`files` (path, ..) with `sha256` of their content: one task reads a file of any size, a block at a time.

    `opened` gives a readable stream for a path; by default the stores that Arrow knows are read.
    """
    def open_stream(path: str) -> BinaryIO:
        from pyarrow import fs

        # Spark writes local paths with one slash, and has a name of its own for S3.
        uri = re.sub("^file:/*", "file:///", path).replace("s3a://", "s3://", 1)
        store, name = fs.FileSystem.from_uri(uri)
        return store.open_input_stream(name)

    start = opened or open_stream
    schema = T.StructType([*files.schema.fields, T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import pyarrow

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                digest = hashlib.sha256()
                with start(path) as stream:
                    while block := stream.read(BLOCK_BYTES):
                        digest.update(block)
                found.append(digest.hexdigest())
            yield pyarrow.RecordBatch.from_arrays([*batch.columns, pyarrow.array(found, pyarrow.string())], names=schema.names)

    # Files are dealt out one by one, so that long ones are read side by side. A number has to be named:
    # adaptive execution goes by the size of the paths, and would put all files into one task.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks).mapInArrow(run, schema)


def dataset_files(
    spark: SparkSession, folder: str, pattern: str = "*.csv", opened: Callable[[str], BinaryIO] | None = None
) -> DataFrame:
    """(file_name, size_bytes, sha256) per dataset folder.

    A dataset of several part files is identified by the hash of its sorted part hashes.
    """
    parts = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", True
    ).load(folder).select("path", "length")  # listed only: the content is not read here
    named = hashed_files(parts, opened).withColumn("file_name", F.element_at(F.split("path", "/"), -2))
    return named.groupBy("file_name").agg(
        F.sum("length").alias("size_bytes"),
        F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), "|"), 256).alias("sha256"),
    )


def file_inventory(entries: DataFrame, files: DataFrame) -> DataFrame:
    """(file_name, issue): listed but absent, or present but not listed."""
    listed = entries.select(F.col("file_name").alias("listed")).distinct()
    there = files.select(F.col("file_name").alias("there")).distinct()
    joined = listed.join(there, F.col("listed") == F.col("there"), "full_outer")
    label = F.when(F.col("there").isNull(), "missing").otherwise("unexpected")
    return joined.filter("listed is null or there is null").select(
        F.coalesce("listed", "there").alias("file_name"), label.alias("issue")
    )


def file_integrity(entries: DataFrame, files: DataFrame) -> DataFrame:
    """(file_name, size_ok, sha256_ok) per listed file that exists."""
    actual = files.select(
        "file_name", F.col("size_bytes").alias("actual_size"), F.col("sha256").alias("actual_sha")
    )
    return entries.join(actual, "file_name").select(
        "file_name",
        (F.col("size_bytes") == F.col("actual_size")).alias("size_ok"),
        (F.lower("sha256") == F.lower("actual_sha")).alias("sha256_ok"),
    )


def deterministic_batch_id(entries: DataFrame, prefix: str) -> DataFrame:
    """One row: prefix and the first 16 hex digits of the SHA-256 over sorted `name:sha256` pairs."""
    pairs = F.array_sort(F.collect_list(F.concat_ws(":", "file_name", "sha256")))
    digest = F.sha2(F.array_join(pairs, "|"), 256)
    return entries.agg(F.concat(F.lit(prefix), F.substring(digest, 1, 16)).alias("batch_id"))
