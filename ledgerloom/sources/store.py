"""Where intermediate tables are written, and how."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


#: Of stored tables: keys and hashes as text take half the room that they take with snappy.
COMPRESSION = "zstd"
#: At most, of a stored table.
BUCKETS_PER_CORE = 4


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    chosen = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", chosen)
    return chosen


def table_writer(spark: SparkSession, root: str | None = None) -> Callable[..., DataFrame]:
    """write(name, df, by): store the table as Parquet in a folder of its own and read it back.

    A stored table outlives lost executors and gives later queries pruning and statistics. With `by`, a
    column that few rows share, it is stored in buckets: joins and groupings by it then move nothing.
    """
    ident = uuid.uuid4().hex
    base = f"{root or shared_root(spark)}/tables-{ident}"

    def write(name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        path = f"{base}/{name}"
        out = df.write.option("compression", COMPRESSION)
        if by is None:
            out.parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        # Every scan runs a task for each bucket, so a small cluster has fewer than a shuffle has partitions.
        buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), BUCKETS_PER_CORE * spark.sparkContext.defaultParallelism)
        out.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(f"{name}_{ident}")
        return spark.table(f"{name}_{ident}")

    return write


def remove_folder(spark: SparkSession, folder: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def swap_folder(spark: SparkSession, fresh: str, target: str) -> None:
    """Put the folder `fresh` in the place of `target`; the old one goes last, and comes back on an error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, place, aside = path(fresh), path(target), path(f"{target}-old-{uuid.uuid4().hex}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = files.exists(place)
    if had and not files.rename(place, aside):
        raise OSError(f"{target} cannot be set aside; it is unchanged")
    files.mkdirs(place.getParent())
    moved = False
    try:
        moved = files.rename(new, place)
    finally:
        if not moved and had:
            files.rename(aside, place)
    if not moved:
        raise OSError(f"{fresh} could not be put in place; the former folder is back")
    if had:
        files.delete(aside, True)
