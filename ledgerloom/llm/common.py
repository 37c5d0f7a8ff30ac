"""Spark helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.sources.store import shared_root

#: Text whose words one bucket of a hash exchange holds at most, on average.
BUCKET_BYTES = 128 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python at most 4 MB at a time: texts are long, and each batch is held several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the cluster's shared one."""
    return f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet into the cluster's shared folder and read back: the lineage ends here."""
    small_batches(df.sparkSession)
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_count(df: DataFrame, text: str = "text") -> int:
    """Buckets for hashes of all words of `df`: bounded memory per bucket at every size."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, -(-size // BUCKET_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def share(spark: SparkSession, thing: object) -> Broadcast:
    """Broadcast an object of this folder; its size must be bounded. Tasks get it with `held`."""
    small_batches(spark)
    return spark.sparkContext.broadcast({"code": cloudpickle.dumps(thing)})


def held(shared: Broadcast) -> object:
    """The shared object, unpacked for one task: nothing of it stays in the worker when that ends."""
    return cloudpickle.loads(shared.value["code"])


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, after which a worker gives back the memory it has freed: idle ones stay beside those at work."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        # Where the C library has it, the unused parts of its heap too.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return tidied


def text_key(text: Column | str) -> Column:
    """128-bit key of a whole text; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links: (node, component), the smallest node of each.

    Every round each component joins its smallest neighbour, chains of joins are followed to their
    ends by pointer jumping, and only links between different components stay. The number of
    components at least halves with each round. Grouping is by partial minimum, so a node with
    very many links needs no task of its own.
    """
    links = stored(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    found = None
    while not links.isEmpty():
        both = links.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("up")), F.struct(F.col("b").alias("node"), F.col("a").alias("up")))))
        up = stored(both.groupBy("node").agg(F.min("up").alias("up")).select("node", F.least("node", "up").alias("up")), "up")
        while True:
            top = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = stored(up.join(top, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "jump")
            up = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        root = up.select(F.col("node").alias("component"), F.col("up").alias("root"))
        found = up.withColumnRenamed("up", "component") if found is None else stored(
            found.join(root, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "found")
        left, right = (up.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in ("a", "b"))
        links = stored(
            links.join(left, "a").join(right, "b").filter("a_up <> b_up")
            .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(),
            "links",
        )
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return found
