"""Sharding by jump consistent hashing, with a gapless place for every row in its shard.

The shard of a row follows from its key and the number of shards alone, without a table of ranges or a
ring: the key seeds a generator whose values are the numbers of shards at which it would move, and
the last one below the number of shards is taken. With one shard more, a row either stays or goes to
the new one.

Shards are written as folders of Parquet files. Within its shard a row lies in a piece that follows from
the part of the input it comes from, not from its key, so a key with very many rows fills many pieces of
its shard. A row's slot is its place in the shard's files, one after the other: it is read off the
written files, from their row counts and the row's number in its file, and needs no sorting.

A NULL key is a key of its own. NULL text has size one. Repeated rows and rows of one key go to one shard and
get slots of their own. An empty table gives no rows. Columns named shard, grown_shard or slot are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ledgerloom.llm.common import fresh, stored

#: Text of one file of a shard, on average.
FILE_BYTES = 256 << 20
#: Fixed multiplier of the generator in the published method.
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard, from 0, of each unsigned 64-bit key; about ln(shards) steps for all keys together."""
    found = np.zeros(len(keys), dtype=np.int32)
    live, state = np.arange(len(keys)), keys.astype(np.uint64)
    while len(live):
        state = state * STEP + np.uint64(1)
        reached = np.floor((found[live] + 1) * (float(1 << 31) / ((state >> np.uint64(33)).astype(np.float64) + 1)))
        on = reached < shards
        live, state = live[on], state[on]
        found[live] = reached[on]
    return found


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key of any type, from the first 64 bits of the MD5 of its text."""
    if shards < 1:
        raise ValueError("there must be a shard")

    @F.arrow_udf("int")
    def at(keys: pa.Array) -> pa.Array:
        return pa.array(jump(np.frombuffer(b"".join(keys.to_pylist()), dtype=">u8"), shards))

    return at(F.unhex(F.substring(F.md5(F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")).cast("binary")), 1, 16)))


def write_shards(docs: DataFrame, folder: str, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write `docs` as folders shard=0, shard=1, .. and return them as `read_shards` does.

    grown_shard is the shard with one shard more. `docs` should be read from files, or otherwise
    split into the same partitions when a task is run again.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(1, -(-least // shards), -(-size // (shards * FILE_BYTES)))
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "grown_shard", "slot")]
    piece = fresh(docs, "piece")
    own = F.col(f"`{key}`")
    dealt = docs.select(*rest, shard_of(own, shards).alias("shard"), shard_of(own, shards + 1).alias("grown_shard"))
    # Parts of the input are dealt out by hash, as neighbours among them may be alike.
    dealt = dealt.withColumn(piece, F.col("shard") * pieces + F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(pieces)).cast("int"))
    dealt.repartitionById(shards * pieces, piece).drop(piece).write.partitionBy("shard").parquet(folder)
    schema = dealt.drop(piece).schema
    return read_shards(docs.sparkSession, folder, StructType([f for f in schema if f.name != "shard"] + [schema["shard"]]))


def read_shards(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Rows of written shards with their slot, from 0 without gaps in each shard."""
    rows = spark.read.schema(schema).parquet(folder)
    at = rows.metadataColumn("_metadata")
    file, upto, row = (fresh(rows, n) for n in ("file", "upto", "row"))
    placed = rows.select("*", at["file_name"].alias(file), at["row_index"].alias(row))
    earlier = Window.partitionBy("shard").orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", file).agg(F.count("*").alias(upto)).withColumn(upto, F.coalesce(F.sum(upto).over(earlier), F.lit(0)))
    # A row per file. As a table its size is known before the join, so the texts need not move for it.
    counts = stored(counts, "slots")
    return placed.join(counts, ["shard", file]).select(*rows.columns, (F.col(upto) + F.col(row)).alias("slot"))
