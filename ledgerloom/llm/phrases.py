"""Phrase collocations per language, counted by direct addressing in tiles of frequency-ranked ids.

Words are numbered by falling frequency over all languages, so the pairs that occur most lie close
together in the corner of the square of (left id, right id). The square is cut into tiles of SIDE by SIDE
cells. A chunk of text adds up the tiles with many pairs in one dense array, addressed by cell; what is
left, far from the corner or thinly spread, is sorted and counted as coordinates. The sums of all chunks
go to the bucket of their tile, packed, and are added up there in the same way. Pairs that are frequent
enough are numbered by falling frequency in their turn, and each place of a text takes the number of
the pair that begins there: pairs of overlapping pairs are three words, pairs of overlapping threes four,
so the same step counts phrases of every length. A phrase that is frequent has only frequent parts.

Phrases of one length are numbered up to 2**31; beyond that the operator raises. No task holds more
than a chunk or a bucket. The most common tile gets at most one sum a cell from each chunk, and chunks of
one part of the corpus are added up before the parts are. Words are exchanged as texts, so their counts
are exact; within a chunk they are told apart by 64-bit hashes.

NULL text is empty, a NULL language is `und`, as is the language of that name. Repeated rows count as often as
they occur. Only text and language are read. An empty table, or one without a frequent phrase, gives no rows.
Scores are exact: products are decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.arrays import Words, bucket_of, chain, mix, pack, steps, unpack
from ledgerloom.llm.common import scratch, small_batches, stored

UNKNOWN = "und"
#: Cells of a tile each way, as bits; tiles each way around the corner that can be dense; least pairs in one of them.
BITS, AREA, DENSE = 6, 256, 256
SIDE, CELLS = 1 << BITS, 1 << 2 * BITS
#: Text of one bucket, and of one part of the corpus that is added up first, on average.
BUCKET_BYTES, PART_BYTES = 32 << 20, 4 << 30
#: Counts of pairs that a bucket holds before it adds them up.
HELD = 4 << 20
_LOW = np.uint64(0xFFFFFFFF)
#: Upper case to lower, marks and line ends to line feeds.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10)


def planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte by byte: upper bytes are near-constant and compress well."""
    return np.ascontiguousarray(np.asarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)


def packed_counts(values: np.ndarray) -> bytes:
    """Counts of 64 bits; all planes but the lowest are mostly zero."""
    return np.ascontiguousarray(np.asarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_counts(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view("<u8").astype(np.int64)


def tally(left: np.ndarray, right: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct pair of ids once, as left << 32 | right in no order, and the sum of its weights (1 each)."""
    near = np.flatnonzero((left < AREA * SIDE) & (right < AREA * SIDE))
    x, y = left[near], right[near]
    tile = (x >> BITS) * AREA + (y >> BITS)
    dense = np.bincount(tile, minlength=AREA * AREA) >= DENSE
    chosen = dense[tile]
    slot = (np.cumsum(dense) - 1)[tile[chosen]]
    cell = slot << 2 * BITS | (x[chosen] & SIDE - 1) << BITS | y[chosen] & SIDE - 1
    # Sums of doubles are exact up to 2**53.
    sums = np.bincount(cell, None if weights is None else weights[near[chosen]]).astype(np.int64)
    filled = np.flatnonzero(sums)
    at = np.flatnonzero(dense)[filled >> 2 * BITS]
    corner = ((at // AREA << BITS) + (filled >> BITS & SIDE - 1)) << 32 | (at % AREA << BITS) + (filled & SIDE - 1)
    thin = np.ones(len(left), dtype=bool)
    thin[near[chosen]] = False
    keys = left[thin] << 32 | right[thin]
    if weights is None:
        keys.sort()
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        rest = np.diff(starts, append=len(keys))
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        rest = np.add.reduceat(weights[thin][order], starts) if len(starts) else np.empty(0, dtype=np.int64)
    return np.concatenate([corner, keys[starts]]).astype(np.uint64), np.concatenate([sums[filled], rest])


def added(keys: Sequence[np.ndarray], counts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of several tallies."""
    if not keys:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    every = np.concatenate(keys)
    return tally((every >> np.uint64(32)).astype(np.int64), (every & _LOW).astype(np.int64), np.concatenate(counts))


def tile_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the tile of each pair."""
    tiles = (keys >> np.uint64(32 + BITS)) << np.uint64(32) | (keys & _LOW) >> np.uint64(BITS)
    return bucket_of(mix(tiles), buckets)


_CHUNK = pa.schema([("chunk", pa.int64()), ("symbols", pa.binary()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_CHUNK_DDL = "chunk long, symbols binary, langs array<string>, words array<string>, counts array<long>"


def numbered_words(texts: list[bytes], langs: list[str | None]) -> tuple[np.ndarray, list[str], list[str], np.ndarray]:
    """Texts as numbers of their words from 1 on, 0 between pieces; language, word and count of each number."""
    words = Words([t.translate(FOLD) for t in texts])
    count = words.first[-1]
    starts, ends = words.starts[:count], words.ends[:count]
    code: dict[str, int] = {}
    own = np.array([code.setdefault(UNKNOWN if g is None else g, len(code)) for g in langs], dtype=np.uint64)
    names = list(code)
    spoken = np.repeat(own, np.diff(words.first))
    _, first, which, times = np.unique(chain(spoken, words.hashes[:count]), return_index=True, return_inverse=True, return_counts=True)
    line = np.searchsorted(np.flatnonzero(words.data == 0x0A), starts)
    new = np.diff(line, prepend=-1) != 0
    symbols = np.zeros(count + int(new.sum()), dtype=np.int64)
    symbols[np.arange(count) + np.cumsum(new)] = which + 1
    data = words.data.tobytes()
    return symbols, [names[g] for g in spoken[first]], [data[i:j].decode() for i, j in zip(starts[first], ends[first], strict=True)], times


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for part, texts in steps(batches, "text"):
        symbols, langs, words, counts = numbered_words(texts, part.column("lang").to_pylist())
        if len(words):
            columns = [[number], [planes(symbols)], [langs], [words], [counts.tolist()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CHUNK, strict=True)], schema=_CHUNK)
            number += 1


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """`df`, stored in this order, with `id` from 0 on: a row's place in the written files."""
    spark, folder = df.sparkSession, scratch(df.sparkSession, name)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = rows.groupBy("file").agg(F.count("*").alias("upto")).withColumn("upto", F.coalesce(F.sum("upto").over(earlier), F.lit(0)))
    return rows.join(stored(files, f"{name}-files"), "file").select(*df.columns, (F.col("upto") + F.col("row")).alias("id"))


def _first_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Global ids in place of a chunk's own numbers; 0 for words that are rare."""
    for batch in batches:
        for chunk, symbols, told in zip(batch.column("chunk").to_pylist(), batch.column("symbols").to_pylist(), batch.column("told"), strict=True):
            pairs, own = told.values, from_planes(symbols)
            table = np.zeros(int(own.max()) + 1, dtype=np.int64)
            table[pairs.field("pos").to_numpy() + 1] = checked(pairs.field("id").to_numpy()) + 1
            yield pa.RecordBatch.from_pydict({"chunk": [chunk], "symbols": [planes(table[own])]})


def checked(ids: np.ndarray) -> np.ndarray:
    """Ids that fit into half of a 64-bit pair."""
    if len(ids) and ids.max() >= 1 << 31:
        raise OverflowError("more than 2**31 frequent phrases of one length")
    return ids


def next_to(symbols: np.ndarray) -> np.ndarray:
    """Places whose symbol and the next are both frequent."""
    return np.flatnonzero((symbols[:-1] > 0) & (symbols[1:] > 0))


_SUMS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SUMS_DDL = "bucket int, chunk long, keys binary, counts binary"


def _asks(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A chunk's pairs and their counts, bucket by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("symbols").to_pylist(), strict=True):
                symbols = from_planes(data)
                at = next_to(symbols)
                keys, counts = tally(symbols[at] - 1, symbols[at + 1] - 1)
                bucket = tile_bucket(keys, buckets)
                order = np.lexsort((keys, bucket))
                keys, counts = keys[order], counts[order]
                border = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for k in np.flatnonzero(np.diff(border)):
                    cut = slice(border[k], border[k + 1])
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": [int(k)], "chunk": [chunk], "keys": [pack(keys[cut])], "counts": [packed_counts(counts[cut])]}, schema=_SUMS)

    return run


def _total(batches: Iterable[pa.RecordBatch]) -> tuple[int, np.ndarray, np.ndarray]:
    """Bucket, pairs and sums of all rows; no more is held than distinct pairs and HELD counts."""
    bucket, keys, counts, held, limit = -1, [], [], 0, HELD
    for batch in batches:
        for number, key, count in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "counts")), strict=True):
            bucket = number
            keys.append(unpack(key))
            counts.append(from_counts(count))
            held += len(keys[-1])
            if held > limit:
                key, count = added(keys, counts)
                keys, counts, held, limit = [key], [count], len(key), HELD + 2 * len(key)
    return (bucket, *added(keys, counts))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket, keys, counts = _total(batches)
    order = np.argsort(keys)
    if len(keys):
        yield pa.RecordBatch.from_pydict({"bucket": [bucket], "chunk": [None], "keys": [pack(keys[order])], "counts": [packed_counts(counts[order])]}, schema=_SUMS)


def _frequent(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, keys, counts = _total(batches)
        keys, counts = keys[counts >= least], counts[counts >= least]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(keys), bucket, dtype=np.int32)), pa.array((keys >> np.uint64(32)).astype(np.int64)), pa.array((keys & _LOW).astype(np.int64)), pa.array(counts)],
            names=["bucket", "left", "right", "f"])

    return run


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent ones among the pairs each chunk asked for. The frequent pairs of the bucket come first."""
    keys, ids, known = [], [], None
    for batch in batches:
        asks = batch.column("chunk").is_valid()
        table = batch.filter(pa.compute.invert(asks))
        if table.num_rows:
            keys.append(table.column("left").to_numpy() << 32 | table.column("right").to_numpy())
            ids.append(checked(table.column("id").to_numpy()))
        batch = batch.filter(asks)
        if not batch.num_rows or not keys:
            continue
        if known is None:
            known, number = np.concatenate(keys), np.concatenate(ids)
            order = np.argsort(known)
            known, number = known[order].astype(np.uint64), number[order]
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("keys").to_pylist(), strict=True):
            asked = unpack(data)
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[at] == asked
            if hit.any():
                yield pa.RecordBatch.from_pydict({"chunk": [chunk], "keys": [pack(asked[hit])], "ids": [planes(number[at[hit]])]})


def _next_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each place's frequent pair. Rows come chunk by chunk: first its symbols, then what it was told."""
    chunk, symbols, keys, ids = None, None, [], []

    def done() -> Iterator[pa.RecordBatch]:
        if keys:
            told, number = np.concatenate(keys), np.concatenate(ids)
            order = np.argsort(told)
            told, number = told[order], number[order]
            at = next_to(symbols)
            own = ((symbols[at] - 1) << 32 | symbols[at + 1] - 1).astype(np.uint64)
            place = np.minimum(np.searchsorted(told, own), len(told) - 1)
            out = np.zeros(len(symbols), dtype=np.int64)
            out[at] = np.where(told[place] == own, number[place] + 1, 0)
            yield pa.RecordBatch.from_pydict({"chunk": [chunk], "symbols": [planes(out)]})

    for batch in batches:
        for c, s, k, i in zip(*(batch.column(n).to_pylist() for n in ("chunk", "symbols", "keys", "ids")), strict=True):
            if c != chunk:
                yield from done()
                chunk, symbols, keys, ids = c, None, [], []
            if s is not None:
                symbols = from_planes(s)
            else:
                keys.append(unpack(k))
                ids.append(from_planes(i))
    yield from done()


def longer(chunks: DataFrame, least: int, buckets: int, parts: int, last: bool, name: str) -> tuple[DataFrame, DataFrame | None]:
    """Frequent pairs of neighbouring symbols as (left, right, f, id), and the chunks with their numbers (not if `last`)."""
    asked = chunks.mapInArrow(_asks(buckets), _SUMS_DDL)
    asked = asked if last else stored(asked, f"{name}-asks")
    # A part of the corpus is known by its chunks' numbers.
    part = F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int")
    sums = asked if parts == 1 else asked.repartitionById(buckets * parts, F.col("bucket") * parts + part).mapInArrow(_partial, _SUMS_DDL)
    found = sums.repartitionById(buckets, "bucket").mapInArrow(_frequent(least), "bucket int, left long, right long, f long")
    found = numbered(stored(found, name), [F.desc("f"), F.col("left"), F.col("right")], f"{name}-ranked")
    if last:
        return found, None
    none = F.lit(None)
    table = found.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), none.cast("long").alias("chunk"), none.cast("binary").alias("keys"), "left", "right", "id")
    rows = asked.select("bucket", part.alias("part"), "chunk", "keys", *[none.cast("long").alias(c) for c in ("left", "right", "id")])
    told = rows.unionByName(table).repartitionById(buckets * parts, F.col("bucket") * parts + F.col("part")).sortWithinPartitions(F.asc_nulls_first("chunk"))
    told = told.mapInArrow(_tell, "chunk long, keys binary, ids binary")
    own = chunks.select("chunk", "symbols", none.cast("binary").alias("keys"), none.cast("binary").alias("ids"))
    both = own.unionByName(told.select("chunk", none.cast("binary").alias("symbols"), "keys", "ids"))
    spread = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(spread, "chunk").sortWithinPartitions("chunk", F.col("symbols").isNull())
    return found, stored(dealt.mapInArrow(_next_symbols, "chunk long, symbols binary"), f"{name}-symbols")


def _described(grams: DataFrame, parts: DataFrame) -> DataFrame:
    """Language and words of phrases, and the frequencies of what they begin and end with, from those of their two parts."""
    a, b = (parts.select(*[F.col(c).alias(f"{side}_{c}") for c in ("id", "lang", "phrase", "last", "f", "heads", "tails")]) for side in ("a", "b"))
    both = grams.join(a, F.col("left") == F.col("a_id")).join(b, F.col("right") == F.col("b_id"))
    return both.select(
        "id", "left", "right", "f", F.col("a_lang").alias("lang"), F.concat("a_phrase", F.lit(" "), "b_last").alias("phrase"), F.col("b_last").alias("last"),
        F.concat("a_heads", F.array("a_f")).alias("heads"), F.concat("b_tails", F.array("b_f")).alias("tails"))


def _scored(level: int, grams: DataFrame, above: DataFrame | None, cover: int) -> DataFrame:
    """Phrases with their weakest cut, without those that a longer one stands for."""
    def cut(k: int) -> Column:
        """After k words."""
        left, right = F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(level - k - 1))
        score = F.call_function("div", F.lit(2_000_000).cast("decimal(18,0)") * F.col("f").cast("decimal(19,0)"), (left + right).cast("decimal(20,0)"))
        return F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    if above is not None:
        over = above.select(F.explode(F.array("left", "right")).alias("id"), F.col("f").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
        covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * cover
        grams = grams.join(over, "id", "left").filter(~F.coalesce(covered, F.lit(False)))
    weakest = F.array_min(F.array(*map(cut, range(1, level))))
    return grams.select("lang", "phrase", F.col("f").alias("a"), weakest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, cover: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to `longest` words that occur `least` times or more within pieces. a, l and r
    are the frequencies of the phrase and of the two parts of its weakest cut, n is the number of
    words of the language. A phrase goes if a longer candidate around it has `cover` percent of its frequency or more.
    """
    spark = docs.sparkSession
    small_batches(spark)
    plain = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    parts = max(1, -(-size // PART_BYTES))
    chunks = stored(plain.mapInArrow(_chunks, _CHUNK_DDL), "chunks")
    asked = chunks.select("chunk", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("pos", "w"))
    asked = asked.select("chunk", "pos", F.col("w.langs").alias("lang"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    # Counts of rare words too: they are part of n.
    sums = stored(asked.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = sums.groupBy("lang").agg(F.sum("f").alias("n"))
    words = numbered(sums.filter(F.col("f") >= least), [F.desc("f"), F.col("lang"), F.col("word")], "words-ranked")
    told = asked.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.struct("pos", "id")).alias("told"))
    symbols = stored(chunks.select("chunk", "symbols").join(told, "chunk").mapInArrow(_first_symbols, "chunk long, symbols binary"), "symbols")
    none = F.array().cast("array<bigint>")
    known = words.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("heads"), none.alias("tails"))
    levels: list[DataFrame] = []
    for level in range(2, longest + 1):
        found, symbols = longer(symbols, least, buckets, parts, level == longest, f"phrases-{level}")
        known = stored(_described(found, known), f"phrases-{level}-known")
        levels.append(known)
    scored = [_scored(k + 2, grams, levels[k + 1] if k + 1 < len(levels) else None, cover) for k, grams in enumerate(levels)]
    every = scored[0]
    for more in scored[1:]:
        every = every.unionByName(more)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
