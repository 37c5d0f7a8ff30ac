"""N-gram Jaccard join as a T-occurrence search in the manner of DivideSkip.

A document of n distinct shingles can only link with documents that share at least
T = ceil(n * percent / 100) of them: they occur T times in its inverted lists. Of its lists the
longest are put aside: the n - T + k shortest ones must then show at least k hits, and the long ones
are only probed by binary search, for the candidates that these merged short lists leave.

1. Copies (equal sets) become one class. Nothing below sees them twice.
2. All inverted lists are built once, in equal ranges of the hash space, to learn their lengths. A
   list with many documents in a few megabytes of text counts as long everywhere and its members
   never travel to one task. Each class gets back which of its shingles occur elsewhere; one that
   shares fewer than T of them is done.
3. Every short list links its members with two of them, its leaders, instead of with each other; both
   differ from list to list, so even thousands of near copies become one component without all pairs.
4. Lists that still hold several components are searched for links across components: those with few
   members pair by pair; the members of longer ones go into tiles of bounded size, and two tiles meet
   in one task, which merges its own short lists and probes its long ones for every member. No link
   is lost: a pair left out is in one component already, and components are all that is returned.

Shingles are compared on 48 of 64 hash bits, sets on 96 bits and their size.

A document without words has an empty set and links with nothing; one with fewer words than a
shingle has one shingle, the whole sequence. NULL text is empty. Repeated rows are copies. Where ids
are NULL, component_id is the smallest non-NULL id of the class, or NULL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.arrays import (
    REPLY_DDL, Words, cuts, holds, in_rows, pack, repeated, replies, reply, steps, unpack, window_starts, windows,
)
from ledgerloom.llm.common import bucket_count, components, fresh, stored, text_key, tidy

SIZE = 5
PERCENT = 75
#: Hits that the merged short lists must show.
HITS = 3
#: Documents of one step of a task that make a list long.
LONG_LIST = 64
#: Members up to which a list that holds several components is searched pair by pair; longer ones go in tiles.
FEW = 32
TILE = 1024
_LONG = 2**31 - 1
_KEY = 16


def _sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words([t.lower() for t in texts])
    at, owner = window_starts(words.first, size)
    hashes = windows(words.hashes, size)[at] if len(at) else np.empty(0, dtype=np.uint64)
    border = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        own = hashes[border[i]:border[i + 1]]
        if not len(own):
            short = words.hashes[words.first[i]:words.first[i + 1]]
            own = windows(short, len(short)) if len(short) else short
        own = np.sort(own)
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
    return out


def _key(own: np.ndarray) -> bytes:
    """Key of a set: 12 bytes of a digest, its last four bytes replaced by the size."""
    return hashlib.blake2b(own.tobytes(), digest_size=_KEY - 4).digest() + len(own).to_bytes(4, "little")


def _identify(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number of shingles and key of the set, beside the other columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in steps(batches, "text"):
            sets = _sets(texts, size)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_key(s) if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "n", "key"],
            )

    return run


_REQUEST = pa.schema([("bucket", pa.int32()), ("tokens", pa.binary()), ("whose", pa.binary()), ("keys", pa.binary()), ("long", pa.binary())])


def _postings(size: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Inverted lists of a few megabytes of text for each bucket.

    A row without `long` tells documents of their shingles in long lists.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in steps(batches, "text"):
            sets = {_key(s): s for s in _sets(texts, size) if len(s)}
            if not sets:
                continue
            keys = list(sets)
            tokens = np.concatenate(list(sets.values())) >> np.uint64(16) << np.uint64(16)
            whose = np.repeat(np.arange(len(keys), dtype="<u4"), [len(s) for s in sets.values()])
            order = np.argsort(tokens, kind="stable")
            tokens, whose = tokens[order], whose[order]
            border = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
            heavy = np.repeat(np.diff(border) > LONG_LIST, np.diff(border))
            rows: dict[str, list] = {n: [] for n in _REQUEST.names}

            def add(*values: object, rows: dict[str, list] = rows) -> None:
                for column, value in zip(rows.values(), values, strict=True):
                    column.append(value)

            long = np.empty(0, dtype=np.uint64)
            if heavy.any():
                far, own = tokens[heavy], whose[heavy]
                long = far[np.concatenate([[True], far[1:] != far[:-1]])]
                present, which = np.unique(own, return_inverse=True)
                add(int.from_bytes(keys[0][:4]) % buckets, pack(far, 6), which.astype("<u4").tobytes(), b"".join(keys[i] for i in present), None)
                tokens, whose = tokens[~heavy], whose[~heavy]
            c, d = cuts(tokens, buckets), cuts(long, buckets)
            for b in np.flatnonzero(np.diff(c) + np.diff(d)):
                present, which = np.unique(whose[c[b]:c[b + 1]], return_inverse=True)
                add(int(b), pack(tokens[c[b]:c[b + 1]], 6), which.astype("<u2" if len(present) <= 65535 else "<u4").tobytes(),
                    b"".join(keys[i] for i in present), pack(long[d[b]:d[b + 1]], 6))
            yield pa.RecordBatch.from_pydict(rows, schema=_REQUEST)

    return run


def _replies(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One bucket: for each document its shingles that other documents have too, with the lists' lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, long = [], [], []
        number: dict[bytes, int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = unpack(row["tokens"], 6)
                keys = [row["keys"][i:i + _KEY] for i in range(0, len(row["keys"]), _KEY)]
                if row["long"] is None:
                    # Shingles in long lists go straight on to their documents.
                    whose = np.frombuffer(row["whose"], dtype="<u4").astype(np.int64)
                    yield reply(keys, whose, own, np.full(len(own), _LONG), groups)
                    continue
                long.append(unpack(row["long"], 6))
                if len(own):
                    wide = len(row["whose"]) // len(own)
                    ids = np.array([number.setdefault(k, len(number)) for k in keys], dtype=np.int64)
                    tokens.append(own)
                    owners.append(ids[np.frombuffer(row["whose"], dtype=f"<u{wide}")])
        if not tokens:
            return
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        del tokens, owners
        far = np.unique(np.concatenate(long))
        again = repeated(token)
        keep = holds(again, token) | holds(far, token)
        token, owner = token[keep], owner[keep]
        if not len(token):
            return
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        once = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])
        token, owner = token[once], owner[once]
        border = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        length = np.minimum(np.repeat(np.diff(border), np.diff(border)), _LONG - 1)
        length[holds(far, token)] = _LONG
        keep = length > 1
        if keep.any():
            yield reply(list(number), owner[keep], token[keep], length[keep], groups)

    return run


def _prefixes(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Classes that share enough shingles: these, and the lists to be merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[bytes, int, bytes, np.ndarray]]:
            for key, tokens, ranks in replies(batches, _KEY):
                # A document may have been told of its long lists more than once.
                tokens, first = np.unique(tokens, return_index=True)
                ranks, n = ranks[first], int.from_bytes(key[-4:], "little")
                least = -(-n * percent // 100)
                if len(tokens) >= least:
                    merged = n - least + min(HITS, least) - (n - len(tokens))
                    order = np.lexsort((tokens, ranks))[:max(merged, 0)]
                    yield key, n, pack(tokens, 6), (tokens[order] >> np.uint64(16)).astype(np.int64)

        yield from in_rows(rows(), pa.schema([("key", pa.binary()), ("n", pa.int64()), ("tokens", pa.binary()), ("short", pa.list_(pa.int64()))]), 256)

    return run


def _probe(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs whose sets overlap enough, by binary search of the smaller set in the larger one."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            for a, b, n, m, left, right in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "n_a", "n_b", "tokens_a", "tokens_b")), strict=True):
                x, y = sorted((unpack(left, 6), unpack(right, 6)), key=len)
                hits = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if 100 * hits >= percent * (n + m - hits):
                    found.append((a, b))
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [y for _, y in found]}, schema=schema)

    return run


def search(queries: list[tuple[int, np.ndarray]], data: list[tuple[int, np.ndarray]], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """T-occurrence search in memory: for each query (size, sorted shingles) the numbers of the data it links with."""
    sizes = np.array([n for n, _ in data])
    tokens = np.concatenate([t for _, t in data])
    whose = np.repeat(np.arange(len(data)), [len(t) for _, t in data])
    order = np.argsort(tokens, kind="stable")
    tokens, whose = tokens[order], whose[order]
    start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
    lists = tokens[start[:-1]]
    for n, own in queries:
        least = -(-n * percent // 100)
        at = np.searchsorted(lists, own)
        at = at[lists[np.minimum(at, len(lists) - 1)] == own]
        if len(at) < least:
            yield n, np.empty(0, dtype=np.int64)
            continue
        length = start[at + 1] - start[at]
        at = at[np.argsort(length, kind="stable")]
        # As many long lists are put aside as balances merging against probing.
        aside = min(least - 1, int(least / (0.5 * np.log2(length.max() + 1) + 1)))
        short, long = at[:len(at) - aside], at[len(at) - aside:]
        size = start[short + 1] - start[short]
        merged = whose[np.arange(size.sum()) + np.repeat(start[short] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)]
        hits = np.bincount(merged, minlength=len(data))
        found = np.flatnonzero(hits >= least - aside)
        hits = hits[found]
        for k in long:
            members = whose[start[k]:start[k + 1]]
            hits = hits + (members[np.minimum(np.searchsorted(members, found), len(members) - 1)] == found)
        yield n, found[100 * hits >= percent * (n + sizes[found] - hits)]


def _compare(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between the components of two tiles: as few as join them."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        left, right = ([r for r in rows if r["second"] == side] for side in (False, True))
        right = right or left
        if not left:
            return schema.empty_table()
        top: dict[bytes, bytes] = {}

        def root(c: bytes) -> bytes:
            while top.get(c, c) != c:
                top[c] = top.get(top[c], top[c])
                c = top[c]
            return c

        found = []
        one, two = ([(r["n"], unpack(r["tokens"], 6)) for r in side] for side in (left, right))
        for row, (_, hits) in zip(left, search(one, two, percent), strict=True):
            for k in hits:
                x, y = root(row["component"]), root(right[k]["component"])
                if x != y:
                    top[max(x, y)] = min(x, y)
                    found.append((row["key"], right[k]["key"]))
        return pa.table([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], schema=schema)

    return run


def _tiled(lists: DataFrame, sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links across components among the members of long lists (token, key, component).

    Lists that overlap are one area. An area is cut into tiles of bounded size, a component that is
    larger than a tile into tiles of its own, which need not be compared with each other.
    """
    first = lists.groupBy("token").agg(F.min("key").alias("first"))
    areas = components(lists.join(first, "token").select(F.col("key").alias("a"), F.col("first").alias("b")))
    members = stored(areas.select(F.col("node").alias("key"), F.col("component").alias("area")).join(lists.select("key", "component").distinct(), "key"), "members")
    size = members.groupBy("area", "component").agg(F.count("*").alias("c"))
    large = F.col("c") > tile
    rest = size.groupBy("area").agg(F.sum(F.when(~large, F.col("c"))).alias("rest"))
    size = size.join(rest, "area").select("area", "component", F.when(large, F.col("component")).alias("alone"), F.ceil(F.when(large, F.col("c")).otherwise(F.col("rest")) / tile).alias("tiles"))
    spread = F.pmod(F.when(F.col("alone").isNull(), F.xxhash64("component")).otherwise(F.xxhash64("key")), F.col("tiles"))
    placed = stored(
        members.join(size, ["area", "component"]).select("key", "area", "component", "alone", F.concat_ws(":", F.hex("alone"), spread).alias("tile")), "placed")
    tiles = placed.select("area", "alone", "tile").distinct()
    a, b = (tiles.select("area", F.col("alone").alias(f"{s}_alone"), F.col("tile").alias(s)) for s in "ab")
    pairs = a.join(b, "area").filter("a <= b and not coalesce(a_alone = b_alone, false)").select("area", "a", "b")
    full = placed.join(sets.select("key", "n", "tokens"), "key").select("area", "tile", "key", "n", "tokens", "component")
    left = full.join(pairs, (full["area"] == pairs["area"]) & (full["tile"] == pairs["a"])).drop(full["area"]).withColumn("second", F.lit(False))
    right = full.join(pairs.filter("a <> b"), (full["area"] == pairs["area"]) & (full["tile"] == pairs["b"])).drop(full["area"]).withColumn("second", F.lit(True))
    return left.unionByName(right).drop("tile").groupBy("area", "a", "b").applyInArrow(_compare(percent), "a binary, b binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("tokens").alias(f"tokens_{side}")), side)
    return pairs.select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b").mapInArrow(tidy(_probe(percent)), "a binary, b binary")


def _alike(percent: int) -> object:
    """Sizes that can reach the similarity."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def class_components(texts: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(node, component) of the classes of `texts` (text) that link with others."""
    buckets = bucket_count(texts)
    asked = texts.select("text").mapInArrow(tidy(_postings(size, buckets)), "bucket int, tokens binary, whose binary, keys binary, long binary")
    told = asked.repartitionById(buckets, "bucket").mapInArrow(tidy(_replies(buckets)), REPLY_DDL)
    sets = stored(told.repartitionById(buckets, "bucket").mapInArrow(tidy(_prefixes(percent)), "key binary, n long, tokens binary, short array<bigint>"), "sets")
    lists = sets.select("key", "n", F.explode("short").alias("token"))
    leads = lists.groupBy("token").agg(
        F.min(F.struct("key", "n")).alias("first"), F.min(F.struct(F.xxhash64("token", "key"), "key", "n")).alias("second"), F.count("*").alias("c"),
    ).filter("c > 1")
    stars = (
        lists.join(leads, "token").select(F.col("key").alias("x"), F.col("n").alias("n_a"), F.explode(F.array(
            F.struct(F.col("first.key").alias("y"), F.col("first.n").alias("n_b")), F.struct(F.col("second.key").alias("y"), F.col("second.n").alias("n_b")))).alias("to"))
        .select("x", F.col("to.y").alias("y"), "n_a", F.col("to.n_b").alias("n_b")).filter(_alike(percent)).filter("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    )
    stars = stored(_linked(stars, sets, percent), "stars")
    parts = components(stars)

    lists = lists.join(parts.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    mixed = lists.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("c")).filter("low <> high").select("token", "c")
    lists = stored(lists.join(mixed, "token"), "lists")
    few = F.col("c") <= FEW
    left, right = (lists.filter(few).select("token", F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("component").alias(f"c_{s}")) for s in ("a", "b"))
    # A pair with too few hits here has others in longer lists, and is found there.
    needed = F.least(F.lit(HITS), F.ceil(F.least("n_a", "n_b") * percent / 100))
    rest = (
        left.join(right, "token").filter("a < b and c_a <> c_b").filter(_alike(percent))
        .groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("hits")).filter(F.col("hits") >= needed).select("a", "b")
    )
    links = stars.unionByName(stored(_linked(rest, sets, percent), "rest"))
    many = lists.filter(~few)
    if not many.isEmpty():
        links = links.unionByName(stored(_tiled(many, sets, percent, TILE), "tiled"))
    return components(links)


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per row of `docs`: doc_id, n_shingles, component_id, copies (rows with the same set), key (of the set, NULL if empty), group (key of the component).

    Two documents link when their sets' intersection has at least `percent` percent of the union;
    component_id is the smallest doc_id reachable by links, the document's own included.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = stored(plain.mapInArrow(tidy(_identify(size)), f"doc_id {kind}, n long, key binary"), "known")
    classes = stored(known.filter("n > 0").groupBy("key", "n").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "classes")
    found = class_components(plain, size, percent)
    named = classes.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("group", F.coalesce("component", "key"))
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = stored(named.join(smallest, "group").select("key", "copies", "group", "component_id"), "named")
    return known.join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"), "key", "group",
    )


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """`docs` with one document of each group of near duplicates: the one with the smallest doc_id.

    A NULL id comes last; among rows with the same id the smaller hash of the text stays, and one of
    rows that have both in common. Documents without words are no duplicates of anything and stay.
    """
    at, group, first = (fresh(docs, n) for n in ("at", "group", "first"))
    known = docs.withColumn(at, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), text_key("text").alias("key")))
    found = near_duplicates(known.select(at, "text"), size, percent, doc_id=at)
    winners = found.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias(first))
    # Only rows that a winner shares its id and text with need to be told apart.
    same = found.filter("group is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).withColumnRenamed("doc_id", first)
    winners = stored(winners.join(same, first).select(F.col(first), F.col("rows").alias(group)), "winners")
    alone = known.join(winners.filter(F.col(group) == 1), F.col(at) == F.col(first), "left_semi")
    several = known.join(winners.filter(F.col(group) > 1), F.col(at) == F.col(first), "left_semi").dropDuplicates([at])
    empty = known.filter(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^ \t-\r]"))
    return alone.unionByName(several).unionByName(empty).drop(at)
