"""Substring dedup with fixed-block anchors.

Any window of `window` words holds one of its text's own blocks of `(window + 1) // 2` words, cut at
multiples of that length. So the blocks are indexed, every rolling window of block length of all
texts probes them, and a block found at a second place is an anchor. Around each anchor all windows
of full length that contain it are compared with those around the other anchors; the windows found
twice, overlapping ones joined, are the maximal exact repeats of at least `window` words.

Both comparisons send hashes to equal ranges of the hash space, sorted and packed per few megabytes
of text. Copies within such a piece leave it once or twice, so no passage, however common, gathers
in one task. Blocks are matched on 48 bits (a false match only makes a candidate), windows on 96 bits
of two independent hashes.

Nulls count as empty texts. Repeated rows (also with the same id) are repeats of each other. Empty
tables give empty results. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.arrays import (
    REPLY_DDL, STEP_BYTES, Words, chain, cuts, holds, in_rows, mix, one_of_each, pack, repeated, replies, reply, steps, unpack, window_starts, windows,
)
from ledgerloom.llm.common import bucket_count, fresh, stored, text_key, tidy

WINDOW = 35
_OTHER = np.uint64(0x5851F42D4C957F2D)
_KEY = 16


def _request(rows: dict[str, list], keys: list[bytes], whose: np.ndarray, place: np.ndarray, **columns: object) -> None:
    """A bucket's part of one step: its own few keys, and for every entry the number of its key and its place."""
    own, which = np.unique(whose, return_inverse=True)
    rows["places"].append(which.astype("<i4").tobytes() + place.astype("<i4").tobytes())
    rows["keys"].append(b"".join(keys[i] for i in own))
    for name, value in columns.items():
        rows[name].append(value)


def _probes(block: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rolling windows of block length, and the blocks with their places, for each bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("rolling", pa.binary()), ("anchors", pa.binary()), ("places", pa.binary()), ("keys", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in steps(batches, "text"):
            keys = part.column("key").to_pylist()
            unique, again = one_of_each(keys)
            keys, texts = [keys[i] for i in unique], [texts[i] for i in unique]
            words = Words(texts)
            at, owner = window_starts(words.first, block)
            if not len(at):
                continue
            hashes = windows(words.hashes, block)[at]
            offset = at - words.first[owner]
            fixed = np.flatnonzero(offset % block == 0)
            order = fixed[np.argsort(hashes[fixed], kind="stable")]
            anchors, place, whose = hashes[order], offset[order] // block, owner[order]
            # A text that comes again here has each window once more.
            rolling = np.sort(np.concatenate([hashes, hashes[again[owner]]])) >> np.uint64(16) << np.uint64(16)
            keep = np.ones(len(rolling), dtype=bool)
            keep[2:] = rolling[2:] != rolling[:-2]  # two of a kind say as much as more
            rolling = rolling[keep]
            a, r = cuts(anchors, buckets), cuts(rolling, buckets)
            rows: dict[str, list] = {n: [] for n in schema.names}
            for b in np.flatnonzero(np.diff(r)):
                cut = slice(a[b], a[b + 1])
                _request(rows, keys, whose[cut], place[cut], bucket=int(b), rolling=pack(rolling[r[b]:r[b + 1]], 6), anchors=pack(anchors[cut], 6))
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return run


def _answer(rows: list[dict], hits: list[np.ndarray], groups: int) -> Iterator[pa.RecordBatch]:
    """Places of the entries that were hit, to their texts; several requests of one text get one answer."""
    number: dict[bytes, int] = {}
    owners, places = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int32)]
    for row, hit in zip(rows, hits, strict=True):
        which, place = np.frombuffer(row["places"], dtype="<i4").reshape(2, -1)
        own = [row["keys"][i:i + _KEY] for i in range(0, len(row["keys"]), _KEY)]
        new = np.array([k not in number for k in own], dtype=bool)
        hit = hit & new[which]
        ids = np.array([number.setdefault(k, len(number)) for k in own], dtype=np.int64)
        owners.append(ids[which[hit]])
        places.append(place[hit])
    owner, place = np.concatenate(owners), np.concatenate(places)
    if len(owner):
        yield reply(list(number), owner, np.empty(0, dtype=np.uint64), place, groups)


def _anchors(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One bucket's blocks that also occur elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, rows = [], []
        for batch in batches:
            for row in batch.to_pylist():
                rolling.append(unpack(row.pop("rolling"), 6))
                rows.append(row)
        if rows:
            twice = repeated(np.concatenate(rolling))
            del rolling
            yield from _answer(rows, [holds(twice, unpack(r["anchors"], 6)) for r in rows], groups)

    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each text."""
    yield from in_rows(((key, np.sort(place).tobytes()) for key, _, place in replies(batches, _KEY)), pa.schema([("key", pa.binary()), ("places", pa.binary())]))


def _candidates(window: int, block: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows of full length around the anchors, for each bucket; `often` marks those of texts with copies here."""
    schema = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("second", pa.binary()), ("often", pa.binary()), ("places", pa.binary()), ("keys", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in steps(batches, "text", STEP_BYTES // 2):
            keys, marks = part.column("key").to_pylist(), part.column("places").to_pylist()
            unique, again = one_of_each(keys)
            keys, texts, marks = [keys[i] for i in unique], [texts[i] for i in unique], [marks[i] for i in unique]
            words = Words(texts)
            at, owner = window_starts(words.first, window)
            if not len(at):
                continue
            # A window from `at` holds the block that starts at the next multiple of the block length.
            marked = np.zeros(len(words.hashes) + window, dtype=bool)
            for i, places in enumerate(marks):
                marked[words.first[i] + np.frombuffer(places, dtype="<i4").astype(np.int64) * block] = True
            near = np.concatenate([[0], np.cumsum(marked)])
            chosen = near[at + window - block + 1] > near[at]
            at, owner = at[chosen], owner[chosen]
            if not len(at):
                continue
            full = windows(words.hashes, window)[at]
            second = windows(mix(words.hashes ^ _OTHER), window)[at]
            order = np.argsort(full)
            full, second, whose, place = full[order], second[order], owner[order], at[order] - words.first[owner[order]]
            c = cuts(full, buckets)
            rows: dict[str, list] = {n: [] for n in schema.names}
            for b in np.flatnonzero(np.diff(c)):
                cut = slice(c[b], c[b + 1])
                _request(rows, keys, whose[cut], place[cut], bucket=int(b), hashes=pack(full[cut], 8), second=pack(second[cut], 4), often=np.packbits(again[whose[cut]]).tobytes())
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return run


def _matches(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One bucket's windows that occur more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, often, rows = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                own = chain(unpack(row.pop("hashes")), unpack(row.pop("second"), 4))
                full.append(own)
                often.append(own[np.unpackbits(np.frombuffer(row.pop("often"), dtype=np.uint8), count=len(own)).astype(bool)])
                rows.append(row)
        if rows:
            twice = repeated(np.concatenate([*full, *often, *often]))
            yield from _answer(rows, [holds(twice, own) for own in full], groups)

    return run


def _spans(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Repeats of each text as [from, to) in words: overlapping and touching windows joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined() -> Iterator[tuple[bytes, np.ndarray]]:
            for key, _, place in replies(batches, _KEY):
                at = np.sort(place)
                gaps = np.flatnonzero(np.diff(at) > window)
                yield key, np.stack([at[np.concatenate([[0], gaps + 1])], at[np.concatenate([gaps, [len(at) - 1]])] + window], axis=1).reshape(-1)

        yield from in_rows(joined(), pa.schema([("key", pa.binary()), ("spans", pa.list_(pa.int32()))]))

    return run


def repeat_spans(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, spans) of the texts of `keyed` (key, text) that share a window with another place.

    `spans` is flat: from, to, from, to, ..., in words, ascending, apart. Rows with one key hold one text.
    """
    block = (window + 1) // 2
    buckets = bucket_count(keyed)
    probes = keyed.mapInArrow(tidy(_probes(block, buckets)), "bucket int, rolling binary, anchors binary, places binary, keys binary")
    anchors = probes.repartitionById(buckets, "bucket").mapInArrow(tidy(_anchors(buckets)), REPLY_DDL)
    anchors = stored(anchors.repartitionById(buckets, "bucket").mapInArrow(tidy(_marks), "key binary, places binary"), "anchors")
    near = keyed.join(anchors, "key").select("key", "text", "places")
    found = near.mapInArrow(tidy(_candidates(window, block, buckets)), "bucket int, hashes binary, second binary, often binary, places binary, keys binary")
    found = found.repartitionById(buckets, "bucket").mapInArrow(tidy(_matches(buckets)), REPLY_DDL)
    return stored(found.repartitionById(buckets, "bucket").mapInArrow(tidy(_spans(window)), "key binary, spans array<int>"), "spans")


def _cleaned(text: str, spans: list[int]) -> tuple[int, int, str]:
    """Words, words removed, and the words that are left, joined by one space."""
    words = (text or "").encode().split()
    kept, done = [], 0
    for low, high in zip(spans[::2], spans[1::2], strict=True):
        kept += words[done:low]
        done = high
    kept += words[done:]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with n_words, n_removed and `kept_text`: the words outside all repeats.

    Every word in a window of `window` words that starts at another place too, in any text, goes;
    windows are judged on the input. All other columns pass through. A text without repeats keeps its
    words, joined by single spaces.
    """
    key, spans, out = fresh(docs, "key"), fresh(docs, "spans"), fresh(docs, "cleaned")
    found = repeat_spans(docs.select(text_key("text").alias("key"), "text"), window).select(F.col("key").alias(key), F.col("spans").alias(spans))

    @F.pandas_udf("n_words long, n_removed long, kept_text string")
    def clean(text, span):
        import pandas as pd

        rows = [_cleaned(t, [] if s is None else list(s)) for t, s in zip(text, span, strict=True)]
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text"])

    joined = docs.withColumn(key, text_key("text")).join(found, key, "left")
    rest = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept_text")]
    return joined.withColumn(out, clean("text", spans)).select(*[F.col(f"`{c}`") for c in rest], f"{out}.*")


