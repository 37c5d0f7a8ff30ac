"""Numpy helpers that run inside tasks: words, their hashes, and sorted hashes packed for a shuffle.

A word is a run of bytes outside space, tab, line feed, vertical tab, form feed and carriage return.
All hashes are 64-bit and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.ones(256, dtype=np.int8)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
#: Text that one step of a task works on; a longer document makes a step of its own.
STEP_BYTES = 4 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of `h` over all 64."""
    h = h ^ (h >> np.uint64(32))
    h = h * _C
    h = h ^ (h >> np.uint64(29))
    h = h * _B
    return h ^ (h >> np.uint64(32))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts, order kept."""
    return mix(left * _A + right)


class Words:
    """The words of some texts: `hashes` of all of them, text i's are first[i]:first[i + 1]."""

    def __init__(self, texts: list[bytes]) -> None:
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        data = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), dtype=np.uint8)
        edges = np.diff(_SPACE[data], prepend=np.int8(0))
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        if len(self.ends) > len(self.starts):
            raise AssertionError("unbalanced words")
        # The eight padding bytes count as one word; it is not part of any text.
        self.starts = self.starts[: len(self.ends)]
        borders = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.first = np.searchsorted(self.starts, borders)
        self.data = data
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        eight = np.ndarray((len(self.data) - 7,), dtype="<u8", buffer=self.data, strides=(1,))
        size = self.ends - self.starts
        h = size.astype(np.uint64) * _A
        at, rest, live = self.starts, size, None
        while len(at):
            part = eight[at] & _KEEP[np.minimum(rest, 8)]
            if live is None:
                h = chain(h, part)
            else:
                h[live] = chain(h[live], part)
            more = np.flatnonzero(rest > 8)
            live = more if live is None else live[more]
            at, rest = at[more] + 8, rest[more] - 8
        return h


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each `width` consecutive values; entry i starts at i, len - width + 1 entries."""
    if len(hashes) < width:
        return np.empty(0, dtype=np.uint64)
    power, span, done, out = hashes, 1, 0, None
    left = width
    while left:
        if left & 1:
            part = power[done:]
            out = part if out is None else chain(out[: len(part)], part[: len(out)])
            done += span
        left >>= 1
        if left:
            power = chain(power[:-span], power[span:])
            span *= 2
    return out[: len(hashes) - width + 1]


def window_starts(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window fits into its text, and the text of each."""
    sizes = np.maximum(np.diff(first) - width + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    skipped = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.arange(len(owner)) + skipped, owner


def pack(values: np.ndarray, width: int = 8) -> bytes:
    """The top `width` bytes of sorted values, plane by plane: near-constant planes compress well."""
    planes = np.ascontiguousarray(values).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(planes[:, 8 - width:].T).tobytes()


def unpack(data: bytes, width: int = 8) -> np.ndarray:
    """Inverse of `pack`; bytes that were left out are zero."""
    planes = np.zeros((len(data) // width, 8), dtype=np.uint8)
    planes[:, 8 - width:] = np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T
    return planes.reshape(-1).view("<u8").astype(np.uint64, copy=False)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash space: sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def cuts(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in sorted hashes, and the end."""
    return np.searchsorted(bucket_of(sorted_hashes, buckets), np.arange(buckets + 1))


def steps(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about `limit` bytes of text, each with its texts; NULL is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.binary() if batch.schema.field(column).type != pa.large_string() else pa.large_binary())
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)).astype(np.int64)
        groups = np.cumsum(sizes) // limit
        borders = np.concatenate([[0], np.flatnonzero(np.diff(groups)) + 1, [batch.num_rows]])
        for low, high in zip(borders[:-1], borders[1:], strict=True):
            part = batch.slice(low, high - low)
            yield part, [t or b"" for t in texts.slice(low, high - low).to_pylist()]


REPLY = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("values", pa.binary()), ("more", pa.binary())])
REPLY_DDL = "bucket int, keys binary, sizes binary, values binary, more binary"


def reply(keys: list[bytes], owner: np.ndarray, values: np.ndarray, more: np.ndarray, groups: int) -> pa.RecordBatch:
    """Send 64-bit `values` (none, if empty) and 32-bit `more` back to their owners: one row for each group of owners.

    `owner` numbers the keys. The group of a key follows from the key alone.
    """
    group = np.fromiter((int.from_bytes(k[:4]) % groups for k in keys), np.int64, len(keys))
    rank = np.argsort(group, kind="stable")
    place = np.empty(len(keys), dtype=np.int64)
    place[rank] = np.arange(len(keys))
    own = place[owner]
    order = np.argsort(own, kind="stable")
    counts = np.bincount(own, minlength=len(keys))
    ends = np.concatenate([[0], np.cumsum(counts)])
    bare = not len(values)
    values, more = values if bare else values[order].astype("<u8"), more[order].astype("<i4")
    border = np.searchsorted(group[rank], np.arange(groups + 1))
    rows: dict[str, list] = {n: [] for n in REPLY.names}
    for g in np.flatnonzero(ends[border[1:]] > ends[border[:-1]]):
        low, high = border[g], border[g + 1]
        filled = np.flatnonzero(counts[low:high]) + low
        rows["bucket"].append(int(g))
        rows["keys"].append(b"".join(keys[rank[i]] for i in filled))
        rows["sizes"].append(counts[filled].astype("<i4").tobytes())
        rows["values"].append(b"" if bare else values[ends[low]:ends[high]].tobytes())
        rows["more"].append(more[ends[low]:ends[high]].tobytes())
    return pa.RecordBatch.from_pydict(rows, schema=REPLY)


def replies(batches: Iterable[pa.RecordBatch], key_size: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """All replies that one group got, owner by owner: key, values, more."""
    number: dict[bytes, int] = {}
    owners, values, more = [], [], []
    for batch in batches:
        for keys, sizes, value, rest in zip(*(batch.column(c).to_pylist() for c in ("keys", "sizes", "values", "more")), strict=True):
            ids = [number.setdefault(keys[i:i + key_size], len(number)) for i in range(0, len(keys), key_size)]
            owners.append(np.repeat(np.array(ids, dtype=np.int64), np.frombuffer(sizes, dtype="<i4")))
            values.append(np.frombuffer(value, dtype="<u8"))
            more.append(np.frombuffer(rest, dtype="<i4"))
    if not number:
        return
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[order], np.arange(len(number) + 1))
    value, rest = np.concatenate(values), np.concatenate(more)[order]
    value = value[order] if len(value) else value
    for i, key in enumerate(number):
        yield key, value[ends[i]:ends[i + 1]], rest[ends[i]:ends[i + 1]]


def in_rows(rows: Iterable[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Rows as record batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def one_of_each(keys: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Where each key comes first, and whether it comes again."""
    first: dict[bytes, int] = {}
    again: set[bytes] = set()
    for i, key in enumerate(keys):
        if first.setdefault(key, i) != i:
            again.add(key)
    return list(first.values()), np.array([k in again for k in first], dtype=bool)


def holds(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of `values` are in `ordered`."""
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def repeated(values: np.ndarray) -> np.ndarray:
    """Values that occur more than once, sorted, once each."""
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return twice[np.concatenate([[True], twice[1:] != twice[:-1]])] if len(twice) else twice
