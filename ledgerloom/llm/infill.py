"""Fill-in-the-middle: whole texts cut into prefix, middle and suffix and put in another order.

Cuts fall between units, words with the space before them or single characters, and are found on the
UTF-8 bytes of many texts at once. A sparse index of exceptions holds only the characters of several
bytes: where each begins, and how many bytes beyond one they take together. A byte cut becomes a
code-point cut, or the reverse, by one binary search in it; between exceptions the two differ by a
constant, so text in ASCII needs no index at all.

A text's form and cuts follow from the SHA-256 of seed and id: repeated rows are cut alike, whatever
their number or place. NULL text is empty and stays plain, a NULL id counts as empty. Texts of any length
are cut whole. Columns that have the name of an added one are replaced, all others pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.arrays import steps
from ledgerloom.llm.common import small_batches

#: What stands before each part; a text that holds one of them stays plain.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ADDED = pa.schema([("n_units", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("infilled", pa.string())])


class Exceptions:
    """Characters of several bytes in UTF-8 data: `at` has their first bytes, `excess` the bytes beyond one before each, and in all."""

    def __init__(self, data: np.ndarray) -> None:
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        beyond = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(beyond)])
        self.chars = self.at - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte cuts, which lie between characters."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before code-point cuts."""
        return cuts + self.excess[np.searchsorted(self.chars, cuts)]


def word_ends(data: np.ndarray) -> np.ndarray:
    """Where runs of bytes outside space and tab to carriage return end, in data that ends with such a space."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


class Cutter:
    """Texts side by side, with the place of every possible cut."""

    def __init__(self, texts: list[bytes], unit: str) -> None:
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        # Each text is followed by a line feed, so that no word goes on in the next one.
        data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        self.stop = np.cumsum(sizes + 1) - 1
        self.start = self.stop - sizes
        self.index = Exceptions(data)
        self.ends = None
        if unit == "chars":
            self.units = self.index.to_chars(self.stop) - self.index.to_chars(self.start)
            return
        self.ends = word_ends(data)
        self.first = np.searchsorted(self.ends, self.start, side="right")
        self.words = np.searchsorted(self.ends, self.stop, side="right") - self.first
        # What follows the last word is a unit of its own.
        last = np.where(self.words > 0, np.concatenate([self.ends, [0]])[self.first + self.words - 1], self.start)
        self.units = self.words + (last < self.stop)

    def after(self, count: np.ndarray) -> np.ndarray:
        """Byte at which each text is cut after its first `count` units."""
        if self.ends is None:
            return self.index.to_bytes(self.index.to_chars(self.start) + count)
        inner = np.concatenate([self.ends, [0]])[np.minimum(self.first + count - 1, len(self.ends))]
        return np.where(count == 0, self.start, np.where(count <= self.words, inner, self.stop))


def draws(seed: str, ids: list[object]) -> np.ndarray:
    """Four unsigned 32-bit numbers for each id."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, dtype=">u4").reshape(-1, 4).astype(np.int64)


def rearranged(texts: list[bytes], ids: list[object], seed: str, rate: int, spm: int, unit: str) -> list[list]:
    """Values of ADDED for each text."""
    cutter, h = Cutter(texts, unit), draws(seed, ids)
    one, two = (h[:, k] % (cutter.units + 1) for k in (0, 1))
    low, high = cutter.after(np.minimum(one, two)), cutter.after(np.maximum(one, two))
    chars = cutter.index.to_chars
    prefix, middle = chars(low) - chars(cutter.start), chars(high) - chars(low)
    forms, out = [], []
    for k, (text, a, b) in enumerate(zip(texts, low - cutter.start, high - cutter.start, strict=True)):
        if not text or h[k, 2] % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
            forms.append(PLAIN)
            out.append(text)
        elif h[k, 3] % 100 < spm:
            forms.append(SPM)
            out.append(b"".join([SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]]))
        else:
            forms.append(PSM)
            out.append(b"".join([PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]]))
    plain = np.array([f == PLAIN for f in forms], dtype=bool)
    return [
        pa.array(cutter.units, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain),
        pa.array(out, pa.binary()).cast(pa.string())]


def fill_in_middle(
    docs: DataFrame, seed: str = "42", rate: int = 50, spm: int = 80, unit: str = "words", text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """`docs` with n_units, form, prefix_chars, middle_chars (code points, NULL if plain) and `infilled`.

    `rate` of 100 texts are rearranged, `spm` of 100 of those with the suffix first.
    """
    if unit not in ("words", "chars"):
        raise ValueError(f"unknown unit: {unit}")
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c.lower() not in ADDED.names]
    if not {text, doc_id} <= set(rest):
        raise ValueError("text and id must not have the name of an added column")
    plain = docs.select(*[F.col(f"`{c}`") for c in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in steps(batches, text):
            found = rearranged(texts, part.column(doc_id).to_pylist(), seed, rate, spm, unit)
            yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*part.schema.names, *ADDED.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(run, f"{fields}, n_units long, form string, prefix_chars long, middle_chars long, infilled string")


def restore(infilled: Column, form: Column) -> Column:
    """The text that `infilled` was made of; a rearranged text holds each mark once."""
    parts = F.split(infilled, "<[PSM]>", -1)
    first, second, middle = (F.get(parts, k) for k in (1, 2, 3))
    return F.when(form == PSM, F.concat(first, middle, second)).when(form == SPM, F.concat(second, middle, first)).otherwise(infilled)
