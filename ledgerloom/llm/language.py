"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword of +1 and -1. One binary classifier per position tells from n-grams
whether a text belongs to the languages with +1 there: it sums log odds, smoothed n-gram frequencies
of the one group of languages against the other. The nearest codeword wins, by logistic loss of each
position, weighted by how well that classifier did on texts of that language that it has not seen
(loss-weighted decoding).

The score is decoded from log odds per n-gram, so it means the same for a short and a long text. Their
scale is set for each language on the texts kept for the weights: a text of which a quarter is in the
language that is taken for it most easily scores AMBIGUOUS. A text below is flagged: about as much of
two languages, or of none. Of a few words, clean texts vary much and some of them are flagged too.

n-grams of one to three letters are taken from the whole lower-cased text, with every run of other
characters as one space, and hashed into 2**15 classes for each length.

Fitting reads a sample of at most `bound` texts a language on average (chosen by a hash of the text),
a fifth of them for the weights. Counting is a Spark aggregation; what comes to the driver is
bounded by languages times classes. Texts or languages that are NULL, and texts without a letter,
teach nothing and are predicted as `und` with score 0. With a single language everything with a
letter is that language; with none everything is `und`. Other columns pass through.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.arrays import steps
from ledgerloom.llm.common import held, share, tidy

BOUND = 5_000
ORDERS = 3
CLASSES = 1 << 15
UNKNOWN = "und"
#: Below this score the two nearest codewords are about as near.
AMBIGUOUS = 0.6
#: Part of another language in a text that scores AMBIGUOUS.
FOREIGN = 0.25
_SMOOTH = 0.5
_STEP = 512 << 10
_SLICE = 1 << 19
#: Log odds are summed over texts as whole numbers of this part, so that their order does not matter.
_UNIT = float(1 << 32)


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


class Grams:
    """Hashed n-grams of texts: `classes` of all of them, text i's are first[i]:first[i + 1]."""

    table: np.ndarray | None = None

    def __init__(self, texts: list[bytes]) -> None:
        if Grams.table is None:
            Grams.table = _letter_table()
        lower = [t.decode().lower() for t in texts]
        codes = np.frombuffer(" ".join(["", *lower, ""]).encode("utf-32-le"), dtype="<u4")
        owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lower])
        owner = np.concatenate([owner, [max(len(texts) - 1, 0)]])
        letter = Grams.table[codes]
        # One space for every run of other characters; texts end with a space and begin after one.
        keep = letter | np.concatenate([[True], letter[:-1]]) | np.concatenate([[True], owner[1:] != owner[:-1]])
        self.letters = np.bincount(owner[letter], minlength=len(texts))
        code, owner = np.where(letter, codes, 32)[keep].astype(np.uint64), owner[keep]
        parts, owners = [], []
        for n in range(1, ORDERS + 1):
            size = len(code) - n + 1
            if size <= 0:
                continue
            h = np.full(size, n, dtype=np.uint64)
            for k in range(n):
                h = (h ^ code[k:k + size]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            inside = owner[:size] == owner[n - 1:]
            if n == 1:
                inside &= code != 32
            parts.append(((h[inside] >> np.uint64(20)) % np.uint64(CLASSES)).astype(np.int32) + np.int32((n - 1) * CLASSES))
            owners.append(owner[:size][inside].astype(np.int32))
        whose = np.concatenate(owners) if owners else np.empty(0, dtype=np.int32)
        order = np.argsort(whose, kind="stable")
        self.classes = np.concatenate(parts)[order] if parts else np.empty(0, dtype=np.int32)
        self.first = np.searchsorted(whose[order], np.arange(len(texts) + 1))


def codebook(languages: int, seed: int = 1) -> np.ndarray:
    """A row of +1 and -1 per language: all splits for up to six languages, else the best of some random codes."""
    if languages < 2:
        return np.ones((languages, 0), dtype=np.int8)
    if languages <= 6:
        splits = range(1, 1 << (languages - 1))
        return np.array([[-1 if s >> r & 1 else 1 for s in splits] for r in range(languages)], dtype=np.int8)
    width, rng, best = math.ceil(10 * math.log2(languages)), random.Random(seed), (-1, None)
    for _ in range(20):
        code = np.array([[rng.choice((-1, 1)) for _ in range(width)] for _ in range(languages)], dtype=np.int8)
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        apart = code.astype(np.int32) @ code.T.astype(np.int32)
        np.fill_diagonal(apart, -width)
        least = int((code.shape[1] - apart.max()) // 2)
        if least > best[0]:
            best = (least, code)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    #: A row per n-gram class, a column per position of the code.
    odds: np.ndarray
    #: For each language and position, how far the classifier can be trusted; rows have mean one.
    trust: np.ndarray
    #: For each language, what log odds per n-gram are multiplied with for the score.
    scale: np.ndarray

    def margins(self, grams: Grams) -> np.ndarray:
        """Summed log odds of each text, per position; every length of n-grams counts as one view of the text."""
        sums = np.zeros((len(grams.first) - 1, self.code.shape[1]))
        for low in range(0, len(grams.classes) if self.code.shape[1] else 0, _SLICE):
            part = self.odds[grams.classes[low:low + _SLICE]]
            starts = grams.first[(grams.first > low) & (grams.first < low + len(part))]
            starts = np.unique(np.concatenate([[low], starts]))
            sums[np.searchsorted(grams.first, starts, "right") - 1] += np.add.reduceat(part, starts - low, axis=0)
        return sums / ORDERS

    def per_gram(self, margins: np.ndarray, grams: Grams) -> np.ndarray:
        return margins / np.maximum(np.diff(grams.first), 1)[:, None]

    def loss(self, margins: np.ndarray) -> np.ndarray:
        """Distance of each text to each codeword."""
        return np.stack([(np.logaddexp(0, -margins * word) * trust).sum(axis=1) for word, trust in zip(self.code, self.trust, strict=True)], axis=1)

    def score(self, margins: np.ndarray, language: np.ndarray) -> np.ndarray:
        """The share of exp(-distance) that each text's language has; margins: per n-gram."""
        loss = self.loss(margins * self.scale[language][:, None])
        return 1 / np.exp(np.take_along_axis(loss, language[:, None], axis=1) - loss).sum(axis=1)

    def nearest(self, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest codeword of each text, and its score."""
        margins = self.margins(grams)
        best = self.loss(margins).argmin(axis=1)
        return best, self.score(self.per_gram(margins, grams), best)

    def calibrate(self, usual: np.ndarray) -> None:
        """Set the scales; usual: log odds per n-gram of a clean text of each language, per position."""
        own = np.arange(len(self.languages))
        loss = self.loss(usual)
        loss[own, own] = np.inf
        blend = (1 - FOREIGN) * usual + FOREIGN * usual[loss.argmin(axis=1)]
        low, high = np.full(len(own), -20.0), np.full(len(own), 20.0)
        for _ in range(50):
            middle = (low + high) / 2
            self.scale = np.exp2(middle)
            enough = self.score(blend, own) >= AMBIGUOUS
            low, high = np.where(enough, low, middle), np.where(enough, middle, high)
        self.scale = np.exp2(high)


def _counted(labelled: DataFrame) -> DataFrame:
    """(language, class, n) over (language, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for part, texts in steps(batches, "text", _STEP):
            grams = Grams(texts)
            language = np.repeat(np.asarray(part.column("language")), np.diff(grams.first))
            for k in np.unique(language):
                total[int(k)] = total.get(int(k), 0) + np.bincount(grams.classes[language == k], minlength=ORDERS * CLASSES)
        for k, counts in total.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), k, dtype=np.int32)), pa.array(found.astype(np.int32)), pa.array(counts[found].astype(np.int64))], names=["language", "class", "n"])

    return labelled.mapInArrow(tidy(run), "language int, class int, n long").groupBy("language", "class").agg(F.sum("n").alias("n"))


def _right(labelled: DataFrame, model: Model) -> DataFrame:
    """How many texts of each language each classifier gets right, and the sum of their log odds per n-gram in _UNIT: (language, position, right, odds, texts)."""
    shared = share(labelled.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = held(shared)
        for part, texts in steps(batches, "text", _STEP):
            language, grams = np.asarray(part.column("language")), Grams(texts)
            margins = model_.margins(grams)
            right = np.sign(margins) == model_.code[language]
            odds = np.rint(model_.per_gram(margins, grams) * _UNIT).astype(np.int64)
            for k in np.unique(language):
                own = right[language == k]
                wide = own.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(wide, k, dtype=np.int32)), pa.array(np.arange(wide, dtype=np.int32)), pa.array(own.sum(axis=0).astype(np.int64)), pa.array(odds[language == k].sum(axis=0)), pa.array(np.full(wide, len(own), dtype=np.int64))],
                    names=["language", "position", "right", "odds", "texts"])

    found = labelled.mapInArrow(tidy(run), "language int, position int, right long, odds long, texts long")
    return found.groupBy("language", "position").agg(F.sum("right").alias("right"), F.sum("odds").alias("odds"), F.sum("texts").alias("texts"))


def fit(labelled: DataFrame, bound: int = BOUND) -> Model:
    """Learn from (text, lang). `bound`: texts a language that are read, on average."""
    usable = labelled.select("text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    code = codebook(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((ORDERS * CLASSES, 0), dtype=np.float32), np.ones((len(languages), 0)), np.ones(len(languages)))
    spark = labelled.sparkSession
    table = spark.createDataFrame([(name, k, min(1.0, bound / sizes[name])) for k, name in enumerate(languages)], "lang string, language int, share double")
    draw = F.pmod(F.xxhash64(F.lit("language"), "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.join(F.broadcast(table), "lang").withColumn("draw", draw).filter("draw < share")
    counts = np.zeros((len(languages), ORDERS, CLASSES))
    for r in _counted(chosen.filter("draw < 0.8 * share").select("language", "text")).toLocalIterator():
        counts[r["language"]].reshape(-1)[r["class"]] = r["n"]
    frequency = (counts + _SMOOTH) / (counts.sum(axis=2, keepdims=True) + _SMOOTH * CLASSES)
    frequency = frequency.reshape(len(languages), -1)
    odds = np.stack([np.log(frequency[code[:, j] > 0].mean(axis=0) / frequency[code[:, j] < 0].mean(axis=0)) for j in range(code.shape[1])], axis=1)
    model = Model(languages, code, odds.astype(np.float32), np.ones(code.shape), np.ones(len(languages)))
    trust = np.ones(code.shape)
    # A language that has no text left for the weights is judged by those that it was learned from.
    counts = counts.reshape(len(languages), -1)
    usual = counts @ odds / np.maximum(counts.sum(axis=1, keepdims=True), 1) / ORDERS
    for r in _right(chosen.filter("draw >= 0.8 * share").select("language", "text"), model).collect():
        trust[r["language"], r["position"]] = max(r["right"] / r["texts"], 0.01)
        usual[r["language"], r["position"]] = r["odds"] / _UNIT / r["texts"]
    model.trust = trust / trust.mean(axis=1, keepdims=True)
    model.calibrate(usual)
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score (0 to 1) and ambiguous."""
    shared = share(docs.sparkSession, model)
    added = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = held(shared)
        names = [*model_.languages, UNKNOWN]
        for part, texts in steps(batches, text, _STEP):
            grams = Grams(texts)
            if model_.languages:
                best, score = model_.nearest(grams)
            else:
                best, score = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
            empty = grams.letters == 0
            score = np.where(empty, 0.0, score)
            found = np.where(empty, len(names) - 1, best)
            columns = [[names[k] for k in found], score, ~empty & (score < AMBIGUOUS)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(c, f.type) for c, f in zip(columns, added, strict=True))], names=[*part.schema.names, *added.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(tidy(run), f"{fields}, lang_pred string, score double, ambiguous boolean")
