"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

    p(w | v) = l2(b) * c(v w) / c(v) + l1(b) * c(w) / N + l0(b) / (V + 1)

b is the bucket of the context's frequency, doublings of c(v), with one for contexts never seen. The
weights of each bucket are learned by expectation-maximisation on a part of the training texts whose
counts are deleted for that purpose; the final estimates count all training texts. All counts cover
the whole corpus.

Texts are dealt into chunks of bounded size. A chunk asks for each of its distinct words and bigrams
once, in packed sorted hashes, and brings its own counts along; every bucket of the hash space adds
them up and answers in the order in which it was asked, so answers are bare numbers. Frequent words
leave a chunk once. For the weights, held-out bigrams are reduced to counts of (bucket, ratios of the
estimates in steps of an eighth of a doubling), whose number is bounded whatever the corpus.

Words are lower-cased in A-Z and compared by 64-bit hashes. NULL text is empty, of which only its end
is scored. Rows are scored one by one, repeated ones too. Without training texts every score is that
of the uniform estimate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.arrays import Words, chain, cuts, pack, unpack
from ledgerloom.llm.common import held, share, stored

CHUNK_BYTES = 8 << 20
ROUNDS = 50
STEPS = 8
_LIMIT = 60 * STEPS
_START, _END = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x5A5A5A5A5A5A5A5A)
#: Where a bucket has no held-out events: uniform, word, bigram.
DEFAULT = (0.05, 0.45, 0.5)
BUCKETS = 65


class Tokens:
    """Words and bigrams of texts; text i has the tokens first[i]:first[i + 1], its end the last one."""

    def __init__(self, texts: list[bytes]) -> None:
        words = Words([t.lower() for t in texts])
        sizes = np.diff(words.first) + 1
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        tokens = np.full(self.first[-1], _END, dtype=np.uint64)
        inside = np.ones(len(tokens), dtype=bool)
        inside[self.first[1:] - 1] = False
        tokens[inside] = words.hashes[:words.first[-1]]
        del words, inside
        before = np.concatenate([[_START], tokens[:-1]])
        before[self.first[:-1]] = _START
        self.words, self.word = np.unique(tokens, return_inverse=True)
        self.pairs, self.pair = np.unique(chain(before, tokens), return_inverse=True)
        # The context's number among the words, or one beyond for a start.
        self.context = np.concatenate([[len(self.words)], self.word[:-1]])
        self.context[self.first[:-1]] = len(self.words)


def numbers(values: np.ndarray) -> bytes:
    """Counts, plane by plane."""
    return np.ascontiguousarray(np.asarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def counted(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view("<u8").astype(np.int64)


_ASK = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("deleted", pa.bool_()), ("words", pa.binary()), ("word_counts", pa.binary()), ("pairs", pa.binary()), ("pair_counts", pa.binary())])
_ASK_DDL = "bucket int, chunk int, deleted boolean, words binary, word_counts binary, pairs binary, pair_counts binary"
_TELL = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("words", pa.binary()), ("pairs", pa.binary()), ("kept_words", pa.binary()), ("kept_pairs", pa.binary())])
_TELL_DDL = "chunk int, bucket int, words binary, pairs binary, kept_words binary, kept_pairs binary"
_TOTALS = ("n", "kept_n", "v", "kept_v", "ends", "kept_ends")


def _ask(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What one chunk asks each bucket, with its own training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, learns, chunk, deleted = [], [], -1, False
        for batch in batches:
            if batch.num_rows:
                texts += [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                learns += batch.column("learns").to_pylist()
                chunk, deleted = batch.column("chunk")[0].as_py(), batch.column("deleted")[0].as_py()
        if not texts:
            return
        t = Tokens(texts)
        learning = np.repeat(np.array(learns, dtype=bool), np.diff(t.first))
        words, pairs = (np.bincount(which[learning], minlength=len(unique)) for which, unique in ((t.word, t.words), (t.pair, t.pairs)))
        a, b = cuts(t.words, buckets), cuts(t.pairs, buckets)
        for k in np.flatnonzero(np.diff(a) + np.diff(b)):
            x, y = slice(a[k], a[k + 1]), slice(b[k], b[k + 1])
            yield pa.RecordBatch.from_pydict({
                "bucket": [int(k)], "chunk": [chunk], "deleted": [deleted], "words": [pack(t.words[x])], "word_counts": [numbers(words[x])],
                "pairs": [pack(t.pairs[y])], "pair_counts": [numbers(pairs[y])],
            }, schema=_ASK)

    return run


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: the sums, to each chunk in the order in which it asked; and totals, as chunk -1."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    bucket, totals = rows[0]["bucket"], dict.fromkeys(_TOTALS, 0)
    answers: dict[str, list[bytes]] = {}
    for kind in ("word", "pair"):
        asked = [unpack(r.pop(f"{kind}s")) for r in rows]
        counts = [counted(r.pop(f"{kind}_counts")) for r in rows]
        unique, which = np.unique(np.concatenate(asked), return_inverse=True)
        deleted = np.repeat([r["deleted"] for r in rows], [len(a) for a in asked])
        every = np.concatenate(counts)
        # Sums of doubles are exact up to 2**53.
        whole = np.bincount(which, every, len(unique)).astype(np.int64)
        kept = np.bincount(which, np.where(deleted, 0, every), len(unique)).astype(np.int64)
        if kind == "word":
            end = unique == _END
            totals = dict(zip(_TOTALS, (int(x) for x in (whole.sum(), kept.sum(), (whole > 0).sum(), (kept > 0).sum(), whole[end].sum(), kept[end].sum())), strict=True))
        border = np.concatenate([[0], np.cumsum([len(a) for a in asked])])
        answers[f"{kind}s"] = [numbers(whole[which[i:j]]) for i, j in zip(border[:-1], border[1:], strict=True)]
        answers[f"kept_{kind}s"] = [numbers(kept[which[i:j]]) if r["deleted"] else b"" for r, i, j in zip(rows, border[:-1], border[1:], strict=True)]
    for k, row in enumerate(rows):
        yield pa.RecordBatch.from_pydict({"chunk": [row["chunk"]], "bucket": [bucket], **{n: [answers[n][k]] for n in _TELL.names[2:]}}, schema=_TELL)
    yield pa.RecordBatch.from_pydict(
        {"chunk": [-1], "bucket": [bucket], "words": [np.array(list(totals.values()), dtype="<u8").tobytes()], **{n: [b""] for n in _TELL.names[3:]}}, schema=_TELL)


def estimates(word: np.ndarray, pair: np.ndarray, context: np.ndarray, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token's context, and its estimates as (uniform, word, bigram)."""
    known = context > 0
    bucket = np.where(known, 1 + np.floor(np.log2(np.maximum(context, 1))).astype(np.int64), 0)
    return bucket, np.stack([np.full(len(word), 1 / (v + 1)), word / max(n, 1), np.where(known, pair / np.maximum(context, 1), 0.0)], axis=1)


def learn(bucket: np.ndarray, parts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Mixture weights of each bucket by expectation-maximisation; the uniform part never vanishes."""
    out = np.tile(np.array(DEFAULT), (BUCKETS, 1))
    out[0] = (0.1, 0.9, 0.0)
    for b in np.unique(bucket):
        own, count = parts[bucket == b], weight[bucket == b]
        mixture = out[b].copy()
        for _ in range(ROUNDS):
            share_ = own * mixture
            share_ /= share_.sum(axis=1, keepdims=True)
            mixture = np.maximum((share_ * count[:, None]).sum(axis=0) / count.sum(), (1e-6, 0, 0))
            mixture /= mixture.sum()
        out[b] = mixture
    return out


def _told(batches: Iterator[pa.RecordBatch]) -> tuple[list[bytes], list[pa.Array], list[dict]]:
    """Texts, their other columns and the answers of one chunk, bucket by bucket."""
    texts, rest, answers = [], [], []
    for batch in batches:
        is_text = batch.column("is_text")
        docs = batch.filter(is_text)
        texts += [t or b"" for t in docs.column("text").cast(pa.binary()).to_pylist()]
        rest.append(docs.column("row"))
        answers += batch.filter(pa.compute.invert(is_text)).select(_TELL.names[1:]).to_pylist()
    answers.sort(key=lambda r: r["bucket"])
    return texts, rest, answers


def _looked_up(t: Tokens, answers: list[dict], kept: bool, ends: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each token, its bigram and its context."""
    names = ("kept_words", "kept_pairs") if kept else ("words", "pairs")
    word, pair = (np.concatenate([counted(r[n]) for r in answers]) for n in names)
    # A word is a context as often as it is a token; a start is one as often as there are texts.
    return word[t.word], pair[t.pair], np.concatenate([word, [ends]])[t.context]


def _events(totals: dict[str, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Held-out tokens as counts of (bucket, ratios)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, _, answers = _told(batches)
        if not texts:
            return
        t = Tokens(texts)
        bucket, parts = estimates(*_looked_up(t, answers, True, totals["kept_ends"]), totals["kept_n"], totals["kept_v"])
        with np.errstate(divide="ignore"):
            ratio = np.clip(np.round(STEPS * np.log2(parts[:, 1:] / parts[:, :1])), -_LIMIT, _LIMIT).astype(np.int64)
        code = (bucket * 2000 + ratio[:, 0] + 1000) * 2000 + ratio[:, 1] + 1000
        found, count = np.unique(code, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count)], names=["code", "n"])

    return run


def _scored(totals: dict[str, int], mixture: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema_of = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, rows, answers = _told(batches)
        if not texts:
            return
        t, n, v = Tokens(texts), totals["n"], totals["v"]
        word, pair, context = _looked_up(t, answers, False, totals["ends"])
        score = np.empty(len(word))
        for low in range(0, len(word), 1 << 18):
            cut = slice(low, low + (1 << 18))
            bucket, parts = estimates(word[cut], pair[cut], context[cut], n, v)
            score[cut] = np.log10((parts * held(mixture)[bucket]).sum(axis=1))
        base = np.log10((word + 0.1) / (n + 0.1 * (v + 1)))
        at = t.first[:-1]
        columns = [np.diff(t.first), np.add.reduceat((word > 0).astype(np.int64), at), np.full(len(texts), n), np.add.reduceat(base, at), np.add.reduceat(score, at)]
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(rows), *(pa.array(c, k) for c, (_, k) in zip(columns, schema_of, strict=True))], names=["row", *(x for x, _ in schema_of)])

    return run


def score(docs: DataFrame, learns: Column, deleted: Column, text: str = "text") -> DataFrame:
    """`docs` with n_tokens, n_known, train_tokens, base_score and score (log10 of the probability).

    `learns` marks training texts, `deleted` those of them on which the weights are learned.
    base_score adds 0.1 to every word's count and knows no context.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(least, -(-size // CHUNK_BYTES))
    spare = -(-chunks // 9)
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in added])
    learns, deleted = F.coalesce(learns, F.lit(False)), F.coalesce(learns & deleted, F.lit(False))
    spread = F.xxhash64(row, F.col(f"`{text}`"))
    chunk = F.when(deleted, chunks + F.pmod(spread, F.lit(spare))).otherwise(F.pmod(spread, F.lit(chunks))).cast("int")
    parts = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text"), learns.alias("learns"), deleted.alias("deleted"), chunk.alias("chunk"))
    whole = chunks + spare
    asked = parts.select("text", "learns", "deleted", "chunk").repartitionById(whole, "chunk").mapInArrow(_ask(chunks), _ASK_DDL)
    told = stored(asked.repartitionById(chunks, "bucket").mapInArrow(_tell, _TELL_DDL), "told")
    totals = dict.fromkeys(_TOTALS, 0)
    for r in told.filter("chunk = -1").select("words").toLocalIterator():
        for name, value in zip(_TOTALS, np.frombuffer(r["words"], dtype="<u8"), strict=True):
            totals[name] += int(value)

    def with_answers(part: DataFrame, of: DataFrame) -> DataFrame:
        left = part.select("chunk", F.lit(True).alias("is_text"), "row", "text", *[F.lit(None).cast(t).alias(n) for n, t in told.dtypes if n != "chunk"])
        right = of.select("chunk", F.lit(False).alias("is_text"), F.lit(None).cast(part.schema["row"].dataType).alias("row"), F.lit(None).cast("string").alias("text"), *[n for n in told.columns if n != "chunk"])
        return left.unionByName(right).repartitionById(whole, "chunk")

    events = with_answers(parts.filter("deleted"), told.filter(F.col("chunk") >= chunks)).mapInArrow(_events(totals), "code long, n long")
    found = np.array([(r["code"], r["n"]) for r in events.groupBy("code").agg(F.sum("n").alias("n")).toLocalIterator()], dtype=np.int64).reshape(-1, 2)
    code, ratio = found[:, 0], np.ones((len(found), 3))
    ratio[:, 1], ratio[:, 2] = (np.where(r <= -_LIMIT, 0.0, 2.0 ** (r / STEPS)) for r in (code // 2000 % 2000 - 1000, code % 2000 - 1000))
    mixture = share(spark, learn(code // 4_000_000, ratio, found[:, 1].astype(np.float64)))
    shape = parts.schema["row"].dataType.simpleString()
    done = with_answers(parts, told.filter(F.col("chunk") >= 0)).mapInArrow(
        _scored(totals, mixture), f"row {shape}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return done.select("row.*", *added)
