"""Phrase collocations against brute force, with edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=30, longest=4, top=2000, cover=80):
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for size in range(1, longest + 1):
                own.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in f.items():
        kept = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, longer in kept.items():
            inner = {p[i:i + size] for size in range(2, len(p)) for i in range(len(p) - size + 1)}
            covered |= {q for q in inner if 100 * longer >= cover * kept[q]}
        found = []
        for p, a in kept.items():
            if p not in covered:
                score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(seed, count):
    rng = random.Random(seed)
    heads = ["new york city", "Ärger im büro", "a b a b a b", "of the", "naïve ✓ bayes", "x x x x x x"]
    rows = []
    for _ in range(count):
        words = []
        while len(words) < 40:
            words += rng.choice(heads).split() if rng.random() < 0.4 else [f"w{int(rng.paretovariate(0.6)) % 300}"]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "\x85 ", "\xa0", "; "]) for w in words)
        rows.append((text.upper() if rng.random() < 0.1 else text, rng.choice(["en", "de", None, "und", "é"])))
    return rows + [(None, "en"), ("", None), (" \t .;", "fr"), ("word", "fr"), ("New York " * 4000, "en"), ("z" * 30_000, "de")] + rows[:10]


def got(df):
    return sorted(tuple(r) for r in df.collect())


COLUMNS = "text string, lang string"


@pytest.mark.parametrize(("part_bytes", "held", "dense", "options"), [
    (1 << 40, 1 << 22, 256, {}),
    (20_000, 50, 1, {"least": 5, "top": 40, "cover": 60}),
    (40_000, 500, 1 << 40, {"least": 3, "longest": 6, "cover": 101}),
    (1 << 40, 1 << 22, 4, {"least": 2, "longest": 2}),
])
def test_collocations(spark, monkeypatch, part_bytes, held, dense, options):
    for name, value in (("PART_BYTES", part_bytes), ("HELD", held), ("DENSE", dense)):
        monkeypatch.setattr(phrases, name, value)
    rows = made(1, 300)
    docs = spark.createDataFrame([(*r, 1) for r in rows], f"{COLUMNS}, rank int").repartition(5)
    found = phrases.collocations(docs, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got(found) == plain(rows, **options) and found.count() > 20


@pytest.mark.parametrize("rows", [[], [(None, None)], [("a b. c d", "en")] * 29])
def test_nothing_frequent(spark, rows):
    assert got(phrases.collocations(spark.createDataFrame(rows, COLUMNS))) == []


def test_query(spark, tmp_path):
    rows = made(2, 60)
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert got(queries.op11_phrase_collocations(spark, str(tmp_path))) == plain(rows)


@pytest.mark.parametrize("dense", [1, 40, 1 << 40])
def test_tally(monkeypatch, dense):
    monkeypatch.setattr(phrases, "DENSE", dense)
    rng = np.random.default_rng(dense % 7)
    left, right = ((rng.pareto(0.5, 20_000) * 20).astype(np.int64) % (1 << 30) for _ in range(2))
    weights = rng.integers(1, 1000, 20_000)
    for own in (None, weights):
        keys, sums = phrases.tally(left, right, own)
        want = Counter()
        for a, b, w in zip(left.tolist(), right.tolist(), [1] * 20_000 if own is None else own.tolist(), strict=True):
            want[a << 32 | b] += w
        assert dict(zip(keys.tolist(), sums.tolist(), strict=True)) == want and len(keys) == len(want)


def test_too_many_phrases_raise():
    with pytest.raises(OverflowError):
        phrases.checked(np.array([1 << 31]))
