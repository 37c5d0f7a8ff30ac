"""Operators on documents against brute force, with edge cases."""

from __future__ import annotations

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import bpe, common, jaccard, language, mixing, queries, scoring, substring
from tests.llm.brute import corpus, jaccard as plain_jaccard, jaccard_roots, prose, repeats, words

SCHEMA = "doc_id long, text string"
WORD_BPE = os.path.join(queries.TOKENIZERS, queries.VOCABULARY)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus())


@pytest.mark.parametrize("long_list", [64, 3])
def test_jaccard(docs, monkeypatch, long_list):
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    found = jaccard.near_duplicates(docs)
    assert got(found, "doc_id", "n_shingles", "component_id") == plain_jaccard(corpus())


@pytest.mark.parametrize(("few", "tile"), [(32, 1024), (2, 8), (0, 4)])
def test_jaccard_random(spark, monkeypatch, few, tile):
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng, rows = random.Random(3), []
    for k in range(300):
        text = list(rng.choice(rows)[1].split()) if rows and rng.random() < 0.7 else [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice("abcdefgh")
        rows.append((k, " ".join(text)))
    assert got(jaccard.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == plain_jaccard(rows)


def test_keep_one(spark):
    rows = [(i, t, "x", "s") for i, t in corpus()]
    kept = jaccard.keep_one(frame(spark, rows, "doc_id long, text string, `group` string, at string"))
    assert set(kept.columns) == {"doc_id", "text", "group", "at"}
    assert kept.count() == len(set(jaccard_roots(corpus())[1]))


@pytest.mark.parametrize("window", [35, 4])
def test_substring(docs, window):
    found = substring.remove_repeats(docs, window)
    assert got(found, "doc_id", "n_words", "n_removed", "kept_text") == repeats(corpus(), window)


def test_substring_keeps_clashing_columns(spark):
    rows = [(1, "a b", "k", 5), (2, None, None, None)]
    found = substring.remove_repeats(frame(spark, rows, "doc_id long, text string, `key` string, spans int"))
    assert got(found, "doc_id", "key", "spans", "kept_text") == [(1, "k", 5, "a b"), (2, None, None, "")]


def test_components(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, rng.randrange(500, 900)) for _ in range(200)] + [(3, 3), (1, 2), (2, 1)]
    found = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(found[k] == 100 for k in range(100, 161)) and found[2] == found[1] == 1
    assert {found[b] for a, b in edges if a == 7} == {7} and 3 not in found


def test_bpe(spark):
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(WORD_BPE)
    rng = random.Random(4)
    letters = "abcdefgh ABC'sΣςİß☃éÅ漢字١½\x1c\x85 <|>*&%\t\n"
    rows = corpus() + [(k, "".join(rng.choice(letters) for _ in range(rng.randrange(30)))) for k in range(1000, 1400)]
    rows += [(2000, "a<|endoftext|>B <|startoftext|> <|EndOfText|>"), (2001, "Å é"), (2002, "it's I'LL we've")]
    found = bpe.tokenize(frame(spark, [(*r, "i") for r in rows], "doc_id long, text string, IDS string"), WORD_BPE)
    want = []
    for i, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, dtype="<u4").tobytes(), plain.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in found.collect()), key=repr) == sorted(want, key=repr)


def test_bpe_memory_has_a_bound(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 8)
    encoder = bpe.Encoder(bpe.Tables(WORD_BPE))
    text = " ".join(f"word{k} other{k}" for k in range(200))
    first = encoder.ids(text)
    assert encoder.ids(text) == first and len(encoder.runs) <= 8


def sentences(seed, count):
    rng = random.Random(seed)
    tongues = {"aa": "the and ing ion ent ough".split(), "bb": "der und sch keit ung ein".split(), "cc": "que les eau ment tion oir".split()}
    for k in range(count):
        lang = rng.choice(sorted(tongues))
        yield k, " ".join("".join(rng.choice(tongues[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 40))), lang


def test_language(spark):
    rows = list(sentences(1, 400))
    model = language.fit(frame(spark, [*((t, g) for _, t, g in rows[:200]), (None, "aa"), ("no label", None), ("123", "zz")], "text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    extra = [(900, None, "aa"), (901, "", None), (902, "12 !? ٣", "bb"), (903, "x" * 100_000, None)]
    found = {r.doc_id: r for r in language.predict(frame(spark, rows[200:] + extra, "doc_id long, text string, score string"), model).collect()}
    assert sum(found[k].lang_pred == g for k, _, g in rows[200:]) >= 198
    assert all((found[k].lang_pred, found[k].score) == ("und", 0.0) for k in (900, 901, 902)) and found[903].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_flags_mixed_and_random_texts(spark):
    rng = random.Random(5)
    known = list(sentences(3, 1500))
    said = {g: " ".join(t for _, t, h in known[1000:] if h == g).split() for g in ("aa", "bb", "cc")}
    model = language.fit(frame(spark, [(t, g) for _, t, g in known[:1000]], "text string, lang string"))

    def piece(g, n):
        at = rng.randrange(len(said[g]) - n)
        return " ".join(said[g][at:at + n])

    rows = []
    for n in (20, 100, 400):
        for k in range(60):
            a, b = rng.sample(sorted(said), 2)
            rows.append((f"clean {n}", piece(a, n), a))
            rows.append((f"mixed {n}", f"{piece(a, n)} {piece(b, n)}", None))
            rows.append((f"random {n}", " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n)), None))
    flagged, score = Counter(), {}
    for r in language.predict(frame(spark, rows, "kind string, text string, lang string"), model).collect():
        flagged[r.kind] += r.ambiguous
        score.setdefault(r.kind, []).append(r.score)
        assert r.lang in (None, r.lang_pred)
    for n in (20, 100, 400):
        assert flagged[f"clean {n}"] == 0 and flagged[f"mixed {n}"] >= 57 and flagged[f"random {n}"] >= 57
    assert abs(np.median(score["clean 20"]) - np.median(score["clean 400"])) < 0.05


@pytest.mark.parametrize("labels", [[], ["aa"]])
def test_language_with_few_labels(spark, labels):
    model = language.fit(frame(spark, [("some text", x) for x in labels], "text string, lang string"))
    found = language.predict(frame(spark, [(1, "a text"), (2, "")]), model)
    assert got(found, "doc_id", "lang_pred") == [(1, labels[0] if labels else "und"), (2, "und")]


@pytest.mark.parametrize("languages", [2, 3, 5, 12])
def test_codebook(languages):
    code = language.codebook(languages)
    apart = [(code[a] != code[b]).sum() for a in range(languages) for b in range(a)]
    assert min(apart) >= 1 + code.shape[1] // 4 and set(np.unique(code)) == {-1, 1}


def fold(i, folds):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds


def test_scores(spark):
    rows = corpus()
    docs = frame(spark, [(*r, 1.5) for r in rows], "doc_id long, text string, score double").withColumn("held_out", queries.fold("doc_id", 10) == 0)
    found = scoring.score(docs, ~F.col("held_out"), queries.fold("doc_id", 10) == 1).collect()
    tokens = [[w.lower() for w in words(t)] + [None] for _, t in rows]
    count = Counter(w for (i, _), own in zip(rows, tokens, strict=True) if fold(i, 10) for w in own)
    n, v = sum(count.values()), len(count)
    want = sorted((repr(i), len(own), sum(count[w] > 0 for w in own), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)) for (i, _), own in zip(rows, tokens, strict=True))
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def plain_scores(rows):
    """Deleted interpolation without hashes, chunks or rounded ratios."""
    tokens = [[None, *(w.lower() for w in words(t)), 0] for _, t in rows]  # None starts, 0 ends
    folds = [fold(i, 10) for i, _ in rows]

    def counts(part):
        pair = Counter(p for own in part for p in zip(own, own[1:], strict=False))
        word = Counter(w for own in part for w in own[1:])
        return word, pair, {**word, None: len(part)}

    def parts(known, v, w):
        word, pair, context = known
        c = context.get(v, 0)
        return (c.bit_length(), [1 / (len(word) + 1), word[w] / max(sum(word.values()), 1), pair[v, w] / c if c else 0.0])

    kept = counts([t for t, f in zip(tokens, folds, strict=True) if f > 1])
    seen = {}
    for own, f in zip(tokens, folds, strict=True):
        if f == 1:
            for v, w in zip(own, own[1:], strict=False):
                bucket, p = parts(kept, v, w)
                seen.setdefault(bucket, []).append(p)
    mixture = {}
    for bucket, events in seen.items():
        weights, events = np.array([0.1, 0.9, 0.0] if bucket == 0 else scoring.DEFAULT), np.array(events)
        for _ in range(scoring.ROUNDS):
            share = events * weights
            weights = np.maximum((share / share.sum(axis=1, keepdims=True)).mean(axis=0), (1e-6, 0, 0))
            weights /= weights.sum()
        mixture[bucket] = weights
    whole = counts([t for t, f in zip(tokens, folds, strict=True) if f > 0])
    out = []
    for own in tokens:
        found = [parts(whole, v, w) for v, w in zip(own, own[1:], strict=False)]
        out.append(sum(math.log10(np.dot(mixture.get(b, (0.1, 0.9, 0.0) if b == 0 else scoring.DEFAULT), p)) for b, p in found))
    return out


@pytest.mark.parametrize("chunk", [scoring.CHUNK_BYTES, 5_000])
def test_model_score(spark, monkeypatch, chunk):
    """Steps of an eighth of a doubling in the weights' events move a score by a hundredth at most. Texts may be longer than a chunk."""
    monkeypatch.setattr(scoring, "CHUNK_BYTES", chunk)
    rows = [r for r in corpus() if r[0] is not None and r[0] != 301]
    rows += [(1000 + k, " ".join(prose(k, 60, 40))) for k in range(150)]
    docs = frame(spark, [(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, at long")
    found = scoring.score(docs, queries.fold("doc_id", 10) != 0, queries.fold("doc_id", 10) == 1)
    score = {r["at"]: r["score"] for r in found.collect()}
    want = plain_scores(rows)
    assert all(abs(score[k] - w) <= 0.01 * abs(w) for k, w in enumerate(want))


def test_scores_sum_to_one():
    rng = np.random.default_rng(1)
    word = rng.integers(1, 50, 20)
    n, v, context = int(word.sum()), 20, 40
    pair = np.bincount(rng.integers(0, 20, context), minlength=20)
    bucket, parts = scoring.estimates(word, pair, np.full(20, context), n, v)
    mixture = scoring.learn(bucket, parts, np.ones(20))
    p = (parts * mixture[bucket]).sum(axis=1).sum() + mixture[bucket[0], 0] / (v + 1)
    assert abs(p - 1) < 1e-12 and mixture[bucket[0]].sum() == pytest.approx(1)


def test_scores_without_training(spark):
    found = scoring.score(frame(spark, [(1, "a b"), (2, None)]), F.lit(False), F.lit(None).cast("boolean")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]



@pytest.mark.parametrize("mean", [0.0, 0.3, 2.5, 60.0, 200.0])
def test_poisson_draws(spark, mean):
    strands = max(1, math.ceil(mean / mixing.STRAND))
    part = F.lit(mean / strands)
    draws = spark.range(4000).select(sum((mixing.draw(mixing.poisson_table(part), mixing.uniform("t", F.lit(k), F.col("id"))) for k in range(strands)), F.lit(0)).alias("k"))
    row = draws.agg(F.avg("k").alias("m"), F.var_samp("k").alias("v")).first()
    assert abs(row.m - mean) <= 5 * math.sqrt(mean / 4000) and abs(row.v - mean) <= 0.15 * mean + 1e-9


def test_mixing(spark):
    rows = [(k, "abcd " * (1 + k % 5), "big" if k % 3 else ("small" if k % 2 else None), k) for k in range(3000)] + [(5000, None, "empty", 1), (1, "abcd abcd ", "big", 1)]
    docs = frame(spark, rows, "doc_id long, text string, source string, size long")
    weights = {"big": 1, "small": 2, None: 1, "absent": 7}
    mixed = mixing.mix(docs, weights).cache()
    chars = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    total = sum(len(t or "") for _, t, _, _ in rows)
    assert set(chars) == {"big", "small", None}
    for name, share in (("big", 0.25), ("small", 0.5), (None, 0.25)):
        assert abs(chars[name] / total - share) < 0.06
    assert mixed.groupBy("doc_id", "text").agg(F.count("*").alias("n"), F.max("n_copies").alias("c")).filter("n % c <> 0").isEmpty()
    assert mixed.columns == ["doc_id", "text", "source", "size", "n_copies", "copy_no", "shuffle_key"]
    again = mixing.mix(docs.repartition(5), weights)
    assert mixed.select("doc_id", "copy_no", "shuffle_key").exceptAll(again.select("doc_id", "copy_no", "shuffle_key")).isEmpty()
    with pytest.raises(ValueError):
        mixing.mix(docs, {"big": -1})


def test_mixing_is_native(spark):
    plan = mixing.mix(frame(spark, [(1, "a", "s")], "doc_id long, text string, source string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("ExistingRDD", "") and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_tables(spark):
    none = frame(spark, [], "doc_id long, text string, lang string, source string, n_chars long")
    assert jaccard.near_duplicates(none).count() == 0 and jaccard.keep_one(none).count() == 0
    assert substring.remove_repeats(none).count() == 0 and mixing.mix(none).count() == 0
    assert bpe.tokenize(none, WORD_BPE).count() == 0
    assert language.predict(none, language.fit(none)).count() == 0
    assert scoring.score(none, F.lit(True), F.lit(False)).count() == 0


def test_pipeline(spark, tmp_path):
    rows = [(k, t, g, f"s{k % 3}", len(t)) for k, t, g in sentences(2, 150)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(500, rows[0][1], rows[0][2], "s1", 0), (501, None, None, "s2", None), (502, "42", "aa", None, 2)]
    rows += [(600 + k, f"{rows[k][1]} {passage}", rows[k][2], "s0", 9) for k in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, str(tmp_path)), "stage")
        seen[name] = docs
        if name != "bpe":
            assert set(docs.columns) == set(corpus_pipeline.COLUMNS)
    first = {r.doc_id for r in seen["language_id"].collect()}
    assert not first & {501, 502} and len(first) >= 150
    kept = {r.doc_id: r.text for r in seen["ngram_jaccard_join"].collect()}
    low = plain_jaccard([(i, t) for i, t, *_ in rows if i in first])
    assert set(kept) == {i for i, n, c in low if i == c}
    texts = {r.doc_id: r.text for r in seen["substring_dedup"].collect()}
    for i, n, gone, rest in repeats(list(kept.items())):
        assert texts.get(i) == (None if gone == n else rest if gone else kept[i])
    assert {r.doc_id for r in seen["source_mixing"].collect()} <= set(texts)
    assert seen["bpe"].count() == seen["source_mixing"].count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["bpe"].count()


def test_pipeline_passes_further_columns(spark, tmp_path):
    further = ("url", "Score", "n_words", "kept_text", "copy_no")
    rows = [(k, t, g, f"s{k % 3}", len(t), f"u{k}", f"score {k}", -k, f"kept {k}", k + 0.5) for k, t, g in sentences(2, 60)]
    docs = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, url string, Score string, n_words long, kept_text string, copy_no double")
    want = {r[0]: r[5:] for r in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == [*corpus_pipeline.COLUMNS, *further], name
        found = docs.select("doc_id", *further).collect()
        assert found and all(tuple(r)[1:] == want[r.doc_id] for r in found), name


def test_mixing_query_shuffles_whole_documents(spark, tmp_path):
    rows = [(k, t, g, f"s{k % 3}", len(t)) for k, t, g in sentences(2, 60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    returned = queries.op10_source_mixing(spark, str(tmp_path))
    mixture = spark.read.parquet(*returned.inputFiles())
    assert mixture.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_copies", "copy_no", "shuffle_key"]
    assert got(mixture, *returned.columns) == got(returned, *returned.columns)
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r.doc_id] == r.text for r in mixture.collect())


def test_held_out_languages(spark):
    """Whole documents of the given tables that the model hasn't learned from."""
    sf_dir = "/root/testdata/sf0.001"
    if not os.path.exists(sf_dir):
        pytest.skip("no given tables here")
    said = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = [r for r in queries.op7_language_id(spark, sf_dir).collect() if r.held_out and said[r.doc_id] is not None and r.lang_pred != "und"]
    right = [r.lang_pred == said[r.doc_id] for r in found]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right) and sum(r.ambiguous for r in found) <= 0.05 * len(found) + 1


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.collect() == [] and "ids" in done.columns
