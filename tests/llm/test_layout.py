"""Sharding and fill-in-the-middle against brute force, with edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import infill, queries, sharding
from tests.llm.brute import corpus

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = ["", " ", "\t\n", "one", " one", "one ", " é ü\x0b", "漢字 かな\n😀 x", "😀😀😀", "a<P>b c", "x <S> y", "<M>", "end <", "S> <P", "a\x00b \x85c\xa0d", "wörd " * 3000]


def rows():
    rng = random.Random(2)
    letters = "ab é漢😀 \t\n<PSM>"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(400)]
    own = list(enumerate(TEXTS + made + TEXTS * 3)) + corpus()
    return own + [(None, None), (None, "a b c"), (7, "漢字 かな\n😀 x")]


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1.0)))
    return b


def shard(doc_id, shards):
    return jump(int(hashlib.md5(("" if doc_id is None else f"={doc_id}").encode()).hexdigest()[:16], 16), shards)


@pytest.mark.parametrize("shards", [1, 2, 8, 1000])
def test_jump(shards):
    keys = np.random.default_rng(shards).integers(0, 2**64, 2000, dtype=np.uint64)
    assert list(sharding.jump(keys, shards)) == [jump(int(k), shards) for k in keys]
    moved = sharding.jump(keys, shards + 1) != sharding.jump(keys, shards)
    assert set(sharding.jump(keys, shards + 1)[moved]) <= {shards} and abs(moved.mean() - 1 / (shards + 1)) < 0.03


@pytest.mark.parametrize(("parts", "file_bytes"), [(1, 1 << 28), (5, 2000)])
def test_shards(spark, tmp_path, monkeypatch, parts, file_bytes):
    monkeypatch.setattr(sharding, "FILE_BYTES", file_bytes)
    docs = spark.createDataFrame([(*r, 1, 2, "p") for r in rows()], "doc_id long, text string, slot int, file int, `_metadata` string").repartition(parts)
    done = sharding.write_shards(docs, str(tmp_path / "out"), 8)
    assert done.columns == ["doc_id", "text", "file", "_metadata", "grown_shard", "shard", "slot"]
    found = done.collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(rows(), key=repr)
    slots = {}
    for r in found:
        assert (r.shard, r.grown_shard) == (shard(r.doc_id, 8), shard(r.doc_id, 9)) and (r.file, r["_metadata"]) == (2, "p")
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8


def test_one_key_fills_many_pieces(spark, tmp_path):
    docs = spark.range(3000).repartition(12).select(F.lit(5).alias("doc_id"), F.lit("same").alias("text"))
    found = sharding.write_shards(docs, str(tmp_path / "out"), 1)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        many = sharding.write_shards(docs, str(tmp_path / "many"), 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sorted(r.slot for r in found.collect()) == sorted(r.slot for r in many.collect()) == list(range(3000))
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "many")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 3 and max(sizes) <= 1500


def test_no_rows_to_shard(spark, tmp_path):
    found = sharding.write_shards(spark.createDataFrame([], "doc_id string, text string"), str(tmp_path / "out"), 3)
    assert found.collect() == [] and found.columns == ["doc_id", "text", "grown_shard", "shard", "slot"]


def test_sharding_query(spark, tmp_path):
    spark.createDataFrame(rows(), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op12_sharding(spark, str(tmp_path)).collect()
    plain = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", shard(i, 8), shard(i, 9)) for i, t in rows()]
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in found), key=repr) == sorted(plain, key=repr)


def infilled(doc_id, text, unit):
    h = [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    text = text or ""
    units = UNIT.findall(text) if unit == "words" else list(text)
    n = len(units)
    low, high = sorted(x % (n + 1) for x in h[:2])
    a, b, c = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    return (n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}") if h[3] % 100 < 80 else (n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}")


@pytest.mark.parametrize("unit", ["words", "chars"])
def test_infill(spark, unit):
    docs = spark.createDataFrame([(*r, "kept", 3) for r in rows()], "doc_id long, text string, extra string, FORM int").repartition(3)
    done = infill.fill_in_middle(docs, unit=unit).withColumn("back", infill.restore(F.col("infilled"), F.col("form")))
    assert done.columns == ["doc_id", "text", "extra", *infill.ADDED.names, "back"]
    found = done.collect()
    assert all(r.back == (r.text or "") and r.extra == "kept" for r in found)
    plain = sorted(((i, *infilled(i, t, unit)) for i, t in rows()), key=repr)
    assert sorted(((r.doc_id, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.infilled) for r in found), key=repr) == plain
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_infill_of_nothing(spark):
    found = infill.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"))
    assert found.collect() == []
    with pytest.raises(ValueError, match="unit"):
        infill.fill_in_middle(found.select("doc_id", F.lit("x").alias("text")), unit="bytes")


def test_exceptions():
    text = "".join(random.Random(1).choice("aé漢😀 ") for _ in range(500))
    index = infill.Exceptions(np.frombuffer(text.encode(), dtype=np.uint8))
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:k].encode()) for k in chars])
    assert (index.to_bytes(chars) == cuts).all() and (index.to_chars(cuts) == chars).all()
    assert len(index.at) == sum(ord(c) > 127 for c in text)
