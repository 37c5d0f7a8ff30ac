"""Landing, manifests, batches, RAW verification."""

from __future__ import annotations

import csv
import hashlib
import json
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import ingest_queries, ingestion
from ledgerloom.plans.ingest_queries import content_hash
from ledgerloom.plans.model import Model
from ledgerloom.sources import batches, landing, manifest
from ledgerloom.sources.commerce import ENTITIES
from tests.golden import BATCH, golden_raw

TEXT = "id bigint, note string, amount decimal(18,2)"


def test_csv_landing(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        b'\xef\xbb\xbfid,note,amount\n1,"two\nlines, ""quoted""",1.50\n2,NA,\n3,plain,2.00\n'
    )
    (tmp_path / "b.csv").write_text('id,note,amount\n4,null,3.00\n5,"NaN",4.00\n6,None of it,5.00\n')
    rows = landing.land(spark, str(tmp_path), TEXT, "batch", "2026-01-01 00:00:00").collect()
    got = {r.id: (r.note, r._source_file, r._file_row_number) for r in rows}
    assert got == {
        1: ('two\nlines, "quoted"', "a.csv", 1), 2: (None, "a.csv", 2), 3: ("plain", "a.csv", 3),
        4: (None, "b.csv", 1), 5: (None, "b.csv", 2), 6: ("None of it", "b.csv", 3),
    }
    assert {r._batch_id for r in rows} == {"batch"}


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount,note\n1,2.00,x\n")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        landing.land(spark, str(tmp_path), TEXT, "b", "2026-01-01 00:00:00").collect()


def tangled_csv(path, seed, rows, end="\n"):
    """A CSV file with quotes, commas and line ends inside values, blank lines between records, and stray quotes."""
    rng = random.Random(seed)
    bits = ["plain", 'say ""hi""', ",", "\n", "\n\n", '""', 'x" y'.replace('"', '""'), "é✓", " ", ',""', "\n,", '"",""']
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(f"id,note,amount{end}")
        for k in range(1, rows + 1):
            kind = rng.randrange(6)
            if kind == 0:
                note = f'5" disk {k}'  # a quote that opens nothing
            elif kind == 1:
                note = f"word {k}"
            else:
                note = '"' + "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) + '"'
            f.write(f"{k},{note},{k}.25{end}" + (end if rng.random() < 0.1 else ""))


@pytest.mark.parametrize(("end", "size"), [("\n", 700), ("\r\n", 3000), ("\n", 1 << 20)])
def test_quoted_csv_is_split(spark, tmp_path, end, size):
    """Records that cross the borders of blocks come out as Python's own reader has them, and are numbered through."""
    for k in range(2):
        tangled_csv(tmp_path / f"f{k}.csv", 10 * k + size, 900, end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = landing.read_csv(spark, str(tmp_path), "id bigint, note string, amount decimal(18,2)")
        found = {(r._source_file, r._file_row_number): (r.id, r.note, str(r.amount)) for r in rows.collect()}
        blocks = landing.scan_lines(spark, str(tmp_path)).select("path", "block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert blocks >= 2 if size == 1 << 20 else blocks > 10
    want = {}
    for k in range(2):
        with open(tmp_path / f"f{k}.csv", encoding="utf-8", newline="") as f:
            for number, row in enumerate((r for r in csv.reader(f) if r), 0):
                if number:
                    want[f"f{k}.csv", number] = (int(row[0]), None if row[1] in landing.NA_TOKENS else row[1], row[2])
    assert found == want and len(found) == 1800


def test_lines_stay_with_the_task_that_reads_them(spark, tmp_path):
    """Judging lines neither moves nor sorts them: a written file holds what one task has read, in the order of the file."""
    tangled_csv(tmp_path / "f.csv", 3, 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = landing.scan_lines(spark, str(tmp_path))
        found = lines.select(F.input_file_name().alias("f"), F.shiftright("line", 33).alias("task"), "line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    tasks = {r.f: [x.task for x in found if x.f == r.f] for r in found}
    assert len(tasks) > 10 and all(len(set(t)) == 1 for t in tasks.values())
    assert len({t[0] for t in tasks.values()}) == len(tasks)
    assert all([x.line for x in found if x.f == f] == sorted(x.line for x in found if x.f == f) for f in tasks)


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_states_go_on_from_batch_to_batch(spark, tmp_path, rows):
    """States and numbers within a block do not depend on how its lines are handed to Python; small files share a task."""
    for k in range(4):
        tangled_csv(tmp_path / f"f{k}.csv", 50 + k, 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        lines = landing.scan_lines(spark, str(tmp_path)).orderBy("file", "block", "line").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    place, state, begun = None, [], []
    for r in lines:
        if (r.file, r.block) != place:
            place, state, begun = (r.file, r.block), [0, 1], [0, 0]
        begun = [n + (s == 0 and r.value != "") for n, s in zip(begun, state)]
        assert ([r.before0, r.before1], [r.n0, r.n1]) == (state, begun)
        state = [r.inside if s else r.outside for s in state]
    assert len({r.file for r in lines}) == 4 and {r.before0 for r in lines} == {0, 1}


def test_csv_is_scanned_once(spark, tmp_path):
    tangled_csv(tmp_path / "f.csv", 1, 50)
    plan = landing.land(spark, str(tmp_path), TEXT, "b", "2026-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and "FileScan text" not in plan


def test_open_quote_at_the_end_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,amount\n1,"never closed,2.00\n2,x,3.00\n')
    with pytest.raises(Exception, match="not closed"):
        landing.land(spark, str(tmp_path), TEXT, "b", "2026-01-01 00:00:00").collect()


def test_files_of_any_size_are_hashed(spark, tmp_path, monkeypatch):
    """Files above the limit of what Spark reads as one value, which is lowered here."""
    monkeypatch.setattr(manifest, "BLOCK_BYTES", 1000)
    folder = tmp_path / "source" / "big.csv"
    folder.mkdir(parents=True)
    parts = {f"part-{k}.csv": random.Random(k).randbytes(k) for k in (1, 999, 1000, 250_000)}
    for name, data in parts.items():
        (folder / name).write_bytes(data)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        row = manifest.dataset_files(spark, str(tmp_path / "source")).first()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    each = sorted(hashlib.sha256(d).hexdigest() for d in parts.values())
    assert (row.file_name, row.size_bytes, row.sha256) == ("big.csv", 252_000, hashlib.sha256("|".join(each).encode()).hexdigest())


def test_batch_is_written_in_one_pass(spark, tmp_path):
    """The source is computed once, whether its batch is new, known or in conflict."""
    source, seen = str(tmp_path / "source"), []
    spark.range(2000).selectExpr("id", "cast(id as string) as text").write.parquet(source)
    for change in ("true", "true", "id < 1999"):
        read = spark.sparkContext.accumulator(0)
        count = F.udf(lambda x, read=read: read.add(1) or x, "long")
        rows = spark.read.parquet(source).filter(change).withColumn("id", count("id"))
        seen.append((batches.write_batch_once(rows, str(tmp_path / "batch")), read.value))
    assert seen == [(batches.CREATED, 2000), (batches.IDENTICAL_REPLAY, 2000), (batches.CONFLICT, 1999)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["batch", "source"]
    # A batch that died half-way is written again.
    (tmp_path / "batch" / "_SUCCESS").unlink()
    assert batches.write_batch_once(spark.range(5), str(tmp_path / "batch")) == batches.CREATED
    assert spark.read.parquet(str(tmp_path / "batch")).count() == 5


def test_content_hash_sees_every_digit(spark):
    def known(*values):
        rows = spark.createDataFrame([values], "a string, b string, x double, d decimal(18,2)")
        return content_hash(rows).first().s

    base = ("p", "q", -23.54562, Decimal("1.00"))
    others = [
        ("p", "q", -23.54563, Decimal("1.00")), ("p", "q", float(np.nextafter(-23.54562, 0)), Decimal("1.00")), ("p", "q", 1e300, Decimal("1.00")),
        ("p", "q", -23.54562, Decimal("1.01")), ("p1=q", "", -23.54562, Decimal("1.00")), ("", "pq", -23.54562, Decimal("1.00")),
        ("p", None, -23.54562, Decimal("1.00")), ("p", "-", -23.54562, Decimal("1.00")), ("p", "q", None, Decimal("1.00")), ("p", "q", float("nan"), Decimal("1.00")),
        ("p", "q", 1e-30, Decimal("1.00")), ("p", "q", 2e-30, Decimal("1.00")),
    ]
    assert len({known(*v) for v in [base, *others]}) == len(others) + 1 and known(*base) == known(*base)


def test_publish_is_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "landing")
    landing.publish(spark, {"one": spark.range(3)}, target)
    broken = spark.range(1).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        landing.publish(spark, {"one": spark.range(9), "two": broken}, target)
    assert spark.read.parquet(f"{target}/one").count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["landing"]
    landing.publish(spark, {"one": spark.range(5)}, target)
    assert spark.read.parquet(f"{target}/one").count() == 5


def test_manifest(spark, tmp_path):
    source = tmp_path / "source" / "a.csv"
    source.mkdir(parents=True)
    (source / "part.csv").write_text("id\n1\n")
    files = manifest.dataset_files(spark, str(tmp_path / "source"))
    row = files.first()
    part = hashlib.sha256(b"id\n1\n").hexdigest()
    assert (row.file_name, row.size_bytes, row.sha256) == ("a.csv", 5, hashlib.sha256(part.encode()).hexdigest())
    listed = {"file_name": "a.csv", "size_bytes": 5, "sha256": row.sha256, "data_rows": 1, "column_count": 1, "columns": ["id"]}
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"manifest_version": 1, "files": [listed]}, indent=1))
    entries = manifest.read_manifest(spark, str(path))
    assert manifest.manifest_contract(entries, ["a.csv"]).count() == 0
    assert manifest.file_inventory(entries, files).count() == 0
    assert manifest.file_integrity(entries, files).filter("size_ok and sha256_ok").count() == 1
    bad = entries.withColumns({"sha256": F.lit("zz"), "data_rows": F.lit(0).cast("bigint")})
    assert {r.issue for r in manifest.manifest_contract(bad, ["a.csv"]).collect()} == {"invalid_data_rows", "invalid_sha256"}
    assert {r.issue for r in manifest.manifest_contract(entries, ["b.csv"]).collect()} == {"missing_file", "unexpected_file"}


def test_files_are_hashed_side_by_side(spark, tmp_path):
    for i in range(8):
        (tmp_path / f"{i}.csv").write_text(str(i))
    files = spark.createDataFrame([(f"file://{tmp_path}/{i}.csv",) for i in range(8)], "path string")
    rows = manifest.hashed_files(files).select("path", "sha256", F.spark_partition_id().alias("task")).collect()
    assert {r.sha256 for r in rows} == {hashlib.sha256(str(i).encode()).hexdigest() for i in range(8)}
    assert len({r.task for r in rows}) > 1


def test_lines_stay_where_they_are(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id\n1\n"2\n3"\n')
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = landing.csv_records(spark, str(tmp_path))
        assert "SortMergeJoin" not in records._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.number, r.record) for r in records.collect()) == [(1, "id"), (2, "1"), (3, '"2\n3"')]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_export_counts_what_it_writes(spark, monkeypatch):
    raw = golden_raw(spark)
    raw["sellers"] = raw["sellers"].limit(0)
    monkeypatch.setattr(ingest_queries, "raw_entities", lambda *_: raw.__getitem__)
    monkeypatch.setattr(ingest_queries, "ENTITIES", ("translation", "sellers"))
    monkeypatch.setattr(ingest_queries.landing, "land", lambda spark, path, *_: spark.range(1))
    found = ingest_queries.export_source(spark, "golden")
    ingest_queries._landed.clear()
    rows = {r.file_name: (r.data_rows, r.column_count) for r in manifest.read_manifest(spark, found.manifest).collect()}
    assert rows["translation.csv"] == (2, 2)
    assert rows.get("sellers.csv", (0, 4)) == (0, 4)


def test_batch_id(spark):
    entries = spark.createDataFrame([("b.csv", "22"), ("a.csv", "11")], "file_name string, sha256 string")
    digest = hashlib.sha256(b"a.csv:11|b.csv:22").hexdigest()
    assert manifest.deterministic_batch_id(entries, "p_").first().batch_id == "p_" + digest[:16]


def test_write_once(spark, tmp_path):
    path = batches.batch_path(str(tmp_path), "dev", "shop", "orders")
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    assert batches.write_batch_once(df, path) == batches.CREATED
    assert batches.write_batch_once(df.orderBy(F.desc("k")).coalesce(1), path) == batches.IDENTICAL_REPLAY
    assert batches.write_batch_once(df.distinct(), path) == batches.CONFLICT
    swapped = spark.createDataFrame([(1, None), (2, "a"), (2, None)], "k int, v string")
    assert batches.write_batch_once(swapped, path) == batches.CONFLICT
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        batches.batch_path("x", "../dev", "shop", "orders")
    with pytest.raises(ValueError):
        batches.require_date("2026-1-1")


def test_ledger_needs_its_fields(spark, tmp_path):
    good = spark.sql("select timestamp_ntz'2026-01-01' event_time, 'W' operation, 'CREATED' outcome, 'd' dataset, 'b' batch_id, 'f' fingerprint")
    batches.append_events(good, str(tmp_path / "ledger"))
    with pytest.raises(ValueError, match="Ledger"):
        batches.append_events(good.withColumn("batch_id", F.lit(" ")), str(tmp_path / "ledger"))
    assert batches.read_ledger(spark, str(tmp_path / "ledger")).count() == 1


@pytest.fixture(scope="module")
def raw(spark):
    return golden_raw(spark)


def _expected(raw):
    return ingestion.batch_profile(raw).select("entity", F.col("rows").alias("expected_rows"))


@pytest.mark.parametrize("damage, reason", [
    (lambda t: t, "RAW_BATCH_VERIFIED"),
    (lambda t: {k: v for k, v in t.items() if k != "orders"}, "TABLE_MISSING:orders"),
    (lambda t: {**t, "sellers": t["sellers"].drop("_batch_id")}, "BATCH_COLUMN_MISSING:sellers"),
    (lambda t: {**t, "payments": t["payments"].limit(2)}, "ROW_COUNT_MISMATCH:payments"),
    (lambda t: {**t, "reviews": t["reviews"].withColumn("_batch_id", F.lit(None).cast("string"))}, "NULL_BATCH_ID:reviews"),
    (lambda t: {**t, "reviews": t["reviews"].withColumn("_batch_id", F.lit("other")), "orders": t["orders"].limit(1)},
     "BATCH_MISMATCH:reviews"),
])
def test_verify_raw_batch(spark, raw, damage, reason):
    verified = ingestion.verify_raw_batch(spark, damage(raw), _expected(raw), BATCH, ENTITIES)
    row = ingestion.batch_verdict(verified).first()
    assert row.reason == reason and row.verified == (reason == "RAW_BATCH_VERIFIED")


def test_batch_uniformity(raw):
    assert ingestion.batch_uniformity(raw).filter("problem is not null").count() == 0
    mixed = {**raw, "orders": raw["orders"].withColumn("_batch_id", F.when(F.col("order_id") == "O1", "x").otherwise("y"))}
    problems = {r.entity: r.problem for r in ingestion.batch_uniformity(mixed).filter("problem is not null").collect()}
    assert problems == {"orders": "several_batch_ids", "__all__": "several_batch_ids"}
    empty = {**raw, "orders": raw["orders"].limit(0)}
    assert ingestion.batch_uniformity(empty).filter("problem = 'empty'").count() == 1


def test_csv_to_marts(spark, tmp_path):
    """RAW tables written as CSV, landed and staged give the same mart."""
    raw = golden_raw(spark)
    lineage = ["_source_file", "_file_row_number", "_loaded_at", "_batch_id"]
    for entity in ENTITIES:
        landing.write_csv(raw[entity].drop(*lineage), str(tmp_path / entity))
    landed = {e: landing.land(spark, str(tmp_path / e), landing.RAW_SCHEMAS[e], "b", "2026-01-01 00:00:00") for e in ENTITIES}
    landing.publish(spark, landed, str(tmp_path / "landing"))
    report = {r.entity: (r.rows, r.source_columns, r.output_columns) for r in landing.landing_report(spark, str(tmp_path / "landing")).collect()}
    assert report["orders"] == (7, 8, 12)
    m = Model(lambda n: spark.read.parquet(str(tmp_path / "landing" / n)))
    months = {str(r.purchase_month): str(r.gross_order_value) for r in m["monthly_revenue"].collect()}
    assert months == {"2025-01-01": "165.00", "2025-02-01": "22.00", "2025-03-01": "33.00", "2025-04-01": "44.00"}
