import os

import pytest
from pyspark.sql import functions as F

from drayage.operators import payloads
from drayage.sources import payload_files
from drayage.plans import upload


@pytest.fixture(scope="module")
def blobs(spark):
    data = [(1, b""), (2, b"x"), (3, b"a" * 1024 * 4), (4, os.urandom(4096)), (5, os.urandom(5000))]
    return spark.createDataFrame(data, "blob_id long, content binary").cache()


def test_chunk_counts(blobs, rows):
    chunks = payloads.chunk_payload(blobs, 1024)
    counts = {r[0]: r[1] for r in chunks.groupBy("blob_id").count().collect()}
    assert counts == {2: 1, 3: 4, 4: 4, 5: 5}
    assert rows(payloads.manifest(blobs, 1024).select("blob_id", "num_chunks")) == [
        (1, 0), (2, 1), (3, 4), (4, 4), (5, 5)
    ]


def test_round_trip_keeps_empty_payloads(blobs, rows):
    whole = payloads.assemble_chunks(
        payloads.chunk_payload(blobs, 1024), payloads.manifest(blobs, 1024)
    )
    assert rows(whole.select("blob_id", "content")) == rows(blobs)
    assert {r.status for r in whole.collect()} == {"ok"}


def test_faults_are_told_apart(blobs):
    chunks = payloads.chunk_payload(blobs, 1024)
    broken = (
        chunks.filter("NOT (blob_id = 3 AND i = 2)")
        .unionByName(chunks.filter("blob_id = 4 AND i = 1"))
        .withColumn("chunk", F.when(F.col("blob_id") == 2, F.lit(b"xx")).otherwise(F.col("chunk")))
    )
    plan = payloads.manifest(blobs, 1024)
    expected = {1: "ok", 2: "size_mismatch", 3: "missing", 4: "duplicate", 5: "ok"}
    assert {r.blob_id: r.status for r in payloads.verify_chunks(broken, plan).collect()} == expected
    whole = payloads.assemble_chunks(broken, plan).collect()
    assert {r.blob_id: r.status for r in whole} == expected
    assert all((r.content is None) == (r.status != "ok") for r in whole)


def test_payloads_too_large_for_a_row_come_in_segments(blobs):
    chunks, plan = payloads.chunk_payload(blobs, 1024), payloads.manifest(blobs, 1024)
    whole = payloads.assemble_chunks(chunks, plan, row_bytes=4500).collect()
    assert {r.status for r in whole} == {"ok"}
    assert [r.blob_id for r in whole if r.content is None] == [5]
    twice = chunks.unionByName(chunks.filter("i = 1"))
    segments = payloads.assemble_segments(twice, plan, 2048).orderBy("blob_id", "segment").collect()
    content = {r.blob_id: bytes(r.content) for r in blobs.collect()}
    assert all(len(r.content) <= 2048 for r in segments)
    assert {r.status for r in segments if r.segment == 0 and r.blob_id > 2} == {"duplicate"}
    for key in (1, 2, 3, 4, 5):
        assert b"".join(bytes(r.content) for r in segments if r.blob_id == key) == content[key]


def test_progress_is_told_after_each_chunk(blobs, rows):
    chunks, plan = payloads.chunk_payload(blobs, 1024), payloads.manifest(blobs, 1024)
    progress = payloads.upload_progress(chunks, plan)
    assert rows(progress.filter("blob_id = 4").select("progress", "bytes_sent")) == [
        (0.25, 1024), (0.5, 2048), (0.75, 3072), (1.0, 4096)
    ]
    assert progress.filter("blob_id = 5 AND i = 4").first().bytes_sent == 5000


def test_chunking_stays_in_one_generated_stage_without_shuffle(blobs):
    plan = payloads.chunk_payload(blobs, 1024)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "*(1) Generate" in plan


def test_segments_tell_what_is_wrong_with_them(blobs):
    chunks, plan = payloads.chunk_payload(blobs, 1024), payloads.manifest(blobs, 1024)
    broken = chunks.filter("NOT (blob_id = 3 AND i = 2)").withColumn(
        "chunk", F.when((F.col("blob_id") == 5) & (F.col("i") == 4), F.lit(b"short")).otherwise(F.col("chunk"))
    )
    found = {(r.blob_id, r.segment): (r.status, r.content) for r in payloads.assemble_segments(broken, plan, 2048).collect()}
    assert found[3, 1] == ("missing", None) and found[3, 0][0] == "ok"
    assert found[5, 2] == ("size_mismatch", None) and found[1, 0] == ("ok", b"")
    assert len(found) == 1 + 1 + 2 + 2 + 3


def test_audit_of_payloads_longer_than_a_segment(blobs):
    found = upload.upload_audit(blobs, 1024, 2048).collect()
    assert {(r.status, r.intact) for r in found} == {("ok", True)} and len(found) == 5


def _plan(spark, rows):
    return spark.createDataFrame(rows, "blob_id string, num_chunks long, size long, dest_path string, mode int")


def test_payloads_are_published_together_or_not_at_all(spark, tmp_path):
    target = str(tmp_path / "out")
    chunks = spark.createDataFrame(
        [("a", 1, b"cd"), ("a", 0, b"ab"), ("a", 0, b"ab"), ("a", 2, b"e"), ("b", 0, b"x"), ("z", 0, b"unlisted")],
        "blob_id string, i int, chunk binary")
    good = [("a", 3, 5, "deep/er/a.bin", 0o600), ("b", 1, 1, "b.bin", None), ("e", 0, 0, "empty", 0o640)]
    payload_files.write_payloads(chunks, _plan(spark, good), target)
    files = {str(p.relative_to(target)): p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert files == {"deep/er/a.bin": b"abcde", "b.bin": b"x", "empty": b""}
    assert (tmp_path / "out/deep/er/a.bin").stat().st_mode & 0o777 == 0o600

    for fault in (("b", 2, 2, "b.bin", None), ("b", 1, 2, "b.bin", None), ("a", 2, 4, "b.bin", None), ("b", 1, 1, "../b", None)):
        with pytest.raises(Exception, match="at fault"):
            payload_files.write_payloads(chunks, _plan(spark, [good[2], fault]), target)
        assert {p.name for p in tmp_path.iterdir()} == {"out"}  # the old tree stays, nothing staged is left
        assert (tmp_path / "out/deep/er/a.bin").read_bytes() == b"abcde"
    payload_files.write_payloads(chunks, _plan(spark, [good[2], ("b", 2, 2, "b.bin", None)]), target, strict=False)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["empty"]
    with pytest.raises(ValueError, match="several"):
        payload_files.write_payloads(chunks, _plan(spark, [good[1], ("a", 3, 5, "b.bin", None)]), target)


def test_copies_that_differ_and_chunks_beyond_the_manifest(spark):
    chunks = spark.createDataFrame(
        [("a", 0, b"xx"), ("a", 0, b"yy"), ("b", 0, b"xx"), ("b", 1, b"x"), ("c", 0, b"xx"), ("c", 0, b"xx")],
        "blob_id string, i int, chunk binary")
    plan = spark.createDataFrame([(b, 1, 2, 2) for b in "abc"], "blob_id string, num_chunks long, size long, chunk_size long")
    wanted = {"a": "conflict", "b": "surplus", "c": "duplicate"}
    assert {r.blob_id: r.status for r in payloads.verify_chunks(chunks, plan).collect()} == wanted
    segments = payloads.assemble_segments(chunks, plan).collect()
    assert {r.blob_id: r.status for r in segments} == wanted
    assert {r.blob_id: r.content for r in segments} == {"a": None, "b": None, "c": b"xx"}
