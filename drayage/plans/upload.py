"""Moving payloads and trees from end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.operators import payloads, trees
from drayage.sources import archives, files


def upload_audit(
    blobs: DataFrame,
    chunk_size: int = payloads.CHUNK_SIZE,
    segment_bytes: int = payloads.SEGMENT_BYTES,
) -> DataFrame:
    """Cut, check and reassemble payloads; say of each whether it came through unchanged.

    Payloads of any length are judged by the digests of their segments. Their bytes are
    shuffled once, as chunks; the sent side only sends digests.
    """
    plan = payloads.manifest(blobs, chunk_size)
    segments = payloads.assemble_segments(payloads.chunk_payload(blobs, chunk_size), plan, segment_bytes)
    # The first of these that any segment has is that of the payload.
    faults = ["surplus", "missing", "conflict", "duplicate", "size_mismatch"]
    found = [F.max(F.when(F.col("status") == fault, F.lit(fault))) for fault in faults]
    arrived = segments.withColumn("digest", F.md5("content")).groupBy("blob_id").agg(
        F.coalesce(*found, F.lit("ok")).alias("status"),
        F.sort_array(F.collect_list(F.struct("segment", "digest"))).alias("parts"),
    ).select("blob_id", "status", payloads.segments_digest(F.col("parts.digest")).alias("digest"))

    step = max(1, segment_bytes // chunk_size) * chunk_size
    size = F.octet_length("content")
    places = F.sequence(F.lit(0), F.greatest(F.ceil(size / step), F.lit(1)).cast("int") - 1)
    parts = F.transform(places, lambda s: F.md5(F.substring("content", s * step + 1, F.lit(step))))
    sent = blobs.select(
        "blob_id", F.ceil(size / chunk_size).alias("num_chunks"),
        payloads.segments_digest(parts).alias("sent_digest"),
    )
    ok = F.col("status") == "ok"
    return arrived.join(sent, "blob_id").select(
        "blob_id", "num_chunks", "status", F.when(ok, F.col("digest")).alias("digest"),
        (ok & F.col("digest").eqNullSafe(F.col("sent_digest"))).alias("intact"),
    )


def upload_tree(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a directory tree over ``target`` by way of archives.

    The old target stays until all files are there. Returns the comparison of
    the source with what arrived.
    """
    staged = f"{target.rstrip('/')}.staged-{uuid.uuid4().hex}"
    tree = files.scan_tree(spark, source).withColumn("root", F.lit(0))
    arrived = archives.unpack_archives(archives.pack_archives(tree)).filter("status = 'ok'")
    files.write_files(arrived.select("rel_path", "mode", "content"), staged)
    files.swap_in(staged, target)
    return trees.reconcile(
        trees.fingerprint(tree), trees.fingerprint(files.scan_tree(spark, target))
    )
