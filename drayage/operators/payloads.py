"""Cutting payloads into numbered chunks, checking them and putting them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_SIZE = 50_000
SEGMENT_BYTES = 64 << 20
# A Spark row holds less than 2 GiB; the content of longer payloads comes in segments.
ROW_BYTES = 1 << 30


def manifest(blobs: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """One row per payload: how many chunks it has and how long it is."""
    size = F.octet_length("content").cast("long")
    return blobs.select(
        "blob_id",
        F.ceil(size / chunk_size).alias("num_chunks"),
        size.alias("size"),
        F.lit(chunk_size).cast("long").alias("chunk_size"),
    )


def chunk_payload(blobs: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Cut ``content`` into chunks numbered from 0; an empty payload has none.

    Scan, explode and substring share one generated stage, so a payload is read
    once however many chunks it has, and nothing is shuffled.
    """
    count = F.ceil(F.octet_length("content") / chunk_size).cast("int")
    # sequence(0, -1) would count down, hence the guard.
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return blobs.select("blob_id", "content", F.explode(numbers).alias("i")).select(
        "blob_id",
        "i",
        F.substring("content", F.col("i") * chunk_size + 1, F.lit(chunk_size)).alias("chunk"),
    )


def _differ(chunk: str) -> Column:
    """Whether the values grouped are not all the same."""
    return F.min(F.xxhash64(chunk)) != F.max(F.xxhash64(chunk))


def verify_chunks(chunks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Compare the chunks present with the manifest, one row per payload.

    The first of these that applies is the status: ``surplus`` (a chunk outside the manifest's
    range), ``missing``, ``conflict`` (copies of a chunk that differ, by a 64-bit hash),
    ``duplicate``, ``size_mismatch``, ``ok``.

    Counted per (payload, index) before per payload, so a payload with very many
    or very often repeated chunks is spread over all tasks.
    """
    per_index = chunks.groupBy("blob_id", "i").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max(F.octet_length("chunk")).cast("long").alias("bytes"),
        _differ("chunk").alias("differ"),
    )
    present = per_index.groupBy("blob_id").agg(
        F.sum("copies").alias("rows_seen"),
        F.count(F.lit(1)).alias("chunks_seen"),
        F.min("i").alias("lo"),
        F.max("i").alias("hi"),
        F.sum("bytes").alias("bytes_seen"),
        F.bool_or("differ").alias("differ"),
    )
    joined = manifest.join(present, "blob_id", "left").na.fill(
        0, ["rows_seen", "chunks_seen", "bytes_seen"]
    )
    complete = (F.col("chunks_seen") == F.col("num_chunks")) & (
        (F.col("num_chunks") == 0)
        | ((F.col("lo") == 0) & (F.col("hi") == F.col("num_chunks") - 1))
    )
    status = (
        F.when((F.col("lo") < 0) | (F.col("hi") >= F.col("num_chunks")), "surplus")
        .when(~complete, "missing")
        .when(F.col("differ"), "conflict")
        .when(F.col("rows_seen") > F.col("chunks_seen"), "duplicate")
        .when(F.col("bytes_seen") != F.col("size"), "size_mismatch")
        .otherwise("ok")
    )
    return joined.select(
        "blob_id", "num_chunks", "size", "rows_seen", "chunks_seen", "bytes_seen",
        status.alias("status"),
    )


def assemble_chunks(chunks: DataFrame, manifest: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    """Put the chunks of each payload together in index order, one row per payload.

    The status is that of :func:`verify_chunks`, by one rule for any length. Content is there
    for payloads that are ``ok`` and fit a row; longer ones come whole from
    :func:`assemble_segments`.
    """
    checked = verify_chunks(chunks, manifest).select("blob_id", "num_chunks", "size", "status")
    due = checked.filter((F.col("status") == "ok") & F.col("size").between(1, row_bytes)).select("blob_id")
    joined = chunks.join(due, "blob_id").groupBy("blob_id").agg(
        F.expr("listagg(chunk) WITHIN GROUP (ORDER BY i)").alias("joined")
    )
    empty = (F.col("status") == "ok") & (F.col("size") == 0)
    return checked.join(joined, "blob_id", "left").select(
        "blob_id", "num_chunks", "status", F.when(empty, F.lit(b"")).otherwise(F.col("joined")).alias("content")
    )


def assemble_segments(
    chunks: DataFrame, manifest: DataFrame, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Put chunks together into numbered segments of bounded size, each with a status.

    Works for payloads of any length: the segments of one payload, in order, are its bytes,
    and they are built by as many tasks as there are segments. An empty payload is one empty
    segment. Of a chunk delivered more than once one copy counts, and the segment is a
    ``duplicate``; ``missing`` and ``size_mismatch`` say that it is not what the manifest
    tells, ``conflict`` that copies of a chunk differ, and ``surplus``, on all segments of a payload,
    that it has chunks outside the manifest's range. Content is null unless ``ok``, or ``duplicate`` and of the right length. The
    bytes of the chunks are shuffled once.
    """
    planned = manifest.withColumn(
        "per", F.greatest(F.lit(1), F.floor(F.lit(segment_bytes) / F.col("chunk_size"))).cast("long")
    )
    first, last = F.col("segment") * F.col("per"), (F.col("segment") + 1) * F.col("per")
    count = F.greatest(F.ceil(F.col("num_chunks") / F.col("per")), F.lit(1))
    expected = planned.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).select(
        "blob_id", "segment",
        (F.least(last, "num_chunks") - first).alias("due"),
        (F.least(last * F.col("chunk_size"), "size") - first * F.col("chunk_size")).alias("due_bytes"),
    )
    inside = (F.col("i") >= 0) & (F.col("i") < F.col("num_chunks"))
    sized = chunks.join(planned.select("blob_id", "per", "num_chunks"), "blob_id").filter(inside)
    ranges = chunks.groupBy("blob_id").agg(F.min("i").alias("lo"), F.max("i").alias("hi")).join(planned.select("blob_id", "num_chunks"), "blob_id")
    beyond = ranges.filter((F.col("lo") < 0) | (F.col("hi") >= F.col("num_chunks"))).select("blob_id", F.lit(True).alias("beyond"))
    dealt = sized.select("blob_id", F.floor(F.col("i") / F.col("per")).alias("segment"), "i", "chunk").repartition(
        "blob_id", "segment"
    )
    once = dealt.groupBy("blob_id", "segment", "i").agg(
        F.count(F.lit(1)).alias("copies"), F.first("chunk").alias("chunk"), _differ("chunk").alias("differ")
    )
    built = once.groupBy("blob_id", "segment").agg(
        F.expr("listagg(chunk) WITHIN GROUP (ORDER BY i)").alias("content"),
        F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"), F.bool_or("differ").alias("differ"),
    )
    content = F.coalesce("content", F.lit(b""))
    right = F.octet_length(content) == F.col("due_bytes")
    status = (
        F.when(F.col("beyond"), "surplus")
        .when(F.coalesce("n", F.lit(0)) != F.col("due"), "missing")
        .when(F.col("differ"), "conflict")
        .when(F.coalesce("copies", F.lit(0)) > F.col("due"), "duplicate")
        .when(~right, "size_mismatch")
        .otherwise("ok")
    )
    return expected.join(built, ["blob_id", "segment"], "left").join(beyond, "blob_id", "left").select(
        "blob_id", "segment", status.alias("status"),
        F.when(status.isin("ok", "duplicate") & right, content).alias("content"),
    )


def segments_digest(digests: Column) -> Column:
    """Digest of a payload from those of its segments in order: that of its only segment, or of all
    of them joined, as for uploads in parts."""
    return F.when(F.size(digests) == 1, digests[0]).otherwise(F.md5(F.array_join(digests, "")))


def upload_progress(chunks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Share and bytes of the payload sent once each chunk is.

    Index and manifest say both, so no window has to order the chunks.
    """
    sent = F.col("i") + 1
    return chunks.select("blob_id", "i").join(manifest, "blob_id").select(
        "blob_id",
        "i",
        (sent / F.col("num_chunks")).alias("progress"),
        F.least(sent * F.col("chunk_size"), F.col("size")).alias("bytes_sent"),
    )
