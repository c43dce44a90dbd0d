"""Queries over payloads, trees and archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.catalog import fixtures as fx
from drayage.catalog.registry import query
from drayage.functions import names
from drayage.operators import payloads, trees
from drayage.plans import upload
from drayage.session import workspace
from drayage.sources import archives, files, payload_files
from drayage.sources.tables import table


@query(f"""WITH {fx.BLOBS_SQL}
SELECT blob_id, num_chunks, 'ok' AS status, md5(unhex(h)) AS digest, true AS intact FROM blobs""")
def upload_audit(spark: SparkSession, folder: str) -> DataFrame:
    return upload.upload_audit(fx.blobs(spark, folder), fx.CHUNK)


@query(f"""WITH {fx.BLOBS_SQL}
SELECT blob_id, i, octet_length(chunk) AS n_bytes, md5(chunk) AS digest FROM chunks""")
def chunk_payload(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.chunk_payload(fx.blobs(spark, folder), fx.CHUNK).select(
        "blob_id",
        F.col("i").cast("long").alias("i"),
        F.octet_length("chunk").cast("long").alias("n_bytes"),
        F.md5("chunk").alias("digest"),
    )


@query(f"""WITH {fx.BLOBS_SQL}
SELECT blob_id, num_chunks, 'ok' AS status, size AS n_bytes, md5(unhex(h)) AS digest FROM blobs""")
def assemble_chunks(spark: SparkSession, folder: str) -> DataFrame:
    blobs = fx.blobs(spark, folder)
    whole = payloads.assemble_chunks(
        payloads.chunk_payload(blobs, fx.CHUNK), payloads.manifest(blobs, fx.CHUNK)
    )
    return whole.select(
        "blob_id", "num_chunks", "status",
        F.octet_length("content").cast("long").alias("n_bytes"),
        F.md5("content").alias("digest"),
    )


@query(f"""WITH {fx.BLOBS_SQL}
SELECT blob_id, segment, octet_length(content) AS n_bytes, md5(content) AS digest
FROM (SELECT blob_id, segment, unhex(substr(h, segment * 32768 + 1, 32768)) AS content
      FROM blobs, unnest(range(0, CAST(ceil(size / 16384.0) AS BIGINT))) AS t(segment))""")
def assemble_segments(spark: SparkSession, folder: str) -> DataFrame:
    blobs = fx.blobs(spark, folder)
    chunks = payloads.chunk_payload(blobs, fx.CHUNK)
    return payloads.assemble_segments(chunks, payloads.manifest(blobs, fx.CHUNK), 4 * fx.CHUNK).select(
        "blob_id", "segment",
        F.octet_length("content").cast("long").alias("n_bytes"),
        F.md5("content").alias("digest"),
    )


@query(f"""WITH {fx.BLOBS_SQL},
arrived AS (SELECT c.* FROM chunks c JOIN documents d ON d.doc_id = c.blob_id
            WHERE NOT (d.lang = 'de' AND c.i = 1)
            UNION ALL
            SELECT c.* FROM chunks c JOIN documents d ON d.doc_id = c.blob_id
            WHERE d.lang = 'es' AND c.i = 0),
per_index AS (SELECT blob_id, i, count(*) AS copies, max(octet_length(chunk)) AS n
              FROM arrived GROUP BY 1, 2),
present AS (SELECT blob_id, CAST(sum(copies) AS BIGINT) AS rows_seen, count(*) AS chunks_seen,
                   CAST(sum(n) AS BIGINT) AS bytes_seen FROM per_index GROUP BY 1)
SELECT blob_id, num_chunks, size, coalesce(rows_seen, 0) AS rows_seen,
       coalesce(chunks_seen, 0) AS chunks_seen, coalesce(bytes_seen, 0) AS bytes_seen,
       CASE WHEN coalesce(chunks_seen, 0) <> num_chunks THEN 'missing'
            WHEN rows_seen > chunks_seen THEN 'duplicate'
            WHEN bytes_seen <> size THEN 'size_mismatch' ELSE 'ok' END AS status
FROM blobs LEFT JOIN present USING (blob_id)""")
def verify_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """German payloads lose their second chunk, Spanish ones get their first one twice."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("blob_id"), "lang", F.col("text").cast("binary").alias("content")
    )
    lang = docs.select("blob_id", "lang")
    chunks = payloads.chunk_payload(docs, fx.CHUNK).join(lang, "blob_id")
    copies = (
        F.when((F.col("lang") == "de") & (F.col("i") == 1), 0)
        .when((F.col("lang") == "es") & (F.col("i") == 0), 2)
        .otherwise(1)
    )
    arrived = chunks.select(
        "blob_id", "i", "chunk", F.explode(F.array_repeat(F.lit(1), copies)).alias("copy")
    ).drop("copy")
    return payloads.verify_chunks(arrived, payloads.manifest(docs, fx.CHUNK))


def _arrived(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The manifest, and chunks of which German payloads lack the second, Spanish ones have the first
    twice, French ones one beyond the last, and English ones of src1 a first in two forms."""
    docs = table(spark, folder, "documents")
    blobs = docs.select(F.col("doc_id").alias("blob_id"), F.col("text").cast("binary").alias("content"))
    plan = payloads.manifest(blobs, fx.CHUNK)
    kinds = docs.select(F.col("doc_id").alias("blob_id"), "lang", "source")
    chunks = payloads.chunk_payload(blobs, fx.CHUNK).join(kinds, "blob_id").join(plan.select("blob_id", "num_chunks"), "blob_id")
    chunks = chunks.filter("NOT (lang = 'de' AND i = 1)")
    odd = chunks.filter("i = 0").select(
        "blob_id", F.when(F.col("lang") == "fr", F.col("num_chunks")).otherwise(F.lit(0)).cast("int").alias("i"),
        F.when((F.col("lang") == "en") & (F.col("source") == "src1"), F.lit(b"?")).otherwise(F.col("chunk")).alias("chunk"), "lang", "source",
    ).filter("lang IN ('es', 'fr') OR (lang = 'en' AND source = 'src1')")
    return plan, chunks.select("blob_id", "i", "chunk").unionByName(odd.select("blob_id", "i", "chunk"))


_STATUS_SQL = """CASE WHEN lang = 'fr' AND num_chunks > 0 THEN 'surplus' WHEN lang = 'de' AND num_chunks > 1 THEN 'missing'
            WHEN lang = 'en' AND source = 'src1' AND num_chunks > 0 THEN 'conflict'
            WHEN lang = 'es' AND num_chunks > 0 THEN 'duplicate' ELSE 'ok' END"""


@query(f"""WITH {fx.BLOBS_SQL}
SELECT blob_id, {_STATUS_SQL} AS status FROM blobs JOIN documents ON doc_id = blob_id""")
def verify_faults(spark: SparkSession, folder: str) -> DataFrame:
    plan, chunks = _arrived(spark, folder)
    return payloads.verify_chunks(chunks, plan).select("blob_id", "status")


@query(f"""WITH {fx.BLOBS_SQL},
judged AS (SELECT blob_id, h, size, {_STATUS_SQL} AS status, unnest(range(0, greatest(1, CAST(ceil(size / 16384.0) AS BIGINT)))) AS segment
           FROM blobs JOIN documents ON doc_id = blob_id),
own AS (SELECT *, CASE WHEN segment > 0 AND status <> 'surplus' THEN 'ok' ELSE status END AS said FROM judged)
SELECT blob_id, segment, said AS status,
       CASE WHEN said IN ('ok', 'duplicate') THEN md5(unhex(substr(h, segment * 32768 + 1, 32768))) END AS digest FROM own""")
def assemble_faulty_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Each segment says what is wrong with it; a surplus chunk speaks against all of its payload."""
    plan, chunks = _arrived(spark, folder)
    return payloads.assemble_segments(chunks, plan, 4 * fx.CHUNK).select("blob_id", "segment", "status", F.md5("content").alias("digest"))


@query(f"""WITH {fx.BLOBS_SQL}
SELECT source || '/' || blob_id || '.bin' AS rel_path, size AS length, md5(unhex(h)) AS digest
FROM blobs JOIN documents ON doc_id = blob_id WHERE {_STATUS_SQL} IN ('ok', 'duplicate')""")
def write_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The payloads that came through, read back from the files published for them."""
    plan, chunks = _arrived(spark, folder)
    paths = table(spark, folder, "documents").select(
        F.col("doc_id").alias("blob_id"), F.concat("source", F.lit("/"), "doc_id", F.lit(".bin")).alias("dest_path"), F.lit(0o640).alias("mode")
    )
    target = workspace(spark, "payloads")
    payload_files.write_payloads(chunks, plan.join(paths, "blob_id"), target, strict=False)
    return files.scan_tree(spark, target).select("rel_path", "length", F.md5("content").alias("digest"))


@query(f"""WITH {fx.BLOBS_SQL}
SELECT blob_id, i,
       row_number() OVER w / CAST(count(*) OVER (PARTITION BY blob_id) AS DOUBLE) AS progress,
       CAST(sum(octet_length(chunk)) OVER w AS BIGINT) AS bytes_sent
FROM chunks WINDOW w AS (PARTITION BY blob_id ORDER BY i)""")
def upload_progress(spark: SparkSession, folder: str) -> DataFrame:
    blobs = fx.blobs(spark, folder)
    return payloads.upload_progress(
        payloads.chunk_payload(blobs, fx.CHUNK), payloads.manifest(blobs, fx.CHUNK)
    ).withColumn("i", F.col("i").cast("long"))


_WORD = "lpad(lower(to_hex(CAST(sum(CAST('0x' || substr(e, {at}, 8) AS BIGINT)) % 4294967296 AS BIGINT))), 8, '0')"


@query(f"""WITH {fx.TREE_SQL},
entries AS (SELECT root, text, md5(rel_path || ':' || md5(text)) AS e FROM tree)
SELECT root, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes,
       {" || ".join(_WORD.format(at=at) for at in (1, 9, 17, 25))} AS digest
FROM entries GROUP BY root""")
def tree_digest(spark: SparkSession, folder: str) -> DataFrame:
    return trees.tree_digest(fx.tree(spark, folder))


@query("""WITH src AS (SELECT lang || '/' || doc_id || '.txt' AS rel_path, text FROM documents WHERE lang <> 'es'),
dst AS (SELECT lang || '/' || doc_id || '.txt' AS rel_path,
               CASE WHEN source = 'src3' THEN text || '!' ELSE text END AS text
        FROM documents WHERE lang <> 'de')
SELECT rel_path,
       CASE WHEN d.text IS NULL THEN 'removed' WHEN s.text IS NULL THEN 'added'
            WHEN s.text = d.text THEN 'same' ELSE 'changed' END AS status,
       octet_length(encode(s.text)) AS source_size, octet_length(encode(d.text)) AS target_size
FROM src s FULL JOIN dst d USING (rel_path)""")
def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """The target gains Spanish files, lacks German ones and holds others changed."""
    docs = fx.tree(spark, folder).withColumn("lang", F.substring_index("rel_path", "/", 1))
    changed = F.concat("content", F.lit(b"!"))
    target = docs.filter("lang <> 'de'").withColumn(
        "content", F.when(F.col("root") == "src3", changed).otherwise(F.col("content"))
    )
    return trees.reconcile(
        trees.fingerprint(docs.filter("lang <> 'es'")), trees.fingerprint(target)
    )


@query("SELECT doc_id, '0o' || format('{:o}', n_chars & 4095) AS mode FROM documents")
def mode_octal(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", names.mode_octal(F.col("n_chars")).alias("mode")
    )


@query("""SELECT archive, count(DISTINCT split_part(path, '/', 1)) AS items,
       count(DISTINCT split_part(path, '/', 1)) = 1 AND bool_and(contains(path, '/')) AS valid
FROM (SELECT source || '-' || lang AS archive,
             CASE WHEN n_chars < 300 THEN doc_id || '.txt' ELSE source || '/' || doc_id || '.txt' END AS path
      FROM documents) GROUP BY archive""")
def single_root(spark: SparkSession, folder: str) -> DataFrame:
    entries = table(spark, folder, "documents").select(
        F.concat("source", F.lit("-"), "lang").alias("archive"),
        F.when(F.col("n_chars") < 300, F.concat("doc_id", F.lit(".txt")))
        .otherwise(F.concat("source", F.lit("/"), "doc_id", F.lit(".txt"))).alias("path"),
    )
    return trees.single_root(entries)


@query("""SELECT source, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes
FROM documents GROUP BY source""")
def scan_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Write the documents as text files, one directory per source, and scan them."""
    root = workspace(spark, "tree")
    table(spark, folder, "documents").select("text", "source").write.partitionBy("source").text(root)
    found = files.scan_tree(spark, root, "part-*")
    return found.groupBy(F.regexp_extract("rel_path", "source=([^/]*)/", 1).alias("source")).agg(
        F.sum("length").alias("bytes")
    )


@query("""SELECT o_orderstatus, o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN upper(o_orderpriority) || '*' ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def replace_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Write all orders, then replace the partition of finished ones."""
    target = workspace(spark, "orders")
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderkey", "o_orderpriority")
    files.replace_tree(orders, target, ["o_orderstatus"])
    finished = orders.filter("o_orderstatus = 'F'").withColumn(
        "o_orderpriority", F.concat(F.upper("o_orderpriority"), F.lit("*"))
    )
    files.replace_tree(finished, target, ["o_orderstatus"])
    return spark.read.parquet(target)


@query(f"""WITH {fx.TREE_SQL} SELECT root, count(*) AS entries FROM tree GROUP BY root""")
def pack_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives of at most about 256 KiB, counted per root."""
    packed = archives.pack_archives(fx.tree(spark, folder), part_bytes=256 << 10)
    return packed.groupBy("root").agg(F.sum("entries").alias("entries"))


@query(f"""WITH {fx.TREE_SQL}
SELECT root, rel_path, 384 AS mode, octet_length(encode(text)) AS size, md5(text) AS digest,
       'ok' AS status FROM tree""")
def unpack_archives(spark: SparkSession, folder: str) -> DataFrame:
    packed = archives.pack_archives(fx.tree(spark, folder), part_bytes=256 << 10)
    return archives.unpack_archives(packed.select("root", "content")).select(
        "root", "rel_path", "mode", "size", F.md5("content").alias("digest"), "status"
    )
