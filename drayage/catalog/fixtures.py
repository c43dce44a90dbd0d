"""Inputs of the queries, derived from the test tables, and the same in SQL.

Every fixture covers its whole table.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.functions.codec import encode_frame
from drayage.operators import ranking
from drayage.sources.tables import table

CHUNK = 4096
PREFIX = "Frame:b64"
# Rows per task of the queries that show the handling of large keys.
CUT_ROWS = 400

BLOBS_SQL = """
blobs AS (SELECT doc_id AS blob_id, hex(encode(text)) AS h, octet_length(encode(text)) AS size,
                 CAST(ceil(octet_length(encode(text)) / 4096.0) AS BIGINT) AS num_chunks
          FROM documents),
chunks AS (SELECT blob_id, i, unhex(substr(h, i * 8192 + 1, 8192)) AS chunk
           FROM blobs, unnest(range(0, num_chunks)) AS t(i))"""


def blobs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("blob_id"), F.col("text").cast("binary").alias("content")
    )


TREE_SQL = """
tree AS (SELECT source AS root, lang || '/' || doc_id || '.txt' AS rel_path, text
         FROM documents)"""


def tree(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("source").alias("root"),
        F.concat("lang", F.lit("/"), "doc_id", F.lit(".txt")).alias("rel_path"),
        F.col("text").cast("binary").alias("content"),
    )


STATES_SQL = """
states AS (SELECT user_id AS session_id, ts, event_id,
                  CASE event_type WHEN 'signup' THEN 'starting' WHEN 'view' THEN 'busy'
                       WHEN 'click' THEN 'idle' WHEN 'error' THEN 'error' ELSE 'success' END AS state
           FROM events)"""


def states(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("session_id"),
        "ts",
        "event_id",
        F.when(kind == "signup", "starting").when(kind == "view", "busy")
        .when(kind == "click", "idle").when(kind == "error", "error")
        .otherwise("success").alias("state"),
    )


RESPONSES_SQL = """
responses AS (SELECT event_id, user_id, ts,
                     CASE event_type WHEN 'error' THEN 503 WHEN 'click' THEN 429 WHEN 'view' THEN 404
                          WHEN 'purchase' THEN 200 END AS status,
                     event_type = 'signup' AS transport_error
              FROM events)"""


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Request attempts; a transport error has no status."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id", "user_id", "ts",
        F.when(kind == "error", 503).when(kind == "click", 429).when(kind == "view", 404)
        .when(kind == "purchase", 200).alias("status"),
        (kind == "signup").alias("transport_error"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    numbered = ranking.positions(responses(spark, folder), ["user_id"], ["ts", "event_id"], "att")
    return numbered.withColumnRenamed("user_id", "key")


LINES_SQL = """
lines AS (SELECT user_id AS source, event_id AS pos, ts,
                 event_type || ':' || CAST(floor(value / 10) AS BIGINT) AS line
          FROM events)"""


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines; few different texts, so that lines repeat."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("source"),
        F.col("event_id").alias("pos"),
        "ts",
        F.concat("event_type", F.lit(":"), F.floor(F.col("value") / 10)).alias("line"),
    )


SNAPSHOTS_SQL = LINES_SQL + """,
snapshots AS (SELECT source, pos // 1000 + d AS poll, pos, line
              FROM lines, (VALUES (0), (1)) AS t(d))"""


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Rotating pages: each poll shows the last two blocks of 1,000 events."""
    block = F.floor(F.col("pos") / 1000)
    return lines(spark, folder).select(
        "source", F.explode(F.array(block, block + 1)).alias("poll"), "pos", "line"
    )


EXITS_SQL = "exits AS (SELECT c_custkey AS pid, c_nationkey - 12 AS returncode FROM customer)"


def exits(spark: SparkSession, folder: str) -> DataFrame:
    """One process per customer; those without events have no output."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("pid"), (F.col("c_nationkey") - 12).alias("returncode")
    )


FRAMES_SQL = """
frames AS (SELECT conv_id, turn,
                  'Frame:b64 ' || CAST(length(to_base64(encode(text))) + CASE WHEN turn = 1 THEN 1 ELSE 0 END AS VARCHAR)
                  || ' ' || to_base64(encode(text)) || CASE WHEN turn = 2 THEN ' extra' ELSE '' END AS line
           FROM conversations)"""


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """Framed conversation turns; turn 1 states a wrong length and turn 2 has a fourth part."""
    framed = encode_frame(F.col("text").cast("binary"), PREFIX)
    size = F.substring_index(F.substring_index(framed, " ", 2), " ", -1).cast("int")
    body = F.substring_index(framed, " ", -1)
    return table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("turn") == 1, F.concat_ws(" ", F.lit(PREFIX), (size + 1).cast("string"), body))
        .when(F.col("turn") == 2, F.concat_ws(" ", framed, F.lit("extra")))
        .otherwise(framed).alias("line"),
    )


OUTPUT_LINES_SQL = """
output_lines AS (SELECT conv_id AS stmt_id, turn AS pos,
                        CASE WHEN role = 'assistant'
                             THEN 'Frame:b64 ' || length(to_base64(encode(text))) || ' ' || to_base64(encode(text))
                             ELSE 'print ' || md5(text) END AS line
                 FROM conversations)"""


def output_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Statement output: assistant turns are framed values, other turns printed lines."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("stmt_id"),
        F.col("turn").alias("pos"),
        F.when(F.col("role") == "assistant", encode_frame(F.col("text").cast("binary"), PREFIX))
        .otherwise(F.concat(F.lit("print "), F.md5("text"))).alias("line"),
    )


STATEMENTS_SQL = """
statements AS (SELECT event_id AS stmt_id,
                      CASE event_type WHEN 'view' THEN 'running' WHEN 'signup' THEN 'cancelled' ELSE 'available' END AS state,
                      CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS out_status,
                      CASE WHEN event_type = 'click' AND value < 20 THEN NULL ELSE props END AS plain,
                      CASE WHEN event_type = 'error' THEN
                           CASE WHEN value < 10 THEN 'ValueError' WHEN value < 20 THEN 'KeyError'
                                ELSE 'AnalysisError' END END AS ename,
                      CASE WHEN event_type = 'error' THEN props END AS evalue
               FROM events)"""


def statements(spark: SparkSession, folder: str) -> DataFrame:
    """Statement records with the nested output a job server reports."""
    kind, value = F.col("event_type"), F.col("value")
    failed = kind == "error"
    name = F.when(value < 10, "ValueError").when(value < 20, "KeyError").otherwise("AnalysisError")
    mime = F.when((kind == "click") & (value < 20), "image/png").otherwise("text/plain")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("stmt_id"),
        F.when(kind == "view", "running").when(kind == "signup", "cancelled")
        .otherwise("available").alias("state"),
        F.struct(
            F.when(failed, "error").otherwise("ok").alias("status"),
            F.create_map(mime, F.col("props")).alias("data"),
            F.when(failed, name).alias("ename"),
            F.when(failed, F.col("props")).alias("evalue"),
            F.when(failed, F.array(F.lit("first\n"), F.concat("event_type", F.lit("\n"))))
            .alias("traceback"),
        ).alias("output"),
    )


OBJECTS_SQL = """
objects AS (SELECT event_type || '_' || user_id AS name, event_id AS version, props AS value
            FROM events)"""


def objects(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat("event_type", F.lit("_"), "user_id").alias("name"),
        F.col("event_id").alias("version"),
        F.col("props").alias("value"),
    )


LOG_LINES_SQL = """
log_lines AS (SELECT event_id,
                     CASE WHEN event_type = 'error' THEN 'ERROR ' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || ': failed: ' || props
                          WHEN event_type = 'view' THEN 'INFO ' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || ': ' || props
                          WHEN event_type = 'click' THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR) || ': ' || props
                          ELSE 'plain ' || props END AS line,
                     CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'view' THEN 'INFO' END AS level,
                     CASE WHEN event_type IN ('error', 'view') THEN epoch_us(ts)
                          WHEN event_type = 'click' THEN epoch_us(ts) // 1000000 * 1000000 END AS stamped_us,
                     CASE WHEN event_type = 'error' THEN 'failed: ' || props
                          WHEN event_type IN ('view', 'click') THEN props
                          ELSE 'plain ' || props END AS message
              FROM events)"""


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log text in both stamped shapes and in none."""
    kind = F.col("event_type")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "error", F.concat(F.lit("ERROR "), iso, F.lit(": failed: "), "props"))
        .when(kind == "view", F.concat(F.lit("INFO "), iso, F.lit(": "), "props"))
        .when(kind == "click", F.concat(F.unix_seconds("ts"), F.lit(": "), "props"))
        .otherwise(F.concat(F.lit("plain "), "props")).alias("line"),
    )


def write_logs(lines: DataFrame, folder: str) -> None:
    """Add lines to a folder as ``.log`` files, a name Spark's text writer cannot give."""
    lines.select("line").write.mode("append").options(
        extension="log", sep="\u0001", quote="", compression="none"
    ).csv(folder)


class PagedFile:
    """Serves a Parquet file in pages by offset. A process that asks for one page after the other opens
    the file once and decodes each row group once, whatever the length of the pages."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns
        self.file, self.starts, self.group, self.rows = None, [], None, None

    def __getstate__(self) -> dict:
        return {"path": self.path, "columns": self.columns, "file": None, "starts": [], "group": None, "rows": None}

    def __call__(self, offset: int, size: int) -> pa.Table:
        if self.file is None:
            self.file = pq.ParquetFile(self.path)
            meta = self.file.metadata
            self.starts = list(accumulate((meta.row_group(g).num_rows for g in range(meta.num_row_groups)), initial=0))
        served = []
        while size > 0 and offset < self.starts[-1]:
            group = bisect_right(self.starts, offset) - 1
            if group != self.group:
                self.rows = self.file.read_row_group(group, self.columns, use_threads=False)
                self.group = group
            served.append(self.rows.slice(offset - self.starts[group], size))
            offset, size = offset + served[-1].num_rows, size - served[-1].num_rows
        return pa.concat_tables(served) if served else self.file.schema_arrow.empty_table().select(self.columns)
