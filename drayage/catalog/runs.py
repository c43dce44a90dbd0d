"""Queries over statements, requests and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.catalog import fixtures as fx
from drayage.catalog.registry import query
from drayage.functions import classify, codec, maps, names, text
from drayage.operators import objects, outcomes, paging, statements
from drayage.plans import runs
from drayage.sources.tables import table


@query(f"""WITH {fx.FRAMES_SQL}, p AS (SELECT conv_id, turn, string_split(line, ' ') AS parts FROM frames)
SELECT conv_id, turn,
       CASE WHEN len(parts) = 3 THEN CAST(parts[2] AS INTEGER) END AS size,
       CASE WHEN len(parts) = 3 AND CAST(parts[2] AS INTEGER) = length(parts[3])
            THEN md5(from_base64(parts[3])) END AS digest,
       CASE WHEN len(parts) <> 3 THEN 'bad_parts'
            WHEN CAST(parts[2] AS INTEGER) <> length(parts[3]) THEN 'len_mismatch' ELSE 'ok' END AS status
FROM p""")
def parse_frames(spark: SparkSession, folder: str) -> DataFrame:
    parsed = statements.parse_frames(fx.frames(spark, folder), fx.PREFIX)
    return parsed.select("conv_id", "turn", "size", F.md5("data").alias("digest"), "status")


@query("""SELECT conv_id, turn,
       md5('Frame:b64 ' || length(to_base64(encode(text))) || ' ' || to_base64(encode(text))) AS digest,
       true AS round_trip
FROM conversations""")
def encode_frame(spark: SparkSession, folder: str) -> DataFrame:
    data = F.col("text").cast("binary")
    line = codec.encode_frame(data, fx.PREFIX)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.md5(line).alias("digest"),
        (codec.decode_frame(line, fx.PREFIX)["data"] == data).alias("round_trip"),
    )


@query(f"""WITH {fx.OUTPUT_LINES_SQL},
cuts AS (SELECT stmt_id, min(pos) AS cut FROM output_lines WHERE starts_with(line, 'Frame:b64') GROUP BY 1)
SELECT stmt_id, pos, line FROM output_lines LEFT JOIN cuts USING (stmt_id)
WHERE cut IS NULL OR pos < cut""")
def printed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return statements.printed_lines(fx.output_lines(spark, folder), fx.PREFIX)


@query(f"""WITH {fx.OUTPUT_LINES_SQL},
f AS (SELECT stmt_id, min(pos) FILTER (starts_with(line, 'Frame:b64')) AS frame_pos,
             arg_min(line, pos) FILTER (starts_with(line, 'Frame:b64')) AS line
      FROM output_lines GROUP BY 1)
SELECT stmt_id, frame_pos, md5(from_base64(split_part(line, ' ', 3))) AS digest,
       CASE WHEN line IS NULL THEN 'no_frame' ELSE 'ok' END AS status FROM f""")
def first_frame(spark: SparkSession, folder: str) -> DataFrame:
    return statements.first_frame(fx.output_lines(spark, folder), fx.PREFIX).select(
        "stmt_id", "frame_pos", F.md5("data").alias("digest"), "status"
    )


_CLASS_SQL = """CASE WHEN state = 'running' THEN 'pending' WHEN state <> 'available' THEN 'failed'
            WHEN out_status <> 'ok' THEN 'error' WHEN plain IS NULL THEN 'non_textual' ELSE 'ok' END"""


@query(f"""WITH {fx.STATEMENTS_SQL} SELECT stmt_id, {_CLASS_SQL} AS class FROM statements""")
def classify_statement(spark: SparkSession, folder: str) -> DataFrame:
    return fx.statements(spark, folder).select(
        "stmt_id", classify.classify_statement(F.col("state"), F.col("output")).alias("class")
    )


@query(f"""WITH {fx.STATEMENTS_SQL}
SELECT stmt_id, ename, CASE WHEN ename IN ('ValueError', 'KeyError') THEN ename ELSE 'StatementError' END AS error_type
FROM statements WHERE out_status = 'error'""")
def classify_errors(spark: SparkSession, folder: str) -> DataFrame:
    failed = fx.statements(spark, folder).filter("output.status = 'error'")
    return statements.classify_errors(failed.select("stmt_id", "output.ename"))


@query(f"""WITH {fx.STATEMENTS_SQL}
SELECT stmt_id, 'error in statement execution: ' || ename || '(' || evalue || '):' || chr(10)
       || 'first' || chr(10) || 'error' || chr(10) AS message
FROM statements WHERE out_status = 'error'""")
def error_text(spark: SparkSession, folder: str) -> DataFrame:
    failed = fx.statements(spark, folder).filter("output.status = 'error'").select("stmt_id", "output.*")
    return failed.select(
        "stmt_id",
        text.error_text(F.col("ename"), F.col("evalue"), F.col("traceback")).alias("message"),
    )


@query(f"""WITH {fx.STATEMENTS_SQL}, {fx.OUTPUT_LINES_SQL.strip()},
judged AS (SELECT *, {_CLASS_SQL} AS class FROM statements),
vals AS (SELECT stmt_id, count(*) FILTER (starts_with(line, 'Frame:b64')) AS frames,
                arg_min(octet_length(from_base64(split_part(line, ' ', 3))), pos) FILTER (starts_with(line, 'Frame:b64')) AS n
         FROM output_lines GROUP BY 1)
SELECT j.stmt_id, class,
       CASE WHEN class = 'ok' THEN CASE WHEN frames > 0 THEN 'ok' ELSE 'no_frame' END END AS value_status,
       CASE WHEN class = 'ok' THEN n END AS value_bytes,
       CASE WHEN class = 'error' THEN CASE WHEN ename = 'AnalysisError' THEN 'StatementError' ELSE ename END END AS error_type,
       CASE WHEN class = 'error' THEN 'error in statement execution: ' || ename || '(' || evalue || '):'
            || chr(10) || 'first' || chr(10) || 'error' || chr(10) END AS message
FROM judged j LEFT JOIN vals v ON v.stmt_id = j.stmt_id""")
def run_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Statements take the conversation of the same number as their output."""
    return runs.run_audit(
        fx.statements(spark, folder), fx.output_lines(spark, folder), fx.PREFIX
    ).withColumn("value_bytes", F.col("value_bytes").cast("long"))


_RESPONSE_SQL = """CASE WHEN transport_error THEN 'retry' WHEN status < 300 THEN 'ok'
            WHEN status = 429 OR status >= 500 THEN 'retry' ELSE 'fatal' END"""


@query(f"WITH {fx.RESPONSES_SQL} SELECT event_id, {_RESPONSE_SQL} AS class FROM responses")
def classify_response(spark: SparkSession, folder: str) -> DataFrame:
    klass = classify.classify_response(F.col("status"), F.col("transport_error"))
    return fx.responses(spark, folder).select("event_id", klass.alias("class"))


@query(f"""WITH {fx.RESPONSES_SQL},
a AS (SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS att,
             {_RESPONSE_SQL} AS class FROM responses),
m AS (SELECT * FROM a WHERE att <= 4),
t AS (SELECT key, min(CASE WHEN class <> 'retry' THEN att END) AS term, max(att) AS n FROM m GROUP BY 1)
SELECT t.key, coalesce(m.class, CASE WHEN n = 4 THEN 'exhausted' ELSE 'incomplete' END) AS outcome,
       coalesce(term, n) AS used, (coalesce(term, n) - 1) * CAST(0.5 AS DOUBLE) AS slept
FROM t LEFT JOIN m ON m.key = t.key AND m.att = t.term""")
def attempt_outcome(spark: SparkSession, folder: str) -> DataFrame:
    return outcomes.attempt_outcome(fx.attempts(spark, folder), max_tries=4, pause=0.5)


@query("""SELECT c_custkey, key, value FROM (
  SELECT c_custkey, 'content-type' AS key, 'text/' || c_mktsegment AS value FROM customer
  UNION ALL SELECT c_custkey, 'x-nation', c_name FROM customer
  UNION ALL SELECT c_custkey, 'accept', c_mktsegment FROM customer)""")
def merge_headers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    base = F.create_map(
        F.lit("Content-Type"), F.lit("application/json"), F.lit("X-Nation"),
        F.col("c_nationkey").cast("string"), F.lit("Accept"), F.col("c_mktsegment"),
    )
    over = F.create_map(
        F.lit("content-TYPE"), F.concat(F.lit("text/"), "c_mktsegment"),
        F.lit("X-NATION"), F.lit("lost"), F.lit("x-nation"), F.col("c_name"),
    )
    return customer.select("c_custkey", F.explode(maps.merge_headers(base, over)))


@query("""SELECT c_custkey, key, value FROM (
  SELECT c_custkey, 'HOME' AS key, c_name AS value FROM customer
  UNION ALL SELECT c_custkey, 'LANG', c_mktsegment FROM customer WHERE c_acctbal >= 0
  UNION ALL SELECT c_custkey, 'NATION', CAST(c_nationkey AS VARCHAR) FROM customer)""")
def overlay_env(spark: SparkSession, folder: str) -> DataFrame:
    """The overlay deletes TMP always and LANG for customers in debt."""
    customer = table(spark, folder, "customer")
    base = F.create_map(
        F.lit("HOME"), F.lit("/root"), F.lit("LANG"), F.lit("C"), F.lit("TMP"), F.lit("/tmp")
    )
    lang = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    over = F.create_map(
        F.lit("HOME"), F.col("c_name"), F.lit("LANG"), lang,
        F.lit("NATION"), F.col("c_nationkey").cast("string"), F.lit("TMP"), F.lit(None),
    )
    return customer.select("c_custkey", F.explode(maps.overlay_env(base, over)))


@query("""SELECT id, kind, md5(body) AS digest FROM (
  SELECT 'props-' || event_id AS id, 'json' AS kind, props AS body FROM events
  UNION ALL SELECT 'page-' || page_id, 'text', html FROM pages)""")
def decode_body(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.concat(F.lit("props-"), "event_id").alias("id"), F.col("props").cast("binary").alias("body")
    )
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("id"), F.col("html").cast("binary").alias("body")
    )
    decoded = codec.decode_body(F.col("body"))
    return events.unionByName(pages).select("id", decoded.alias("d")).select(
        "id", F.col("d.kind").alias("kind"), F.md5("d.text").alias("digest")
    )


@query("SELECT page_id, rtrim(url, '/') || '/sessions/' || page_id AS joined FROM pages")
def join_url(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id",
        names.join_url(
            F.concat("url", F.lit("//")), F.concat(F.lit("/sessions/"), "page_id")
        ).alias("joined"),
    )


@query("""SELECT page_id, regexp_extract(rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '[^/]*$') AS name
FROM pages""")
def url_basename(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id", names.url_basename(F.col("url")).alias("name")
    )


@query("""WITH n AS (SELECT p_partkey, replace(p_name, ' ', '_') || CASE WHEN p_size < 20 THEN '.tmpl.xml'
        WHEN p_size < 35 THEN '.log' ELSE '.tmpl.conf.tmpl' END AS name FROM part)
SELECT p_partkey, contains(name, '.tmpl') AS is_template, replace(name, '.tmpl', '') AS rendered,
       name LIKE '%.log' AS is_log FROM n""")
def select_named(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    name = F.concat(
        F.replace("p_name", F.lit(" "), F.lit("_")),
        F.when(size < 20, ".tmpl.xml").when(size < 35, ".log").otherwise(".tmpl.conf.tmpl"),
    )
    return table(spark, folder, "part").select("p_partkey", name.alias("name")).select(
        "p_partkey",
        names.is_template(F.col("name")).alias("is_template"),
        names.rendered_name(F.col("name")).alias("rendered"),
        names.matches_glob(F.col("name"), "*.log").alias("is_log"),
    )


@query("""SELECT p_partkey,
       CASE WHEN p_size >= 5 AND p_size <= 45 THEN
         'name=' || p_name || ' cost=100% of ' || CASE WHEN p_retailprice < 1000 THEN 'None' ELSE p_brand END
         || chr(10) || 'size=' || p_size END AS text,
       CASE WHEN p_size < 5 THEN 'missing_key' WHEN p_size > 45 THEN 'unsupported' ELSE 'ok' END AS status
FROM part""")
def render_template(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    template = F.concat(
        F.lit("name=%(NAME)s cost=100%% of %(BRAND)s\nsize=%(SIZE)s"),
        F.when(size < 5, "%(GONE)s").when(size > 45, "%d").otherwise(""),
    )
    env = F.create_map(
        F.lit("NAME"), F.col("p_name"),
        F.lit("BRAND"), F.when(F.col("p_retailprice") >= 1000, F.col("p_brand")),
        F.lit("SIZE"), size.cast("string"),
    )
    rendered = text.render_template(F.col("template"), F.col("env"))
    return (
        table(spark, folder, "part")
        .select("p_partkey", template.alias("template"), env.alias("env"))
        .select("p_partkey", rendered.alias("r"))
        .select("p_partkey", "r.text", "r.status")
    )


@query(f"""WITH {fx.STATES_SQL}
SELECT event_id,
       CASE WHEN state = 'idle' THEN 'done' WHEN state IN ('starting', 'busy') THEN 'wait' ELSE 'bad' END AS ready,
       CASE WHEN state IN ('success', 'error') THEN 'finished' ELSE 'wait' END AS closed,
       CASE WHEN state IN ('success', 'error') THEN 'stopped' ELSE 'live' END AS follow
FROM states""")
def classify_state(spark: SparkSession, folder: str) -> DataFrame:
    return fx.states(spark, folder).select(
        "event_id",
        *[classify.classify_state(F.col("state"), goal).alias(goal) for goal in ("ready", "closed", "follow")],
    )


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN '<unknown>' ELSE c_mktsegment END AS state
FROM customer""")
def with_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of customers in debt are null and BUILDING is blanked."""
    segment = F.col("c_mktsegment")
    value = F.when(F.col("c_acctbal") < 0, None).when(segment == "BUILDING", "").otherwise(segment)
    return table(spark, folder, "customer").select("c_custkey", classify.or_unknown(value).alias("state"))


@query("""SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal < 0 THEN 'dead' ELSE 'idle' END AS state
FROM customer""")
def refresh_record(spark: SparkSession, folder: str) -> DataFrame:
    record = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.lit("starting").alias("state"), F.array("c_mktsegment").alias("log"),
    )
    state = F.when(F.col("c_acctbal") < 0, "dead").otherwise("idle")
    return (
        table(spark, folder, "customer")
        .select(classify.refresh_record(record, state).alias("r"))
        .select("r.*")
    )


@query(f"""WITH {fx.STATES_SQL}
SELECT session_id, arg_max(state, (ts, event_id)) AS state, epoch_us(max(ts)) AS observed_us
FROM states GROUP BY 1""")
def latest_state(spark: SparkSession, folder: str) -> DataFrame:
    return outcomes.latest_state(fx.states(spark, folder)).select(
        "session_id", "state", F.unix_micros("observed_at").alias("observed_us")
    )


@query(f"""WITH {fx.STATES_SQL},
a AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS poll,
             CASE WHEN state = 'idle' THEN 'done' WHEN state IN ('starting', 'busy') THEN 'wait' ELSE 'bad' END AS class
      FROM states),
m AS (SELECT * FROM a WHERE poll <= 3),
t AS (SELECT session_id, min(CASE WHEN class <> 'wait' THEN poll END) AS term, max(poll) AS n FROM m GROUP BY 1)
SELECT t.session_id, coalesce(m.class, CASE WHEN n = 3 THEN 'timed_out' ELSE 'waiting' END) AS outcome,
       coalesce(term, n) AS polls, (coalesce(term, n) - 1) * CAST(1.5 AS DOUBLE) AS waited
FROM t LEFT JOIN m ON m.session_id = t.session_id AND m.poll = t.term""")
def wait_outcome(spark: SparkSession, folder: str) -> DataFrame:
    return outcomes.wait_outcome(fx.states(spark, folder), "ready", max_tries=3, pause=1.5)


@query("""SELECT c_mktsegment || '-' || c_nationkey AS name, count(*) AS uses
FROM customer GROUP BY 1 HAVING count(*) > 1""")
def duplicate_names(spark: SparkSession, folder: str) -> DataFrame:
    sessions = table(spark, folder, "customer").select(
        F.concat("c_mktsegment", F.lit("-"), "c_nationkey").alias("name")
    )
    return outcomes.duplicate_names(sessions)


EXPIRE_SQL = """marked AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS life FROM marked),
lives AS (SELECT user_id AS session_id, epoch_us(min(ts)) AS born_us, epoch_us(max(ts)) AS last_us,
                 count(*) AS beats, epoch_us(max(ts) + INTERVAL 6 HOUR) AS dead_us
          FROM numbered GROUP BY user_id, life)"""


def lives_in_micros(lives: DataFrame) -> DataFrame:
    return lives.select(
        "session_id", F.unix_micros("born_at").alias("born_us"),
        F.unix_micros("last_beat").alias("last_us"), "beats",
        F.unix_micros("dead_at").alias("dead_us"),
    )


@query(f"WITH {EXPIRE_SQL} SELECT * FROM lives")
def expire_sessions(spark: SparkSession, folder: str) -> DataFrame:
    beats = fx.states(spark, folder).select("session_id", "ts")
    return lives_in_micros(outcomes.expire_sessions(beats, 6 * 3600))


@query(f"WITH {EXPIRE_SQL} SELECT * FROM lives")
def expire_sessions_cut(spark: SparkSession, folder: str) -> DataFrame:
    """As above, with keys cut into ranges as in a table too large for one task per key."""
    beats = fx.states(spark, folder).select("session_id", "ts")
    return lives_in_micros(outcomes.expire_sessions(beats, 6 * 3600, rows_per_task=fx.CUT_ROWS))


@query("""SELECT o_custkey, o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < DATE '1995-03-01')""")
def new_items(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the customers who had none before March 1995."""
    orders = table(spark, folder, "orders")
    before = orders.filter("o_orderdate < '1995-03-01'")
    return paging.new_items(before, orders, "o_custkey").select("o_custkey", "o_orderkey")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20 OFFSET 40")
def offset_page(spark: SparkSession, folder: str) -> DataFrame:
    page = paging.offset_page(table(spark, folder, "customer"), ["c_acctbal", "c_custkey"], 40, 20)
    return page.select("c_custkey", "c_name")


@query("""SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 20 AS page
FROM orders""")
def assign_pages(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    return paging.assign_pages(orders, ["o_orderdate", "o_orderkey"], 20).select("o_orderkey", "page")


@query("""SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 20 AS page
FROM orders""")
def assign_pages_cut(spark: SparkSession, folder: str) -> DataFrame:
    """As above, with the table cut into ranges."""
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    paged = paging.assign_pages(orders, ["o_orderdate", "o_orderkey"], 20, fx.CUT_ROWS)
    return paged.select("o_orderkey", "page")


@query("""SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN 'killed' WHEN c_nationkey = 12 THEN 'ok' ELSE 'failed' END AS outcome,
       CASE c_nationkey - 12 WHEN -1 THEN 'SIGHUP' WHEN -2 THEN 'SIGINT' WHEN -3 THEN 'SIGQUIT' WHEN -4 THEN 'SIGILL'
            WHEN -5 THEN 'SIGTRAP' WHEN -6 THEN 'SIGABRT' WHEN -7 THEN 'SIGBUS' WHEN -8 THEN 'SIGFPE'
            WHEN -9 THEN 'SIGKILL' WHEN -10 THEN 'SIGUSR1' WHEN -11 THEN 'SIGSEGV' WHEN -12 THEN 'SIGUSR2' END AS signal
FROM customer""")
def classify_returncode(spark: SparkSession, folder: str) -> DataFrame:
    """Return codes run from -12 to 12."""
    end = classify.classify_returncode(F.col("returncode"))
    return fx.exits(spark, folder).select(F.col("pid").alias("c_custkey"), end.alias("e")).select(
        "c_custkey", "e.outcome", "e.signal"
    )


@query(f"WITH {fx.OBJECTS_SQL} SELECT name, arg_max(value, version) AS value, max(version) AS version FROM objects GROUP BY 1")
def upsert_objects(spark: SparkSession, folder: str) -> DataFrame:
    return objects.upsert_objects(fx.objects(spark, folder))


@query(f"""WITH {fx.OBJECTS_SQL},
latest AS (SELECT name, arg_max(value, version) AS value, max(version) AS version FROM objects GROUP BY 1),
asked AS (SELECT 'click_' || c_custkey AS name FROM customer)
SELECT name, value, version, version IS NOT NULL AS found FROM asked LEFT JOIN latest USING (name)""")
def lookup_objects(spark: SparkSession, folder: str) -> DataFrame:
    asked = table(spark, folder, "customer").select(F.concat(F.lit("click_"), "c_custkey").alias("name"))
    return objects.lookup_objects(asked, fx.objects(spark, folder))


@query("""SELECT p_partkey, p_brand AS class_name FROM part
WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_type = 'ECONOMY' AND p_size > 40)""")
def missing_refs(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").withColumnRenamed("p_brand", "class_name")
    registry = part.filter("p_type = 'ECONOMY' AND p_size > 40")
    return objects.missing_refs(part, registry).select("p_partkey", "class_name")
