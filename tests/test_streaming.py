"""Streams give what their batch forms give, over several micro-batches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from drayage.operators import logs
from drayage.sources.tail import TailReader, tail_logs
from drayage.streaming.drain import drain_stream
from drayage.streaming.pages import BLOCK, assembled_delta_stream, poll_delta_stream
from drayage.streaming.sinks import append_table, sink_lines
from test_logs import SNAPSHOTS, random_pages


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run(stream, target):
    sink_lines(stream, append_table(target), f"{target}-checkpoint", once=True).awaitTermination()


def result(spark, target):
    return spark.read.parquet(target).drop("batch")


def test_poll_delta_stream(spark, tmp_path, rows):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    pages = spark.createDataFrame(random_pages(5), SNAPSHOTS)
    for low, high in ((0, 3), (4, 4), (5, 12)):
        land(pages.filter(f"poll BETWEEN {low} AND {high}"), landing)
        stream = spark.readStream.schema(pages.schema).parquet(landing)
        run(poll_delta_stream(stream), target)
    assert rows(result(spark, target).select("source", "poll", "pos", "line")) == rows(logs.poll_delta(pages))


def test_many_sources_share_few_groups(spark, tmp_path, rows):
    """As many state rows as buckets and open blocks, not as sources; each source keeps its own page."""
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    data = [(f"s{s}", p, i, f"{(i + p * (s % 3)) // 2}") for s in range(200) for p in range(BLOCK - 2, BLOCK + 2) for i in range(p, p + 3)]
    pages = spark.createDataFrame(data, SNAPSHOTS)
    for low, high in ((0, BLOCK - 1), (BLOCK, BLOCK), (BLOCK + 1, 2 * BLOCK)):
        land(pages.filter(f"poll BETWEEN {low} AND {high}"), landing)
        run(poll_delta_stream(spark.readStream.schema(pages.schema).parquet(landing), buckets=8), target)
    assert rows(result(spark, target).select("source", "poll", "pos", "line")) == rows(logs.poll_delta(pages))
    left = spark.read.format("statestore").option("path", f"{target}-checkpoint").load()
    assert 0 < left.count() <= 8


def test_pages_in_parts_and_out_of_order(spark, tmp_path, rows):
    """Lines of a page, and what is stated of it, come over several micro-batches, later polls first."""
    landing, stated, target = (str(tmp_path / n) for n in ("in", "sizes", "out"))
    data = [(s, p, i, x) for s, p, i, x in random_pages(7)]
    data += [("long", p, i, f"{(i + p) // 3}") for p in range(2 * BLOCK + 3) for i in range(p, p + 4)]
    pages = spark.createDataFrame(data, SNAPSHOTS)
    count = {}
    for source, poll, *_ in data:
        count[source, poll] = count.get((source, poll), 0) + 1
    last = {s: max(p for t, p in count if t == s) for s, _ in count}
    sizes = spark.createDataFrame(
        [(s, p, count.get((s, p), 0)) for s in last for p in range(last[s] + 1)], "source string, poll int, n_lines long")
    steps = [
        (pages.filter("pos % 3 = 0 AND poll > 4"), None),
        (pages.filter("pos % 3 = 1"), sizes.filter("poll % 2 = 0")),
        (pages.filter("pos % 3 = 0 AND poll <= 4"), sizes.filter("poll % 2 = 1 AND poll < 20")),
        (pages.filter("pos % 3 = 2"), sizes.filter("poll % 2 = 1 AND poll >= 20")),
    ]
    pages.limit(0).write.parquet(landing)
    sizes.limit(0).write.parquet(stated)
    for lines, said in steps:
        land(lines, landing)
        if said is not None:
            land(said, stated)
        run(assembled_delta_stream(
            spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(landing),
            spark.readStream.schema(sizes.schema).parquet(stated)), target)
    expected = logs.poll_delta(pages)
    assert rows(result(spark, target).select(expected.columns)) == rows(expected)
    # Only blocks that are not full stay, with the last page of each source.
    left = spark.read.format("statestore").option("path", f"{target}-checkpoint").option("stateVarName", "parts").load()
    held = left.select(F.col("user_map_key.poll"))
    assert {r[0] for r in held.collect()} <= set(last.values()) | {2 * BLOCK - 1, BLOCK - 1}


def test_pages_held_back_by_an_early_one_are_not_lost(spark, tmp_path, rows):
    """Polls 1 to 3 are whole before poll 0; polls 4 and 5 are empty without a row that says so."""
    landing, stated, target = (str(tmp_path / n) for n in ("in", "sizes", "out"))
    shown = [p for p in range(2 * BLOCK) if p not in (4, 5, BLOCK - 1, BLOCK)]
    data = [(s, p, i, f"{(i + p) // 2}") for s in ("a", "b") for p in shown for i in range(p, p + 3)]
    pages = spark.createDataFrame(data, SNAPSHOTS)
    sizes = spark.createDataFrame(
        [(s, p, 3, p - max([q for q in shown if q < p], default=-1) - 1) for s in ("a", "b") for p in shown],
        "source string, poll int, n_lines long, idle long")
    pages.limit(0).write.parquet(landing)
    for said in (sizes.filter("poll > 0"), sizes.filter("poll = 0")):
        land(pages.join(said.select("source", "poll"), ["source", "poll"]).select(pages.columns), landing)
        land(said, stated)
        run(assembled_delta_stream(
            spark.readStream.schema(pages.schema).parquet(landing),
            spark.readStream.schema(sizes.schema).parquet(stated), buckets=1), target)
    expected = logs.poll_delta(pages)
    assert rows(result(spark, target).select(expected.columns)) == rows(expected)
    left = spark.read.format("statestore").option("path", f"{target}-checkpoint").option("stateVarName", "parts").load()
    assert {r[0] for r in left.select(F.col("user_map_key.poll")).collect()} <= {2 * BLOCK - 1}


def test_drain_stream_holds_the_code_back(spark, tmp_path, rows):
    t0 = datetime(2024, 1, 1)
    output = spark.createDataFrame(
        [(p, i, f"{p}.{i}", t0 + timedelta(seconds=10 * i)) for p in (1, 2) for i in range(5)] ,
        "pid int, pos long, line string, ts timestamp")
    exits = spark.createDataFrame(
        [(1, 7, t0 + timedelta(seconds=40)), (2, 0, t0 + timedelta(seconds=40)), (3, -9, t0)],
        "pid int, returncode int, ts timestamp")
    out, end, target = str(tmp_path / "out"), str(tmp_path / "end"), str(tmp_path / "drained")
    drained = lambda: drain_stream(
        spark.readStream.schema(output.schema).parquet(out),
        spark.readStream.schema(exits.schema).parquet(end), 2, delay="0 seconds")

    land(output.filter("pos < 3"), out)
    land(exits.filter("pid = 3"), end)
    run(drained(), target)
    first = result(spark, target).filter("returncode IS NOT NULL")
    assert rows(first.select("pid", "poll", "returncode")) == [(3, 0, -9)]

    land(exits.filter("pid < 3"), end)   # the codes come no later than the last lines
    land(output.filter("pos >= 3"), out)
    run(drained(), target)
    columns = ["pid", "poll", "pos", "line", "returncode"]
    expected = logs.drain_batches(output.drop("ts"), exits.drop("ts"), 2)
    assert rows(result(spark, target).select(columns)) == rows(expected.select(columns))


def test_many_processes_share_few_groups(spark, tmp_path, rows):
    """Codes come at different times, in several runs; no more state keys than buckets are left."""
    t0 = datetime(2024, 1, 1)
    output = spark.createDataFrame(
        [(p, i, f"{p}.{i}", t0 + timedelta(seconds=p % 40 + 100 * i)) for p in range(120) for i in range(p % 4)],
        "pid int, pos long, line string, ts timestamp")
    exits = spark.createDataFrame(
        [(p, p - 60, t0 + timedelta(seconds=p % 40 + 100 * (p % 4))) for p in range(120)],
        "pid int, returncode int, ts timestamp")
    out, end, target = str(tmp_path / "out"), str(tmp_path / "end"), str(tmp_path / "drained")
    at = "ts < timestamp'2024-01-01 00:{}:00'"
    for now in (at.format("02"), f"NOT {at.format('02')}"):
        land(output.filter(now), out)
        land(exits.filter(now), end)
        run(drain_stream(
            spark.readStream.schema(output.schema).parquet(out),
            spark.readStream.schema(exits.schema).parquet(end), 2, delay="0 seconds", buckets=4), target)
        left = spark.read.format("statestore").option("path", f"{target}-checkpoint").option("stateVarName", "size").load()
        assert left.count() <= 4
    columns = ["pid", "poll", "pos", "line", "returncode"]
    expected = logs.drain_batches(output.drop("ts"), exits.drop("ts"), 2)
    assert rows(result(spark, target).select(columns)) == rows(expected.select(columns))


def test_tail_follows_growth_and_restarts(spark, tmp_path):
    folder, target = tmp_path / "logs", str(tmp_path / "out")
    folder.mkdir()
    one, two = folder / "one.log", folder / "two.log"

    def follow():
        run(tail_logs(spark, str(folder), partitionBytes=7), target)
        got = result(spark, target).orderBy("path", "offset").collect()
        return [(r.path.rsplit("/")[-1], r.offset, r.line) for r in got]

    one.write_text("l1\nl2\npart")
    (folder / "skip.txt").write_text("no\n")
    assert follow() == [("one.log", 0, "l1"), ("one.log", 3, "l2")]
    with one.open("a") as f:
        f.write("ial\n\nl5\r\n")
    two.write_text("é first\n")
    assert follow()[2:] == [
        ("one.log", 6, "partial"), ("one.log", 14, ""), ("one.log", 15, "l5"), ("two.log", 0, "é first")
    ]
    assert len(follow()) == 6


def reader(folder, **options):
    return TailReader(str(folder), "*.log", options.get("partition_bytes", 1 << 20), options.get("max_bytes"))


def read(r, start, end):
    return [line for p in r.partitions(start, end) for batch in r.read(p) for line in batch.column(2).to_pylist()]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 64])
def test_every_split_of_a_file_reads_each_line_once(tmp_path, size):
    lines = ["", "a", "bb", "", "cccccccccc", "d" * 30, "e"]
    (tmp_path / "x.log").write_text("\n".join(lines) + "\nheld back")
    r = reader(tmp_path, partition_bytes=size)
    end = r.latestOffset()
    assert read(r, {}, end) == lines


def test_tail_limits_a_trigger(tmp_path):
    lines = [f"line {i}" for i in range(50)]
    (tmp_path / "a.log").write_text("\n".join(lines[:30]) + "\n")
    (tmp_path / "b.log").write_text("\n".join(lines[30:]) + "\n")
    r, got, start, steps = reader(tmp_path, max_bytes=40), [], {}, 0
    r.initialOffset()
    while (end := r.latestOffset()) != start:
        got += read(r, start, end)
        start, steps = end, steps + 1
    assert sorted(got) == sorted(lines) and steps > 5


def test_tail_forgets_deleted_files(tmp_path):
    log = tmp_path / "a.log"
    log.write_text("old 1\nold 2\n")
    r = reader(tmp_path)
    first = r.latestOffset()
    log.unlink()
    gone = r.latestOffset()
    assert gone == {} and read(r, first, gone) == []
    log.write_text("new\n")
    assert read(r, gone, r.latestOffset()) == ["new"]
    log.write_text("n\n")  # shorter than before: read from its start
    assert read(r, {str(log): 4}, r.latestOffset()) == ["n"]


def test_tail_starts_over_in_a_longer_file_of_the_same_name(tmp_path):
    log = tmp_path / "a.log"
    log.write_text("old 1\nold 2\n")
    r = reader(tmp_path)
    first = r.latestOffset()
    assert read(r, {}, first) == ["old 1", "old 2"]
    log.unlink()
    log.write_text("new one\nnew two\nnew three\n")
    second = r.latestOffset()
    assert read(r, first, second) == ["new one", "new two", "new three"]
    assert read(reader(tmp_path), first, second) == ["new one", "new two", "new three"]  # after a restart
    with log.open("a") as f:
        f.write("more\n")
    assert read(r, second, r.latestOffset()) == ["more"]


def test_sink_repeats_replace_themselves(spark, tmp_path):
    deliver = append_table(str(tmp_path / "t"))
    deliver(spark.range(3), 0)
    deliver(spark.range(5), 0)
    deliver(spark.range(1), 1)
    assert result(spark, str(tmp_path / "t")).count() == 6
