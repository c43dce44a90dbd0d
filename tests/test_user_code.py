import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from drayage.catalog import fixtures
from drayage.operators import user_code
from drayage.sources import paged


def test_pipe_rows(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id int, line string")
    assert rows(user_code.pipe_rows(df, ["tr", "a-z", "A-Z"])) == [
        (1, "A", 0, False), (2, "", 0, False), (3, "", 0, False)
    ]


def test_pipe_rows_keeps_code_and_output_of_a_failure(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, line string").coalesce(1)
    got = user_code.pipe_rows(df, ["bash", "-c", "cat; echo oops >&2; exit 3"])
    assert rows(got) == [
        (1, None, 3, False), (2, None, 3, False),
        (None, "a", 3, False), (None, "b", 3, False), (None, "oops", 3, False),
    ]


def test_run_commands(spark):
    df = spark.createDataFrame([(1, "echo hello; echo >&2 world"), (2, "exit 42"), (3, "echo $A-$HOME")],
                               "id int, command string")
    got = user_code.run_commands(df, env={"A": "x", "HOME": None}).collect()
    assert {r.id: (r.output, r.returncode, r.timed_out) for r in got} == {
        1: ("hello\nworld\n", 0, False), 2: ("", 42, False), 3: ("x-\n", 0, False)
    }


def test_run_commands_time_out(spark):
    df = spark.createDataFrame([("sleep 10",), ("trap '' TERM; while true; do sleep 0.1; done",)],
                               "command string").repartition(2)
    started = time.monotonic()
    got = {r.command[:5]: (r.returncode, r.timed_out) for r in user_code.run_commands(df, "command", 1, 1).collect()}
    assert got == {"sleep": (-15, True), "trap ": (-9, True)}
    assert 1 <= time.monotonic() - started < 20


@pytest.fixture
def flaky():
    def fn(x, fails):
        print("try", x)
        if x < fails:
            raise ValueError(x)
        if x == 9:
            raise IndexError(x)
        return x * 10

    return fn


def test_apply_with(spark, flaky):
    df = spark.createDataFrame([(1,), (5,), (9,)], "x int")
    got = user_code.apply_with(df, flaky, ["x"], {"fails": 3}, "long", max_tries=3, retry_on=(ValueError,))
    assert {r.x: (r.value, r.printed, r.attempts, r.error_type) for r in got.collect()} == {
        1: (None, ["try 1"] * 3, 3, "ValueError"), 5: (50, ["try 5"], 1, None), 9: (None, ["try 9"], 1, "IndexError"),
    }


def test_apply_with_bounds_what_it_ships(spark, flaky, monkeypatch):
    monkeypatch.setattr(user_code, "MAX_VARS_BYTES", 10)
    with pytest.raises(ValueError, match="bytes"):
        user_code.apply_with(spark.range(1), flaky, ["id"], {"fails": 3}, "long")


def test_register_transform(spark):
    def ask():
        return spark.sql("SELECT twice(id) AS v FROM range(3)").agg({"v": "sum"}).first()[0]

    assert user_code.register_transform(spark, "twice", lambda s: s * 2, "long") == "twice"
    assert ask() == 6
    user_code.register_transform(spark, "twice", lambda s: s * 3, "long")
    assert ask() == 6
    user_code.register_transform(spark, "twice", lambda s: s * 3, "long", force=True)
    assert ask() == 9


@pytest.mark.parametrize("rows", [0, 1, 20, 105, 128])
@pytest.mark.parametrize("known", [True, False])
def test_scan_paged(spark, rows, known):
    def provider(offset, size):
        return pa.table({"id": pa.array(range(offset, min(offset + size, rows)), pa.int64())})

    df = paged.scan_paged(spark, f"numbers_{rows}_{known}", provider, "id long", 20,
                          rows if known else None, pages_per_task=2)
    assert sorted(r.id for r in df.collect()) == list(range(rows))


def test_apply_with_keeps_whole_numbers_and_nulls(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(1, big), (2, None)], "id int, x long").coalesce(1)
    got = user_code.apply_with(df, lambda x: repr(x), ["x"], {}, "string").orderBy("id").collect()
    assert [(r.x, r.value) for r in got] == [(big, str(big)), (None, "None")]


def test_pages_shorter_than_asked_for(spark):
    def provider(offset, size):
        return pa.table({"n": list(range(offset, min(200, offset + size, offset + 10)))}, pa.schema([("n", pa.int64())]))

    df = paged.scan_paged(spark, "short_pages", provider, "n long", page_size=20, pages_per_task=2)
    assert sorted(r.n for r in df.collect()) == list(range(200))


def test_long_listings_take_a_bounded_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(paged, "MOST_TASKS", 4)

    def provider(offset, size):
        return pa.table({"n": pa.array(range(offset, min(offset + size, 205)), pa.int64())})

    df = paged.scan_paged(spark, "long_listing", provider, "n long", page_size=5, total=205, pages_per_task=1)
    assert df.rdd.getNumPartitions() <= 5
    assert sorted(r.n for r in df.collect()) == list(range(205))


def test_paged_file_decodes_a_row_group_once(tmp_path, monkeypatch):
    path = str(tmp_path / "rows.parquet")
    pq.write_table(pa.table({"n": list(range(100)), "m": [0] * 100}), path, row_group_size=40)
    provider, decoded = fixtures.PagedFile(path, ["n"]), []
    read = pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda *a, **k: decoded.append(a[1]) or read(*a, **k))
    served = [provider(at, 7)["n"].to_pylist() for at in range(0, 112, 7)]
    assert [n for page in served for n in page] == list(range(100)) and served[-1] == []
    assert decoded == [0, 1, 2]
