import pytest
from pyspark.sql import functions as F

from drayage.functions import classify, codec, maps, names, text


@pytest.fixture
def value(spark):
    """Evaluate a column over literals."""
    return lambda column: spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("line, expected", [
    ("INFO 2024-01-02T03:04:05: started: now", ("INFO", "2024-01-02 03:04:05", "started: now")),
    ("1700000000.25: hi", (None, "2023-11-14 22:13:20.25", "hi")),
    ("1700000000: hi", (None, "2023-11-14 22:13:20", "hi")),
    ("no stamp: here", (None, None, "no stamp: here")),
    ("INFO soon: x", (None, None, "INFO soon: x")),
    ("", (None, None, "")),
])
def test_parse_log_line(value, line, expected):
    got = value(text.parse_log_line(F.lit(line)))
    stamp = got.stamped_at and str(got.stamped_at).rstrip("0").removesuffix(":0")
    want = expected[1] and expected[1].rstrip("0")
    assert (got.level, stamp, got.message) == (expected[0], want, expected[2])


@pytest.mark.parametrize("body, lines", [
    ("a\nb\r\nc", ["a", "b", "c"]), ("a\n", ["a"]), ("a\n\n", ["a", ""]), ("", []), ("\n", [""]),
])
def test_split_lines(value, body, lines):
    assert value(text.split_lines(F.lit(body))) == lines


@pytest.mark.parametrize("template, expected", [
    ("a=%(A)s b=%(B)s 100%%", ("a=%(B)s b=None 100%", "ok")),
    ("%(C)s", (None, "missing_key")),
    ("%d", (None, "unsupported")),
    ("plain\ntext", ("plain\ntext", "ok")),
    ("", ("", "ok")),
])
def test_render_template(value, template, expected):
    env = F.create_map(F.lit("A"), F.lit("%(B)s"), F.lit("B"), F.lit(None).cast("string"))
    assert tuple(value(text.render_template(F.lit(template), env))) == expected


def test_merge_headers(value):
    base = F.create_map(F.lit("A"), F.lit("1"), F.lit("a"), F.lit("2"), F.lit("B"), F.lit("3"))
    over = F.create_map(F.lit("b"), F.lit("4"), F.lit("C"), F.lit("5"))
    assert value(maps.merge_headers(base, over)) == {"a": "2", "b": "4", "c": "5"}
    none = F.lit(None).cast("map<string,string>")
    assert value(maps.merge_headers(base, none)) == {"a": "2", "b": "3"}


def test_overlay_env(value):
    base = F.create_map(F.lit("A"), F.lit("1"), F.lit("B"), F.lit("2"))
    over = F.create_map(F.lit("A"), F.lit(None).cast("string"), F.lit("C"), F.lit("3"))
    assert value(maps.overlay_env(base, over)) == {"B": "2", "C": "3"}
    assert value(maps.overlay_env(base, F.lit(None).cast("map<string,string>"))) == {"A": "1", "B": "2"}


@pytest.mark.parametrize("line, status", [
    ("P 4 YWJj", "ok"), ("  P 4 YWJj", None), ("P 4", "bad_parts"), ("P 4 YWJj x", "bad_parts"),
    ("P x YWJj", "bad_size"), ("P 5 YWJj", "len_mismatch"), ("PX 4 YWJj", "bad_prefix"),
    ("P 4 !!!!", "bad_b64"), ("P\t4  YWJj \r", "ok"), ("other", None),
])
def test_decode_frame(value, line, status):
    got = value(codec.decode_frame(F.lit(line), "P"))
    assert (got and got.status) == status
    assert (got and got.data) == (b"abc" if status == "ok" else None)


def test_frames_round_trip_without_line_breaks(value):
    data = bytes(range(256)) * 3
    line = value(codec.encode_frame(F.lit(data), "P"))
    assert "\n" not in line and "\r" not in line
    assert value(codec.decode_frame(F.lit(line), "P")).data == data


@pytest.mark.parametrize("body, expected", [
    (b'{"a": [1]}', ("json", '{"a": [1]}')), (b"42", ("json", "42")), (b"hi {", ("text", "hi {")),
    (b"", ("text", "")), (b"a\xff", ("bytes", "a�")),
])
def test_decode_body(value, body, expected):
    assert tuple(value(codec.decode_body(F.lit(body)))) == expected


@pytest.mark.parametrize("url, name", [
    ("https://h/a/b.tar.gz?x=1#y", "b.tar.gz"), ("https://h/a/b/", "b"), ("https://h", ""),
    ("dir/c.zip", "c.zip"), ("http://[bad/d.zip", "d.zip"),
])
def test_url_basename(value, url, name):
    assert value(names.url_basename(F.lit(url))) == name


@pytest.mark.parametrize("name, glob, hit", [
    ("a.log", "*.log", True), ("a.log.1", "*.log", False), ("a_b", "a?b", True),
    ("axb", "a_b", False), ("100%", "100%", True), ("100x", "100%", False),
])
def test_matches_glob(value, name, glob, hit):
    assert value(names.matches_glob(F.lit(name), glob)) is hit


def test_names(value):
    assert value(names.rendered_name(F.lit("a.tmpl.b.tmpl"))) == "a.b"
    assert value(names.join_url(F.lit("http://h//"), F.lit("/s"))) == "http://h/s"
    assert value(names.mode_octal(F.lit(0o100600))) == "0o600"
    assert value(names.mode_octal(F.lit(0))) == "0o0"


@pytest.mark.parametrize("status, transport, klass", [
    (None, True, "retry"), (200, False, "ok"), (299, False, "ok"), (301, False, "fatal"),
    (404, False, "fatal"), (429, False, "retry"), (500, False, "retry"),
])
def test_classify_response(value, status, transport, klass):
    column = classify.classify_response(F.lit(status).cast("int"), F.lit(transport))
    assert value(column) == klass


@pytest.mark.parametrize("goal, answers", [
    ("ready", "wait wait wait done bad bad bad bad bad"),
    ("closed", "wait wait wait wait deleted finished finished finished wait"),
    ("follow", "live live live live stopped stopped stopped stopped live"),
])
def test_classify_state(value, goal, answers):
    states = "not_started starting busy idle dead killed success error shutting_down".split()
    assert [value(classify.classify_state(F.lit(s), goal)) for s in states] == answers.split()


@pytest.mark.parametrize("code, expected", [
    (None, ("running", None)), (0, ("ok", None)), (3, ("failed", None)),
    (-15, ("killed", "SIGTERM")), (-9, ("killed", "SIGKILL")), (-200, ("killed", None)),
])
def test_classify_returncode(value, code, expected):
    assert tuple(value(classify.classify_returncode(F.lit(code).cast("int")))) == expected


@pytest.mark.parametrize("head", ["1700000000000000", "9" * 15, "9" * 40, "999999999999.5"])
def test_numbers_that_are_no_time_stamp_nothing(value, head):
    got = value(text.parse_log_line(F.lit(f"{head}: x")))
    assert got["stamped_at"] is None and got["message"] == f"{head}: x"


def test_error_text_with_missing_parts(value):
    null = F.lit(None).cast("string")
    got = value(text.error_text(null, null, F.lit(None).cast("array<string>")))
    assert got == "error in statement execution: None(None):\n"


def test_overlay_of_a_null_base(value):
    over = F.create_map(F.lit("A"), F.lit("1"), F.lit("B"), F.lit(None).cast("string"))
    assert value(maps.overlay_env(F.lit(None).cast("map<string,string>"), over)) == {"A": "1"}
