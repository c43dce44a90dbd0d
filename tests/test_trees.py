import io
import os
import stat
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from drayage.operators import trees
from drayage.plans.upload import upload_tree
from drayage.sources import archives, files

TREE = "root string, rel_path string, mode int, content binary"


@pytest.fixture(scope="module")
def tree(spark):
    data = [("r", f"d{i % 3}/f{i}", 0o600 + i % 8, os.urandom(i * 7)) for i in range(100)]
    data += [("s", "foo", 0o644, b"foo"), ("s", "inner/bar", 0o600, b"bar"), ("s", "empty", 0o600, b"")]
    return spark.createDataFrame(data, TREE).cache()


@pytest.mark.parametrize("part_bytes", [8 << 10, 1 << 20])
def test_pack_and_unpack(tree, rows, part_bytes):
    packed = archives.pack_archives(tree, part_bytes=part_bytes)
    unpacked = archives.unpack_archives(packed.select("root", "content"))
    assert rows(unpacked.select("root", "rel_path", "mode", "content")) == rows(tree)
    assert packed.filter("root = 's'").count() == 1
    assert (packed.filter("root = 'r'").count() > 1) == (part_bytes == 8 << 10)


def test_same_files_pack_to_same_bytes(tree, rows):
    a = archives.pack_archives(tree.repartition(2)).select("root", F.md5("content"))
    b = archives.pack_archives(tree.repartition(5)).select("root", F.md5("content"))
    assert rows(a) == rows(b)


def test_unpack_reads_zip_and_reports_bad_payloads(spark):
    zipped, tarred = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(zipped, "w") as z:
        z.writestr("a/b", b"1")
    with tarfile.open(fileobj=tarred, mode="w:gz") as t:
        for name in ("../up", "/abs", "./ok"):
            info = tarfile.TarInfo(name)
            info.size = 1
            t.addfile(info, io.BytesIO(b"x"))
    data = [(1, zipped.getvalue()), (2, tarred.getvalue()), (3, b"junk"),
            (4, tarred.getvalue()[:40])]
    found = archives.unpack_archives(spark.createDataFrame(data, "id int, content binary"))
    got = {(r.id, r.rel_path): r.status for r in found.collect()}
    assert got == {
        (1, "a/b"): "ok", (2, "../up"): "unsafe", (2, "/abs"): "unsafe", (2, "ok"): "ok",
        (3, None): "unreadable", (4, None): "unreadable",
    }


def test_digest_ignores_order_but_not_content(spark, tree, rows):
    digest = trees.tree_digest(tree)
    assert rows(digest) == rows(trees.tree_digest(tree.orderBy(F.desc("rel_path")).repartition(7)))
    moved = tree.withColumn("rel_path", F.when(F.col("rel_path") == "foo", "oof").otherwise(F.col("rel_path")))
    old, new = {r.root: r for r in digest.collect()}, {r.root: r for r in trees.tree_digest(moved).collect()}
    assert old["r"] == new["r"] and old["s"].digest != new["s"].digest and old["s"].bytes == new["s"].bytes


def test_reconcile_tells_modes_apart(spark):
    a = spark.createDataFrame([("x", 0o600, b"1"), ("y", 0o600, b"1"), ("z", 0o600, b"1")],
                              "rel_path string, mode int, content binary")
    b = spark.createDataFrame([("x", 0o600, b"1"), ("y", 0o644, b"1"), ("w", 0o600, b"1")], a.schema)
    got = {r.rel_path: r.status for r in trees.reconcile(trees.fingerprint(a), trees.fingerprint(b)).collect()}
    assert got == {"x": "same", "y": "changed", "z": "removed", "w": "added"}


def test_single_root(spark):
    data = [("ok", "top/a"), ("ok", "top/b/c"), ("two", "a/x"), ("two", "b/x"), ("file", "a")]
    got = trees.single_root(spark.createDataFrame(data, "archive string, path string"))
    assert {r.archive: (r["items"], r.valid) for r in got.collect()} == {
        "ok": (1, True), "two": (2, False), "file": (1, False)
    }


def test_scan_tree(spark, tmp_path, rows):
    (tmp_path / "inner").mkdir()
    (tmp_path / "foo").write_text("foo")
    (tmp_path / "inner" / "bar").write_text("bar!")
    found = files.scan_tree(spark, str(tmp_path))
    assert rows(found.select("rel_path", "length", "content")) == [
        ("foo", 3, b"foo"), ("inner/bar", 4, b"bar!")
    ]
    plan = found.select("rel_path")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan
    assert files.scan_tree(spark, str(tmp_path), "f*").count() == 1


def test_upload_tree_replaces_the_target(spark, tmp_path):
    source, target = tmp_path / "src", tmp_path / "out" / "dst"
    (source / "inner").mkdir(parents=True)
    (source / "foo").write_text("foo")
    (source / "inner" / "bar").write_text("bar")
    target.mkdir(parents=True)
    (target / "old").write_text("old")
    got = upload_tree(spark, str(source), str(target))
    assert {r.rel_path: r.status for r in got.collect()} == {"foo": "same", "inner/bar": "same"}
    assert sorted(p.name for p in target.rglob("*") if p.is_file()) == ["bar", "foo"]
    assert stat.S_IMODE((target / "foo").stat().st_mode) == 0o600


def test_replace_tree_leaves_other_partitions_alone(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    files.replace_tree(old, path, ["k"])
    files.replace_tree(old.filter("v = 1").withColumn("v", F.lit(9)), path, ["k"])
    assert rows(spark.read.parquet(path).select("k", "v")) == [("a", 9), ("b", 3)]
    files.replace_tree(old.filter("v = 3"), path)
    assert rows(spark.read.parquet(path).select("k", "v")) == [("b", 3)]


def test_many_small_files_take_few_tasks(spark, tmp_path):
    for n in range(32 * 40):
        (tmp_path / f"{n}.bin").write_bytes(b"%d" % n)
    found = files.scan_tree(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert {(r.rel_path, bytes(r.content)) for r in found.collect()} == {(f"{n}.bin", b"%d" % n) for n in range(32 * 40)}
