import os

import pytest
from pyspark.sql import functions as F

from blockloom.model import ARCHIVE, ARCHIVE_PARTITIONS
from blockloom.session import scratch_path
from blockloom.sources import archive, local

NAMES = ["a b", "50%", "x+y", "é", "a%20b", "q[1]", "st*r", "q?x", "c:d", "e=f", "p|q", "\xa0nb", "_a=b"]
HIDDEN = ["_hid", ".dot", "x._COPYING_"]


def test_a_local_listing_is_made_by_tasks(spark, tmp_path, plan_of):
    """The names are those that Spark's own listing has, which it holds on the driver."""
    for number, name in enumerate(NAMES + HIDDEN):
        (tmp_path / "t" / name / "sub").mkdir(parents=True)
        (tmp_path / "t" / name / "sub" / f"f{name}").write_bytes(b"v" * (number % 2))
    listed = archive.list_archive_files(spark, str(tmp_path / "t"))
    assert "MapInArrow" in plan_of(listed) and "binaryFile" not in plan_of(listed)
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "t"))
    found = {r["path"]: r for r in listed.collect()}
    assert sorted(found) == sorted(name.replace("file:///", "file:/") for name in scan.inputFiles()) and len(found) == len(NAMES)
    for row in scan.select("_metadata.file_path", "modificationTime", "length").collect():
        same = found[row[0].replace("file:///", "file:/")]
        assert (same["modificationTime"], same["length"]) == (row[1], row[2])
    assert [r["length"] for r in found.values()].count(0) == 7


def test_a_large_tree_is_shared_out(spark, tmp_path):
    for number in range(300):
        (tmp_path / f"range={number}" / "kind=a").mkdir(parents=True)
        (tmp_path / f"range={number}" / "kind=a" / "f.txt").write_bytes(b"v")
    (tmp_path / "above.txt").write_bytes(b"v")
    shares = local.shared_out(spark, str(tmp_path))
    assert shares.rdd.getNumPartitions() == 8 * spark.sparkContext.defaultParallelism
    assert shares.count() == 301 and local.list_files(spark, str(tmp_path)).count() == 301


def test_archive_folders_are_named_as_by_spark(spark, tmp_path):
    """Their files are made without Spark's committer; null and odd ranges, a range in several files, a replaced one."""
    values = [None, "", "a b", "x=y", "50%", "q[1]", "c:d", "é", "a/b", "t\x01"]
    rows = spark.createDataFrame(
        [(f"k{n}", "x", None if n % 3 else "proto", n, b"" if n % 2 else None, "s", "blocks", v, 5) for n, v in enumerate(values * 3)], ARCHIVE
    )
    root, other = scratch_path(spark, "archive"), scratch_path(spark, "spark")
    archive.write_archive(rows, root)
    rows.write.partitionBy(*ARCHIVE_PARTITIONS).parquet(other)

    def folders(top):
        top = local.plain_path(spark, top)
        return sorted(os.path.relpath(d, top) for d, _, names in os.walk(top) if any(n.endswith(".parquet") for n in names))

    def contents(top):
        return sorted(map(str, archive.read_archive(spark, top).collect()))

    assert folders(root) == folders(other) and contents(root) == contents(other)
    archive.write_archive(rows.where("range = 'a b' AND ts < 10").withColumn("value", F.lit(b"new")), root)
    assert [bytes(r["value"]) for r in archive.read_archive(spark, root).where("range = 'a b'").collect()] == [b"new"]
    assert archive.read_archive(spark, root).count() == 28


def test_what_a_repeated_task_left_is_in_no_folder(spark, monkeypatch):
    root, move = scratch_path(spark, "archive"), local.move_folders
    rows = spark.createDataFrame([("k", "x", "proto", 1, b"v", "s", "blocks", "r", 0)], ARCHIVE)

    def found(aside, places, top):
        assert os.listdir(f"{aside}/_files") == [] and places == ["sync_type=s/table_name=blocks/range=r/commit_id=0"]
        open(f"{aside}/_files/part-of-a-dead-attempt.parquet", "wb").close()
        move(aside, places, top)

    monkeypatch.setattr(local, "move_folders", found)
    archive.write_archive(rows, root)
    assert archive.read_archive(spark, root).count() == 1 and not os.listdir(local.plain_path(spark, f"{root}/_parts"))


@pytest.mark.parametrize("missing_ok", [True, False])
def test_a_missing_folder(spark, tmp_path, missing_ok):
    if missing_ok:
        assert archive.list_archive_files(spark, str(tmp_path / "none"), missing_ok=True).count() == 0
    else:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            archive.list_archive_files(spark, str(tmp_path / "none"))
