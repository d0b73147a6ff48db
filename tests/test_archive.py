import re

import pytest
from pyspark.sql import functions as F

from blockloom.functions import keys
from blockloom.model import CELL
from blockloom.operators import cells as cell_ops
from blockloom.operators import ranges
from blockloom.plans import archiving
from blockloom.session import scratch_path
from blockloom.sources import archive, ledgers, snapshots


def cells(spark, count, start=0):
    slot = F.col("id")
    return spark.range(start, start + count).select(
        keys.slot_to_key(slot).alias("row_key"),
        F.lit("x").alias("family"),
        F.lit("proto").alias("qualifier"),
        slot.alias("ts"),
        F.encode(F.concat(F.lit("v"), slot), "UTF-8").alias("value"),
    )


def stored_slots(spark, root):
    return sorted(int(r[0], 16) for r in archive.read_archive(spark, root).select("row_key").collect())


def run(spark, rows, root, ledger, start, end, **options):
    archiving.archive_key_range(spark, rows, start, end, 100, root, ledger, "sync", "blocks", **options)


def test_round_trip_and_second_run(spark):
    root, ledger = scratch_path(spark, "a"), scratch_path(spark, "l")
    rows = cells(spark, 1000)
    run(spark, rows, root, ledger, 120, 450)
    assert stored_slots(spark, root) == list(range(100, 500))
    run(spark, rows, root, ledger, 120, 450)
    run(spark, rows, root, ledger, 0, 999, in_key_order=True)
    assert stored_slots(spark, root) == list(range(1000))
    differences = cell_ops.digest_differences(
        cell_ops.row_digest(rows), cell_ops.row_digest(archive.read_archive(spark, root))
    )
    assert differences.count() == 0
    records = ledgers.read_range_ledger(spark, ledger, "sync", "blocks")
    assert records.count() == 10 and records.where("status <> 'done'").count() == 0


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        archiving.archive_key_range(spark, cells(spark, 1), 0, 1, 10, "/tmp/a", "/tmp/l", "sync", "tx")


def test_failed_write_is_recorded_and_planned_again(spark):
    root, ledger = scratch_path(spark, "a"), scratch_path(spark, "l")
    broken = cells(spark, 300).withColumn("value", F.when(F.col("ts") == 250, F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        run(spark, broken, root, ledger, 0, 299)
    plan = ranges.split_key_range(spark, 0, 299, 100)
    known = ledgers.read_range_ledger(spark, ledger, "sync", "blocks")
    assert {r["status"] for r in ranges.range_status(plan, known).collect()} == {"failed"}
    run(spark, cells(spark, 300), root, ledger, 0, 299)
    known = ledgers.read_range_ledger(spark, ledger, "sync", "blocks")
    assert {r["status"] for r in ranges.range_status(plan, known).collect()} == {"done"}
    assert stored_slots(spark, root) == list(range(300))


def test_a_whole_wave_needs_no_join(spark, plan_of, monkeypatch):
    """The bounds of ranges without a gap tell their cells; where some are done, the plan is still asked."""
    root, ledger = scratch_path(spark, "a"), scratch_path(spark, "l")
    plans, write = [], archive.write_archive
    monkeypatch.setattr(archive, "write_archive", lambda rows, *args: (plans.append(plan_of(rows)), write(rows, *args)))
    run(spark, cells(spark, 1000), root, ledger, 200, 299)
    run(spark, cells(spark, 1000), root, ledger, 0, 999, waves=2)
    assert ["Join" in plan for plan in plans] == [False, True, False]
    assert stored_slots(spark, root) == list(range(1000))
    records = ledgers.read_range_ledger(spark, ledger, "sync", "blocks")
    assert records.count() == 10 and spark.read.parquet(ledger).count() == 10


def test_folders_are_moved_in(spark):
    """Those of an earlier attempt are replaced, others stay, nothing stays aside; the root's name is no pattern."""
    root = scratch_path(spark, "a[1]{2}*")
    archive.write_archive(archiving.to_archive(cells(spark, 300), "sync", "blocks", 100), root)
    fewer = cells(spark, 50, 120)
    archive.write_archive(archiving.to_archive(fewer, "sync", "blocks", 100), root)
    slots = [*range(100), *range(120, 170), *range(200, 300)]
    _, files = snapshots.file_system(spark, root)
    assert len(files.listStatus(snapshots.file_system(spark, f"{root}/sync_type=sync/table_name=blocks")[0])) == 3
    broken = fewer.withColumn("value", F.raise_error(F.lit("lost")).cast("binary"))
    with pytest.raises(Exception, match="lost"):
        archive.write_archive(archiving.to_archive(broken, "sync", "blocks", 100), root)
    assert not files.listStatus(snapshots.file_system(spark, f"{root}/_parts")[0])
    literal = re.sub(r"([][*?{}])", r"\\\1", root)
    assert sorted(int(r[0], 16) for r in archive.read_archive(spark, literal).select("row_key").collect()) == slots


def test_range_filter_selects_folders(spark, plan_of):
    root, ledger = scratch_path(spark, "a"), scratch_path(spark, "l")
    run(spark, cells(spark, 500), root, ledger, 0, 499)
    name = "range_" + f"{200:016x}_{299:016x}"
    chosen = archive.read_archive(spark, root).where((F.col("table_name") == "blocks") & (F.col("range") == name))
    assert chosen.count() == 100
    assert "PartitionFilters: [isnotnull(table_name" in plan_of(chosen)
    paths = [r["path"] for r in archive.list_archive_files(spark, root).collect()]
    assert len({p.split("/")[-3] for p in paths}) == 5


def test_hot_range_is_split_over_files(spark, setting):
    """One range holds most cells; its folder gets several files and nothing is lost."""
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    setting("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    root = scratch_path(spark, "a")
    hot = spark.range(40000).repartition(8).select(
        keys.slot_to_key(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("row_key"),
        F.lit("x").alias("family"), F.lit("q").alias("qualifier"), F.col("id").alias("ts"),
        F.encode(F.sha2(F.col("id").cast("string"), 512), "UTF-8").alias("value"),
    )
    archive.write_archive(archiving.to_archive(hot, "sync", "blocks", 10000), root)
    stored = archive.read_archive(spark, root)
    assert stored.count() == 40000
    files = {r["range"]: r["files"] for r in stored.groupBy("range").agg(F.count_distinct("_metadata.file_path").alias("files")).collect()}
    assert files[f"range_{0:016x}_{9999:016x}"] > 2


def test_key_range_and_row_limit(spark, plan_of):
    twice = cells(spark, 50).union(cells(spark, 50).withColumn("ts", F.col("ts") + 1000))
    lo, hi = f"{10:016x}", f"{29:016x}"
    assert archive.read_key_range(twice, lo, hi).count() == 40
    limited = archive.read_key_range(twice, lo, hi, limit=7)
    assert sorted({int(r["row_key"], 16) for r in limited.collect()}) == list(range(10, 17))
    assert limited.count() == 14


def test_key_filter_reaches_the_files(spark, plan_of):
    path = scratch_path(spark, "cells")
    cells(spark, 100).write.parquet(path)
    rows = archive.read_key_range(spark.read.schema(CELL).parquet(path), f"{3:016x}", f"{5:016x}")
    assert f"GreaterThanOrEqual(row_key,{3:016x})" in plan_of(rows)
    assert rows.count() == 3


def test_records_round_trip(spark):
    rows = [("k1", "x", "proto", 5, b"\x00\xff\n1"), ("ké", "fé", "b", 2**62, b""), ("", "", "", 0, b"12")]
    frame = spark.createDataFrame(rows, CELL)
    path = scratch_path(spark, "records")
    archive.export_records(frame, path)
    found = sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in archive.import_records(spark, path).collect())
    assert found == sorted(rows)


def test_keys_that_are_no_slots_are_returned(spark):
    odd = cells(spark, 3).withColumn("row_key", F.when(F.col("ts") == 1, F.lit("zz")).otherwise(F.col("row_key")))
    assert archiving.to_archive(odd, "s", "blocks", 10).count() == 2
    assert [r["row_key"] for r in archiving.unplaced_cells(odd).collect()] == ["zz"]
