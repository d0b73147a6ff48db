"""Cases that once lost rows, changed them, or ended a job."""

import pytest
from pyspark.sql import functions as F

from blockloom.functions import keys
from blockloom.model import ADDRESS_TABLE, CELL, RAW_TABLE, TX_TABLE
from blockloom.operators import blocks, payloads, ranges
from blockloom.plans import archiving, loading
from blockloom.session import scratch_path, stage
from blockloom.sources import archive, ledgers, tables
from blockloom.streaming import live

from test_loading import current_json, key, legacy_json


def block_cells(spark, slots):
    rows = [(key(s), "x", "bin", 1, legacy_json(f"s{s}", ["a", f"k{s}"])) for s in slots]
    return stage(payloads.encode_payloads(spark.createDataFrame(rows, CELL)).drop("codec"), "cells")


@pytest.fixture
def load(spark):
    reserved = spark.createDataFrame([], "address string")

    def run(root, out, start, end):
        return loading.load_archive(spark, root, "sync", start, end, reserved, out)

    return run


def archived(spark, slots, root=None, sync_type="sync", size=10):
    root = root or scratch_path(spark, "archive")
    rows = block_cells(spark, slots)
    archiving.archive_key_range(spark, rows, min(slots), max(slots), size, root, scratch_path(spark, "ledger"), sync_type, "blocks")
    return root


def raw_slots(spark, out):
    return sorted(int(r["row_key"], 16) for r in tables.read_table(spark, f"{out}/blocks", RAW_TABLE).collect())


def test_two_loads_keep_all_rows(spark, load):
    root, out = archived(spark, range(40)), scratch_path(spark, "out")
    load(root, out, 0, 19)
    load(root, out, 19, 39)
    assert raw_slots(spark, out) == list(range(40))


def test_two_archives_in_one_target(spark, load):
    out = scratch_path(spark, "out")
    roots = [archived(spark, range(10)), archived(spark, range(5, 10))]
    load(roots[0], out, 0, 9)
    load(roots[1], out, 0, 9)
    assert ledgers.read_file_ledger(spark, f"{out}/snapshots").count() == 2


def test_a_load_that_died_is_finished_under_its_number(spark, load, monkeypatch):
    root, out = archived(spark, range(20)), scratch_path(spark, "out")
    with monkeypatch.context() as patch:
        patch.setattr(loading, "entries_passthrough", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(root, out, 0, 9)
    load(root, out, 9, 19)
    assert raw_slots(spark, out) == list(range(20))
    runs = spark.read.parquet(f"{out}/runs").select("run_id").distinct().count()
    assert runs == spark.read.parquet(f"{out}/finished").count() == 2


def test_sync_types_named_like_tables(spark, load):
    root, out = scratch_path(spark, "archive"), scratch_path(spark, "out")
    archived(spark, range(10), root, "blocks-v2")
    entries = block_cells(spark, range(10)).withColumn("value", F.lit(b"entry"))
    archiving.archive_key_range(spark, entries, 0, 9, 10, root, scratch_path(spark, "ledger"), "blocks-v2", "entries")
    reserved = spark.createDataFrame([], "address string")
    assert loading.load_archive(spark, root, "blocks-v2", 0, 9, reserved, out).count() == 0
    assert tables.read_table(spark, f"{out}/tx", TX_TABLE).count() == 10


def test_bytes_that_are_no_text_are_rejected(spark, load):
    bad = spark.createDataFrame([(key(3), "x", "proto", 1, b"\0\0\0\0\xff\xfe\x80")], CELL)
    root, out = scratch_path(spark, "archive"), scratch_path(spark, "out")
    rows = block_cells(spark, range(3)).union(bad)
    archiving.archive_key_range(spark, rows, 0, 9, 10, root, scratch_path(spark, "ledger"), "sync", "blocks")
    assert [r["error"] for r in load(root, out, 0, 9).collect()] == ["payload does not parse"]
    report = {r["outcome"]: r["rows"] for r in loading.load_report(spark, out).collect()}
    assert report == {"stored": 4, "rejected: payload does not parse": 1}


def test_null_account_keys(spark):
    tx = "struct<signatures:array<string>,account_keys:array<string>,memo:string,meta:struct<err:string>>"
    rows = spark.createDataFrame([(1, 5, [(["s"], [None, "a", "b"], None, (None,))])], f"slot long, block_time long, transactions array<{tx}>")
    found = blocks.tx_by_addr(rows, spark.createDataFrame([], "address string")).collect()
    assert {(r["address"], len(r["entries"])) for r in found} == {(None, 1), ("a", 1), ("b", 1)}
    raw = payloads.encode_payloads(spark.createDataFrame([(key(1), "x", "proto", 1, current_json("s", [None, "a"], []))], CELL)).drop("codec")
    assert loading.parse_blocks(raw).first()["error"] == "transaction with a null account key"


def test_plan_must_fit_the_size(spark):
    planned = ranges.split_key_range(spark, 0, 99, 100)
    with pytest.raises(ValueError):
        archiving.archive_ranges(spark, block_cells(spark, [1]), planned, 50, scratch_path(spark, "a"), scratch_path(spark, "l"), "sync", "blocks")


def test_cells_without_a_slot_are_set_aside(spark):
    rows = block_cells(spark, range(10)).union(spark.createDataFrame([("zz", "x", "bin", 1, b"v")], CELL))
    root, ledger, rejects = (scratch_path(spark, name) for name in ("a", "l", "r"))
    with pytest.raises(ValueError, match="no slot"):
        archiving.archive_key_range(spark, rows, 0, 9, 10, root, ledger, "sync", "blocks")
    assert archiving.archive_key_range(spark, rows, 0, 9, 10, root, ledger, "sync", "blocks", rejects=rejects) == 1
    assert [r["row_key"] for r in spark.read.parquet(rejects).collect()] == ["zz"]
    assert archive.read_archive(spark, root).count() == 10


def test_keys_spelt_in_another_way_are_set_aside(spark):
    spelt = ["000000000000000a", "B", "0c", "000000000000000D", "0000000000000000e", None, "", "x"]
    rows = spark.createDataFrame([(k, "x", "bin", 1, b"v") for k in spelt], CELL)
    root, ledger, rejects = (scratch_path(spark, name) for name in ("a", "l", "r"))
    assert archiving.archive_key_range(spark, rows, 0, 15, 16, root, ledger, "sync", "blocks", rejects=rejects) == 7
    stored = [r["row_key"] for r in archive.read_archive(spark, root).collect()]
    assert stored == ["000000000000000a"]
    set_aside = [r["row_key"] for r in archiving.read_rejects(spark, rejects).collect()]
    assert sorted(stored + set_aside, key=repr) == sorted(spelt, key=repr)


def test_runs_keep_the_rejects_of_others(spark):
    root, ledger, rejects = (scratch_path(spark, name) for name in ("a", "l", "r"))
    for start, bad in ((0, "zz"), (10, "yy")):
        rows = block_cells(spark, range(start, start + 10)).union(spark.createDataFrame([(bad, "x", "bin", 1, b"v")], CELL))
        for _ in range(2):
            archiving.archive_key_range(spark, rows, start, start + 9, 10, root, ledger, "sync", "blocks", rejects=rejects)
    assert sorted(r["row_key"] for r in archiving.read_rejects(spark, rejects).collect()) == ["yy", "zz"]
    assert archiving.read_rejects(spark, scratch_path(spark, "none")).count() == 0


def test_a_failed_wave_leaves_the_others_done(spark):
    rows = block_cells(spark, range(40))
    broken = rows.withColumn("value", F.when(F.col("row_key") == key(15), F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("value")))
    root, ledger = scratch_path(spark, "a"), scratch_path(spark, "l")
    with pytest.raises(Exception, match="lost"):
        archiving.archive_key_range(spark, broken, 0, 39, 10, root, ledger, "sync", "blocks", waves=4)
    plan = ranges.split_key_range(spark, 0, 39, 10)
    known = ledgers.read_range_ledger(spark, ledger, "sync", "blocks")
    states = {int(r["start_key"], 16): r["status"] for r in ranges.range_status(plan, known).collect()}
    assert states == {0: "done", 10: "failed", 20: "done", 30: "done"}
    archiving.archive_key_range(spark, rows, 0, 39, 10, root, ledger, "sync", "blocks", waves=4)
    assert archive.read_archive(spark, root).count() == 40


def test_an_empty_commit_replaces_rows(spark):
    path, rows = scratch_path(spark, "t"), spark.createDataFrame([("a", 1, 0, None, None)], TX_TABLE)
    tables.write_commit(rows, path, 1)
    tables.write_commit(rows.limit(0), path, 1)
    assert tables.read_table(spark, path, TX_TABLE).count() == 0


def test_streams_of_two_checkpoints_keep_their_rows(spark, tmp_path):
    path, schema = scratch_path(spark, "t"), "row_key string, value string"
    for name in ("k1", "k2", "k1"):
        source = f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}"
        spark.createDataFrame([(name, source)], schema).write.parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        live.upsert_stream(stream, path, scratch_path(spark, "checkpoint")).awaitTermination()
    latest = tables.read_table(spark, path, spark.createDataFrame([], schema).schema).collect()
    assert {r["row_key"] for r in latest} == {"k1", "k2"}
    assert [r["value"] for r in latest if r["row_key"] == "k1"] == [source]


def test_folders_of_any_spelling(spark, tmp_path):
    (tmp_path / "in/range_0_f/1/blocks").mkdir(parents=True)
    (tmp_path / "in/range_0_f/1/blocks/0001.pb").write_bytes(b"v")
    for folder in (f"file://{tmp_path}/in", f"file:{tmp_path}/in/", f"{tmp_path}/in"):
        root = scratch_path(spark, "a")
        live.follow(spark, folder, root, "live", scratch_path(spark, "c")).awaitTermination()
        assert archive.read_archive(spark, root).first()["range"] == "range_0_f"
    with pytest.raises(Exception, match="not below"):
        spark.range(1).select(keys.folder_below(F.lit("file:/other/x"), "/data")).collect()


def test_rejected_files_keep_their_content(spark, tmp_path):
    (tmp_path / "in/range_0_f/1/other").mkdir(parents=True)
    (tmp_path / "in/range_0_f/1/other/0001.pb").write_bytes(b"v")
    rejects = scratch_path(spark, "rejects")
    with pytest.raises(ValueError):
        live.follow(spark, f"{tmp_path}/in", scratch_path(spark, "a"), "live", scratch_path(spark, "c"), clean_source="delete")
    live.follow(spark, f"{tmp_path}/in", scratch_path(spark, "a"), "live", scratch_path(spark, "c"), clean_source="delete", rejects=rejects).awaitTermination()
    assert [bytes(r["value"]) for r in spark.read.parquet(rejects).collect()] == [b"v"]


def test_records_of_any_length_time_and_value(spark):
    rows = [("k", "f" * 70_000, "q" * 70_000, -5, b"v" * 70_000), ("n", "f", "q", -(2**63), None), ("e", "", "", 0, b"")]
    path = scratch_path(spark, "records")
    archive.export_records(spark.createDataFrame(rows, CELL), path)
    found = [(*r[:4], None if r[4] is None else bytes(r[4])) for r in archive.import_records(spark, path).collect()]
    assert sorted(found, key=repr) == sorted(rows, key=repr)


def test_keys_before_a_newline_are_no_slots(spark):
    assert spark.range(1).select(keys.key_to_slot(F.lit("0a\n"))).first()[0] is None


@pytest.mark.parametrize("inclusive", (True, False))
def test_overlap_up_to_the_largest_slot(spark, inclusive):
    top = 2**63 - 1
    files = spark.createDataFrame([("all", 0, top), ("last", top, top), ("low", 0, 9)], "path string, lo long, hi long")
    requests = spark.createDataFrame([(1, top - 5, top), (2, 9, 9), (3, top, top)], "id long, s long, e long")
    found = {(r["path"], r["id"]) for r in ranges.overlapping_files_of_requests(files, requests, inclusive).collect()}
    touch = {(f, i) for f, lo, hi in [("all", 0, top), ("last", top, top), ("low", 0, 9)] for i, s, e in [(1, top - 5, top), (2, 9, 9), (3, top, top)] if (max(lo, s) <= min(hi, e) if inclusive else max(lo, s) < min(hi, e))}
    assert found == touch


def test_addresses_of_the_serving_table(spark, load):
    root, out = archived(spark, range(3)), scratch_path(spark, "out")
    load(root, out, 0, 9)
    assert {r["address"] for r in tables.read_table(spark, f"{out}/tx-by-addr", ADDRESS_TABLE).collect()} == {"a", "k0", "k1", "k2"}
