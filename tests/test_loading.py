import json

import pytest
from pyspark.sql import functions as F

from blockloom.model import ADDRESS_TABLE, CELL, RAW_TABLE, TX_ORDER, TX_TABLE
from blockloom.operators import payloads
from blockloom.plans import archiving, loading
from blockloom.session import scratch_path, stage
from blockloom.sources import archive, ledgers, tables


def legacy_json(signature, accounts, complete=True):
    meta = {"fee": 1, "pre_balances": [1], "post_balances": [1]} if complete else None
    tx = {"transaction": {"signatures": [signature], "account_keys": accounts, "memo": "m"}, "meta": meta}
    return json.dumps({"blockhash": "h", "parent_slot": 1, "transactions": [tx], "rewards": [], "block_time": 77}).encode()


def current_json(signature, accounts, loaded):
    meta = {"err": "E", "loaded_addresses": {"writable": loaded, "readonly": []}}
    tx = {"transaction": {"signatures": [signature], "account_keys": accounts}, "meta": meta}
    return json.dumps({"transactions": [tx], "num_partitions": 1}).encode()


def key(slot):
    return f"{slot:016x}"


def source(spark):
    plain = [
        (key(1), "x", "bin", 1, legacy_json("s1", ["a", "r"])),
        (key(2), "x", "proto", 1, current_json("s2", ["a"], ["w"])),
        (key(3), "x", "bin", 1, legacy_json("s3", ["a"], complete=False)),
        (key(4), "x", "proto", 9, current_json("new", ["a"], [])),
        (key(4), "x", "proto", 1, current_json("old", ["b"], [])),
        (key(5), "x", "proto", 1, b"{not json"),
        (key(6), "x", "other", 1, b"{}"),
        (key(8), "x", "proto", 1, b'{"transactions": [{"transaction": {"signatures": []}, "meta": {}}]}'),
        (key(15), "x", "bin", 1, legacy_json("s15", ["b"])),
    ]
    encoded = payloads.encode_payloads(spark.createDataFrame(plain, CELL)).drop("codec")
    broken = spark.createDataFrame([(key(7), "x", "bin", 1, b"\x09\0\0\0")], CELL)
    return stage(encoded.unionByName(broken), "source")


def test_load_twice_and_extend(spark):
    root, ledger, out = (scratch_path(spark, name) for name in ("a", "l", "o"))
    rows = source(spark)
    for table in ("blocks", "entries"):
        archiving.archive_key_range(spark, rows, 0, 19, 10, root, ledger, "sync", table)
    reserved = spark.createDataFrame([("r",)], "address string")

    def load(end):
        return loading.load_archive(spark, root, "sync", 0, end, reserved, out)

    rejected = {int(r["row_key"], 16): r["error"] for r in load(9).collect()}
    assert set(rejected) == {5, 6, 7, 8}
    assert rejected[8] == "transaction without signature"
    assert rejected[6] == "unknown qualifier" and "codec" in rejected[7]
    tx = tables.read_table(spark, f"{out}/tx", TX_TABLE, TX_ORDER)
    assert {r["row_key"]: r["err"] for r in tx.collect()} == {"s1": None, "s2": "E", "new": "E"}
    raw = {int(r["row_key"], 16) for r in tables.read_table(spark, f"{out}/blocks", RAW_TABLE).collect()}
    assert raw == {1, 2, 3, 4, 5, 6, 7, 8}
    lists = tables.read_table(spark, f"{out}/tx-by-addr", ADDRESS_TABLE).collect()
    assert {(r["address"], r["slot"]) for r in lists} == {("a", 1), ("a", 2), ("w", 2), ("a", 4)}
    assert {e["block_time"] for r in lists if r["slot"] == 1 for e in r["entries"]} == {77}

    loaded = ledgers.read_file_ledger(spark, f"{out}/snapshots").count()
    assert loaded == 2
    assert load(9).count() == 0
    assert ledgers.read_file_ledger(spark, f"{out}/snapshots").count() == loaded
    load(19)
    assert "s15" in {r["row_key"] for r in tables.read_table(spark, f"{out}/tx", TX_TABLE, TX_ORDER).collect()}
    assert ledgers.read_file_ledger(spark, f"{out}/snapshots").count() == 4
    entries = tables.read_table(spark, f"{out}/entries", RAW_TABLE)
    assert entries.count() == 9


def test_other_folders_are_skipped(spark, plan_of):
    root, ledger = scratch_path(spark, "blocks-and-entries"), scratch_path(spark, "l")
    rows = source(spark)
    archiving.archive_key_range(spark, rows, 0, 19, 10, root, ledger, "sync", "blocks")
    chosen = loading.candidate_folders(spark, root, "sync", 10, 19, scratch_path(spark, "none"))
    # The name of the root itself routes nothing.
    assert [r["kind"] for r in chosen.collect()] == ["blocks"]
    found = loading.read_folders(spark, root, "sync", stage(chosen, "folders"), "blocks")
    assert [int(r["row_key"], 16) for r in found.collect()] == [15]
    assert "dynamicpruning" in plan_of(found)


def test_sync_types_are_folder_names(spark):
    with pytest.raises(ValueError):
        loading.stored_folders(spark, "/tmp", "a/b")


def test_raw_rows_keep_one_cell_without_shuffling_values(spark, plan_of):
    root = scratch_path(spark, "a")
    same = [(key(1), "x", "q", 1, b"1"), (key(1), "x", "q", 1, b"1"), (key(2), "x", "q", 1, b"2"), (key(3), "x", "q", 1, b"o"), (key(3), "x", "b", 1, b"n")]
    archive.write_archive(archiving.to_archive(spark.createDataFrame(same, CELL), "sync", "blocks", 10), root)
    stored = archive.read_archive(spark, root).withColumns(
        {"file": F.col("_metadata.file_path"), "position": F.col("_metadata.row_index")}
    )
    raw = loading.raw_rows(stored)
    assert sorted((int(r["row_key"], 16), bytes(r["value"])) for r in raw.collect()) == [(1, b"1"), (2, b"2"), (3, b"n")]
    assert all("Broadcast" in line for line in plan_of(raw).splitlines() if "Exchange" in line)


def test_nothing_archived_loads_nothing(spark):
    empty = spark.createDataFrame([], "address string")
    root, out = scratch_path(spark, "a"), scratch_path(spark, "o")
    assert loading.load_archive(spark, root, "sync", 0, 9, empty, out).count() == 0
