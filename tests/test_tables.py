from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F, types as T

from blockloom.functions import keys
from blockloom.model import TX_ORDER, TX_TABLE
from blockloom.session import scratch_path
from blockloom.sources import ledgers, snapshots, tables


def puts(spark, rows):
    return spark.createDataFrame(rows, TX_TABLE)


def view(spark, path):
    rows = tables.read_table(spark, path, TX_TABLE, TX_ORDER).collect()
    return {r["row_key"]: (r["commit_id"], r["slot"], r["index"], r["err"]) for r in rows}


def test_latest_wins_and_replay_changes_nothing(spark):
    path = scratch_path(spark, "tx")
    tables.write_commit(puts(spark, [("a", 1, 0, None, None), ("a", 1, 2, "E", None), ("b", 1, 1, None, None)]), path, 1)
    second = puts(spark, [("b", 0, 0, "late", None)])
    tables.write_commit(second, path, 2)
    expected = {"a": (1, 1, 2, "E"), "b": (2, 0, 0, "late")}
    assert view(spark, path) == expected
    tables.write_commit(second, path, 2)
    assert view(spark, path) == expected
    tables.compact(spark, path, TX_TABLE, TX_ORDER)
    assert view(spark, path) == expected
    tables.write_commit(puts(spark, [("a", 9, 9, None, None)]), path, 3)
    assert view(spark, path)["a"] == (3, 9, 9, None)


def test_commit_can_be_read_alone(spark):
    path = scratch_path(spark, "tx")
    tables.write_commit(puts(spark, [("a", 1, 0, None, None)]), path, 1)
    tables.write_commit(puts(spark, [("b", 1, 0, None, None)]), path, 2)
    assert [r["row_key"] for r in tables.read_commit(spark, path, TX_TABLE, 2).collect()] == ["b"]


def test_missing_table_is_empty_but_a_broken_one_fails(spark, tmp_path):
    assert tables.read_table(spark, f"{tmp_path}/none", TX_TABLE, TX_ORDER).count() == 0
    assert ledgers.read_file_ledger(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"this is no parquet file")
    with pytest.raises(Exception):
        ledgers.read_range_ledger(spark, f"{tmp_path}/broken", "s", "blocks").collect()


def test_hot_key_is_combined_before_the_shuffle(spark, plan_of):
    frame = spark.range(1000).selectExpr("'hot' AS row_key", "id AS slot", "id AS index", "'e' AS err", "'m' AS memo")
    latest = tables.latest_by_key(frame, TX_ORDER)
    assert latest.first()["slot"] == 999
    assert "partial_max" in plan_of(latest)


SCHEMA = "row_key string, value string"


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def values(spark, path, schema=None):
    schema = schema or kv(spark).schema
    return {r["row_key"]: r["value"] for r in tables.read_table(spark, path, schema).collect()}


def test_a_put_after_compaction_wins(spark):
    path = scratch_path(spark, "t")
    tables.put(kv(spark, ("a", "1"), ("b", "1")), path, "w", 0)
    tables.put(kv(spark, ("a", "2")), path, "w", 1)
    tables.compact(spark, path, kv(spark).schema)
    assert len(snapshots.snapshot(spark, path).commits) == 1
    tables.put(kv(spark, ("a", "3")), path, "w", 2)
    assert values(spark, path) == {"a": "3", "b": "1"}
    tables.put(kv(spark, ("b", "replayed")), path, "w", 0)  # is in the compacted files already
    assert values(spark, path) == {"a": "3", "b": "1"}
    tables.compact(spark, path, kv(spark).schema)
    assert snapshots.snapshot(spark, path).done == {"w": [[0, 2]]}
    assert values(spark, path) == {"a": "3", "b": "1"}


def test_a_late_commit_is_ordered_by_its_number(spark):
    """Compacted rows keep their commits: one that comes late is newer than some of them and older than others."""
    path = scratch_path(spark, "t")
    tables.write_commit(kv(spark, ("a", "1"), ("b", "1")), path, 1)
    tables.write_commit(kv(spark, ("a", "5")), path, 5)
    tables.compact(spark, path, kv(spark).schema)
    tables.write_commit(kv(spark, ("a", "3"), ("b", "3")), path, 3)
    assert values(spark, path) == {"a": "5", "b": "3"}


def test_writers_and_a_compaction_at_once(spark):
    path = scratch_path(spark, "t")

    def write(writer):
        for number in range(4):
            tables.put(kv(spark, (f"{writer}{number}", writer), ("both", f"{writer}{number}")), path, writer, number)

    def squeeze():
        for _ in range(3):
            tables.compact(spark, path, kv(spark).schema)

    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(write, "x"), pool.submit(write, "y"), pool.submit(squeeze)]
        [job.result() for job in jobs]
    found = values(spark, path)
    assert found.pop("both") in ("x3", "y3")
    assert found == {f"{w}{n}": w for w in "xy" for n in range(4)}


def test_a_reader_sees_one_state(spark):
    path, schema = scratch_path(spark, "t"), kv(spark).schema
    tables.put(kv(spark, ("a", "1")), path, "w", 0)
    before = snapshots.snapshot(spark, path)
    view = tables.read_table(spark, path, schema, at=before)
    tables.put(kv(spark, ("a", "2")), path, "w", 1)
    tables.compact(spark, path, schema)
    assert [r["value"] for r in view.collect()] == ["1"]
    assert snapshots.expire(spark, path, keep=len(snapshots.versions(spark, path))) == 0
    assert snapshots.expire(spark, path) == 2
    assert values(spark, path) == {"a": "2"}


def test_a_manifest_is_created_once(spark, tmp_path):
    (tmp_path / "m").mkdir()
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: snapshots.create_once(spark, f"{tmp_path}/m/0.json", str(n)), range(8)))
    assert sum(won) == 1 and snapshots.read_text(spark, f"{tmp_path}/m/0.json") == str(won.index(True))


def test_compaction_that_met_a_replay_is_done_again(spark, monkeypatch):
    path, schema = scratch_path(spark, "t"), kv(spark).schema
    tables.write_commit(kv(spark, ("a", "1")), path, 1)
    merge, tried = snapshots.merge, []

    def late(*args):
        if not tried:
            tables.write_commit(kv(spark, ("a", "again")), path, 1)
        tried.append(merge(*args))
        return tried[-1]

    monkeypatch.setattr(snapshots, "merge", late)
    tables.compact(spark, path, schema)
    assert tried == [False, True] and values(spark, path) == {"a": "again"}


def test_keys_open_only_their_files(spark):
    path, schema = scratch_path(spark, "t"), kv(spark).schema
    for number in range(6):
        rows = spark.range(number * 100, number * 100 + 120).selectExpr("lpad(id, 6, '0') AS row_key", f"'{number}' AS value")
        tables.put(rows.coalesce(1), path, "w", number, indexed=True)
    keys = spark.createDataFrame([("000250",), ("000310",), ("none",), (None,), ("000250",)], "row_key string")
    found = tables.read_keys(spark, path, schema, keys)
    assert {(r["row_key"], r["value"]) for r in found.collect()} == {("000250", "2"), ("000310", "3")}
    assert len(tables.files_of_keys(spark, path, keys, snapshots.snapshot(spark, path))) == 2  # of six; 310 is in two commits
    tables.compact(spark, path, schema, indexed=True)
    assert {(r["row_key"], r["value"]) for r in tables.read_keys(spark, path, schema, keys).collect()} == {("000250", "2"), ("000310", "3")}
    assert len(tables.files_of_keys(spark, path, keys, snapshots.snapshot(spark, path))) <= 2
    assert tables.read_keys(spark, scratch_path(spark, "none"), schema, keys).count() == 0


def history_table(spark, path, commits=4, slots=50):
    """Each commit has later slots of the same addresses, in files of a few slots; one slot is put twice."""
    for number in range(commits):
        rows = spark.range(number * slots, (number + 1) * slots + 1).selectExpr(
            "explode(array('hot', concat('rare', id % 40))) AS address", "id AS slot"
        ).select(keys.address_slot_key(F.col("address"), F.col("slot")).alias("row_key"), F.concat(F.lit(f"{number}:"), "slot").alias("value"))
        tables.put(rows.repartitionByRange(5, F.expr("substring_index(row_key, '/', -1)")), path, "w", number, indexed=True)


def test_newest_rows_of_a_prefix_with_early_stop(spark):
    path, schema = scratch_path(spark, "t"), kv(spark).schema
    history_table(spark, path)
    wanted = spark.createDataFrame([("hot", None), ("rare7", None), ("rar", None), ("hot", None)], "prefix string, after string")
    found = tables.scan_prefixes(spark, path, schema, wanted, 3).collect()
    assert [(r["place"], r["value"]) for r in sorted(found, key=lambda r: (r["row_key"], r["place"])) if r["row_key"].startswith("hot/")] == [
        (1, "3:200"), (2, "3:199"), (3, "3:198")
    ]
    rare = sorted((r["place"], r["value"]) for r in found if r["row_key"].startswith("rare7/"))
    assert [v.split(":")[1] for _, v in rare] == ["167", "127", "87"] and len(found) == 6
    now = snapshots.snapshot(spark, path)
    hot = spark.createDataFrame([("hot", None)], "prefix string, after string")
    files = tables.files_of_prefixes(spark, path, hot, 3, now)
    assert files.count() == 1  # of 20 files
    # Each scan goes on where the last one ended.
    seen, after = [], None
    while True:
        page = tables.scan_prefixes(spark, path, schema, spark.createDataFrame([("hot", after)], "prefix string, after string"), 64)
        rows = [r for r in sorted(page.collect())]
        if not rows:
            break
        seen += [r["value"].split(":")[1] for r in rows]
        after = rows[-1]["row_key"]
    assert seen == [str(n) for n in range(200, -1, -1)]
    tables.compact(spark, path, schema, indexed=True)
    assert sorted(tables.scan_prefixes(spark, path, schema, wanted, 3).collect()) == sorted(found)


def test_keys_that_were_put_once_are_not_shuffled(spark, plan_of):
    path = scratch_path(spark, "t")
    tables.put(kv(spark, *[(f"k{n}", "1") for n in range(20)], (None, "1")), path, "w", 0)
    view = tables.read_table(spark, path, kv(spark).schema)
    assert "hashpartitioning" not in plan_of(view) and view.count() == 21
    tables.put(kv(spark, ("k3", "2"), (None, "2")), path, "w", 1)
    assert values(spark, path) == {f"k{n}": "2" if n == 3 else "1" for n in range(20)} | {None: "2"}
    assert tables.read_table(spark, path, kv(spark).schema).columns == view.columns
    tables.put(kv(spark, *[(f"k{n}", "3") for n in range(20)]), path, "w", 2)
    assert values(spark, path) == {f"k{n}": "3" for n in range(20)} | {None: "2"}


def test_file_work_is_done_many_at_once():
    together, done = Barrier(8, timeout=30), []
    snapshots.for_each(lambda n: (together.wait(), done.append(n)), iter(range(16)), threads=8)
    assert sorted(done) == list(range(16))
    with pytest.raises(ZeroDivisionError):
        snapshots.for_each(lambda n: 1 / n, [1, 0], threads=2)


def test_a_scan_shuffles_rows_of_wanted_prefixes_only(spark, plan_of, setting, monkeypatch):
    """Hashes of the prefixes go to the rows before the join; more of them than may be sent change no result."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    path, schema = scratch_path(spark, "table"), T.StructType.fromDDL("row_key string, v bigint")
    rows = spark.range(2000).selectExpr("concat('a', id % 100, '/', lpad(id, 6, '0')) AS row_key", "id AS v")
    tables.put(rows.union(rows.limit(50)), path, "job", 0, indexed=True)
    wanted = spark.createDataFrame([("a3", None), ("a4", "a4/000204"), (None, None)], "prefix string, after string")
    scan = tables.scan_prefixes(spark, path, schema, wanted, 3)
    found = sorted(map(tuple, scan.collect()))
    assert [r[0] for r in found] == ["a3/000003", "a3/000103", "a3/000203", "a4/000304", "a4/000404", "a4/000504"]
    assert "LeftSemi" in plan_of(scan)
    monkeypatch.setattr(tables, "_SENT", 0)
    plain = tables.scan_prefixes(spark, path, schema, wanted, 3)
    assert "LeftSemi" not in plan_of(plain) and sorted(map(tuple, plain.collect())) == found


def test_an_index_shuffles_keys_once(spark, monkeypatch):
    """It tells apart repeated keys of a file where the file's keys of a prefix are counted."""
    path, plans, frames = scratch_path(spark, "table"), [], type(spark.range(0))
    write = frames.repartitionByRange

    def noted(frame, *args):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, *args)

    monkeypatch.setattr(frames, "repartitionByRange", noted)
    rows = spark.createDataFrame([("a/1", 1), ("a/1", 2), ("a/2", 3), ("b", 4), (None, 5)], "row_key string, v bigint").coalesce(1)
    tables.put(rows, path, "job", 0, indexed=True)
    assert plans[0].count("Exchange") == 1
    index = tables._index(spark, path, snapshots.snapshot(spark, path)).where("first IS NOT NULL").collect()
    assert sorted((r["first"], r["last"], r["keys"]) for r in index) == [("a/1", "a/2", 2), ("b", "b", 1)]
