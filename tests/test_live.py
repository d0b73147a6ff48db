import os

import pytest
from pyspark.sql import functions as F

from blockloom.session import scratch_path
from blockloom.sources import archive, tables
from blockloom.streaming import live


def put(folder, path, content):
    """Files arrive by rename."""
    target = folder / path
    target.parent.mkdir(parents=True, exist_ok=True)
    part = folder.parent / "arriving"
    part.write_bytes(content)
    os.replace(part, target)


@pytest.fixture
def places(spark, tmp_path):
    folder = tmp_path / "live"
    folder.mkdir()
    return folder, scratch_path(spark, "archive"), scratch_path(spark, "checkpoint"), scratch_path(spark, "rejects")


def stored(spark, root):
    rows = archive.read_archive(spark, root).collect()
    return sorted((r["table_name"], r["range"], r["row_key"], bytes(r["value"])) for r in rows)


FIRST = {
    "range_0_9/1/blocks/0001.pb": b"one",
    "range_0_9/1/entries/0001": b"two",
    "range_0_9/2/blocks/0002.v1.pb": b"three",
    "range_0_9/2/other/0002.pb": b"skip",
    "range_0_9/2/blocks/empty.pb": b"",
}
FIRST_ROWS = [
    ("blocks", "range_0_9", "0001", b"one"),
    ("blocks", "range_0_9", "0002.v1", b"three"),
    ("blocks", "range_0_9", "empty", b""),
    ("entries", "range_0_9", "0001", b"two"),
]


def test_restart_continues(spark, places):
    folder, root, checkpoint, rejects = places
    for path, content in FIRST.items():
        put(folder, path, content)

    def run(**options):
        live.follow(spark, str(folder), root, "live", checkpoint, rejects=rejects, **options).awaitTermination()

    run(files_per_batch=2)
    assert stored(spark, root) == FIRST_ROWS
    assert [r["row_key"] for r in spark.read.parquet(rejects).collect()] == ["0002"]
    put(folder, "range_0_9/3/blocks/0003.pb", b"late")
    put(folder, "range_10_19/11/blocks/000b.pb", b"next")
    run()
    expected = sorted(FIRST_ROWS + [("blocks", "range_0_9", "0003", b"late"), ("blocks", "range_10_19", "000b", b"next")])
    assert stored(spark, root) == expected
    run()
    assert stored(spark, root) == expected


def test_follow_picks_up_new_files(spark, places):
    folder, root, checkpoint, _ = places
    for path, content in FIRST.items():
        put(folder, path, content)
    query = live.backfill_then_follow(spark, str(folder), root, "live", checkpoint, "0 seconds", 2)
    try:
        assert stored(spark, root) == FIRST_ROWS
        put(folder, "range_0_9/3/blocks/0003.pb", b"late")
        query.processAllAvailable()
        assert ("blocks", "range_0_9", "0003", b"late") in stored(spark, root)
    finally:
        query.stop()


def test_clean_up_moves_finished_files_only(spark, places, tmp_path):
    folder, root, checkpoint, rejects = places
    done = tmp_path / "done"
    for number in range(6):
        put(folder, f"range_0_9/{number}/blocks/{number:04}.pb", b"v%d" % number)
    live.follow(
        spark, str(folder), root, "live", checkpoint, files_per_batch=1, clean_source="archive", done_folder=str(done), rejects=rejects
    ).awaitTermination()
    left = [path for path in folder.rglob("*") if path.is_file()]
    moved = [path for path in done.rglob("*") if path.is_file()]
    assert len(left) + len(moved) == 6 and moved
    assert len(stored(spark, root)) == 6


def test_failed_batch_keeps_source_files(spark, places, tmp_path, monkeypatch):
    folder, root, checkpoint, rejects = places
    put(folder, "range_0_9/1/blocks/0001.pb", b"one")

    def broken(cells, root):
        raise OSError("store is down")

    monkeypatch.setattr(archive, "write_archive", broken)
    with pytest.raises(Exception, match="store is down"):
        live.follow(
            spark, str(folder), root, "live", checkpoint, clean_source="delete", rejects=rejects
        ).awaitTermination()
    monkeypatch.undo()
    assert (folder / "range_0_9/1/blocks/0001.pb").exists()
    live.follow(spark, str(folder), root, "live", checkpoint).awaitTermination()
    assert stored(spark, root) == [("blocks", "range_0_9", "0001", b"one")]


def test_archive_needs_a_folder(spark, places):
    with pytest.raises(ValueError):
        live.live_files(spark, str(places[0]), clean_source="archive")


def test_streamed_puts_restart_on_one_checkpoint(spark, tmp_path):
    source, path, checkpoint = str(tmp_path / "puts"), scratch_path(spark, "table"), scratch_path(spark, "checkpoint")
    schema = "row_key string, value string"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        live.upsert_stream(stream, path, checkpoint).awaitTermination()
        latest = tables.read_table(spark, path, spark.createDataFrame([], schema).schema)
        return {r["row_key"]: r["value"] for r in latest.collect()}

    assert run([("a", "1"), ("b", "1")]) == {"a": "1", "b": "1"}
    assert run([("a", "0")]) == {"a": "0", "b": "1"}


def follow(spark, places, **options):
    folder, root, checkpoint, rejects = places
    live.follow(spark, str(folder), root, "live", checkpoint, rejects=rejects, **options).awaitTermination()


def files_below(folder):
    return sorted(str(path.relative_to(folder)) for path in folder.rglob("*") if path.is_file())


def states(frame):
    return {r["range"]: (r["files"], r["rejected"], r["cleaned"]) for r in frame.collect()}


def test_only_empty_files(spark, places):
    folder, root, _, rejects = places
    put(folder, "range_0_9/1/entries/0001.pb", b"")
    put(folder, "range_0_9/1/other/0002.pb", b"")
    follow(spark, places)
    assert stored(spark, root) == [("entries", "range_0_9", "0001", b"")]
    assert [(r["row_key"], bytes(r["value"])) for r in spark.read.parquet(rejects).collect()] == [("0002", b"")]
    assert sorted((r["path"].rsplit("/", 1)[1], r["length"]) for r in archive.list_archive_files(spark, str(folder)).collect()) == [("0001.pb", 0), ("0002.pb", 0)]


def test_odd_names(spark, places):
    folder, root, checkpoint, rejects = places
    names = ["a b", "50%", "x+y", "é", "a%20b", "q[1]", "st*r"]
    for number, name in enumerate(names):
        put(folder, f"range_0_9/{number}/blocks/{name}.pb", b"" if number % 2 else b"v")
        put(folder, f"range_0_9/{number}/other/{name}.pb", b"" if number % 3 else b"w")
    follow(spark, places)
    assert [r[2] for r in stored(spark, root)] == sorted(names)
    found = {r["row_key"]: bytes(r["value"]) for r in spark.read.parquet(rejects).collect()}
    assert found == {name: b"" if number % 3 else b"w" for number, name in enumerate(names)}
    assert live.committed_files(spark, checkpoint).count() == 14


def test_compacted_record_of_files(spark, places):
    """Every tenth entry of the stream's record replaces those before it."""
    folder, root, checkpoint, _ = places
    for number in range(13):
        put(folder, f"range_0_9/{number}/blocks/{number:04}.pb", b"" if number % 2 else b"v")
    follow(spark, places, files_per_batch=1)
    assert len(stored(spark, root)) == 13
    assert live.committed_files(spark, checkpoint).distinct().count() == 13


def test_a_repeated_batch_repeats_nothing(spark, places, monkeypatch):
    folder, root, checkpoint, _ = places
    for path, content in FIRST.items():
        put(folder, path, content)
    write = archive.write_archive

    def dies(cells, root):
        write(cells, root)
        raise OSError("killed after the write")

    monkeypatch.setattr(archive, "write_archive", dies)
    with pytest.raises(Exception, match="killed"):
        follow(spark, places)
    monkeypatch.undo()
    put(folder, "range_0_9/3/blocks/0003.pb", b"")
    assert states(live.clean_ranges(spark, str(folder), checkpoint, places[3])) == {"range_0_9": (6, 0, False)}
    follow(spark, places)
    assert stored(spark, root) == sorted([*FIRST_ROWS, ("blocks", "range_0_9", "0003", b"")])


def test_ranges_go_when_all_their_files_are_archived(spark, places):
    folder, root, checkpoint, rejects = places
    for number in (0, 10, 20):
        put(folder, f"range_{number}_{number + 9}/{number}/blocks/{number:04}.pb", b"v")
        put(folder, f"range_{number}_{number + 9}/{number}/entries/{number:04}.pb", b"")
    put(folder, "range_10_19/10/other/0010.pb", b"no table takes it")
    follow(spark, places, files_per_batch=3)
    put(folder, "range_20_29/21/blocks/0021.pb", b"late")
    kept = ["range_10_19/10/blocks/0010.pb", "range_10_19/10/entries/0010.pb", "range_10_19/10/other/0010.pb"]
    late = ["range_20_29/20/blocks/0020.pb", "range_20_29/20/entries/0020.pb", "range_20_29/21/blocks/0021.pb"]
    expected = {"range_0_9": (2, 0, True), "range_10_19": (3, 1, False), "range_20_29": (3, 0, False)}
    assert states(live.clean_ranges(spark, str(folder), checkpoint, rejects)) == expected
    assert files_below(folder) == kept + late and not (folder / "range_0_9").exists()
    follow(spark, places)
    found = states(live.clean_ranges(spark, str(folder), checkpoint, rejects))
    assert found == {"range_10_19": (3, 1, False), "range_20_29": (3, 0, True)}
    assert files_below(folder) == kept and not (folder / "range_20_29").exists()
    assert len(stored(spark, root)) == 7
    assert states(live.clean_ranges(spark, str(folder), checkpoint, rejects)) == {"range_10_19": (3, 1, False)}


def test_a_cleaning_that_failed_is_repeated(spark, places, monkeypatch):
    folder, root, checkpoint, rejects = places
    put(folder, "range_0_9/1/blocks/0001.pb", b"v")
    put(folder, "range_0_9/1/entries/0001.pb", b"")
    follow(spark, places)
    monkeypatch.setattr(live, "_remove", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        live.clean_ranges(spark, str(folder), checkpoint, rejects)
    monkeypatch.undo()
    assert len(files_below(folder)) == 2
    assert states(live.clean_ranges(spark, str(folder), checkpoint, rejects)) == {"range_0_9": (2, 0, True)}
    assert files_below(folder) == []
    assert states(live.clean_ranges(spark, str(folder), checkpoint, rejects)) == {}


def test_a_listing_survives_files_that_are_moved_meanwhile(spark, places, tmp_path):
    """Spark goes on to move finished files after a stream has ended."""
    folder = places[0]
    for number in range(4):
        put(folder, f"range_0_9/{number}/blocks/{number:04}.pb", b"" if number == 3 else b"v")
    listed = archive.list_archive_files(spark, str(folder))
    os.replace(folder / "range_0_9/1/blocks/0001.pb", tmp_path / "0001.pb")
    assert sorted((r["path"].rsplit("/", 1)[1], r["length"]) for r in listed.collect()) == [("0000.pb", 1), ("0002.pb", 1), ("0003.pb", 0)]


def test_a_batch_is_read_once(spark, places, monkeypatch):
    """Archive, rejects and the search for empty files share one reading of a batch's files."""
    folder, _, _, rejects = places
    put(folder, "range_0_9/0/other/0000.pb", b"no table takes it")
    seen, stage = [], live.stage
    monkeypatch.setattr(live, "stage", lambda rows, label: seen.append(label) or stage(rows, label))
    follow(spark, places)
    assert seen.count("batch-rows") == 1
    assert [bytes(r["value"]) for r in spark.read.parquet(rejects).collect()] == [b"no table takes it"]


def test_a_listing_takes_few_tasks(spark, places, setting):
    """By default every file of a batch has a task of its own that lists it again."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    setting(name, "10000")
    for number in range(40):
        put(places[0], f"range_0_9/{number}/blocks/{number:04}.pb", b"v")
    follow(spark, places)
    assert int(spark.conf.get(name)) == 8 * spark.sparkContext.defaultParallelism
    setting(name, "7")
    archive.list_archive_files(spark, str(places[0]))
    assert spark.conf.get(name) == "7"


def test_the_live_tree_is_written_as_by_spark(spark, tmp_path):
    """Each file whole and named as Spark names folders; rows of one folder in one file, nulls among them."""
    from blockloom import samples

    rows = "SELECT * FROM VALUES (1, 'a'), (1, 'b'), (4, NULL), (NULL, 'c'), (107, 'é') AS t(page_id, html)"
    spark.sql(rows).selectExpr("cast(page_id as bigint) page_id", "html").write.parquet(str(tmp_path / "pages.parquet"))
    folder, other = tmp_path / "live", tmp_path / "spark"
    samples.write_live_tree(spark, str(tmp_path), str(folder))
    samples.add_empty_files(spark, str(tmp_path), str(folder))
    samples._live_rows(spark, str(tmp_path)).repartition("slot").write.partitionBy("range", "slot", "kind").text(str(other))

    def contents(top):
        return sorted((str(p.parent.relative_to(top)), sorted(p.read_bytes().split(b"\n"))) for p in top.rglob("part-*.txt"))

    assert contents(folder) == contents(other) and len(contents(folder)) == 4
    assert [p.stat().st_size for p in folder.rglob("empty.txt")] == [0] and {p.name for p in folder.iterdir()} == {p.name for p in other.iterdir() if p.name[0] not in "._"}


def test_a_stream_of_local_files_keeps_no_names_on_the_driver(spark, places):
    """Its source has a marker for each batch, of the files that are oldest; the names are in tables."""
    folder, root, checkpoint, _ = places
    for number in range(7):
        put(folder, f"range_0_9/{number}/blocks/{number:04}.pb", b"v%d" % number)
        os.utime(folder / f"range_0_9/{number}/blocks/{number:04}.pb", (1000 - number, 1000 - number))
    follow(spark, places, files_per_batch=3)
    assert [r["path"].rsplit("/", 1)[1] for r in live._logged(spark, checkpoint, 0, 9).sort("path").collect()] == [f"{n:010d}.json" for n in range(3)]
    batches = [sorted(r["path"].rsplit("/", 1)[1] for r in live.batch_files(spark, checkpoint, n).collect()) for n in range(3)]
    assert batches == [["0004.pb", "0005.pb", "0006.pb"], ["0001.pb", "0002.pb", "0003.pb"], ["0000.pb"]]
    assert live.committed_files(spark, checkpoint).count() == 7 and len(stored(spark, root)) == 7


def test_a_stream_that_spark_listed_goes_on(spark, places, monkeypatch):
    """Files that a checkpoint of Spark's own file source has are not archived again."""
    folder, root, checkpoint, rejects = places
    is_local = live.local.is_local
    put(folder, "range_0_9/1/blocks/0001.pb", b"one")
    put(folder, "range_0_9/1/blocks/empty.pb", b"")
    monkeypatch.setattr(live.local, "is_local", lambda spark, path: path != live.archive.qualified(spark, str(folder)) and is_local(spark, path))
    follow(spark, places)
    monkeypatch.undo()
    for name in ("0002.pb", "0003.pb"):
        put(folder, f"range_0_9/2/blocks/{name}", b"two")
        follow(spark, places)
    assert [r[2] for r in stored(spark, root)] == ["0001", "0002", "0003", "empty"]
    commits = archive.read_archive(spark, root).groupBy("row_key").agg(F.count_distinct("commit_id")).collect()
    assert sorted(map(tuple, commits)) == [("0001", 1), ("0002", 1), ("0003", 1), ("empty", 1)]
    assert live.committed_files(spark, checkpoint).count() == 4


def test_a_listing_that_fails_ends_the_stream(spark, places, monkeypatch):
    folder, root, checkpoint, _ = places
    query = live.follow(spark, str(folder), root, "live", checkpoint, "0 seconds")
    monkeypatch.setattr(live, "look_for_files", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        query.awaitTermination(60)
    assert not query.isActive
