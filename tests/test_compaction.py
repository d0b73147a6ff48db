import pytest
from pyspark.sql import functions as F

from blockloom.model import RAW_TABLE, TX_TABLE
from blockloom.plans import compaction, loading
from blockloom.session import scratch_path, stage
from blockloom.sources import archive, tables

from test_losses import block_cells, raw_slots


def batch(spark, root, slots, commit, table="blocks"):
    """What a batch of the live job leaves: some cells of ranges of ten slots."""
    slot = F.conv("row_key", 16, 10).cast("bigint")
    name = F.concat(F.lit("range_"), F.hex((slot / 10).cast("bigint") * 10), F.lit("_"), F.hex((slot / 10).cast("bigint") * 10 + 9))
    cells = block_cells(spark, slots).withColumns({"sync_type": F.lit("live"), "table_name": F.lit(table), "range": name, "commit_id": F.lit(commit).cast("bigint")})
    archive.write_archive(cells, root)


def load(spark, root, out, end=99):
    return loading.load_archive(spark, root, "live", 0, end, spark.createDataFrame([], "address string"), out)


def stored(spark, root):
    return sorted((r["range"], int(r["row_key"], 16), r["commit_id"]) for r in archive.read_archive(spark, root, "live").collect())


def folders(spark, root):
    return archive.list_archive_files(spark, root).select(F.regexp_extract("path", "^(.*)/", 1)).distinct().count()


@pytest.fixture
def root(spark):
    root = scratch_path(spark, "archive")
    batch(spark, root, [0, 1, 10, 11, 12], 1)
    batch(spark, root, [2, 3, 13], 2)
    batch(spark, root, [4, 20], 3)
    return root


def test_one_folder_per_range_and_the_same_cells(spark, root):
    before = stored(spark, root)
    done = compaction.compact_archive(spark, root, "live")
    assert sorted((r["range"], r["folders"]) for r in done.collect()) == [("range_0_9", 3), ("range_A_13", 2)]
    assert stored(spark, root) == before and archive.read_archive(spark, root).count() == len(before)
    assert compaction.purge(spark, root) == 5 and compaction.purge(spark, root) == 0
    assert stored(spark, root) == before and folders(spark, root) == 3
    assert compaction.compact_archive(spark, root, "live").count() == 0


def test_loads_before_and_after_load_nothing_twice(spark, root):
    out = scratch_path(spark, "out")
    load(spark, root, out, 9)  # of the first range only
    batch(spark, root, [5, 6, 14], 4)
    compaction.compact_archive(spark, root, "live")
    load(spark, root, out)
    runs = spark.read.parquet(f"{out}/runs")
    assert runs.count() == runs.select("path").distinct().count() == 8
    assert raw_slots(spark, out) == [*range(7), *range(10, 15), 20]
    # Each commit of the target has its own slots: none came in two loads.
    assert sum(tables.read_commit(spark, f"{out}/tx", TX_TABLE, run).count() for run in (1, 2)) == 13
    compaction.purge(spark, root)
    load(spark, root, out)
    assert spark.read.parquet(f"{out}/runs").select("run_id").distinct().count() == 2


def test_compaction_of_compacted_ranges(spark, root):
    out = scratch_path(spark, "out")
    compaction.compact_archive(spark, root, "live")
    load(spark, root, out)
    batch(spark, root, [7, 15], 5)
    assert compaction.compact_archive(spark, root, "live").count() == 2
    compaction.purge(spark, root)
    expected = stored(spark, root)
    assert [s for _, s, _ in expected] == [0, 1, 2, 3, 4, 7, 20, 10, 11, 12, 13, 15] and folders(spark, root) == 3
    load(spark, root, out)
    assert raw_slots(spark, out) == sorted(s for _, s, _ in expected)
    assert tables.read_commit(spark, f"{out}/blocks", RAW_TABLE, 2).count() == 2


def test_a_run_that_died_changes_nothing(spark, root, monkeypatch):
    before = stored(spark, root)
    monkeypatch.setattr(compaction.snapshots, "create_once", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compaction.compact_archive(spark, root, "live")
    monkeypatch.undo()
    assert stored(spark, root) == before  # its folders are there, but count for nobody
    assert loading.stored_folders(spark, root, "live").count() == 6
    assert compaction.compact_archive(spark, root, "live").count() == 2
    compaction.purge(spark, root)
    assert stored(spark, root) == before


def test_of_two_at_once_one_gives_up(spark, root, monkeypatch):
    before, write = stored(spark, root), archive.write_archive
    nested = []

    def meanwhile(cells, place):
        if not nested:
            nested.append(0)
            nested.append(compaction.compact_archive(spark, root, "live").count())
        write(cells, place)

    monkeypatch.setattr(archive, "write_archive", meanwhile)
    assert compaction.compact_archive(spark, root, "live").count() == 0 and nested == [0, 2]
    assert stored(spark, root) == before


def test_a_load_that_died_finds_its_cells_after_a_purge(spark, root, monkeypatch):
    out = scratch_path(spark, "out")
    with monkeypatch.context() as patch:
        patch.setattr(loading, "entries_passthrough", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, root, out)
    compaction.compact_archive(spark, root, "live")
    compaction.purge(spark, root)
    load(spark, root, out)
    assert raw_slots(spark, out) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 20]


def test_an_archive_that_is_not_there(spark):
    assert compaction.compact_archive(spark, scratch_path(spark, "none"), "live").count() == 0


def test_a_reader_that_began_before_the_publication(spark, root, monkeypatch):
    """Its runs are older than its listing of folders: it sees the old folders, and the new ones not."""
    before, asked, known = stored(spark, root), [], archive.compactions

    def early(*args, **options):
        found = known(*args, **options)
        if len(asked) < 2:  # both questions of one reader
            asked.append(1)
            if len(asked) == 2:
                compaction.compact_archive(spark, root, "live")
        return found

    monkeypatch.setattr(archive, "compactions", early)
    assert stored(spark, root) == before and len(asked) == 2
    monkeypatch.undo()
    assert stored(spark, root) == before and known(spark, root)
