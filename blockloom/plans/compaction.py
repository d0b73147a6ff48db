"""Compaction of an archive: one folder per range instead of one per batch of the live job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from blockloom.plans import loading
from blockloom.session import stage
from blockloom.sources import archive, snapshots


def fragmented_ranges(spark: SparkSession, root: str, sync_type: str, folders: int, small: int) -> DataFrame:
    """Ranges in at least so many folders whose files have fewer than ``small`` bytes on the average."""
    files = archive.list_archive_files(spark, f"{root.rstrip('/')}/sync_type={sync_type}", missing_ok=True, empty=False)
    parts = files.select(
        F.regexp_extract("path", "table_name=([^/]*)", 1).alias("table_name"),
        F.regexp_extract("path", "range=([^/]*)", 1).alias("range"),
        F.regexp_extract("path", r"commit_id=(-?\d+)/", 1).cast("bigint").alias("commit_id"),
        "length",
    )
    live = loading.stored_folders(spark, root, sync_type).select("table_name", "range", "commit_id").distinct()
    ranges = parts.join(live, ["table_name", "range", "commit_id"]).groupBy("table_name", "range").agg(
        F.count_distinct("commit_id").alias("folders"), F.avg("length").alias("bytes")
    )
    return ranges.where((F.col("folders") >= folders) & (F.col("bytes") < small)).select("table_name", "range", "folders")


def compact_archive(spark: SparkSession, root: str, sync_type: str, folders: int = 2, small: int = 64 << 20) -> DataFrame:
    """Write the cells of fragmented ranges into one folder each; returns the ranges (table_name, range, folders).

    The new folders count for readers from the moment the run is published, and the old ones no longer; a run that
    died before has changed nothing. Every cell keeps the commit it came in, so loads know which of a folder's cells
    they have: nothing is loaded twice, and what was not yet loaded still is. Batches that arrive meanwhile stay apart.
    Of two compactions at once the one that publishes second has worked on folders that are no longer there: it is
    given up and returns no range. Old folders stay for their readers until ``purge``.

    Only the chosen ranges are read. The write is rebalanced by range, so a large range has several files.
    """
    archive.check_sync_type(sync_type)
    root = root.rstrip("/")
    number = len(archive.compactions(spark, root))
    chosen = stage(fragmented_ranges(spark, root, sync_type, folders, small), "fragmented")
    if chosen.isEmpty():
        return chosen
    place, files = snapshots.file_system(spark, f"{root}/_compactions")
    files.mkdirs(place)  # from now on readers look for unpublished folders
    run = uuid.uuid4().int >> 66  # 62 bits; as a commit it is negative, so no batch has it
    names = ["table_name", "range"]
    members = loading.stored_folders(spark, root, sync_type).join(chosen.select(*names), names, "left_semi")
    members = stage(members.select(F.lit(sync_type).alias("sync_type"), *names, "commit_id", "origin", F.lit(run).cast("bigint").alias("run")), "members")
    # Exactly those folders: a batch that comes now is in none of them.
    keys = [*names, "commit_id", "origin"]
    cells = archive.stored_cells(spark, root, sync_type).join(members.select(*keys), keys, "left_semi")
    archive.write_archive(cells.withColumn("commit_id", F.lit(-run).cast("bigint")), root)
    members.write.parquet(f"{root}/_compactions/run={run}")
    if not snapshots.create_once(spark, f"{root}/_compactions/{number}.json", str(run)):
        return chosen.limit(0)
    return chosen


def purge(spark: SparkSession, root: str) -> int:
    """Delete the folders that published compactions have replaced; returns how many. It may be repeated."""
    root = root.rstrip("/")
    _, files = snapshots.file_system(spark, root)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    runs, deleted = archive.compactions(spark, root), 0
    waiting = set(archive.compactions(spark, root, purged=False))
    for number, run in enumerate(runs):
        if run not in waiting:
            continue
        folders = archive.replaced_folders(spark, root, [run]).select("sync_type", "table_name", "range", "commit_id").distinct()
        gone: list[bool] = []

        def delete(row: Row) -> None:
            name = "/".join(f"{k}={row[k]}" for k in ("sync_type", "table_name", "range", "commit_id"))
            gone.append(bool(files.delete(Path(f"{root}/{name}"), True)))

        snapshots.for_each(delete, folders.toLocalIterator())
        deleted += sum(gone)
        snapshots.create_once(spark, f"{root}/_compactions/{number}.purged", "")
    return deleted
