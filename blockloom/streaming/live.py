"""Follow a directory of arriving block files and archive them."""

from __future__ import annotations

import json
import re
import threading
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from blockloom.functions import keys
from blockloom.model import ARCHIVE, BINARY_FILE, struct
from blockloom.operators import cells as cell_ops
from blockloom.session import pace_listings, stage
from blockloom.sources import archive, local, snapshots, tables


#: More files than a stream can have.
_ALL_FILES = (1 << 31) - 1

def live_files(
    spark: SparkSession,
    folder: str,
    files_per_batch: int | None = None,
    clean_source: str = "off",
    done_folder: str | None = None,
) -> DataFrame:
    """Stream of the files below ``folder``. Files must arrive complete, by rename.

    ``clean_source`` is ``off``, ``archive`` (finished files move to ``done_folder``) or ``delete``.
    Spark cleans the files of a batch when a later batch commits, so the last batch stays in place.
    """
    _check_cleaning(folder, clean_source, done_folder)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("cleanSource", clean_source)
        # Files that a listing found and a bounded batch left are kept by name, as the names of all files taken are, so
        # the next batches do not list the whole tree again.
        .option("maxCachedFiles", _ALL_FILES)
    )
    if clean_source == "archive":
        reader = reader.option("sourceArchiveDir", done_folder)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _check_cleaning(folder: str, clean_source: str, done_folder: str | None) -> None:
    if clean_source not in ("off", "archive", "delete"):
        raise ValueError(f"clean_source is off, archive or delete, not {clean_source!r}")
    if clean_source == "archive" and (not done_folder or f"{done_folder.rstrip('/')}/".startswith(f"{folder.rstrip('/')}/")):
        raise ValueError("clean_source='archive' needs a done_folder outside the watched folder")


def live_cells(files: DataFrame, folder: str) -> DataFrame:
    """One cell per file, with the name of the range folder it arrived in."""
    return cell_ops.file_to_cell(files).withColumn("range", keys.folder_below(F.col("path"), folder))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint; a new checkpoint has a new one."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def _stream_number(spark: SparkSession, checkpoint: str) -> int:
    """31 bits of the stream's id, for commit numbers."""
    return int(_stream_id(spark, checkpoint).replace("-", "")[:8], 16) >> 1


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


#: A stream's own record of the files it has taken.
_LOGGED = "path string, timestamp long, batchId long"


def _plain(path: Column) -> Column:
    """A logged path as the file source's rows have it: not URL-encoded, one slash after the scheme."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^(\w+):///", "$1:/")


def _offset(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """How far into its record of files a batch of the stream goes."""
    if batch_id < 0:
        return -1
    lines = snapshots.read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}").strip().split("\n")
    return json.loads(lines[-1])["logOffset"]


def _logged_files(spark: SparkSession, checkpoint: str, first: int, last: int) -> DataFrame:
    """Files that the stream has taken, from one place of its record to another: (path, modificationTime, length).

    A marker in the record stands for the files of a listing. The record of a stream that Spark's own listing has fed
    has the files themselves, without lengths.
    """
    logged = _logged(spark, checkpoint, first, last).withColumn("length", F.lit(None).cast("bigint"))
    marker = F.col("path").startswith(f"{_plain_text(archive.qualified(spark, checkpoint))}/{_MARKERS}/")
    numbers = [_number(row["path"]) for row in logged.where(marker).select("path").collect()]
    return logged.where(~marker).union(_names(spark, checkpoint, numbers))


def _plain_text(path: str) -> str:
    return re.sub(r"^(\w+):///", r"\1:/", path).rstrip("/")


def _number(marker: str) -> int:
    return int(marker.rsplit("/", 1)[1].split(".")[0])


#: Below a checkpoint: files found by a listing, in folders by its number, and a marker for each that is whole.
_NAMES, _MARKERS = "listed/names", "listed/markers"


def _names(spark: SparkSession, checkpoint: str, numbers: list[int]) -> DataFrame:
    schema = "path string, modificationTime timestamp, length bigint"
    if not numbers:
        return spark.createDataFrame([], schema)
    folders = [f"{checkpoint.rstrip('/')}/{_NAMES}/{number:010d}" for number in sorted(numbers)]
    return spark.read.schema(schema).parquet(*folders)


def _markers(spark: SparkSession, checkpoint: str) -> list[int]:
    folder, files = snapshots.file_system(spark, f"{checkpoint.rstrip('/')}/{_MARKERS}")
    files.mkdirs(folder)
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(_number(f"/{name}") for name in names if name.endswith(".json") and not name.startswith("."))


def _fed_by_spark(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a checkpoint is of a stream that Spark's own listing feeds: such a stream goes on as it began."""
    top = checkpoint.rstrip("/")
    record, files = snapshots.file_system(spark, f"{top}/sources/0")
    return files.exists(record) and not files.exists(snapshots.file_system(spark, f"{top}/{_MARKERS}")[0])


def look_for_files(spark: SparkSession, folder: str, checkpoint: str, files_per_batch: int | None, missing_ok: bool = False) -> None:
    """List a folder and mark its new files for the stream of a checkpoint, oldest first, so many at once.

    Tasks list the folder, compare it with what is known and write the names; the driver has the markers alone. Names
    without a marker, of a run that died, are written again.
    """
    numbers, top = _markers(spark, checkpoint), checkpoint.rstrip("/")
    known = _names(spark, checkpoint, numbers).select("path")
    listed = archive.list_archive_files(spark, folder, missing_ok).withColumn("path", _plain(F.col("path")))
    new = listed.join(known, "path", "left_anti")
    if new.isEmpty():
        return
    following = numbers[-1] + 1 if numbers else 0

    def mark(rows: DataFrame, number: int) -> None:
        rows.select("path", "modificationTime", "length").write.mode("overwrite").parquet(f"{top}/{_NAMES}/{number:010d}")
        snapshots.create_once(spark, f"{top}/{_MARKERS}/{number:010d}.json", "{}")

    if not files_per_batch:
        mark(new, following)
        return
    # Numbered in order, from the counts of the sorted parts.
    ordered = new.repartitionByRange("modificationTime", "path").sortWithinPartitions("modificationTime", "path")
    ordered = stage(ordered.withColumn("id", F.monotonically_increasing_id()), "new-files").withColumn("part", F.shiftright("id", 33))
    before, starts = 0, []
    for part, count in sorted(ordered.groupBy("part").count().collect()):
        starts.append((part, before))
        before += count
    rank = F.col("before") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ordered.join(F.broadcast(spark.createDataFrame(starts, "part bigint, before bigint")), "part").withColumn("rank", rank)
    for batch in range(-(-before // files_per_batch)):
        mark(ranked.where(F.col("rank").between(batch * files_per_batch, (batch + 1) * files_per_batch - 1)), following + batch)


class _Following(StreamingQuery):
    """A stream whose folder is looked through again and again, by a thread, while it is active."""

    def __init__(self, query: StreamingQuery, look: Callable[[], None], pause: float) -> None:
        super().__init__(query._jsq)
        self._look, self._pause, self._lock = look, pause, threading.Lock()
        self._ended, self._error = threading.Event(), None
        self._thread = threading.Thread(target=self._run, daemon=True)
        self._thread.start()

    def _look_once(self) -> float:
        began = time.monotonic()
        with self._lock:
            if not self._ended.is_set():
                self._look()
        return time.monotonic() - began

    def _run(self) -> None:
        try:
            while self.isActive:
                took = self._look_once()
                if self._ended.wait(max(self._pause, 1, 3 * took)):  # most of the time is the stream's
                    return
        except Exception as error:
            self._error = error
            super().stop()

    def _check(self) -> None:
        if self._error:
            raise self._error

    def processAllAvailable(self) -> None:
        self._check()
        self._look_once()
        super().processAllAvailable()

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        ended = super().awaitTermination(timeout)
        self._check()
        return ended

    def stop(self) -> None:
        self._ended.set()
        super().stop()
        self._thread.join()


def _logged(spark: SparkSession, checkpoint: str, first: int, last: int) -> DataFrame:
    """Entries of the record that Spark's file source keeps: (path, modificationTime)."""
    folder, files = snapshots.file_system(spark, f"{checkpoint.rstrip('/')}/sources/0")
    names = {status.getPath().getName() for status in files.listStatus(folder)} if files.exists(folder) else set()
    compacted = [int(name.split(".")[0]) for name in names if name.endswith(".compact")]
    base = max((n for n in compacted if n <= last), default=-1)  # has all entries up to its own number
    chosen = [f"{base}.compact"] if base >= first else []
    chosen += [str(n) for n in range(max(first, base + 1), last + 1) if str(n) in names]
    if not chosen:
        return spark.createDataFrame([], "path string, modificationTime timestamp")
    lines = spark.read.text([f"{folder.toString()}/{name}" for name in chosen]).where("value LIKE '{%'")
    entries = lines.select(F.from_json("value", _LOGGED).alias("e")).select("e.*").where(F.col("batchId").between(first, last))
    return entries.select(_plain(F.col("path")).alias("path"), F.timestamp_millis("timestamp").alias("modificationTime"))


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """All files of a batch of ``follow``, those without a byte too: (path, modificationTime, length).

    They are in the stream's checkpoint, so a repeated batch has the same. Spark's own file source takes empty files, and
    counts them as read, but makes no rows of them.
    """
    last = _offset(spark, checkpoint, batch_id)
    return _logged_files(spark, checkpoint, _offset(spark, checkpoint, batch_id - 1) + 1, last)


def committed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """All files of the batches of ``follow`` that are archived: (path, modificationTime, length)."""
    folder, files = snapshots.file_system(spark, f"{checkpoint.rstrip('/')}/commits")
    names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
    done = max((int(name) for name in names if name.isdigit()), default=-1)
    return _logged_files(spark, checkpoint, 0, _offset(spark, checkpoint, done))


def follow(
    spark: SparkSession,
    folder: str,
    root: str,
    sync_type: str,
    checkpoint: str,
    interval: str | None = None,
    files_per_batch: int | None = None,
    clean_source: str = "off",
    done_folder: str | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Archive the files of ``folder``: what is there now when ``interval`` is None, else also new ones.

    Both phases share one checkpoint, so following on after a backfill neither misses nor repeats a
    file. Each batch is a commit of its own in the archive (0 is the archive job's), numbered within the
    stream; a repeated batch replaces itself, and streams of other checkpoints stay apart. A failed batch
    fails the query and leaves its source files in place. Empty files are cells with an empty value. ``rejects`` gets the path and content of files
    that no table takes; without it files cannot be cleaned up, since those would be lost.

    Spark's file source lists the whole folder on the driver and keeps every name there. A folder of a local disk is
    listed by tasks instead (``look_for_files``), and the stream's source has a marker for each batch; tasks read the files.
    A checkpoint that Spark's source began with stays with it.
    Files of a batch are cleaned up when the next one begins, so the last batch stays in place.
    """
    archive.check_sync_type(sync_type)
    if clean_source != "off" and not rejects:
        raise ValueError("cleaning up needs a rejects folder, which keeps the files that no table takes")
    folder = archive.qualified(spark, folder)
    pace_listings(spark)  # a batch's files are listed once more by name
    marked = local.is_local(spark, folder) and not _fed_by_spark(spark, checkpoint)
    if marked:
        _check_cleaning(folder, clean_source, done_folder and archive.qualified(spark, done_folder))
        look_for_files(spark, folder, checkpoint, files_per_batch)
        markers = f"{checkpoint.rstrip('/')}/{_MARKERS}"
        files = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(markers)
    else:
        files = live_files(spark, folder, files_per_batch, clean_source, done_folder)

    def archive_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        number = (_stream_number(session, checkpoint) << 32) + batch_id + 1
        commit_id = F.lit(number).cast("bigint")

        def placed(rows: DataFrame) -> DataFrame:
            return live_cells(rows, folder).withColumns({"sync_type": F.lit(sync_type), "commit_id": commit_id})

        if marked and clean_source != "off" and batch_id > 0:
            done = local.plain_path(session, done_folder) if clean_source == "archive" else None
            local.move_files(batch_files(session, checkpoint, batch_id - 1), done)
        taken = stage(batch_files(session, checkpoint, batch_id), "batch-files")
        # The files are opened once: the archive, the rejects and the search for empty files read the staged rows.
        if marked:
            cells = placed(stage(local.read_files(taken), "batch-rows"))
        else:
            spelt = F.regexp_replace("path", r"^(\w+):///", "$1:/").alias("path")
            read = stage(batch.select(spelt, "modificationTime", "content"), "batch-rows")
            empty = taken.drop("length").join(read.select("path"), "path", "left_anti").withColumn("content", F.lit(b""))
            cells = placed(read.unionByName(empty))
        archive.write_archive(cell_ops.route_cells(cells).select(*ARCHIVE.fieldNames()), root)
        if rejects:
            # Names tell whether there are files that no table takes.
            unknown = cell_ops.rejected_cells(placed(taken.withColumn("content", F.lit(b""))))
            if not unknown.isEmpty():
                rejected = cell_ops.rejected_cells(cells).select("path", "row_key", "value")
                rejected.write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/commit_id={number}")

    writer = files.writeStream.foreachBatch(archive_batch).option("checkpointLocation", checkpoint)
    query = writer.trigger(**_trigger(interval)).start()
    if not marked or interval is None:
        return query
    pause = spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {interval}) / 1000").first()[0]
    return _Following(query, lambda: look_for_files(spark, folder, checkpoint, files_per_batch, missing_ok=True), pause)


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Put streamed rows into a keyed table. Each batch is one commit, and a repeated batch replaces itself.

    Batches of several streams are numbered in the order in which they are published.
    """

    def put_batch(batch: DataFrame, batch_id: int) -> None:
        tables.put(batch, path, _stream_id(batch.sparkSession, checkpoint), batch_id)

    writer = rows.writeStream.foreachBatch(put_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(interval)).start()


def backfill_then_follow(
    spark: SparkSession,
    folder: str,
    root: str,
    sync_type: str,
    checkpoint: str,
    interval: str,
    files_per_batch: int,
    **options: str,
) -> StreamingQuery:
    """Finish the files already present in bounded batches, then keep following."""
    follow(
        spark, folder, root, sync_type, checkpoint, files_per_batch=files_per_batch, **options
    ).awaitTermination()
    return follow(
        spark, folder, root, sync_type, checkpoint, interval, files_per_batch=files_per_batch, **options
    )


def clean_ranges(spark: SparkSession, folder: str, checkpoint: str, rejects: str) -> DataFrame:
    """Remove range folders all of whose files are archived: (range, files, rejected, cleaned), a row per range.

    A range goes as a whole: not while a file in it is not in a finished batch of the stream, and never if some of its
    files were rejected. Only files that were looked up go, and folders only when empty, so a file that arrives
    meanwhile stays. What the stream has archived is in its checkpoint, which is written after the archive; a run that
    fails midway is simply repeated. It may run beside the stream, and after it for the last batch.
    """
    folder = archive.qualified(spark, folder)
    present = stage(archive.list_archive_files(spark, folder, missing_ok=True).select(_plain(F.col("path")).alias("path")), "present")
    done = committed_files(spark, checkpoint).select("path").distinct().withColumn("done", F.lit(True))
    refused = tables.read_or_empty(spark, rejects, struct(path=T.StringType())).select("path").distinct()
    refused = refused.withColumn("refused", F.lit(True))
    found = present.join(done, "path", "left").join(refused, "path", "left")
    found = stage(found.withColumn("range", keys.folder_below(F.col("path"), folder)), "found")
    states = found.groupBy("range").agg(
        F.count(F.lit(1)).alias("files"), F.count("refused").alias("rejected"), (F.count("done") == F.count(F.lit(1))).alias("whole")
    )
    states = stage(states.select("range", "files", "rejected", (F.col("whole") & (F.col("rejected") == 0)).alias("cleaned")), "ranges")
    ready = found.join(states.where("cleaned"), "range", "left_semi").select("path")
    _remove(spark, ready, folder)
    return states


def _remove(spark: SparkSession, paths: DataFrame, folder: str) -> None:
    """Remove files, and the folders above them that become empty, up to the watched one."""
    if local.is_local(spark, folder):
        local.remove_files(paths, local.plain_path(spark, folder))
        return
    top, files = snapshots.file_system(spark, folder)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    shortest = len(re.sub(r"^(\w+):///", r"\1:/", top.toString()))
    above: dict[int, set[str]] = {}  # by depth

    def remove(row: Row) -> None:
        files.delete(Path(row["path"]), False)

    def prune(name: str) -> None:
        folder = Path(name)
        if files.exists(folder) and not files.listStatus(folder):
            files.delete(folder, False)

    def noted() -> Iterator[Row]:
        for row in paths.toLocalIterator():  # names only, a part at a time
            parent = row["path"].rsplit("/", 1)[0]
            while len(parent) > shortest:
                above.setdefault(parent.count("/"), set()).add(parent)
                parent = parent.rsplit("/", 1)[0]
            yield row

    snapshots.for_each(remove, noted())
    for depth in sorted(above, reverse=True):  # a folder's own folders have gone before it
        snapshots.for_each(prune, above[depth])
