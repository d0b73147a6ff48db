"""Folders on a disk that all executors reach by a local path: listed, read, written and removed by tasks, with plain file calls.

Spark lists files on the driver and keeps an object for each. Hadoop's local file system starts a process for the mode
of every file and folder that it makes.
"""

from __future__ import annotations

import os
import re
import shutil
import unicodedata
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockloom.model import FILE_LISTING

_ROWS = 10_000  # of a batch

#: Characters of a path that a URI has as they are, beside letters, digits and those beyond ASCII.
_LEGAL = "/:@!$&'()*+,;=-._~"
_PLAIN = re.compile(r"[A-Za-z0-9/:@!$&'()*+,;=\-._~]*")


def is_local(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().startswith("file:")


def plain_path(spark: SparkSession, folder: str) -> str:
    """A folder as file calls take it."""
    return os.path.abspath(spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath())


def spelt(path: str) -> str:
    """A path as Hadoop spells its URI."""
    if _PLAIN.fullmatch(path):
        return f"file:{path}"

    def kept(c: str) -> bool:
        return c > "\x7f" and unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc")

    return "file:" + "".join(c if kept(c) else quote(c, safe=_LEGAL, errors="surrogateescape") for c in path)


def _hidden(name: str) -> bool:
    """Names that Spark's listing leaves out."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str) -> Iterator[os.DirEntry]:
    """What is in a folder; nothing if it has gone."""
    try:
        with os.scandir(folder) as found:
            yield from (entry for entry in found if not _hidden(entry.name))
    except FileNotFoundError:
        return


def _files_below(folder: str) -> Iterator[os.DirEntry]:
    waiting = [folder]
    while waiting:
        for entry in _entries(waiting.pop()):
            if entry.is_dir():
                waiting.append(entry.path)
            else:
                yield entry


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files at or below the given paths."""
    rows: list[tuple] = []
    stamp = pa.timestamp("us", "UTC")

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), stamp, pa.int64()))]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, FILE_LISTING.fieldNames())

    for given in batches:
        for top in given.column(0).to_pylist():
            for path in [top] if os.path.isfile(top) else (entry.path for entry in _files_below(top)):
                try:
                    status = os.stat(path)
                except FileNotFoundError:  # it has gone since
                    continue
                seen = datetime.fromtimestamp(status.st_mtime_ns // 1_000_000 / 1000, timezone.utc)
                rows.append((spelt(path), seen, status.st_size))
                if len(rows) == _ROWS:
                    yield batch()
    if rows:
        yield batch()


def shared_out(spark: SparkSession, top: str) -> DataFrame:
    """Folders and files (``path``) that together hold all that is below ``top``, one task's share in a partition.

    The upper levels are read here, until there are some folders for each task.
    """
    tasks = 8 * spark.sparkContext.defaultParallelism
    folders, files = [top], []
    while folders and len(folders) < tasks:
        below = [entry for folder in folders for entry in _entries(folder)]
        folders = [entry.path for entry in below if entry.is_dir()]
        files += [entry.path for entry in below if not entry.is_dir()]
    rows = [(path,) for path in folders + files]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, min(tasks, len(rows)))), "path string")


def list_files(spark: SparkSession, top: str) -> DataFrame:
    """Files below a folder, those without a byte too: (path, modificationTime, length). No name comes to the driver."""
    return shared_out(spark, top).mapInArrow(_listed, FILE_LISTING)


#: Bytes of files that are given to a task and handed on at once.
_TASK_BYTES, _BATCH_BYTES = 64 << 20, 16 << 20


def read_files(files: DataFrame) -> DataFrame:
    """Contents of files (``path``, ``modificationTime``, ``length``): (path, modificationTime, content).

    Paths are as a file source has them, not URL-encoded. Names stay with the tasks; a file that is not there is an error.
    """
    spark = files.sparkSession
    rows, size = files.agg(F.count(F.lit(1)), F.sum("length")).first()
    tasks = max(2 * spark.sparkContext.defaultParallelism, (size or 0) // _TASK_BYTES, rows // _ROWS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, contents = 0, 0, []
            for number, path in enumerate(batch.column(0).to_pylist(), 1):
                with open(path.removeprefix("file:"), "rb") as file:
                    contents.append(file.read())
                held += len(contents[-1])
                if held >= _BATCH_BYTES or number == batch.num_rows:
                    part = batch.slice(start, len(contents))
                    yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(contents, pa.binary())], ["path", "modificationTime", "content"])
                    start, held, contents = number, 0, []

    dealt = files.select("path", "modificationTime").repartition(min(tasks, max(1, rows)), "path")
    return dealt.mapInArrow(read, "path string, modificationTime timestamp, content binary")


def _done(paths: DataFrame, work: Callable[[str], None]) -> None:
    """Do something with each path, in tasks."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                work(path.removeprefix("file:"))
        yield from ()

    tasks = 2 * paths.sparkSession.sparkContext.defaultParallelism
    paths.select("path").repartition(tasks, "path").mapInArrow(each, "path string").write.format("noop").mode("overwrite").save()


def remove_files(paths: DataFrame, top: str) -> None:
    """Remove files, and the folders above them that become empty, up to ``top``. What has gone already is passed over."""

    def remove(path: str) -> None:
        with suppress(FileNotFoundError):
            os.unlink(path)
        above = os.path.dirname(path)
        with suppress(OSError):  # not empty, or another task has removed it and goes on from there
            while len(above) > len(top):
                os.rmdir(above)
                above = os.path.dirname(above)

    _done(paths, remove)


def move_files(paths: DataFrame, done: str | None) -> None:
    """Move files below another folder, under their whole paths, or delete them. What has gone already is passed over."""

    def move(path: str) -> None:
        with suppress(FileNotFoundError):
            if done is None:
                os.unlink(path)
            elif os.path.exists(path):
                os.makedirs(os.path.dirname(done + path), exist_ok=True)
                shutil.move(path, done + path)

    _done(paths, move)


def _folder_name(name: str, value: object) -> str:
    """A partition's folder as Spark names it."""
    text = "" if value is None else str(value)
    escaped = re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda c: f"%{ord(c[0]):02X}", text)
    return f"{name}={escaped or '__HIVE_DEFAULT_PARTITION__'}"


def write_folders(rows: DataFrame, by: Sequence[str], aside: str) -> list[str]:
    """Write rows, which come sorted by the columns ``by``, as Parquet files in a folder each; returns the folders.

    They are made below ``aside``. A task writes under names of its own and returns them, so what a repeated task left is
    in none of the folders.
    """
    by, kept = list(by), [name for name in rows.columns if name not in by]
    parts = f"{aside}/_files"
    os.makedirs(parts)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, name, writer, done = None, None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            # Where a row's folder is another than that of the row before it.
            places = batch.select(by)
            changed = pa.array([False] * (batch.num_rows - 1), pa.bool_())
            for column in places.columns:
                one, two = column[1:], column[:-1]
                other = pc.fill_null(pc.not_equal(one, two), True)
                changed = pc.or_(changed, pc.and_not(other, pc.and_(pc.is_null(one), pc.is_null(two))))
            starts = [0, *(pc.indices_nonzero(changed).to_numpy() + 1).tolist(), batch.num_rows]
            for start, stop in zip(starts, starts[1:]):
                place = "/".join(_folder_name(n, c[start].as_py()) for n, c in zip(by, places.columns))
                some = batch.select(kept).slice(start, stop - start)
                if place != current:
                    if writer:
                        writer.close()
                    current, name = place, f"part-{uuid.uuid4().hex}.parquet"
                    writer = pq.ParquetWriter(f"{parts}/{name}", some.schema, write_page_checksum=True)
                    done.append((place, name))
                writer.write_batch(some)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["place", "name"])

    written = rows.select(*kept, *by).mapInArrow(write, "place string, name string").toArrow()
    folders: dict[str, None] = {}
    for batch in written.to_batches():
        for place, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if place not in folders:
                os.makedirs(f"{aside}/{place}")
                folders[place] = None
            os.rename(f"{parts}/{name}", f"{aside}/{place}/{name}")
    return list(folders)


def move_folders(aside: str, places: Sequence[str], root: str) -> None:
    """Move folders from ``aside`` to ``root``, in the place of those there are."""
    for place in places:
        target = f"{root}/{place}"
        os.makedirs(os.path.dirname(target), exist_ok=True)
        if os.path.isdir(target):
            shutil.rmtree(target)
        os.rename(f"{aside}/{place}", target)
