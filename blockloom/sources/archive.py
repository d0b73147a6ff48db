"""The range archive: key-range scans, partitioned files, listing, record-file exchange."""

from __future__ import annotations

import os
import re
import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from blockloom.functions import keys
from blockloom.model import ARCHIVE, ARCHIVE_PARTITIONS, CELL, FILE_LISTING, SOURCE_TABLES
from blockloom.session import pace_listings
from blockloom.sources import local, snapshots


def check_table(table: str) -> None:
    if table not in SOURCE_TABLES:
        raise ValueError(f"no source table {table!r}; there are {', '.join(SOURCE_TABLES)}")


def check_sync_type(sync_type: str) -> None:
    """Sync types become folder names."""
    if not re.fullmatch(r"[\w.-]+", sync_type):
        raise ValueError(f"sync type {sync_type!r} has other characters than letters, digits and _ . -")


def read_key_range(cells: DataFrame, start_key: str, end_key: str, limit: int | None = None) -> DataFrame:
    """Cells of the rows from ``start_key`` to ``end_key``, both included, at most ``limit`` rows.

    The limit counts row keys, lowest first. Only keys are ranked; the values stay where they are,
    and at most ``limit`` keys are sent to them.
    """
    rows = cells.where(F.col("row_key").between(start_key, end_key))
    if limit is None:
        return rows
    chosen = rows.select("row_key").distinct().orderBy("row_key").limit(limit)
    return rows.join(chosen, "row_key", "left_semi")


def write_archive(cells: DataFrame, root: str, in_key_order: bool = False) -> None:
    """Write cells (with ``sync_type``, ``table_name``, ``range``, ``commit_id``) below ``root``.

    A rebalance by range keeps ranges together, merges small ones and splits a hot one over several
    files. A source that is stored in key order needs no shuffle (``in_key_order``): each task then
    meets few ranges. Only the partitions that occur in ``cells`` are replaced.

    The files are written aside and their folders moved in, many at once: Spark's own overwrite of partitions moves one
    after the other, and writers of one folder share a working folder, which the first to finish removes. A folder is
    moved in one step, in the place of what an earlier attempt left. On a local disk the tasks make the files with plain
    file calls (``local``).
    """
    spark, root = cells.sparkSession, root.rstrip("/")
    rows = cells.select(*ARCHIVE.fieldNames(), *[name for name in cells.columns if name == "origin"])
    if not in_key_order:
        rows = rows.hint("rebalance", *[F.col(name) for name in ARCHIVE_PARTITIONS])
    rows = rows.sortWithinPartitions(*ARCHIVE_PARTITIONS, "row_key", "family", "qualifier", F.desc("ts"))
    aside, files = snapshots.file_system(spark, f"{root}/_parts/{uuid.uuid4().hex}")
    try:
        if local.is_local(spark, root):
            place = local.plain_path(spark, aside.toString())
            local.move_folders(place, local.write_folders(rows, ARCHIVE_PARTITIONS, place), local.plain_path(spark, root))
        else:
            rows.write.partitionBy(*ARCHIVE_PARTITIONS).parquet(aside.toString())
            _move_folders(spark, aside.toString(), root)
    finally:
        files.delete(aside, True)


def _move_folders(spark: SparkSession, aside: str, root: str) -> None:
    """Move the partition folders below ``aside`` to ``root``, in the place of those there are."""
    depth = len(ARCHIVE_PARTITIONS)
    pattern = re.sub(r"([][*?{}\\])", r"\\\1", aside) + "/*=*" * depth  # the folder's own name is no pattern
    below, files = snapshots.file_system(spark, pattern)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.globStatus(below)) or ()

    def move(number: int) -> None:
        source = found[number]
        target = Path("/".join([root, *source.toString().split("/")[-depth:]]))
        files.mkdirs(target.getParent())
        files.delete(target, True)
        if not files.rename(source, target):
            raise OSError(f"{source.toString()} could not be moved to {target.toString()}")

    snapshots.for_each(move, range(len(found)))


def write_archive_beside(cells: DataFrame, root: str, in_key_order: bool = False) -> None:
    """``write_archive`` for jobs that write to one root at once."""
    write_archive(cells, root, in_key_order)


#: Folders that compactions replaced: ``commit_id`` of the folder, ``origin`` of the commit its cells are of.
MEMBERS = "sync_type string, table_name string, range string, commit_id bigint, origin bigint, run bigint"


def compactions(spark: SparkSession, root: str, purged: bool = True) -> list[int]:
    """Runs that have replaced folders of the archive, in order; without those whose old folders are gone."""
    folder, files = snapshots.file_system(spark, f"{root.rstrip('/')}/_compactions")
    names = {status.getPath().getName() for status in files.listStatus(folder)} if files.exists(folder) else set()
    numbers = sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))
    chosen = [n for n in numbers if purged or f"{n}.purged" not in names]
    return [int(snapshots.read_text(spark, f"{folder.toString()}/{n}.json")) for n in chosen]


def replaced_folders(spark: SparkSession, root: str, runs: list[int]) -> DataFrame:
    """The folders that these runs replaced."""
    if not runs:
        return spark.createDataFrame([], MEMBERS)
    return spark.read.schema(MEMBERS).parquet(*[f"{root.rstrip('/')}/_compactions/run={run}" for run in runs])


def stored_cells(spark: SparkSession, root: str, sync_type: str | None = None, places: bool = False) -> DataFrame:
    """Archived cells as they are stored: ``commit_id`` is the folder's, ``origin`` the commit they came in, and with
    ``places`` their ``file`` and ``position``.

    Folders of a compaction have a negative number. They count once it is published, and the folders it replaced no
    longer do; until these are purged a join on the partition columns leaves them out. Where no compaction ever began
    there is nothing to leave out.
    """
    # Asked before the folders are listed: a run that is published later changes nothing for this reader.
    pace_listings(spark)
    runs = compactions(spark, root)
    waiting = [run for run in compactions(spark, root, purged=False) if run in runs]
    schema = T.StructType([*CELL.fields, T.StructField("origin", T.LongType()), *ARCHIVE.fields[len(CELL.fields) :]])
    reader = spark.read.schema(schema)
    if sync_type is None:
        rows = reader.parquet(root)
    else:
        check_sync_type(sync_type)
        root = root.rstrip("/")
        rows = reader.option("basePath", root).parquet(f"{root}/sync_type={sync_type}")
    place = {"file": F.col("_metadata.file_path"), "position": F.col("_metadata.row_index")} if places else {}
    rows = rows.withColumns({"origin": F.coalesce("origin", "commit_id"), **place})
    folder, files = snapshots.file_system(spark, f"{root.rstrip('/')}/_compactions")
    if not files.exists(folder):
        return rows
    rows = rows.where((F.col("commit_id") >= 0) | F.col("commit_id").isin([-run for run in runs]))
    if waiting:
        names = list(ARCHIVE_PARTITIONS)
        rows = rows.join(replaced_folders(spark, root, waiting).select(*names).distinct(), names, "left_anti")
    return rows


def read_archive(spark: SparkSession, root: str, sync_type: str | None = None) -> DataFrame:
    """All archived cells, or those of one sync type, whose folders alone are then listed, with the commit they came in.

    Filters on the other partition columns select files.
    """
    cells = stored_cells(spark, root, sync_type)
    return cells.withColumn("commit_id", F.col("origin")).select(*ARCHIVE.fieldNames())


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder as its file system spells it, which is how the paths of its files begin."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def list_archive_files(spark: SparkSession, root: str, missing_ok: bool = False, empty: bool = True) -> DataFrame:
    """Files below ``root`` as ``path``, ``modificationTime`` and ``length``; contents are not read.

    A folder of a local disk is listed by tasks. Elsewhere Spark's scan is asked, which has no row for a file without a
    byte. Those are found among the names that Spark lists for the scan, which it holds on the driver in any case;
    ``empty=False`` saves that where files have a header. A file that goes while the listing is made is left out: a
    stream cleans up its source even after it has ended.
    """
    pace_listings(spark)
    if local.is_local(spark, root) and os.path.exists(place := local.plain_path(spark, root)):
        return local.list_files(spark, place)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    try:
        files = reader.load(root)
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_LISTING)
    listed = files.select(F.col("_metadata.file_path").alias("path"), "modificationTime", "length")
    if not empty:
        return listed
    # One name in each spelling of the scheme.
    names = spark.createDataFrame([(name,) for name in files.inputFiles()], "path string")
    spelt = F.regexp_replace("path", r"^(\w+):///", "$1:/")
    missing = names.withColumn("spelt", spelt).join(listed.select(spelt.alias("spelt")), "spelt", "left_anti").collect()
    _, system = snapshots.file_system(spark, root)
    Path, rows = spark._jvm.org.apache.hadoop.fs.Path, []

    def look_up(row: Row) -> None:
        try:
            status = system.getFileStatus(Path(unquote(row["path"])))
        except Py4JJavaError as error:
            if not error.java_exception.getClass().getName().endswith("FileNotFoundException"):
                raise
            return
        rows.append((row["path"], status.getModificationTime(), status.getLen()))

    snapshots.for_each(look_up, missing)
    blank = spark.createDataFrame(rows, "path string, ms long, length long")
    return listed.union(blank.select("path", F.timestamp_millis("ms"), "length"))


def export_records(cells: DataFrame, path: str) -> None:
    """Write one uncompressed key/value record per cell.

    The value starts with the lengths of family and qualifier (8 hex digits each, enough for any text), the cell time
    as 16 digits of its two's complement, and 1 or 0 for a value or none, followed by family, qualifier and value.
    """
    head = F.concat(
        F.lower(F.lpad(F.hex(F.octet_length("family")), 8, "0")),
        F.lower(F.lpad(F.hex(F.octet_length("qualifier")), 8, "0")),
        keys.slot_to_key(F.col("ts")),
        F.when(F.col("value").isNull(), "0").otherwise("1"),
        F.col("family"),
        F.col("qualifier"),
    )
    records = cells.select(
        F.encode("row_key", "UTF-8").alias("key"),
        F.concat(F.encode(head, "UTF-8"), F.coalesce("value", F.lit(b""))).alias("value"),
    )
    records.rdd.map(lambda record: (bytearray(record[0]), bytearray(record[1]))).saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        "org.apache.hadoop.io.BytesWritable",
        "org.apache.hadoop.io.BytesWritable",
        conf={"mapreduce.output.fileoutputformat.compress": "false"},
    )


def import_records(spark: SparkSession, path: str) -> DataFrame:
    """Cells written by ``export_records``."""
    pairs = spark.sparkContext.sequenceFile(
        path, "org.apache.hadoop.io.BytesWritable", "org.apache.hadoop.io.BytesWritable"
    ).map(lambda pair: (bytes(pair[0]), bytes(pair[1])))
    records = spark.createDataFrame(pairs, "key binary, value binary", verifySchema=False)

    def text(start, length):
        return F.decode(F.substring("value", start, length), "UTF-8")

    def number(start: int, length: int):
        # A negative target base reads 16 digits as two's complement.
        return F.conv(text(F.lit(start), F.lit(length)), 16, -10).cast("bigint")

    sized = records.withColumns(
        {"family_size": number(1, 8).cast("int"), "qualifier_size": number(9, 8).cast("int")}
    )
    body = F.lit(34) + F.col("family_size")
    rest = body + F.col("qualifier_size")
    return sized.select(
        F.decode("key", "UTF-8").alias("row_key"),
        text(F.lit(34), F.col("family_size")).alias("family"),
        text(body, F.col("qualifier_size")).alias("qualifier"),
        number(17, 16).alias("ts"),
        F.when(text(F.lit(33), F.lit(1)) == "1", F.substring("value", rest, F.octet_length("value"))).alias("value"),
    ).to(CELL)
