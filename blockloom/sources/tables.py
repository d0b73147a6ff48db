"""Keyed tables: puts by commit, the latest value per key, compaction in place, reads by key and by prefix.

The commits of a table are listed in its manifests (``snapshots``). Beside a commit's files lies an index of its keys:
for each file the hashes of the keys, or of their prefixes, that are in it.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from blockloom.model import struct
from blockloom.session import stage
from blockloom.sources import snapshots
from blockloom.sources.snapshots import Commit, Snapshot

_COMMIT = [T.StructField("commit_id", T.LongType()), T.StructField("writer", T.StringType())]
_ATTEMPT = T.StructField("attempt", T.StringType())

#: Files by key: a hash of the key's prefix, the file below the table, its first and last such key, their number.
INDEX = struct(hash=T.LongType(), file=T.StringType(), first=T.StringType(), last=T.StringType(), keys=T.LongType())

#: So many hashes, of 8 bytes each, are sent to every task at the most.
_SENT = 1_000_000


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``; no rows when nothing was ever written there. Other errors are raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def prefix_of(key: Column) -> Column:
    """What stands before the first ``/`` of a key: the address of an address key, the whole of a key without one."""
    return F.substring_index(key, "/", 1)


def _write_files(rows: DataFrame, path: str, indexed: bool) -> str:
    """Write rows aside, with their index; returns the attempt."""
    attempt = uuid.uuid4().hex
    folder = snapshots.folder_of(path, attempt)
    rows.write.parquet(folder)
    if indexed:
        spark = rows.sparkSession
        stored = spark.read.schema(rows.schema).parquet(folder).select("row_key", F.col("_metadata.file_name").alias("file"))
        # Keys are shuffled once, to where they are told apart and counted; a prefix that is everywhere stays spread by file.
        dealt = stored.withColumn("hash", F.xxhash64(prefix_of(F.col("row_key")))).repartition("hash", "file")
        by_file = dealt.groupBy("hash", "file").agg(
            F.min("row_key").alias("first"), F.max("row_key").alias("last"), F.count_distinct("row_key").alias("keys")
        )
        # Sorted by hash, so that a look-up skips row groups.
        by_file.repartitionByRange("hash").sortWithinPartitions("hash").write.parquet(f"{folder}/_index")
    return attempt


def write_commit(rows: DataFrame, path: str, commit_id: int, writer: str = "job", indexed: bool = False) -> None:
    """Append one commit of one writer. Writing it again replaces it, also by no rows, so a replay changes nothing.

    Numbers of a writer are its own: commits of the same number by other writers stay. The commit is seen when it is
    whole; a reader sees it or what was before. One that was compacted meanwhile stays as it is.
    """
    snapshots.add(rows.sparkSession, path, writer, commit_id, _write_files(rows, path, indexed), commit_id)


def put(rows: DataFrame, path: str, writer: str, number: int, indexed: bool = False) -> None:
    """Append a writer's ``number``-th piece of work as the newest commit; a replay replaces it where it stands."""
    if not snapshots.snapshot(rows.sparkSession, path).is_done(writer, number):
        snapshots.add(rows.sparkSession, path, writer, number, _write_files(rows, path, indexed))


def _read(spark: SparkSession, path: str, schema: T.StructType, commits: Sequence[Commit], files: Sequence[str] | None = None) -> DataFrame:
    """Rows of some commits, of all their files or of those named (attempt/name), with ``commit_id`` and ``writer``."""
    wide = T.StructType([*schema.fields, *_COMMIT])
    found = []
    for merged in (False, True):
        chosen = [c for c in commits if c.merged == merged]
        if files is None:
            paths = [snapshots.folder_of(path, c.attempt) for c in chosen]
        else:
            mine = {c.attempt for c in chosen}
            paths = [f"{path.rstrip('/')}/data/attempt={f}" for f in files if f.split("/")[0] in mine]
        if not paths:
            continue
        stored = T.StructType([*(wide if merged else schema).fields, _ATTEMPT])
        rows = spark.read.schema(stored).option("basePath", f"{path.rstrip('/')}/data").parquet(*paths)
        if not merged:  # one short row per live commit
            named = spark.createDataFrame([(c.attempt, c.commit_id, c.writer) for c in chosen], T.StructType([_ATTEMPT, *_COMMIT]))
            rows = rows.join(F.broadcast(named), "attempt")
        found.append(rows.select(*wide.fieldNames()))
    return functools.reduce(DataFrame.union, found) if found else spark.createDataFrame([], wide)


def read_commit(spark: SparkSession, path: str, schema: T.StructType, commit_id: int, writer: str = "job") -> DataFrame:
    """Rows of one commit as they were written; those of a compacted one as far as they are the latest."""
    now = snapshots.snapshot(spark, path)
    chosen = [c for c in now.commits if c.merged or (c.commit_id, c.writer) == (commit_id, writer)]
    rows = _read(spark, path, schema, chosen)
    return rows.where((F.col("commit_id") == commit_id) & (F.col("writer") == writer)).drop("commit_id", "writer")


def latest_by_key(puts: DataFrame, order: Sequence[str], key: str = "row_key") -> DataFrame:
    """One row per key: the put with the highest ``order``.

    The struct maximum is combined before the shuffle, so a hot key sends one row per task.
    """
    values = [name for name in puts.columns if name != key and name not in order]
    newest = F.max(F.struct(*order, *values)).alias("newest")
    return puts.groupBy(key).agg(newest).select(key, *[F.col(f"newest.{name}") for name in (*order, *values)])


def _latest(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return latest_by_key(rows, ["commit_id", "writer", *order])


def read_table(spark: SparkSession, path: str, schema: T.StructType, order: Sequence[str] = (), at: Snapshot | None = None) -> DataFrame:
    """Latest view of a keyed table: the newest commit wins, then the writer's name, then ``order`` within it."""
    at = at or snapshots.snapshot(spark, path)
    return _latest_of_few(_read(spark, path, schema, at.commits), order).drop("writer")


def _latest_of_few(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``_latest`` for tables where most keys were put once: their rows are not shuffled.

    Keys alone are grouped to find those that were put again, and only rows of these are compared. Where they are more
    than a quarter of all rows, all are compared.
    """
    counted = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("puts")).where(F.col("puts") > 1)
    again = stage(counted.select(F.col("row_key").alias("again"), "puts"), "repeated-keys")
    puts = again.agg(F.sum("puts")).first()[0] or 0
    if 4 * puts > rows.count():
        return _latest(rows, order)
    leading = ["row_key", "commit_id", "writer", *order]
    columns = [*leading, *[name for name in rows.columns if name not in leading]]
    if not puts:
        return rows.select(*columns)
    same = F.col("row_key").eqNullSafe(F.col("again"))
    once, more = (rows.join(again.select("again"), same, how) for how in ("left_anti", "left_semi"))
    return once.select(*columns).union(_latest(more, order).select(*columns))


def compact(spark: SparkSession, path: str, schema: T.StructType, order: Sequence[str] = (), indexed: bool = False) -> None:
    """Put one commit with the latest row of each key, in key order, in the place of those there are.

    Rows keep the commit they are of, so what is put later or late is ordered as before. Puts that come meanwhile stay
    beside it; if one of the compacted commits is replaced meanwhile, the work is done again. The old files stay for
    their readers until ``snapshots.expire``.
    """
    while True:
        now = snapshots.snapshot(spark, path)
        if not now.commits or (len(now.commits) == 1 and now.commits[0].merged):
            return
        latest = stage(_latest(_read(spark, path, schema, now.commits), order), "latest")  # the range sort reads it twice
        ordered = latest.select(*schema.fieldNames(), "commit_id", "writer").repartitionByRange("row_key")
        attempt = _write_files(ordered.sortWithinPartitions("row_key"), path, indexed)
        if snapshots.merge(spark, path, now, attempt):
            return


def _index(spark: SparkSession, path: str, at: Snapshot) -> DataFrame:
    """The index of all live files, with the commit of each."""
    folders = [f"{snapshots.folder_of(path, c.attempt)}/_index" for c in at.commits]
    if not folders:
        return spark.createDataFrame([], T.StructType([*INDEX.fields, _ATTEMPT]))
    rows = spark.read.schema(INDEX).parquet(*folders)
    return rows.withColumn("attempt", F.regexp_extract(F.col("_metadata.file_path"), "attempt=([^/]*)/", 1))


def files_of_keys(spark: SparkSession, path: str, keys: DataFrame, at: Snapshot) -> list[str]:
    """Files that may hold some of the keys (``row_key``): their prefix is in the index and the key in its bounds."""
    wanted = keys.select("row_key", F.xxhash64(prefix_of(F.col("row_key"))).alias("hash"))
    met = _index(spark, path, at).join(wanted, "hash").where(F.col("row_key").between(F.col("first"), F.col("last")))
    # No more names than the table has files.
    return sorted(r[0] for r in met.select(F.concat_ws("/", "attempt", "file")).distinct().collect())


def read_keys(spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame, order: Sequence[str] = (), at: Snapshot | None = None) -> DataFrame:
    """Latest rows of the given keys (``row_key``) of an indexed table. Only files that may hold one are opened."""
    at = at or snapshots.snapshot(spark, path)
    wanted = stage(keys.select("row_key").where("row_key IS NOT NULL").distinct(), "keys")
    rows = _read(spark, path, schema, at.commits, files_of_keys(spark, path, wanted, at))
    return _latest(rows.join(wanted, "row_key", "left_semi"), order).drop("writer")


def files_of_prefixes(spark: SparkSession, path: str, wanted: DataFrame, k: int, at: Snapshot) -> DataFrame:
    """For each ``prefix`` the key up to which its next ``k`` keys after ``after`` reach at most: (prefix, after, upto),
    with the ``files`` that hold keys of it up to there.

    A commit has a key once. So where the files of one commit have k keys that end before some key, k keys end there
    in the whole table; the best commit tells where to stop. ``upto`` is null where all the rest is needed.
    """
    asked = wanted.select("prefix", "after", F.xxhash64("prefix").alias("hash"))
    met = _index(spark, path, at).join(asked, "hash").where(prefix_of(F.col("first")) == F.col("prefix"))
    met = stage(met.where(F.col("after").isNull() | (F.col("last") > F.col("after"))), "met-files")
    whole = met.where(F.col("after").isNull() | (F.col("first") > F.col("after")))  # others may hold fewer
    # A row per file here, and files of a commit that follow one another.
    following = Window.partitionBy("prefix", "attempt").orderBy("last", "file")
    counted = whole.withColumn("so_far", F.sum("keys").over(following.rowsBetween(Window.unboundedPreceding, 0)))
    stops = counted.where(F.col("so_far") >= k).groupBy("prefix").agg(F.min("last").alias("upto"))
    needed = met.join(stops, "prefix", "left").where(F.col("upto").isNull() | (F.col("first") <= F.col("upto")))
    return needed.select("prefix", "after", "upto", F.concat_ws("/", "attempt", "file").alias("file"))


def _with_some_of(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows that may have a wanted value in a column, and few others, so that a join need not shuffle the whole table.

    The hashes of the values are sent to the rows. Where they are more than ``_SENT`` the rows stay as they are.
    """
    hashes = wanted.select(F.xxhash64(column).alias("sent")).distinct()
    if hashes.count() > _SENT:
        return rows
    return rows.join(F.broadcast(hashes), F.xxhash64(column) == F.col("sent"), "left_semi")


def scan_prefixes(spark: SparkSession, path: str, schema: T.StructType, wanted: DataFrame, k: int, order: Sequence[str] = (), at: Snapshot | None = None) -> DataFrame:
    """The first ``k`` keys of each ``prefix``, in key order, with their latest rows: the table's columns and ``place``.

    ``wanted`` has (prefix, after); the scan of a prefix goes on after that key, from its start where it is null. So
    the last key of one scan resumes it. Files beyond a prefix's k-th key are not opened. Repeated prefixes count
    once, with the smallest key to go on after.
    """
    at = at or snapshots.snapshot(spark, path)
    asked = wanted.groupBy("prefix").agg(F.min(F.struct(F.col("after").isNotNull(), "after")).alias("from"))
    asked = stage(asked.select("prefix", F.col("from.after").alias("after")), "prefixes")
    needed = stage(files_of_prefixes(spark, path, asked, k, at), "needed-files")
    files = sorted(r[0] for r in needed.select("file").distinct().collect())
    bounds = needed.select("prefix", "after", "upto").distinct()
    rows = _read(spark, path, schema, at.commits, files).withColumn("prefix", prefix_of(F.col("row_key")))
    rows = _with_some_of(rows, "prefix", asked).join(bounds, "prefix").where(
        (F.col("after").isNull() | (F.col("row_key") > F.col("after"))) & (F.col("upto").isNull() | (F.col("row_key") <= F.col("upto")))
    )
    latest = _latest(rows.drop("after", "upto"), order)
    place = F.row_number().over(Window.partitionBy("prefix").orderBy("row_key"))
    return latest.withColumn("place", place).where(F.col("place") <= k).select(*schema.fieldNames(), "place")
