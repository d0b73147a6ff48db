"""Load job: choose archive folders, copy raw rows, derive the serving tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from blockloom.functions import keys
from blockloom.model import BLOCK, LEGACY_BLOCK, MAX_PAYLOAD_BYTES, QUALIFIER_BIN, QUALIFIER_PROTO, RAW_TABLE, SOURCE_TABLES
from blockloom.operators import blocks as block_ops
from blockloom.operators import cells as cell_ops
from blockloom.operators import payloads, ranges
from blockloom.session import stage
from blockloom.sources import archive, ledgers, tables

REJECTED = "row_key string, slot bigint, error string"

INCOMPLETE = "row_key string, slot bigint, missing bigint"

#: The folders of each load, written before its data, and the loads that have finished.
RUNS = "run_id bigint, path string, kind string, root string, table_name string, range string, commit_id bigint"
FINISHED = "run_id bigint"

_CORRUPT = "_corrupt_record"


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


Parser = Callable[[Column], Column]


def json_parser(schema: T.StructType) -> Parser:
    checked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    # Bytes that are no UTF-8 would end the job in ``decode``; they become null, which does not parse.
    return lambda payload: F.from_json(F.try_validate_utf8(payload.cast("string")), checked)


# Per cell format: decoded bytes to a block struct, null or without transactions when they do not parse.
# ``from_protobuf`` fits here where its package is installed.
JSON_PARSERS: dict[str, Parser] = {
    QUALIFIER_PROTO: json_parser(BLOCK),
    QUALIFIER_BIN: json_parser(LEGACY_BLOCK),
}


def stored_folders(spark: SparkSession, root: str, sync_type: str) -> DataFrame:
    """Archived range folders of one sync type: ``path`` below ``root`` and its partition values.

    A folder is the unit of loading: it holds one range of one table, in however many files. Its path is the whole
    one, so folders of several archives are told apart. A folder that was compacted keeps its path; ``commit_id`` is
    that of the folder its cells are in now, and ``origin`` its own.
    """
    archive.check_sync_type(sync_type)
    runs = archive.compactions(spark, root)  # asked before the listing, see ``archive.stored_cells``
    files = archive.list_archive_files(spark, f"{root.rstrip('/')}/sync_type={sync_type}", missing_ok=True, empty=False)
    folder = F.regexp_extract("path", r"^(.*/sync_type=[^/]*/table_name=[^/]*/range=[^/]*/commit_id=-?\d+)/[^/]*$", 1)
    folders = files.select(folder.alias("path")).where(F.col("path") != "").distinct()
    listed = folders.select(
        "path",
        F.regexp_extract("path", "table_name=([^/]*)", 1).alias("table_name"),
        F.regexp_extract("path", "range=([^/]*)", 1).alias("range"),
        F.regexp_extract("path", r"commit_id=(-?\d+)", 1).cast("bigint").alias("commit_id"),
    )
    if not runs:
        return listed.where("commit_id >= 0").withColumn("origin", F.col("commit_id"))
    moved = stage(archive.replaced_folders(spark, root, runs).where(F.col("sync_type") == sync_type), "moved")
    listed = stage(listed, "listed").where((F.col("commit_id") >= 0) | F.col("commit_id").isin([-run for run in runs]))
    now = listed.join(moved.select("table_name", "range", "commit_id").distinct(), ["table_name", "range", "commit_id"], "left_anti")
    here = moved.select("table_name", "range", "origin", (-F.col("run")).alias("commit_id"))
    # A folder that was compacted again is where the last run put it.
    found = now.join(here, ["table_name", "range", "commit_id"], "left").withColumn("origin", F.coalesce("origin", "commit_id"))
    first = F.regexp_replace("path", r"commit_id=-?\d+$", "commit_id=")
    return found.select(F.concat(first, "origin").alias("path"), "table_name", "range", "commit_id", "origin")


def candidate_folders(
    spark: SparkSession, root: str, sync_type: str, start: int, end: int, ledger_path: str
) -> DataFrame:
    """Unloaded folders of one sync type that overlap the request, one row per folder and kind."""
    named = stored_folders(spark, root, sync_type).withColumnRenamed("path", "whole").withColumn("path", F.col("range"))
    folders = ranges.parse_range_path(named).drop("path").withColumnRenamed("whole", "path")
    chosen = ranges.overlapping_files(folders, start, end)
    unread = ranges.pending_files(chosen, ledgers.read_file_ledger(spark, ledger_path))
    # By the partition, not by the path: a sync type may have a table's name in its own.
    return unread.withColumn("kind", F.col("table_name")).where(F.col("kind").isin(*SOURCE_TABLES))


def read_folders(spark: SparkSession, root: str, sync_type: str, folders: DataFrame, kind: str) -> DataFrame:
    """Cells of the chosen folders.

    The join keys but ``origin`` are partition columns, so Spark skips other folders at run time. The list has one
    short row per range; Spark broadcasts it below its size limit.
    """
    names = ["table_name", "range", "commit_id", "origin"]
    wanted = folders.where(F.col("kind") == kind).select(*names)
    stored = archive.stored_cells(spark, root, sync_type, places=True)
    return stored.join(wanted, names, "left_semi")


def first_cells(cells: DataFrame) -> DataFrame:
    """What a raw serving table keeps of cells that are not in an archive."""
    return cell_ops.first_cell(cells).select(*RAW_TABLE.fieldNames())


def raw_rows(stored: DataFrame) -> DataFrame:
    """What a raw serving table keeps of each archived row: its first cell.

    Values are far larger than keys and nearly every row has one cell. So only keys are grouped to
    find the rows with more, and only those are ranked. No value is shuffled while that set is small
    enough for Spark to broadcast.
    """
    repeated = stored.groupBy("row_key").agg(F.count(F.lit(1)).alias("cells")).where(F.col("cells") > 1)
    repeated = stage(repeated.select("row_key"), "repeated-rows")
    if repeated.isEmpty():
        return stored.select(*RAW_TABLE.fieldNames())
    rank = F.struct("family", "qualifier", (-F.col("ts")).alias("age"), "file", "position")
    first = stored.join(repeated, "row_key", "left_semi").groupBy("row_key").agg(F.min(rank).alias("first"))
    ranked = stored.join(stage(first, "first-cells"), "row_key", "left")
    chosen = F.col("first").isNull() | (F.col("first") == rank)
    return ranked.where(chosen).select(*RAW_TABLE.fieldNames())


def parse_blocks(raw: DataFrame, parsers: dict[str, Parser] = JSON_PARSERS, limit: int = MAX_PAYLOAD_BYTES) -> DataFrame:
    """Raw block rows as ``slot``, ``block_time``, ``transactions``; ``error`` tells why a row has none.

    Payloads of more than ``limit`` bytes are rejected; to load them, parse their raw rows, which are stored, again.
    """
    named = cell_ops.with_format(raw).withColumn("slot", keys.key_to_slot(F.col("row_key")))
    decoded = payloads.decode_payloads(named.select("row_key", "slot", "format", "value"), limit=limit)

    def parsed(name: str) -> Column:
        return F.when(F.col("format") == name, parsers[name](F.col("payload")))

    both = decoded.withColumns({"current": parsed(QUALIFIER_PROTO), "legacy": parsed(QUALIFIER_BIN)})

    def sound(name: str) -> Column:
        block = F.col(name)
        broken = block["transactions"].isNull()
        if _CORRUPT in both.schema[name].dataType.fieldNames():
            broken = broken | block[_CORRUPT].isNotNull()
        return block.isNotNull() & ~broken

    current = F.when(sound("current"), F.transform("current.transactions", block_ops.flat_transaction))
    legacy = F.when(
        sound("legacy"),
        F.transform(
            F.transform("legacy.transactions", block_ops.current_transaction), block_ops.flat_transaction
        ),
    )

    def unsigned(tx: Column) -> Column:
        return F.coalesce(F.size(tx["signatures"]), F.lit(0)) == 0

    def keyless(tx: Column) -> Column:
        return F.exists(F.coalesce(tx["account_keys"], F.array().cast("array<string>")), lambda key: key.isNull())

    transactions = F.coalesce(current, legacy)
    error = (
        F.when(F.col("slot").isNull(), "row key is no slot")
        .when(F.col("format").isNull(), "unknown qualifier")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("transactions").isNull(), "payload does not parse")
        .when(F.exists("transactions", unsigned), "transaction without signature")
        .when(F.exists("transactions", keyless), "transaction with a null account key")
    )
    block_time = F.coalesce("current.block_time", "legacy.block_time")
    rows = both.withColumns({"transactions": transactions, "block_time": block_time})
    return rows.select("row_key", "slot", "block_time", "transactions", error.alias("error"))


def fan_out_tables(
    raw: DataFrame,
    reserved: DataFrame,
    out: str,
    commit_id: int,
    parsers: dict[str, Parser] = JSON_PARSERS,
    indexed: bool = False,
) -> DataFrame:
    """Feed ``blocks``, ``tx`` and ``tx-by-addr`` from one parse of the raw block rows.

    Raw rows are written first, so a block that yields nothing is kept. What was left out is stored as well:
    ``rejected`` has the rows that do not parse, with a reason, and ``incomplete`` the blocks with transactions
    without metadata and the number of these. ``indexed`` tables can be read by key (``serving``). Returns the
    rejected rows.
    """
    tables.write_commit(raw, f"{out}/blocks", commit_id, indexed=indexed)
    stored = tables.read_commit(raw.sparkSession, f"{out}/blocks", RAW_TABLE, commit_id)
    parsed = stage(parse_blocks(stored, parsers), "parsed-blocks")
    good = parsed.where(F.col("error").isNull())
    tables.write_commit(block_ops.tx_table(good), f"{out}/tx", commit_id, indexed=indexed)
    tables.write_commit(block_ops.tx_by_addr(good, reserved), f"{out}/tx-by-addr", commit_id, indexed=indexed)
    left_out = block_ops.incomplete_blocks(good).select(
        keys.slot_to_key(F.col("slot")).alias("row_key"), "slot", F.col("missing").cast("bigint").alias("missing")
    )
    tables.write_commit(left_out, f"{out}/incomplete", commit_id)
    rejected = parsed.where(F.col("error").isNotNull()).select("row_key", "slot", "error")
    tables.write_commit(rejected, f"{out}/rejected", commit_id)
    return tables.read_commit(
        raw.sparkSession, f"{out}/rejected", _schema(REJECTED), commit_id
    )


def entries_passthrough(raw: DataFrame, out: str, commit_id: int) -> None:
    """Copy entry rows by key, unparsed."""
    tables.write_commit(raw, f"{out}/entries", commit_id)


def _open_run(spark: SparkSession, out: str) -> DataFrame:
    """Folders of loads that began and have not finished."""
    begun = tables.read_or_empty(spark, f"{out}/runs", _schema(RUNS))
    return begun.join(tables.read_or_empty(spark, f"{out}/finished", _schema(FINISHED)), "run_id", "left_anti")


def _load_folders(spark: SparkSession, folders: DataFrame, root: str, reserved: DataFrame, out: str, run: int, parsers: dict[str, Parser], indexed: bool) -> DataFrame:
    sync_type = folders.select(F.regexp_extract("path", "/sync_type=([^/]*)/", 1)).first()[0]
    # Where the folders are now: a compaction may have come since the run began.
    places = stored_folders(spark, root, sync_type).select("path", "commit_id", "origin")
    folders = stage(folders.select("path", "kind", "table_name", "range").join(places, "path"), "places")
    blocks = raw_rows(read_folders(spark, root, sync_type, folders, "blocks"))
    rejected = fan_out_tables(blocks, reserved, out, run, parsers, indexed)
    entries_passthrough(raw_rows(read_folders(spark, root, sync_type, folders, "entries")), out, run)
    loaded = ledgers.read_file_ledger(spark, f"{out}/snapshots")
    ledgers.mark_files(folders.select("path").distinct().join(loaded, "path", "left_anti"), f"{out}/snapshots")
    spark.createDataFrame([(run,)], FINISHED).coalesce(1).write.mode("append").parquet(f"{out}/finished")
    return rejected


def load_archive(
    spark: SparkSession,
    root: str,
    sync_type: str,
    start: int,
    end: int,
    reserved: DataFrame,
    out: str,
    parsers: dict[str, Parser] = JSON_PARSERS,
    indexed: bool = False,
) -> DataFrame:
    """Load every unloaded archive folder that overlaps the request; returns the rejected block rows.

    A load is a run with a number of its own, which is the commit in all tables below ``out``. Its folders are
    recorded before any data and again when all is written. A run that died is finished first, with its folders
    and under its number, so it replaces what it wrote; no other run ever has that number. One load at a time may
    write to ``out``.
    """
    rejected = spark.createDataFrame([], REJECTED)
    opened = stage(_open_run(spark, out), "open-runs")
    for run, place in sorted(opened.select("run_id", "root").distinct().collect()):
        rejected = rejected.union(_load_folders(spark, opened.where(F.col("run_id") == run), place, reserved, out, run, parsers, indexed))
    folders = candidate_folders(spark, root, sync_type, start, end, f"{out}/snapshots")
    folders = stage(folders.select("path", "kind", "table_name", "range", "commit_id"), "load-folders")
    if folders.isEmpty():
        return rejected
    last = tables.read_or_empty(spark, f"{out}/runs", _schema(RUNS)).agg(F.max("run_id")).first()[0]
    run = 1 if last is None else last + 1
    record = folders.withColumns({"run_id": F.lit(run).cast("bigint"), "root": F.lit(root)})
    record.select(*_schema(RUNS).fieldNames()).coalesce(1).write.mode("append").parquet(f"{out}/runs")
    return rejected.union(_load_folders(spark, folders, root, reserved, out, run, parsers, indexed))


def load_report(spark: SparkSession, out: str) -> DataFrame:
    """What the loads below ``out`` stored and left out: (outcome, rows), rejected ones by reason."""
    raw = tables.read_table(spark, f"{out}/blocks", RAW_TABLE).select(F.lit("stored").alias("outcome"))
    incomplete = tables.read_table(spark, f"{out}/incomplete", _schema(INCOMPLETE)).select(F.lit("incomplete").alias("outcome"))
    reasons = tables.read_table(spark, f"{out}/rejected", _schema(REJECTED)).select(F.concat(F.lit("rejected: "), "error").alias("outcome"))
    return raw.union(incomplete).union(reasons).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))
