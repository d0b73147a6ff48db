"""The given tables read as ledger data: the inputs of the registered queries, tests and benchmark.

Every sample is derived by Spark from whole tables, so it grows with them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from blockloom.functions import keys
from blockloom.model import LEGACY_BLOCK, STATUS_DONE, STATUS_FAILED
from blockloom.operators import blocks as block_ops
from blockloom.operators import payloads, ranges
from blockloom.sources import archive, snapshots

# The lines of an order are dealt into so many blocks, whatever their number. A lane's slot follows from the order.
LANES = 4

RANGE_SIZE = 100

_LIVE_FOLDERS = ("range", "slot", "kind")

_LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _since_epoch(unit: str, column: str) -> Column:
    """Time-zone-free distance of a ``timestamp_ntz`` from the epoch."""
    return F.expr(f"timestampdiff({unit}, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the slot and position of the transaction they stand for.

    An order is dealt into ``LANES`` blocks, so no task numbers a hot order alone. ``deal`` is the lane as a number from
    0 on; numbering, gathering and the join to the orders all go by order and deal, so lines are shuffled once.
    """
    rows = table(spark, sf_dir, "lineitem").withColumn("lane", (F.col("l_partkey") + F.col("l_suppkey")) % LANES)
    rows = rows.withColumn("deal", F.coalesce(F.pmod("lane", F.lit(LANES)), F.lit(0)).cast("int"))
    rows = rows.repartition("l_orderkey", "deal")
    # A running count, because row_number is an INT.
    within = Window.partitionBy("l_orderkey", "deal", "lane").orderBy(*_LINE_ORDER).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return rows.withColumns(
        {"slot": F.col("l_orderkey") * LANES + F.col("lane"), "index": F.count(F.lit(1)).over(within) - 1}
    )


def _signature() -> Column:
    return F.concat(F.lit("sig"), F.col("slot"), F.lit("-"), F.col("index"))


def _account_keys() -> Column:
    return F.array(F.concat(F.lit("p"), F.col("l_partkey")), F.concat(F.lit("s"), F.col("l_suppkey")))


def _memo() -> Column:
    whole = F.col("l_quantity").cast("int")
    return F.when(F.col("l_quantity") > 45, F.concat(F.lit("q"), whole))


def _err() -> Column:
    return F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))


def _has_meta() -> Column:
    return ~((F.col("l_tax") == 0) & (F.col("l_discount") == 0))


def _gather(rows: DataFrame, item: Column, name: str) -> DataFrame:
    """Items of a block in position order; the position itself is dropped again."""
    placed = F.sort_array(F.collect_list(F.struct("index", item.alias("item"))))
    grouped = rows.groupBy("l_orderkey", "deal", "lane", "slot").agg(placed.alias("placed")).drop("lane")
    return grouped.withColumn(name, F.transform("placed", lambda p: p["item"])).drop("placed")


def _with_time(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), _since_epoch("SECOND", "o_orderdate").alias("block_time")
    )
    # Short rows of the orders for each deal, where the far larger blocks are already.
    dealt = orders.withColumn("deal", F.explode(F.array(*[F.lit(n) for n in range(LANES)])))
    return rows.join(dealt.hint("shuffle_hash"), ["l_orderkey", "deal"]).drop("l_orderkey", "deal")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in the shape the serving tables read: slot, block_time, transactions."""
    transaction = F.struct(
        F.array(_signature()).alias("signatures"),
        _account_keys().alias("account_keys"),
        _memo().alias("memo"),
        F.when(_has_meta(), F.struct(_err().alias("err"))).alias("meta"),
    )
    gathered = _gather(lines(spark, sf_dir), transaction, "transactions")
    return _with_time(spark, sf_dir, gathered).select("slot", "block_time", "transactions")


def legacy_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in the older layout, with a ``slot`` beside the stored fields."""
    amount = "decimal(20,0)"
    balances = F.array(F.col("l_quantity").cast("bigint").cast(amount), F.col("l_linenumber").cast(amount))
    item = F.struct(
        F.struct(
            F.array(_signature()).alias("signatures"),
            _account_keys().alias("account_keys"),
            _memo().alias("memo"),
        ).alias("transaction"),
        F.when(
            _has_meta(),
            F.struct(
                _err().alias("err"),
                F.floor("l_extendedprice").cast(amount).alias("fee"),
                balances.alias("pre_balances"),
                balances.alias("post_balances"),
            ),
        ).alias("meta"),
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("pubkey"),
        F.col("l_linenumber").cast("bigint").alias("lamports"),
    )
    gathered = _with_time(spark, sf_dir, _gather(lines(spark, sf_dir), item, "items"))
    slot = F.col("slot")
    return gathered.select(
        "slot",
        F.concat(F.lit("h"), slot - 1).alias("previous_blockhash"),
        F.concat(F.lit("h"), slot).alias("blockhash"),
        (slot - 1).alias("parent_slot"),
        F.transform(
            "items", lambda i: F.struct(i["transaction"].alias("transaction"), i["meta"].alias("meta"))
        ).alias("transactions"),
        F.transform(
            "items", lambda i: F.struct(i["pubkey"].alias("pubkey"), i["lamports"].alias("lamports"))
        ).alias("rewards"),
        "block_time",
        slot.cast(amount).alias("block_height"),
    )


def block_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as stored cells: even slots in the current layout, odd ones in the older one."""
    legacy = legacy_blocks(spark, sf_dir)
    even = F.col("slot") % 2 == 0
    fields = {name: F.col(name) for name in LEGACY_BLOCK.fieldNames()}
    current = {
        **fields,
        "transactions": F.transform("transactions", block_ops.current_transaction),
        "rewards": F.transform("rewards", block_ops.current_reward),
    }

    def text(columns: dict[str, Column]) -> Column:
        return F.to_json(F.struct(*[column.alias(name) for name, column in columns.items()]))

    stored = legacy.select(
        keys.slot_to_key(F.col("slot")).alias("row_key"),
        F.lit("x").alias("family"),
        F.when(even, "proto").otherwise("bin").alias("qualifier"),
        (F.col("block_time") * 1000).alias("ts"),
        F.encode(F.when(even, text(current)).otherwise(text(fields)), "UTF-8").alias("value"),
    )
    return payloads.encode_payloads(stored).drop("codec")


def broken_block_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that hold no block, one per supplier, far above the others: bytes that are no text, an unknown layout."""
    number = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        keys.slot_to_key(number + 1_000_000_000).alias("row_key"),
        F.lit("x").alias("family"),
        F.when(number % 3 == 0, "other").otherwise("proto").alias("qualifier"),
        number.alias("ts"),
        F.unhex(F.lit("00000000FFFE80")).alias("value"),
    )


def reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reserved addresses: the suppliers of some nations."""
    chosen = table(spark, sf_dir, "supplier").where(F.col("s_nationkey") < 5)
    return chosen.select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("address"))


def cells(spark: SparkSession, sf_dir: str, key: str = "user_id") -> DataFrame:
    """Events as cells: several per row when keyed by user, one per row when keyed by event."""
    qualifier = F.when(F.col("event_type").isin("click", "view"), "proto").otherwise("bin")
    return table(spark, sf_dir, "events").select(
        keys.slot_to_key(F.col(key)).alias("row_key"),
        F.lit("x").alias("family"),
        qualifier.alias("qualifier"),
        _since_epoch("MICROSECOND", "ts").alias("ts"),
        F.encode("props", "UTF-8").alias("value"),
    )


def order_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slot"))


def planned_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges over the whole key space of orders."""
    bounds = order_slots(spark, sf_dir).agg(F.min("slot").alias("start"), F.max("slot").alias("end"))
    return ranges.split_key_ranges(bounds, RANGE_SIZE)


def range_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the ranges that orders fall in: every third done, others failed, some both."""
    number = ranges.bucket_of(F.col("slot"), RANGE_SIZE)
    numbers = order_slots(spark, sf_dir).select(number.alias("number")).distinct()
    failed = (F.col("number") % 3 == 1) | (F.col("number") % 5 == 0)
    statuses = F.filter(
        F.array(
            F.when(F.col("number") % 3 == 0, F.lit(STATUS_DONE)), F.when(failed, F.lit(STATUS_FAILED))
        ),
        lambda status: status.isNotNull(),
    )
    records = numbers.select("number", F.explode(statuses).alias("status"))
    start = F.col("number") * RANGE_SIZE
    return records.select(
        F.lit("sync").alias("sync_type"),
        F.lit("blocks").alias("table_name"),
        keys.slot_to_key(start).alias("start_key"),
        keys.slot_to_key(start + RANGE_SIZE - 1).alias("end_key"),
        "status",
    )


def archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of stored files: three kinds per range that orders fall in, and odd ones.

    Besides ``range_lo_hi`` names there are upper-case bounds, paths that name both kinds, bounds
    beyond 2^31, bounds too large for a slot, and ledger records without a range name.
    """
    number = ranges.bucket_of(F.col("slot"), RANGE_SIZE)
    numbers = order_slots(spark, sf_dir).select(number.alias("number")).distinct()
    lo = keys.slot_to_key(F.col("number") * RANGE_SIZE)
    hi = keys.slot_to_key(F.col("number") * RANGE_SIZE + RANGE_SIZE - 1)
    name = keys.range_name(lo, hi)
    high = keys.range_name(
        keys.slot_to_key(F.col("number") + (1 << 31)), keys.slot_to_key(F.col("number") + (1 << 32))
    )
    paths = F.array(
        F.concat(F.lit("sync/blocks/"), name, F.lit("/blocks.seq")),
        F.concat(F.lit("sync/entries/"), name, F.lit("/entries.seq")),
        F.concat(F.lit("sync/other/"), name, F.lit("/other.seq")),
        F.concat(F.lit("sync/checkpoints/blocks/"), lo, F.lit("_"), hi, F.lit(".txt")),
        F.concat(F.lit("sync/blocks/range_"), F.upper(lo), F.lit("_"), F.upper(hi), F.lit("/a.seq")),
        F.concat(F.lit("sync/blocks/"), name, F.lit("/entries.seq")),
        F.concat(F.lit("sync/blocks/"), high, F.lit("/blocks.seq")),
        F.concat(F.lit("sync/blocks/range_ffff"), F.substring(lo, 5, 12), F.lit("_ffff"), hi, F.lit("/b.seq")),
    )
    return numbers.select("number", F.explode(paths).alias("path"))


def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files of every second range as already loaded."""
    return archive_files(spark, sf_dir).where(F.col("number") % 2 == 0).select("path")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slot interval per customer, of different widths; some are empty."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        (F.col("c_custkey") * 7).alias("s"),
        (F.col("c_custkey") * 7 + F.col("c_nationkey") * 13).alias("e"),
    )


def puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as keyed puts: about 13 per key, in commits of 1,000."""
    return _as_puts(table(spark, sf_dir, "events"))


def streamed_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same puts as a stream over the table's files, without a commit of their own."""
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    return _as_puts(events.option("pathGlobFilter", "events.parquet").parquet(sf_dir)).drop("commit_id")


def _as_puts(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(keys.slot_to_key(F.col("user_id")), F.lit("/"), F.col("event_type")).alias("row_key"),
        ranges.bucket_of(F.col("event_id"), 1000).alias("commit_id"),
        F.col("event_id").alias("seq"),
        "value",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.select("doc_id", F.encode("text", "UTF-8").alias("value"))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files of a live tree: path, modificationTime, content."""
    slot = F.col("page_id")
    kind = (
        F.when(slot % 3 == 0, "blocks").when(slot % 3 == 1, "entries").otherwise("other")
    )
    lo = ranges.range_start(slot, RANGE_SIZE)
    suffix = F.when(slot % 4 == 0, "").when(slot % 4 == 1, ".pb").otherwise(".v1.pb")
    return table(spark, sf_dir, "pages").select(
        F.concat(
            F.lit("/in/"),
            keys.range_name(keys.slot_to_key(lo), keys.slot_to_key(lo + RANGE_SIZE - 1)),
            F.lit("/"), slot, F.lit("/"), kind, F.lit("/"), keys.slot_to_key(slot), suffix,
        ).alias("path"),
        F.timestamp_seconds(slot).alias("modificationTime"),
        F.encode("html", "UTF-8").alias("content"),
    )


def _live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the folders of the live tree: range, slot, kind."""
    slot = F.col("page_id")
    lo = ranges.range_start(slot, RANGE_SIZE)
    kind = F.when(slot % 3 == 0, "blocks").when(slot % 3 == 1, "entries").otherwise("other")
    return table(spark, sf_dir, "pages").select(
        keys.range_name(keys.slot_to_key(lo), keys.slot_to_key(lo + RANGE_SIZE - 1)).alias("range"),
        slot.alias("slot"),
        kind.alias("kind"),
        "html",
    )


def write_live_tree(spark: SparkSession, sf_dir: str, folder: str, part: int | None = None, only: str = "true") -> None:
    """Pages as text files below ``range=…/slot=…/kind=…``, a file each; all, those of one remainder by 3, or some."""
    rows = _live_rows(spark, sf_dir).where(only)
    rows = (rows if part is None else rows.where(F.col("slot") % 3 == part)).repartition("slot")
    rows = rows.sortWithinPartitions("range", "slot", "kind")
    if archive.qualified(spark, folder).startswith("file:"):
        _write_local(rows, folder, f"part-{uuid.uuid4().hex}.txt")
    else:
        rows.write.mode("append").partitionBy("range", "slot", "kind").text(folder)


def _write_local(rows: DataFrame, folder: str, name: str) -> None:
    """What Spark's text writer makes of rows (``range``, ``slot``, ``kind``, ``html``) in the order of their folders.

    On a local disk that writer starts processes to set the modes of every file, and its driver moves the folders one by
    one. Here tasks write each file aside and rename it in, so it arrives whole, and again if the task is repeated. Rows
    without a column ``html`` make empty files.
    """
    path, files = snapshots.file_system(rows.sparkSession, folder)
    top, blank = path.toUri().getPath().rstrip("/"), "html" not in rows.columns
    aside = f"{top}/_arriving-{uuid.uuid4().hex}"
    os.makedirs(aside)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, out = f"{aside}/{uuid.uuid4().hex}", None, None

        def arrive() -> None:
            out.close()
            place = "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in zip(_LIVE_FOLDERS, current))
            os.makedirs(f"{top}/{place}", exist_ok=True)
            os.replace(part, f"{top}/{place}/{name}")

        for batch in batches:
            for *place, text in zip(*[c.to_pylist() for c in batch.columns]):
                if place != current:
                    if current is not None:
                        arrive()
                    current, out = place, open(part, "wb")
                if not blank:
                    out.write((text or "").encode() + b"\n")
        if current is not None:
            arrive()
        yield from ()

    text = F.lit(None).cast("string") if blank else F.col("html")
    rows.select(*_LIVE_FOLDERS, text).mapInArrow(write, "range string").write.format("noop").mode("overwrite").save()
    files.delete(rows.sparkSession._jvm.org.apache.hadoop.fs.Path(aside), True)


def add_empty_files(spark: SparkSession, sf_dir: str, folder: str, only: str = "slot % 10 = 7") -> None:
    """A file without a byte beside some of the pages of the live tree."""
    rows = _live_rows(spark, sf_dir).where(only).drop("html")
    if archive.qualified(spark, folder).startswith("file:"):
        _write_local(rows, folder, "empty.txt")
        return
    _, files = snapshots.file_system(spark, folder)
    Path = spark._jvm.org.apache.hadoop.fs.Path

    def create(row: Row) -> None:
        files.create(Path(f"{folder}/range={row['range']}/slot={row['slot']}/kind={row['kind']}/empty.txt"), True).close()

    snapshots.for_each(create, rows.toLocalIterator())
