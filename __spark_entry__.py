
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blockloom import samples  # noqa: E402
from blockloom.functions import keys  # noqa: E402
from blockloom.model import ADDRESS_TABLE, CELL, RANGE_LEDGER, RAW_TABLE, TX_ORDER, TX_TABLE  # noqa: E402
from blockloom.operators import blocks, cells, digests, payloads, ranges  # noqa: E402
from blockloom.plans import archiving, compaction, loading, serving  # noqa: E402
from blockloom.session import scratch_path, stage  # noqa: E402
from blockloom.sources import archive, ledgers, tables  # noqa: E402
from blockloom.streaming import live  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql is not None:
            _ORACLES[function.__name__] = sql
        return function

    return register


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """The training-data queries with their SQL; none where that subpackage is not installed."""
    try:
        import corpus_pipeline
        from blockloom.llm import queries as llm
    except ModuleNotFoundError as error:
        if error.name in ("blockloom.llm", "corpus_pipeline"):
            return {}, {}
        raise
    pipeline = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, llm.ORACLES | pipeline


def entry(spark: SparkSession) -> DataFrame:
    return tx_by_addr(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return _QUERIES | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _llm()[1]


# SQL building blocks. They restate the samples, not the operators.


def _hex(number: str) -> str:
    return f"lower(lpad(hex({number}), 16, '0'))"


_LINES = """
dealt AS (SELECT *, (l_partkey + l_suppkey) % 4 AS lane FROM lineitem),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, lane ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS idx
  FROM dealt),
tx AS (
  SELECT l_orderkey * 4 + lane AS slot, idx,
    date_diff('second', TIMESTAMP '1970-01-01', o_orderdate) AS block_time,
    CASE WHEN l_quantity > 45 THEN 'q' || CAST(l_quantity AS INTEGER) END AS memo,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS err,
    NOT (l_tax = 0 AND l_discount = 0) AS has_meta,
    'p' || l_partkey AS part, 's' || l_suppkey AS supp,
    floor(l_extendedprice)::BIGINT AS fee, trunc(l_quantity)::BIGINT AS quantity, l_linenumber
  FROM numbered JOIN orders ON o_orderkey = l_orderkey),
complete AS (
  SELECT * FROM tx WHERE slot NOT IN (SELECT slot FROM tx WHERE NOT has_meta)),
accounts AS (
  SELECT slot, idx, block_time, memo, err, unnest([part, supp]) AS address FROM complete),
reserved AS (SELECT 's' || s_suppkey AS address FROM supplier WHERE s_nationkey < 5),
kept AS (SELECT * FROM accounts WHERE address NOT IN (SELECT address FROM reserved)),
by_addr AS (
  SELECT address || '/' || lower(hex(~slot)) AS row_key, address, slot,
    string_agg(concat_ws('|', 'sig' || slot || '-' || idx, coalesce(err, ''), idx, coalesce(memo, ''),
      block_time), ',' ORDER BY idx) AS entries
  FROM kept GROUP BY address, slot)
"""

_CELLS = f"""
cells AS (
  SELECT {_hex('user_id')} AS row_key, 'x' AS family,
    CASE WHEN event_type IN ('click', 'view') THEN 'proto' ELSE 'bin' END AS qualifier,
    epoch_us(ts) AS ts, props AS value, event_id
  FROM events)
"""

_PLANNED = f"""
planned AS (
  SELECT {_hex('n * 100')} AS start_key, {_hex('n * 100 + 99')} AS end_key, n
  FROM (SELECT unnest(range(min(o_orderkey) // 100, max(o_orderkey) // 100 + 1)) AS n FROM orders))
"""

_RANGE_LEDGER = f"""
numbers AS (SELECT DISTINCT o_orderkey // 100 AS n FROM orders),
ledger AS (
  SELECT {_hex('n * 100')} AS start_key, {_hex('n * 100 + 99')} AS end_key, 'done' AS status
  FROM numbers WHERE n % 3 = 0
  UNION ALL
  SELECT {_hex('n * 100')}, {_hex('n * 100 + 99')}, 'failed' FROM numbers WHERE n % 3 = 1 OR n % 5 = 0)
"""

_FILES = f"""
numbers AS (
  SELECT DISTINCT o_orderkey // 100 AS n FROM orders),
names AS (
  SELECT n, {_hex('n * 100')} AS lo, {_hex('n * 100 + 99')} AS hi,
    {_hex('n + 2147483648')} AS high_lo, {_hex('n + 4294967296')} AS high_hi FROM numbers),
files AS (
  SELECT n, unnest([
    'sync/blocks/range_' || lo || '_' || hi || '/blocks.seq',
    'sync/entries/range_' || lo || '_' || hi || '/entries.seq',
    'sync/other/range_' || lo || '_' || hi || '/other.seq',
    'sync/checkpoints/blocks/' || lo || '_' || hi || '.txt',
    'sync/blocks/range_' || upper(lo) || '_' || upper(hi) || '/a.seq',
    'sync/blocks/range_' || lo || '_' || hi || '/entries.seq',
    'sync/blocks/range_' || high_lo || '_' || high_hi || '/blocks.seq',
    'sync/blocks/range_ffff' || substr(lo, 5) || '_ffff' || hi || '/b.seq']) AS path
  FROM names),
parsed AS (
  SELECT path, regexp_extract(path, 'range_([0-9a-fA-F]+)_([0-9a-fA-F]+)', 1) AS start_key,
    regexp_extract(path, 'range_([0-9a-fA-F]+)_([0-9a-fA-F]+)', 2) AS end_key FROM files),
bounded AS (
  SELECT path, start_key, end_key, CAST(('0x' || start_key) AS BIGINT) AS lo, CAST(('0x' || end_key) AS BIGINT) AS hi
  FROM parsed WHERE start_key <> '' AND start_key NOT LIKE 'ffff%')
"""

_PAGES = f"""
tree AS (
  SELECT page_id, html,
    '/in/range_' || {_hex('page_id // 100 * 100')} || '_' || {_hex('page_id // 100 * 100 + 99')} || '/'
      || page_id || '/' || CASE page_id % 3 WHEN 0 THEN 'blocks' WHEN 1 THEN 'entries' ELSE 'other' END || '/'
      || {_hex('page_id')} || CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.pb' ELSE '.v1.pb' END AS path,
    CASE page_id % 3 WHEN 0 THEN 'blocks' WHEN 1 THEN 'entries' ELSE 'other' END AS kind,
    {_hex('page_id')} || CASE WHEN page_id % 4 > 1 THEN '.v1' ELSE '' END AS stem
  FROM pages)
"""

_LIVE = f"""
arrived AS (
  SELECT page_id AS slot, html || chr(10) AS content FROM pages UNION ALL SELECT page_id, '' FROM pages WHERE page_id % 10 = 7),
placed AS (
  SELECT *, 'range_' || {_hex('slot // 100 * 100')} || '_' || {_hex('slot // 100 * 100 + 99')} AS range,
    CASE slot % 3 WHEN 0 THEN 'blocks' WHEN 1 THEN 'entries' ELSE 'other' END AS kind
  FROM arrived)
"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + select


def _text(column: str) -> Column:
    return F.decode(F.col(column), "UTF-8").alias(column)


# Scans, sources, sinks


@_query(
    _with(
        _CELLS,
        select=f"""
SELECT row_key, qualifier, ts, value FROM cells WHERE row_key BETWEEN {_hex('10')} AND 'ffffffffffffffff'""",
    )
)
def read_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive.read_key_range(samples.cells(spark, sf_dir), f"{10:016x}", "f" * 16)
    return found.select("row_key", "qualifier", "ts", _text("value"))


@_query(
    _with(
        _CELLS,
        select=f"""
SELECT row_key, qualifier, ts, value FROM cells WHERE row_key IN (
  SELECT DISTINCT row_key FROM cells WHERE row_key >= {_hex('10')} ORDER BY row_key LIMIT 100)""",
    )
)
def read_key_range_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive.read_key_range(samples.cells(spark, sf_dir), f"{10:016x}", "f" * 16, limit=100)
    return found.select("row_key", "qualifier", "ts", _text("value"))


def _archived_events(spark: SparkSession, sf_dir: str) -> str:
    """Archive the events in waves, twice: the second run finds every range done. Cells of bad keys are set aside."""
    root, ledger = scratch_path(spark, "archive"), scratch_path(spark, "ledger")
    rows = samples.cells(spark, sf_dir, key="event_id")
    bad = rows.where(F.col("qualifier") == "proto").withColumn("row_key", F.concat("row_key", F.lit("z")))
    short = rows.where(F.col("qualifier") == "bin").withColumn("row_key", F.upper(F.ltrim("row_key", F.lit("0"))))
    end = samples.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    for _ in range(2):
        archiving.archive_key_range(
            spark, rows.union(bad).union(short), 0, end, samples.RANGE_SIZE * 10, root, ledger, "sync", "blocks", waves=3,
            rejects=f"{root}-rejects",
        )
    return root


_EVENT_RANGE = f"'range_' || {_hex('event_id // 1000 * 1000')} || '_' || {_hex('event_id // 1000 * 1000 + 999')}"


@_query(
    f"""
SELECT {_EVENT_RANGE} AS range, count(*) AS cells, min(event_id) AS first_slot, max(event_id) AS last_slot
FROM events GROUP BY ALL
UNION ALL SELECT 'rejected', count(*), NULL, NULL FROM (
  SELECT DISTINCT event_id, ts, props, event_type IN ('click', 'view') FROM events)"""
)
def archive_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _archived_events(spark, sf_dir)
    slot = keys.key_to_slot(F.col("row_key"))
    counts = archive.read_archive(spark, root).groupBy("range").agg(
        F.count(F.lit(1)).alias("cells"), F.min(slot).alias("first_slot"), F.max(slot).alias("last_slot")
    )
    nothing = F.lit(None).cast("bigint")
    rejected = archiving.read_rejects(spark, f"{root}-rejects").agg(F.count(F.lit(1)).alias("cells"))
    return counts.union(rejected.select(F.lit("rejected"), "cells", nothing, nothing))


@_query(f"""
SELECT {_EVENT_RANGE} AS range, count(*) AS cells, 1::BIGINT AS records FROM events GROUP BY ALL""")
def archive_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs share a plan: every range is archived and recorded once."""
    rows = stage(samples.cells(spark, sf_dir, key="event_id"), "cells")
    root, ledger, claims = (scratch_path(spark, name) for name in ("archive", "ledger", "claims"))
    end = samples.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    plan = stage(ranges.split_key_range(spark, 0, end, samples.RANGE_SIZE * 10), "plan")

    def job(_: int) -> None:
        archiving.archive_shared(spark, rows, plan, samples.RANGE_SIZE * 10, root, ledger, "sync", "blocks", claims, poll=0.2, waves=4)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(job, range(2)))
    done = tables.read_or_empty(spark, ledger, RANGE_LEDGER).groupBy(keys.range_name(F.col("start_key"), F.col("end_key")).alias("range"))
    cells_of = archive.read_archive(spark, root).groupBy("range").agg(F.count(F.lit(1)).alias("cells"))
    return cells_of.join(done.agg(F.count(F.lit(1)).alias("records")), "range")


@_query(
    f"""
SELECT {_EVENT_RANGE} AS range, {_hex('event_id')} AS row_key, props AS value,
  CASE WHEN event_type IN ('click', 'view') THEN 'proto' ELSE 'bin' END AS qualifier
FROM events"""
)
def read_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = archive.read_archive(spark, _archived_events(spark, sf_dir))
    chosen = stored.where((F.col("sync_type") == "sync") & (F.col("table_name") == "blocks"))
    return chosen.select("range", "row_key", _text("value"), "qualifier")


@_query(f"SELECT DISTINCT {_EVENT_RANGE} AS range, 'blocks' AS kind, true AS has_bytes FROM events")
def list_archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = archive.list_archive_files(spark, _archived_events(spark, sf_dir))
    named = ranges.route_by_kind(ranges.parse_range_path(files))
    name = keys.range_name(F.col("start_key"), F.col("end_key"))
    return named.groupBy(name.alias("range"), "kind").agg((F.min("length") > 0).alias("has_bytes"))


def _follow_pages(spark: SparkSession, sf_dir: str, **options) -> dict[str, str]:
    paths = {name: scratch_path(spark, name) for name in ("live", "archive", "checkpoint", "done", "rejects")}
    samples.write_live_tree(spark, sf_dir, paths["live"])
    samples.add_empty_files(spark, sf_dir, paths["live"])
    live.follow(
        spark, paths["live"], paths["archive"], "live", paths["checkpoint"], rejects=paths["rejects"], **options
    ).awaitTermination()
    return paths


def _archived_pages(spark: SparkSession, root: str) -> DataFrame:
    stored = archive.read_archive(spark, root)
    return stored.select(
        "table_name", "range", "family", "qualifier",
        F.octet_length("value").cast("bigint").alias("bytes"), F.sha2("value", 256).alias("digest"),
    )


_LIVE_ROWS = _with(
    _LIVE,
    select="""
SELECT kind AS table_name, range, 'x' AS family, 'proto' AS qualifier,
  octet_length(encode(content)) AS bytes, sha256(content) AS digest
FROM placed WHERE kind <> 'other'""",
)


@_query(_LIVE_ROWS)
def live_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archived_pages(spark, _follow_pages(spark, sf_dir)["archive"])


@_query(_LIVE_ROWS)
def backfill_then_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the pages is there beforehand; the others arrive in two parts while the stream runs."""
    paths = {name: scratch_path(spark, name) for name in ("live", "archive", "checkpoint")}
    samples.write_live_tree(spark, sf_dir, paths["live"], 0)
    query = live.backfill_then_follow(
        spark, paths["live"], paths["archive"], "live", paths["checkpoint"], "0 seconds", 10_000
    )
    for part in (1, 2):
        samples.write_live_tree(spark, sf_dir, paths["live"], part)
        if part == 2:
            samples.add_empty_files(spark, sf_dir, paths["live"])
        query.processAllAvailable()
    query.stop()
    return _archived_pages(spark, paths["archive"])


@_query(
    _with(
        _LIVE,
        select="""
SELECT kind, count(*) AS files, true AS some_moved FROM placed GROUP BY kind""",
    )
)
def clean_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per kind after four batches with clean-up: some have moved, none is lost."""
    paths = {name: scratch_path(spark, name) for name in ("live", "archive", "checkpoint", "done", "rejects")}
    samples.write_live_tree(spark, sf_dir, paths["live"])
    samples.add_empty_files(spark, sf_dir, paths["live"])
    arrived = archive.list_archive_files(spark, paths["live"]).count()
    live.follow(
        spark, paths["live"], paths["archive"], "live", paths["checkpoint"],
        files_per_batch=arrived // 4 + 1, clean_source="archive", done_folder=paths["done"],
        rejects=paths["rejects"],
    ).awaitTermination()
    # Spark may still be moving files: what is left is listed first, and a file that is met in both places counts once.
    left = stage(archive.list_archive_files(spark, paths["live"], missing_ok=True), "left")
    moved = stage(archive.list_archive_files(spark, paths["done"], missing_ok=True), "moved")
    below = F.regexp_extract("path", "/range=.*$", 0).alias("path")
    found = left.union(moved).select(below).where(F.col("path").endswith(".txt")).distinct()
    kinds = found.groupBy(keys.parent_folder(F.col("path")).alias("kind")).agg(F.count(F.lit(1)).alias("files"))
    return kinds.withColumn("some_moved", F.lit(not moved.isEmpty()))


@_query(_with(_LIVE, select="""
SELECT kind AS table_name, range, count(*) AS cells, sum(octet_length(encode(content)))::BIGINT AS bytes, 1::BIGINT AS folders, true AS same_commits
FROM placed WHERE kind <> 'other' GROUP BY ALL"""))
def compact_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches of the live job, then one folder per range; the cells keep the commits they came in."""
    paths = {name: scratch_path(spark, name) for name in ("live", "archive", "checkpoint")}
    samples.write_live_tree(spark, sf_dir, paths["live"])
    samples.add_empty_files(spark, sf_dir, paths["live"])
    arrived = archive.list_archive_files(spark, paths["live"]).count()
    live.follow(spark, paths["live"], paths["archive"], "live", paths["checkpoint"], files_per_batch=arrived // 4 + 1).awaitTermination()
    by = ["table_name", "range"]
    before = stage(archive.read_archive(spark, paths["archive"]).groupBy(*by).agg(F.count_distinct("commit_id").alias("commits")), "before")
    compaction.compact_archive(spark, paths["archive"], "live")
    compaction.purge(spark, paths["archive"])
    cells = archive.stored_cells(spark, paths["archive"], places=True).withColumn("folder", F.regexp_extract("file", "^(.*)/", 1))
    after = cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"), F.sum(F.octet_length("value")).alias("bytes"),
        F.count_distinct("folder").alias("folders"), F.count_distinct("origin").alias("origins"),
    )
    return after.join(before, by).select(*by, "cells", "bytes", "folders", (F.col("origins") == F.col("commits")).alias("same_commits"))


@_query(_with(_LIVE, select="""
SELECT range, kind, count(*) AS files, count(*) FILTER (content = '') AS empty_files FROM placed GROUP BY ALL"""))
def list_live_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing has the files without a byte, too."""
    folder = scratch_path(spark, "live")
    samples.write_live_tree(spark, sf_dir, folder)
    samples.add_empty_files(spark, sf_dir, folder)
    files = archive.list_archive_files(spark, folder).where(F.col("path").endswith(".txt"))
    name = F.regexp_extract("path", "/range=([^/]*)/", 1).alias("range")
    return files.groupBy(name, keys.parent_folder(F.col("path")).alias("kind")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") == 0).alias("empty_files")
    )


@_query(_with(_LIVE, select="""
SELECT range, count(*) FILTER (content <> '' OR late) AS files, count(*) FILTER (content <> '' AND kind = 'other') AS rejected,
  NOT bool_or(late) AND NOT bool_or(kind = 'other') AS cleaned,
  CASE WHEN cleaned THEN 0 ELSE count(*) FILTER (content <> '' OR late) END AS left_over
FROM (SELECT *, content = '' AND slot // 100 % 3 = 0 AS late FROM placed WHERE kind <> 'other' OR slot // 100 % 2 = 0)
GROUP BY range"""))
def clean_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even ranges have files that no table takes, and every third gets files after the stream has ended: they stay."""
    paths = {name: scratch_path(spark, name) for name in ("live", "archive", "checkpoint", "rejects")}
    known = "(kind <> 'other' OR slot div 100 % 2 = 0)"
    samples.write_live_tree(spark, sf_dir, paths["live"], only=known)
    live.follow(spark, paths["live"], paths["archive"], "live", paths["checkpoint"], rejects=paths["rejects"]).awaitTermination()
    samples.add_empty_files(spark, sf_dir, paths["live"], f"slot % 10 = 7 AND slot div 100 % 3 = 0 AND {known}")
    states = live.clean_ranges(spark, paths["live"], paths["checkpoint"], paths["rejects"])
    left = archive.list_archive_files(spark, paths["live"], missing_ok=True).where(F.col("path").contains("/range="))
    left = left.groupBy(F.regexp_extract("path", "/range=([^/]*)/", 1).alias("range")).agg(F.count(F.lit(1)).alias("left_over"))
    return states.where("range LIKE 'range%'").join(left, "range", "left").fillna(0, ["left_over"])


@_query(
    """
SELECT lower(lpad(hex(user_id), 16, '0')) || '/' || event_type AS row_key,
  max(event_id // 1000) AS commit_id, max(event_id) AS seq, arg_max(value, event_id) AS value
FROM events GROUP BY ALL"""
)
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest_by_key(samples.puts(spark, sf_dir), ["commit_id", "seq"])


def _put_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """The puts in three commits, the second written twice; the first two are compacted before the third comes."""
    puts, path = samples.puts(spark, sf_dir).drop("commit_id"), scratch_path(spark, "puts")
    for number, times in enumerate((1, 2, 1)):
        for _ in range(times):
            tables.put(puts.where(F.col("seq") % 3 == number), path, "job", number, indexed=True)
        if number == 1:
            tables.compact(spark, path, puts.schema, ["seq"], indexed=True)
    return path


_PUT_ROWS = """
SELECT lower(lpad(hex(user_id), 16, '0')) || '/' || event_type AS row_key, max(event_id % 3) AS commit_id,
  max_by(event_id, (event_id % 3, event_id)) AS seq, max_by(value, (event_id % 3, event_id)) AS value
FROM events"""


@_query(f"{_PUT_ROWS} GROUP BY ALL")
def upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A put after a compaction wins; compacted rows keep their commits."""
    return tables.read_table(spark, _put_in_parts(spark, sf_dir), samples.puts(spark, sf_dir).drop("commit_id").schema, ["seq"])


@_query(f"{_PUT_ROWS} WHERE user_id % 20 = 0 GROUP BY ALL")
def read_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every twentieth user by their keys, and keys that are nowhere."""
    puts = samples.puts(spark, sf_dir)
    events = samples.table(spark, sf_dir, "events").where(F.col("user_id") % 20 == 0)
    wanted = events.select(F.concat(keys.slot_to_key(F.col("user_id")), F.lit("/"), F.col("event_type")).alias("row_key"))
    nowhere = wanted.select(F.concat("row_key", F.lit("!")))
    return tables.read_keys(spark, _put_in_parts(spark, sf_dir), puts.drop("commit_id").schema, wanted.union(nowhere), ["seq"])


@_query(
    """
SELECT lower(lpad(hex(user_id), 16, '0')) || '/' || event_type AS row_key,
  max(event_id) AS seq, arg_max(value, event_id) AS value
FROM events GROUP BY ALL"""
)
def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The puts as a stream; the second start finds nothing new."""
    path, checkpoint = scratch_path(spark, "puts"), scratch_path(spark, "checkpoint")
    rows = samples.streamed_puts(spark, sf_dir)
    for _ in range(2):
        live.upsert_stream(rows, path, checkpoint).awaitTermination()
    return tables.read_table(spark, path, samples.puts(spark, sf_dir).drop("commit_id").schema, ["seq"]).drop("commit_id")


def _entries_text() -> Column:
    """The list of one row as text, in list order."""
    return F.array_join(
        F.transform(
            "entries",
            lambda e: F.concat_ws(
                "|", e["signature"], F.coalesce(e["err"], F.lit("")), e["index"],
                F.coalesce(e["memo"], F.lit("")), e["block_time"],
            ),
        ),
        ",",
    ).alias("entries")


def _load(spark: SparkSession, sf_dir: str, broken: bool = False) -> str:
    """Archive all block cells and entry cells, load them twice, return where the serving tables are.

    The plan holds the ranges that blocks fall in.
    """
    root, ledger, out = (scratch_path(spark, name) for name in ("archive", "ledger", "serving"))
    size = samples.RANGE_SIZE * 10
    block_rows = samples.block_cells(spark, sf_dir)
    if broken:
        block_rows = block_rows.union(samples.broken_block_cells(spark, sf_dir))
    tables_of = {"blocks": stage(block_rows, "block-cells"), "entries": samples.cells(spark, sf_dir)}
    slots = [rows.select(keys.key_to_slot(F.col("row_key")).alias("slot")) for rows in tables_of.values()]
    counts = ranges.range_row_counts(slots[0].union(slots[1]), F.col("slot"), size)
    planned = stage(counts.select("start_key", "end_key"), "plan")
    last = int(planned.agg(F.max("end_key")).first()[0], 16)
    for table, rows in tables_of.items():
        archiving.archive_ranges(spark, rows, planned, size, root, ledger, "sync", table)
    for _ in range(2):
        loading.load_archive(spark, root, "sync", 0, last + 1, samples.reserved(spark, sf_dir), out)
    return out


@_query(
    _with(
        _LINES,
        select="""
SELECT 'blocks' AS name, count(DISTINCT slot) AS rows, count(DISTINCT slot) AS keys FROM tx
UNION ALL SELECT 'tx', count(*), count(DISTINCT slot || '-' || idx) FROM complete
UNION ALL SELECT 'tx-by-addr', count(*), count(DISTINCT row_key) FROM by_addr""",
    )
)
def fan_out_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _load(spark, sf_dir)
    counted = [
        spark.read.parquet(f"{out}/{name}")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("row_key").alias("keys"))
        .select(F.lit(name).alias("name"), "rows", "keys")
        for name in ("blocks", "tx", "tx-by-addr")
    ]
    return counted[0].union(counted[1]).union(counted[2])


@_query(_with(_LINES, select="SELECT row_key, address, slot, entries FROM by_addr"))
def load_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive, list, select, parse, derive and upsert, end to end."""
    stored = tables.read_table(spark, f"{_load(spark, sf_dir)}/tx-by-addr", ADDRESS_TABLE)
    return stored.select("row_key", "address", "slot", _entries_text())


@_query(
    _with(
        _LINES,
        select="SELECT 'sig' || slot || '-' || idx AS row_key, slot, idx AS index, err, memo FROM complete",
    )
)
def load_archive_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = tables.read_table(spark, f"{_load(spark, sf_dir)}/tx", TX_TABLE, TX_ORDER)
    return stored.select("row_key", "slot", "index", "err", "memo")


@_query(
    _with(
        _CELLS,
        select="""
SELECT row_key, qualifier, ts, value FROM cells
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY family, qualifier, ts DESC) = 1""",
    )
)
def entries_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry rows of several cells each, as the load leaves them."""
    copied = tables.read_table(spark, f"{_load(spark, sf_dir)}/entries", RAW_TABLE)
    return copied.select("row_key", "qualifier", "ts", _text("value"))


@_query(
    _with(
        _LINES,
        select=f"""
SELECT DISTINCT {_hex('slot')} AS row_key, CASE WHEN slot % 2 = 0 THEN 'proto' ELSE 'bin' END AS qualifier,
  slot NOT IN (SELECT slot FROM complete) AS underived
FROM tx""",
    )
)
def blocks_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw block is stored, also those that derive no rows."""
    out = _load(spark, sf_dir)
    derived = tables.read_table(spark, f"{out}/tx", TX_TABLE, TX_ORDER).select(
        keys.slot_to_key(F.col("slot")).alias("derived_key")
    )
    stored = tables.read_table(spark, f"{out}/blocks", RAW_TABLE)
    joined = stored.join(derived.distinct(), F.col("row_key") == F.col("derived_key"), "left")
    return joined.select("row_key", "qualifier", F.col("derived_key").isNull().alias("underived"))


@_query(
    _with(
        _LINES,
        select="""
SELECT 'stored' AS outcome, (SELECT count(DISTINCT slot) FROM tx) + (SELECT count(*) FROM supplier) AS rows
UNION ALL SELECT 'incomplete', count(DISTINCT slot) FROM tx WHERE NOT has_meta
UNION ALL SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'rejected: unknown qualifier' ELSE 'rejected: payload does not parse' END,
  count(*) FROM supplier GROUP BY ALL""",
    )
)
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of good and broken blocks stored and left out."""
    return loading.load_report(spark, _load(spark, sf_dir, broken=True))


@_query(_with(_CELLS, select="SELECT row_key, family, qualifier, ts, value FROM cells"))
def seqfile_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    archive.export_records(samples.cells(spark, sf_dir).select(*CELL.fieldNames()), path)
    return archive.import_records(spark, path).withColumn("value", _text("value"))


# Range planning and ledgers


@_query(_with(_PLANNED, select="SELECT start_key, end_key FROM planned"))
def split_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.planned_ranges(spark, sf_dir)


@_query(
    f"""
SELECT {_hex('o_orderkey // 100 * 100')} AS start_key, {_hex('o_orderkey // 100 * 100 + 99')} AS end_key,
  count(*) AS rows FROM orders GROUP BY ALL"""
)
def range_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.range_row_counts(samples.order_slots(spark, sf_dir), F.col("slot"), samples.RANGE_SIZE)


@_query(
    _with(
        _PLANNED,
        _RANGE_LEDGER,
        select="""
SELECT start_key, end_key FROM planned
WHERE (start_key, end_key) NOT IN (SELECT (start_key, end_key) FROM ledger WHERE status = 'done')""",
    )
)
def pending_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.pending_ranges(samples.planned_ranges(spark, sf_dir), samples.range_ledger(spark, sf_dir))


@_query(
    _with(
        _RANGE_LEDGER,
        select="""
SELECT start_key, end_key, status, 100::BIGINT AS size FROM ledger""",
    )
)
def mark_range_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written in two appends, one repeated, and read back."""
    records, path = samples.range_ledger(spark, sf_dir), scratch_path(spark, "ledger")
    for status in ("done", "failed", "done"):
        ledgers.mark_ranges(records.where(F.col("status") == status), path, "sync", "blocks", 100, status)
    stored = ledgers.read_range_ledger(spark, path, "sync", "blocks")
    return stored.select("start_key", "end_key", "status", "size")


@_query(
    _with(
        _PLANNED,
        _RANGE_LEDGER,
        select="""
SELECT p.start_key, p.end_key, coalesce(min(l.status), 'pending') AS status
FROM planned p LEFT JOIN ledger l USING (start_key, end_key) GROUP BY ALL""",
    )
)
def range_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.range_status(samples.planned_ranges(spark, sf_dir), samples.range_ledger(spark, sf_dir))


@_query(_with(_FILES, select="SELECT path, start_key, end_key, lo, hi FROM bounded"))
def parse_range_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.parse_range_path(samples.archive_files(spark, sf_dir)).drop("number")


@_query(
    _with(
        _FILES,
        select="""
SELECT path, lo, hi, c_custkey AS id, c_custkey * 7 AS s, c_custkey * 7 + c_nationkey * 13 AS e
FROM bounded JOIN customer ON greatest(lo, c_custkey * 7) < least(hi, c_custkey * 7 + c_nationkey * 13)""",
    )
)
def overlapping_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = ranges.parse_range_path(samples.archive_files(spark, sf_dir)).select("path", "lo", "hi")
    return ranges.overlapping_files_of_requests(files, samples.requests(spark, sf_dir))


@_query(_with(_FILES, select="SELECT path, lo, hi FROM bounded WHERE greatest(lo, 199) < least(hi, 10000000)"))
def overlapping_files_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = ranges.parse_range_path(samples.archive_files(spark, sf_dir)).select("path", "lo", "hi")
    return ranges.overlapping_files(files, 199, 10000000)


@_query(
    _with(
        _FILES,
        select="""
SELECT path, kind FROM files, (VALUES ('blocks'), ('entries')) kinds(kind) WHERE contains(path, kind)""",
    )
)
def route_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.route_by_kind(samples.archive_files(spark, sf_dir)).drop("number")


@_query(
    _with(
        _FILES,
        select="SELECT path FROM files WHERE path NOT IN (SELECT path FROM files WHERE n % 2 = 0)",
    )
)
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = samples.archive_files(spark, sf_dir).select("path")
    return ranges.pending_files(files, samples.file_ledger(spark, sf_dir))


# Cells and keys


@_query(
    _with(
        _PAGES,
        select="""
SELECT path, stem AS row_key, 'x' AS family, 'proto' AS qualifier, page_id * 1000 AS ts,
  sha256(html) AS digest FROM tree""",
    )
)
def file_to_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cells.file_to_cell(samples.page_files(spark, sf_dir))
    return made.select("path", "row_key", "family", "qualifier", "ts", F.sha2("value", 256).alias("digest"))


@_query(f"SELECT o_orderkey AS slot, {_hex('o_orderkey')} AS row_key FROM orders")
def slot_to_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.order_slots(spark, sf_dir).withColumn("row_key", keys.slot_to_key(F.col("slot")))


@_query(
    f"""
SELECT key, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderkey END AS slot FROM (
  SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN {_hex('o_orderkey')} WHEN 1 THEN upper(hex(o_orderkey))
    ELSE {_hex('o_orderkey')} || 'z' END AS key FROM orders)"""
)
def key_to_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, short upper-case and corrupt keys."""
    slot = F.col("slot")
    key = (
        F.when(slot % 3 == 0, keys.slot_to_key(slot))
        .when(slot % 3 == 1, F.hex(slot))
        .otherwise(F.concat(keys.slot_to_key(slot), F.lit("z")))
    )
    written = samples.order_slots(spark, sf_dir).select(key.alias("key"))
    return written.withColumn("slot", keys.key_to_slot(F.col("key")))


@_query(
    _with(
        _CELLS,
        select="""
SELECT row_key, qualifier, ts, value FROM cells
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY family, qualifier, ts DESC) = 1""",
    )
)
def first_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.first_cell(samples.cells(spark, sf_dir)).select("row_key", "qualifier", "ts", _text("value"))


@_query(
    """
SELECT event_id, CASE WHEN event_type LIKE 'p%' THEN 'proto' WHEN event_type LIKE 'b%' THEN 'bin' END AS format
FROM events"""
)
def format_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    qualified = samples.table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("qualifier"))
    return cells.with_format(qualified).select("event_id", "format")


@_query(
    _with(
        _PAGES,
        select="""
SELECT path, CASE WHEN kind <> 'other' THEN kind END AS table_name, kind = 'other' AS rejected FROM tree""",
    )
)
def route_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cells.file_to_cell(samples.page_files(spark, sf_dir))
    routed = cells.route_cells(made).select("path", "table_name", F.lit(False).alias("rejected"))
    unknown = cells.rejected_cells(made).select(
        "path", F.lit(None).cast("string").alias("table_name"), F.lit(True).alias("rejected")
    )
    return routed.union(unknown)


@_query("SELECT l_orderkey AS slot, 's' || l_suppkey || '/' || lower(hex(~l_orderkey)) AS row_key FROM lineitem")
def inverted_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.col("l_orderkey")
    address = F.concat(F.lit("s"), F.col("l_suppkey"))
    return samples.table(spark, sf_dir, "lineitem").select(
        slot.alias("slot"), keys.address_slot_key(address, slot).alias("row_key")
    )


@_query(
    _with(
        _CELLS,
        select="""
SELECT row_key, sha256(string_agg(value, '' ORDER BY family, qualifier, ts DESC)) AS digest
FROM cells GROUP BY row_key""",
    )
)
def row_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.row_digest(samples.cells(spark, sf_dir))


def _changed_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cells of the events, and a copy where some are missing, some twice, and some have another value."""
    number = F.conv("event", 16, 10).cast("bigint")
    events = samples.cells(spark, sf_dir, "event_id").withColumnRenamed("row_key", "event")
    users = samples.table(spark, sf_dir, "events").select(
        keys.slot_to_key(F.col("event_id")).alias("event"), keys.slot_to_key(F.col("user_id") % 1000).alias("row_key")
    )
    whole = stage(events.join(users, "event"), "cells")
    value = F.when(number % 101 == 0, F.encode(F.lit("changed"), "UTF-8")).otherwise(F.col("value"))
    times = F.array_repeat(F.lit(1), F.when(number % 103 == 0, 2).when(number % 97 == 0, 0).otherwise(1))
    copy = whole.withColumns({"value": value, "time": F.explode(times)})
    return whole.select(*CELL.fieldNames()), copy.select(*CELL.fieldNames())


_COMPARED = f"""
WITH cells AS (
  SELECT {_hex('user_id % 1000')} AS row_key, CASE WHEN event_type IN ('click', 'view') THEN 'proto' ELSE 'bin' END AS qualifier,
    epoch_us(ts) AS ts, props AS value, event_id FROM events),
both_sides AS (
  SELECT row_key, qualifier, ts, sha256(value) AS digest, 1 AS l, 0 AS r FROM cells
  UNION ALL
  SELECT row_key, qualifier, ts, sha256(CASE WHEN event_id % 101 = 0 THEN 'changed' ELSE value END), 0,
    CASE WHEN event_id % 103 = 0 THEN 2 WHEN event_id % 97 = 0 THEN 0 ELSE 1 END FROM cells)"""


@_query(f"""{_COMPARED}
SELECT row_key, qualifier, ts, digest, sum(l)::BIGINT AS left_cells, sum(r)::BIGINT AS right_cells
FROM both_sides GROUP BY ALL HAVING sum(l) <> sum(r)""")
def cell_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, repeated and changed cells, found from the top down."""
    return digests.cell_differences(*_changed_cells(spark, sf_dir), samples.RANGE_SIZE).drop("family")


@_query(f"""{_COMPARED}
SELECT lower(lpad(hex(CAST('0x' || row_key AS BIGINT) // 100 * 100), 16, '0')) AS range, sum(l)::BIGINT AS cells, sum(r)::BIGINT AS copied,
  NOT bool_or(wrong) AS equal
FROM (SELECT *, sum(l) OVER w <> sum(r) OVER w AS wrong FROM both_sides WINDOW w AS (PARTITION BY row_key, qualifier, ts, digest))
GROUP BY ALL""")
def range_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which ranges of a copy are equal, by their digests alone."""
    left, right = (digests.range_digests(cells, samples.RANGE_SIZE) for cells in _changed_cells(spark, sf_dir))
    right = right.select("range", F.col("cells").alias("copied"), F.col("digest").alias("copy"))
    return left.join(right, "range").select("range", "cells", "copied", (F.col("digest") == F.col("copy")).alias("equal"))


# Block transforms


@_query(
    _with(
        _LINES,
        select="""
SELECT slot, 'h' || slot AS blockhash, 'h' || (slot - 1) AS previous_blockhash, slot - 1 AS parent_slot,
  NULL::BIGINT AS num_partitions, block_time, slot AS block_height, idx AS index,
  CASE WHEN has_meta THEN err END AS err, CASE WHEN has_meta THEN fee END AS fee,
  CASE WHEN has_meta THEN quantity || ';' || l_linenumber END AS balances,
  CASE WHEN has_meta THEN 0 END AS loaded, supp AS pubkey, l_linenumber::BIGINT AS lamports,
  0::BIGINT AS post_balance, NULL::VARCHAR AS reward_type, NULL::INTEGER AS commission
FROM tx""",
    )
)
def normalise_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened to one row per transaction and its reward."""
    current = blocks.normalise_block(samples.legacy_blocks(spark, sf_dir))
    pairs = F.arrays_zip("transactions", "rewards")
    meta, reward = F.col("pair.transactions.meta"), F.col("pair.rewards")
    loaded = F.size(meta["loaded_addresses"]["writable"]) + F.size(meta["loaded_addresses"]["readonly"])
    return current.select("*", F.posexplode(pairs).alias("index", "pair")).select(
        "slot",
        "blockhash",
        "previous_blockhash",
        "parent_slot",
        F.col("num_partitions").cast("bigint").alias("num_partitions"),
        "block_time",
        F.col("block_height").cast("bigint").alias("block_height"),
        F.col("index").cast("bigint").alias("index"),
        meta["err"].alias("err"),
        meta["fee"].cast("bigint").alias("fee"),
        F.when(
            meta["pre_balances"] == meta["post_balances"],
            F.array_join(meta["pre_balances"].cast("array<string>"), ";"),
        ).alias("balances"),
        F.when(meta.isNotNull(), loaded).alias("loaded"),
        reward["pubkey"].alias("pubkey"),
        reward["lamports"].alias("lamports"),
        reward["post_balance"].cast("bigint").alias("post_balance"),
        reward["reward_type"].alias("reward_type"),
        reward["commission"].alias("commission"),
    )


@_query(
    _with(
        _LINES,
        select="SELECT slot, idx AS index, CASE WHEN has_meta THEN 'complete' ELSE 'missing' END AS completeness FROM tx",
    )
)
def tx_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = blocks.tx_completeness(samples.blocks(spark, sf_dir))
    return states.withColumn("index", F.col("index").cast("bigint"))


@_query(_with(_LINES, select="SELECT slot, count(*) AS transactions FROM complete GROUP BY slot"))
def complete_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = blocks.complete_blocks(samples.blocks(spark, sf_dir))
    return kept.select("slot", F.size("transactions").cast("bigint").alias("transactions"))


@_query(_with(_LINES, select="SELECT slot, count(*) AS missing FROM tx WHERE NOT has_meta GROUP BY slot"))
def incomplete_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    left_out = blocks.incomplete_blocks(samples.blocks(spark, sf_dir))
    return left_out.withColumn("missing", F.col("missing").cast("bigint"))


@_query(
    _with(
        _LINES,
        select="SELECT slot, idx AS index, 'sig' || slot || '-' || idx AS signature, memo, block_time FROM tx",
    )
)
def explode_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = blocks.explode_transactions(samples.blocks(spark, sf_dir))
    return exploded.select("slot", "index", "signature", "memo", "block_time")


@_query(_with(_LINES, select="SELECT slot, idx AS index, err, err IS NULL AS succeeded FROM complete"))
def tx_status_err(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = blocks.explode_transactions(blocks.complete_blocks(samples.blocks(spark, sf_dir)))
    return exploded.select("slot", "index", "err", F.col("err").isNull().alias("succeeded"))


@_query(
    _with(
        _LINES,
        select="SELECT 'sig' || slot || '-' || idx AS row_key, slot, idx AS index, err, memo FROM complete",
    )
)
def tx_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.tx_table(samples.blocks(spark, sf_dir))


@_query(_with(_LINES, select="SELECT slot, idx AS index, address FROM accounts"))
def explode_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = blocks.explode_transactions(blocks.complete_blocks(samples.blocks(spark, sf_dir)))
    return blocks.explode_accounts(exploded).select("slot", "index", "address")


@_query(_with(_LINES, select="SELECT slot, idx AS index, address FROM kept"))
def drop_reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = blocks.explode_transactions(blocks.complete_blocks(samples.blocks(spark, sf_dir)))
    kept = blocks.drop_reserved(blocks.explode_accounts(exploded), samples.reserved(spark, sf_dir))
    return kept.select("slot", "index", "address")


@_query(_with(_LINES, select="SELECT row_key, address, slot, entries FROM by_addr"))
def tx_by_addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = blocks.tx_by_addr(samples.blocks(spark, sf_dir), samples.reserved(spark, sf_dir))
    return lists.select("row_key", "address", "slot", _entries_text())


@_query(
    _with(
        _LINES,
        select="""
SELECT row_key, address, slot, entries, row_number() OVER (PARTITION BY address ORDER BY slot DESC) AS place
FROM by_addr WHERE address LIKE 'p%' AND CAST(substr(address, 2) AS BIGINT) % 20 = 0 QUALIFY place <= 6""",
    )
)
def address_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest lists of every twentieth part, in two pages of three; the lists came in two commits."""
    lists, path = stage(blocks.tx_by_addr(samples.blocks(spark, sf_dir), samples.reserved(spark, sf_dir)), "lists"), scratch_path(spark, "tx-by-addr")
    for number in range(2):
        tables.put(lists.where(F.col("slot") % 4 % 2 == number), path, "job", number, indexed=True)
    parts = samples.table(spark, sf_dir, "lineitem").where(F.col("l_partkey") % 20 == 0)
    wanted = parts.select(F.concat(F.lit("p"), "l_partkey").alias("address"), F.lit(None).cast("string").alias("after")).distinct()
    first = stage(serving.address_history(spark, path, wanted, 3), "page")
    second = serving.address_history(spark, path, serving.next_page(first, 3), 3).withColumn("place", F.col("place") + 3)
    return first.union(second).select("row_key", "address", "slot", _entries_text(), F.col("place").cast("bigint").alias("place"))


# Payload codecs


@_query(
    """
SELECT doc_id, octet_length(encode(text)) AS bytes, sha256(text) AS digest, false AS failed FROM documents
UNION ALL SELECT -1 - doc_id, NULL, NULL, true FROM documents"""
)
def decode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document, and a value beside it that names no codec or ends before its tag does."""
    documents = samples.documents(spark, sf_dir)
    encoded = payloads.encode_payloads(documents).drop("codec")
    wrong = F.when(F.col("doc_id") % 2 == 0, F.unhex(F.lit("09000000AB"))).otherwise(F.unhex(F.lit("0000")))
    broken = documents.select((-1 - F.col("doc_id")).alias("doc_id"), wrong.alias("value"))
    decoded = payloads.decode_payloads(encoded.union(broken))
    return decoded.select(
        "doc_id", F.octet_length("payload").cast("bigint").alias("bytes"), F.sha2("payload", 256).alias("digest"),
        F.col("error").isNotNull().alias("failed"),
    )


@_query(
    """
SELECT doc_id, octet_length(encode(text)) < 128 AS short, true AS tagged, true AS no_larger FROM documents"""
)
def encode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of every encoding: short values stay plain, the tag names the codec, none grows."""
    named = samples.documents(spark, sf_dir).withColumn("bytes", F.octet_length("value"))
    encoded = payloads.encode_payloads(named)
    short = F.col("bytes") < 128
    codecs = F.array(*[F.lit(name) for name in payloads.CODECS])
    tag = F.conv(F.hex(F.reverse(F.substring("value", 1, 1))), 16, 10).cast("int")
    return encoded.select(
        "doc_id",
        short.alias("short"),
        ((F.get(codecs, tag) == F.col("codec")) & (~short | (F.col("codec") == "none"))).alias("tagged"),
        (F.octet_length("value") <= F.col("bytes") + 4).alias("no_larger"),
    )


@_query(
    """
SELECT octet_length(encode(text)) < 128 AS short, count(*) AS rows, sum(octet_length(encode(text)))::BIGINT AS bytes_in,
  CASE WHEN octet_length(encode(text)) < 128 THEN 4 * count(*) END AS added, true AS bounded
FROM documents GROUP BY octet_length(encode(text)) < 128"""
)
def codec_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of short values, which stay plain and grow by the tag, and of the others, which grow no more."""
    docs = samples.documents(spark, sf_dir)
    parts = []
    for short in (True, False):
        report = payloads.codec_report(docs.where((F.octet_length("value") < 128) == short))
        total = report.groupBy(F.lit(short).alias("short")).agg(
            F.sum("rows").alias("rows"), F.sum("bytes_in").alias("bytes_in"), F.sum("bytes_out").alias("bytes_out")
        )
        added = F.col("bytes_out") - F.col("bytes_in")
        parts.append(
            total.select(
                "short", "rows", "bytes_in", F.when(F.col("short"), added).alias("added"),
                (added <= 4 * F.col("rows")).alias("bounded"),
            )
        )
    return parts[0].union(parts[1])


@_query("SELECT count(*) AS rows, sum(octet_length(encode(text)))::BIGINT AS bytes_in FROM documents")
def codec_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report adds up to the whole input; which codec wins depends on library versions."""
    report = payloads.codec_report(samples.documents(spark, sf_dir))
    return report.agg(F.sum("rows").alias("rows"), F.sum("bytes_in").alias("bytes_in"))
