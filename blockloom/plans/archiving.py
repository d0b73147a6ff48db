"""Archive job: plan ranges, skip the finished ones, copy the rest, record the outcome."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blockloom.functions import keys
from blockloom.model import ARCHIVE, CELL, STATUS_DONE, STATUS_FAILED
from blockloom.operators import ranges
from blockloom.session import stage
from blockloom.sources import archive, claims as claiming, ledgers, tables


def to_archive(cells: DataFrame, sync_type: str, table: str, size: int, commit_id: int = 0) -> DataFrame:
    """Cells with their archive partition columns. Keys that are not the key of a slot, as it is written, have no
    range and are left out; ``unplaced_cells`` returns them."""
    # A column of its own, so that Spark reads the key once and not for each of the bounds.
    placed = cells.where(is_placed()).withColumn("slot", keys.key_to_slot(F.col("row_key")))
    placed = ranges.with_range(placed, F.col("slot"), size)
    return placed.select(
        *[name for name in ARCHIVE.fieldNames() if name in cells.columns],
        F.lit(sync_type).alias("sync_type"),
        F.lit(table).alias("table_name"),
        "range",
        F.lit(commit_id).cast("bigint").alias("commit_id"),
        "start_key",
        "end_key",
    )


def is_placed() -> Column:
    """Whether a key is that of a slot in 16 lower-case digits: only for these is text order slot order."""
    return F.coalesce(keys.is_slot_key(F.col("row_key")), F.lit(False))


def unplaced_cells(cells: DataFrame) -> DataFrame:
    """Cells that no range takes: null keys, bad ones, and slots that are spelt in another way."""
    return cells.where(~is_placed())


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """Cells that archive jobs set aside, each once, though every run over a source meets them."""
    return tables.read_or_empty(spark, rejects, CELL).select(*CELL.fieldNames()).distinct()


def _bounds_if_whole(wave: DataFrame, size: int) -> tuple[str, str] | None:
    """First and last key of ranges that leave no gap between them; None where some are missing, or there are none."""
    plain = keys.is_slot_key(F.col("start_key")) & keys.is_slot_key(F.col("end_key"))
    found = wave.agg(F.min("start_key"), F.max("end_key"), F.count_distinct("start_key"), F.min(plain)).first()
    first, last, count, all_plain = found
    return (first, last) if all_plain and int(last, 16) - int(first, 16) + 1 == count * size else None


def _check_plan(planned: DataFrame, size: int) -> None:
    """Every planned range has to be one that cells of this size are put into."""
    lo, hi = keys.key_to_slot(F.col("start_key")), keys.key_to_slot(F.col("end_key"))
    fits = (hi - lo == size - 1) & (lo % size == 0)
    wrong = planned.where(~F.coalesce(fits, F.lit(False))).first()
    if wrong is not None:
        raise ValueError(f"{wrong['start_key']} to {wrong['end_key']} is no range of {size} slots")


def archive_ranges(
    spark: SparkSession,
    cells: DataFrame,
    planned: DataFrame,
    size: int,
    root: str,
    ledger_path: str,
    sync_type: str,
    table: str,
    in_key_order: bool = False,
    waves: int = 1,
    rejects: str | None = None,
    claims: str | None = None,
    lease: float = 3600,
) -> int:
    """Copy the planned ranges (``start_key``, ``end_key``) that are not finished to the archive.

    The ranges are archived in so many ``waves``, each a stretch of the key space that is written and recorded by
    itself: as done only after its write has committed, or as failed, which leaves it pending for the next run. A
    failed wave does not keep the others from being archived; its error is raised in the end.

    Cells whose keys are not written as slots are belong to no range. They are written to ``rejects``, in a folder of
    the planned bounds, which a repeated run replaces, and counted; the count is returned. Without ``rejects`` any such
    cell is an error, before anything is archived. Looking for them reads the keys alone.

    Several jobs may share a plan by a folder for ``claims``: each wave, and setting the bad cells aside, is then done
    by the job that claims it, for ``lease`` seconds. A job leaves out what others hold (``archive_shared`` waits for
    it), and takes over what a dead one held. One that was late and lost its claim does not record the wave.
    """
    archive.check_table(table)
    archive.check_sync_type(sync_type)
    ledger = ledgers.read_range_ledger(spark, ledger_path, sync_type, table)
    # Fixed before the ledger grows; it holds one short row per range.
    pending = stage(ranges.pending_ranges(planned, ledger), "pending-ranges")
    first, last = pending.agg(F.min("start_key"), F.max("end_key")).first()
    if first is None:
        return 0
    _check_plan(pending, size)
    unplaced = unplaced_cells(cells)
    # In one pass, of which a task ends at its first: taking a row goes through a clean source by a few tasks at a time.
    one = unplaced.select("row_key").limit(1).agg(F.first("row_key"), F.count(F.lit(1)).alias("rows"))
    bad = one.where("rows > 0").first()
    if bad is not None and rejects is None:
        raise ValueError(f"{bad[0]!r} is no slot's key; give a folder for such cells")
    bounds = planned.agg(F.min("start_key"), F.max("end_key")).first()
    place = f"sync_type={sync_type}/table_name={table}"

    def taken(piece: str) -> tuple[bool, claiming.Claim | None]:
        claim = claiming.take(spark, claims, f"{place}/{piece}", lease) if claims else None
        return claims is None or claim is not None, claim

    lost = 0
    if rejects is not None and taken(f"rejects_{bounds[0]}_{bounds[1]}")[0]:
        folder = f"{rejects.rstrip('/')}/{place}/planned={bounds[0]}_{bounds[1]}"
        set_aside = unplaced if bad is not None else spark.createDataFrame([], cells.schema)
        set_aside.write.mode("overwrite").parquet(folder)
        lost = 0 if bad is None else spark.read.schema(cells.schema).parquet(folder).count()
    # Jobs that share a plan cut it alike, whatever is pending.
    low, high = (int(k, 16) for k in (bounds if claims else (first, last)))
    step = -(-(high - low + 1) // (size * waves)) * size
    failed: Exception | None = None
    for start in range(low, high + 1, step):
        keys_of_wave = f"{start:016x}", f"{start + step - 1:016x}"
        wave = pending.where(F.col("start_key").between(*keys_of_wave))
        if claims and wave.isEmpty():
            continue
        mine, claim = taken("_".join(keys_of_wave))
        if not mine:
            continue
        if claim:  # others may have done it since
            known = ledgers.read_range_ledger(spark, ledger_path, sync_type, table)
            wave = stage(ranges.pending_ranges(wave, known), "claimed-ranges")
            if wave.isEmpty():
                claiming.give_back(spark, claim)
                continue
        whole = _bounds_if_whole(wave, size)
        chosen = to_archive(archive.read_key_range(cells, *(whole or keys_of_wave)), sync_type, table, size)
        if whole is None:  # else the bounds tell: a plan of many ranges need not be sent to the cells, or these to it
            chosen = chosen.join(wave, ["start_key", "end_key"], "left_semi")
        status = STATUS_DONE
        try:
            write = archive.write_archive_beside if claims else archive.write_archive
            write(chosen, root, in_key_order)
        except Exception as error:
            status, failed = STATUS_FAILED, failed or error
        if claim is None or claiming.is_held(spark, claim):
            ledgers.mark_ranges(wave, ledger_path, sync_type, table, size, status)
            if claim and status == STATUS_FAILED:
                claiming.give_back(spark, claim)
    if failed is not None:
        raise failed
    return lost


def archive_shared(
    spark: SparkSession, cells: DataFrame, planned: DataFrame, size: int, root: str, ledger_path: str, sync_type: str,
    table: str, claims: str, poll: float = 5, **options,
) -> None:
    """Work on a plan beside other jobs until all of it is done; see ``archive_ranges``.

    A job that dies leaves its claims to run out; the others wait for that and do its waves.
    """
    while True:
        archive_ranges(spark, cells, planned, size, root, ledger_path, sync_type, table, claims=claims, **options)
        known = ledgers.read_range_ledger(spark, ledger_path, sync_type, table)
        if ranges.pending_ranges(planned, known).isEmpty():
            return
        time.sleep(poll)


def archive_key_range(spark: SparkSession, cells: DataFrame, start: int, end: int, size: int, *args, **options) -> int:
    """``archive_ranges`` for every range of ``size`` slots between ``start`` and ``end``."""
    return archive_ranges(spark, cells, ranges.split_key_range(spark, start, end, size), size, *args, **options)
