"""Range planning, ledger differences and selection of archive files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blockloom.functions import keys
from blockloom.model import STATUS_DONE, STATUS_FAILED, STATUS_PENDING


#: Ranges that one row of a plan's first step stands for.
RANGES_PER_STEP = 10_000


def _check(start: int, end: int, size: int) -> None:
    if size < 1:
        raise ValueError(f"size must be positive, not {size}")
    if start < 0 or end < start:
        raise ValueError(f"no key range from {start} to {end}")


def bucket_of(slot: Column, size: int) -> Column:
    """Whole-number division; ``/`` would go through DOUBLE and lose large slots."""
    return F.call_function("div", slot, F.lit(size).cast("bigint"))


def range_start(slot: Column, size: int) -> Column:
    """First slot of the range that owns ``slot``."""
    return bucket_of(slot, size) * F.lit(size).cast("bigint")


def _bounds(start: Column, size: int) -> list[Column]:
    return [
        keys.slot_to_key(start).alias("start_key"),
        keys.slot_to_key(start + F.lit(size - 1).cast("bigint")).alias("end_key"),
    ]


def split_key_range(spark: SparkSession, start: int, end: int, size: int) -> DataFrame:
    """Ranges of ``size`` slots that cover ``start`` to ``end``.

    The first starts at a multiple of ``size``; the last may reach past ``end``, which keeps
    the names of ranges the same from run to run.
    """
    _check(start, end, size)
    first = start // size * size
    # A plan is short: do not spread it over every core of a cluster.
    parts = 1 + (end - first) // size // 1_000_000
    return spark.range(first, end + 1, size, parts).select(*_bounds(F.col("id"), size))


def split_key_ranges(bounds: DataFrame, size: int, start: str = "start", end: str = "end") -> DataFrame:
    """``split_key_range`` for every row of ``bounds``; rows with ``end < start`` are an error."""
    if size < 1:
        raise ValueError(f"size must be positive, not {size}")
    lo, hi = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    step = F.lit(size).cast("bigint")
    valid = F.when((lo < 0) | (hi < lo), F.raise_error(F.lit("no key range"))).otherwise(range_start(lo, size))
    # In two steps of which neither makes a long array, so that one wide interval spreads over tasks.
    stride = F.lit(size * RANGES_PER_STEP).cast("bigint")
    steps = bounds.select(
        F.explode(F.sequence(valid, range_start(hi, size), stride)).alias("step"), range_start(hi, size).alias("last")
    ).hint("rebalance")
    end_of_step = F.least(F.col("last"), F.col("step") + (stride - step))
    first = F.explode(F.sequence(F.col("step"), end_of_step, step)).alias("first")
    return steps.select(first).select(*_bounds(F.col("first"), size))


def with_range(rows: DataFrame, slot: Column, size: int) -> DataFrame:
    """Add ``start_key``, ``end_key`` and ``range`` of the owning range by arithmetic, not by a join."""
    rows = rows.withColumns(
        {
            "start_key": keys.slot_to_key(range_start(slot, size)),
            "end_key": keys.slot_to_key(range_start(slot, size) + F.lit(size - 1).cast("bigint")),
        }
    )
    return rows.withColumn("range", keys.range_name(F.col("start_key"), F.col("end_key")))


def range_row_counts(rows: DataFrame, slot: Column, size: int) -> DataFrame:
    """Rows per owning range. Grouping by the number keeps hex text out of the shuffle."""
    counts = rows.groupBy(range_start(slot, size).alias("first")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(*_bounds(F.col("first"), size), "rows")


def pending_ranges(planned: DataFrame, ledger: DataFrame) -> DataFrame:
    """Planned ranges without a done record of the same bounds."""
    done = ledger.where(F.col("status") == STATUS_DONE).select("start_key", "end_key")
    return planned.join(done, ["start_key", "end_key"], "left_anti")


def range_status(planned: DataFrame, ledger: DataFrame) -> DataFrame:
    """``done``, ``failed`` or ``pending`` per planned range; done outranks failed."""
    rank = F.when(F.col("status") == STATUS_DONE, 2).when(F.col("status") == STATUS_FAILED, 1).otherwise(0)
    known = ledger.groupBy("start_key", "end_key").agg(F.max(rank).alias("rank"))
    status = (
        F.when(F.col("rank") == 2, STATUS_DONE).when(F.col("rank") == 1, STATUS_FAILED).otherwise(STATUS_PENDING)
    )
    return planned.join(known, ["start_key", "end_key"], "left").select(
        "start_key", "end_key", status.alias("status")
    )


def with_path_bounds(files: DataFrame) -> DataFrame:
    """Add ``start_key``, ``end_key``, ``lo``, ``hi``; paths without a range name are dropped."""
    path = F.col("path")
    named = files.withColumns({"start_key": keys.range_start_key(path), "end_key": keys.range_end_key(path)})
    named = named.where(F.col("start_key") != "")
    return named.withColumns(
        {"lo": keys.key_to_slot(F.col("start_key")), "hi": keys.key_to_slot(F.col("end_key"))}
    )


def parse_range_path(files: DataFrame) -> DataFrame:
    """Files whose range bounds are slots."""
    return with_path_bounds(files).where(F.col("lo").isNotNull() & F.col("hi").isNotNull())


def rejected_range_paths(files: DataFrame) -> DataFrame:
    """Files with a range name whose bounds do not fit a slot."""
    return with_path_bounds(files).where(F.col("lo").isNull() | F.col("hi").isNull())


def _overlap(lo: Column, hi: Column, start: Column, end: Column, inclusive: bool) -> Column:
    first, last = F.greatest(lo, start), F.least(hi, end)
    return first <= last if inclusive else first < last


def overlapping_files(files: DataFrame, start: int, end: int, inclusive: bool = False) -> DataFrame:
    """Files (``lo``, ``hi``) that overlap one request. Ranges that only touch count when ``inclusive``."""
    lo, hi = F.col("lo"), F.col("hi")
    return files.where(
        _overlap(lo, hi, F.lit(start).cast("bigint"), F.lit(end).cast("bigint"), inclusive)
    )


def _aligned_pieces(first: Column, last: Column) -> Column:
    """``first`` to ``last`` cut into disjoint pieces of 2^level slots that start at a multiple of it.

    There are at most two pieces per level, so a wide interval does not turn into many rows.
    """

    def pieces(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low = F.call_function("div", first, size) + F.when(first % size > 0, 1).otherwise(0)
        # The last whole piece, not the one after it, which the largest slot does not have.
        high = F.call_function("div", last, size) - F.when(last % size == size - 1, 0).otherwise(1)
        left = F.when((low <= high) & (low % 2 == 1), F.struct(level.alias("level"), low.alias("piece")))
        right = F.when((low <= high) & (high % 2 == 0), F.struct(level.alias("level"), high.alias("piece")))
        return F.filter(F.array(left, right), lambda piece: piece.isNotNull())

    widest = F.least(F.ceil(F.log2((last - first).cast("double") + 1)) + 1, F.lit(62)).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(0), widest), pieces))


def _points_in_intervals(points: DataFrame, point: str, intervals: DataFrame, first: Column, last: Column) -> DataFrame:
    """Pairs with ``first <= point <= last``, by an equality join on the one piece that holds the point."""
    cut = intervals.where(first <= last).withColumn("at", F.explode(_aligned_pieces(first, last)))
    cut = cut.withColumns({"level": F.col("at.level"), "piece": F.col("at.piece")}).drop("at")
    bounds = cut.groupBy("level").agg(F.min("piece").alias("low"), F.max("piece").alias("high"))
    levels = bounds.agg(F.collect_list(F.struct("level", "low", "high")).alias("levels"))  # one entry per level
    placed = (
        points.withColumn("levels", levels.scalar())
        .withColumn("bound", F.explode("levels"))
        .withColumn("level", F.col("bound.level"))
        .withColumn("piece", F.call_function("shiftright", F.col(point), F.col("level")))
        .where(F.col("piece").between(F.col("bound.low"), F.col("bound.high")))
        .drop("levels", "bound")
    )
    # Spark estimates a cut side as if it had not grown and would broadcast millions of pieces.
    return placed.join(cut.hint("merge"), ["level", "piece"]).drop("level", "piece")


def overlapping_files_of_requests(files: DataFrame, requests: DataFrame, inclusive: bool = False) -> DataFrame:
    """Pairs of file (``lo``, ``hi``) and request (``s``, ``e``) that overlap.

    Either the file starts inside the request or the request starts inside the file, never both, so
    the two equality joins find each pair once, form no other pair, and need no distinct.
    """
    lo, hi, start, end = F.col("lo"), F.col("hi"), F.col("s"), F.col("e")
    within = 0 if inclusive else 1
    real_files = files.where(lo <= hi - within)
    real_requests = requests.where(start <= end - within)
    from_file = _points_in_intervals(real_files, "lo", requests, start, end - within)
    from_request = _points_in_intervals(real_requests, "s", files, F.when(lo < hi, lo + 1), hi - within)
    columns = [*files.columns, *requests.columns]
    return from_file.select(*columns).unionByName(from_request.select(*columns))


def route_by_kind(files: DataFrame) -> DataFrame:
    """One row per file and source table named in its path; other files are skipped."""
    return files.withColumn("kind", F.explode(keys.kinds_of(F.col("path"))))


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose path has no record in the file ledger."""
    return files.join(ledger.select("path"), "path", "left_anti")
