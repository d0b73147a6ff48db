"""Append-only ledgers of finished ranges and loaded files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from blockloom.model import FILE_LEDGER, RANGE_LEDGER
from blockloom.sources.tables import read_or_empty


def mark_ranges(ranges: DataFrame, path: str, sync_type: str, table: str, size: int, status: str) -> None:
    """Append one record per range. ``size`` explains why ranges of another size never match.

    Every append has a folder of its own, so jobs that append at once do not meet.
    """
    ranges.select(
        F.lit(sync_type).alias("sync_type"),
        F.lit(table).alias("table_name"),
        "start_key",
        "end_key",
        F.lit(size).cast("bigint").alias("size"),
        F.lit(status).alias("status"),
    ).write.parquet(f"{path.rstrip('/')}/mark={uuid.uuid4().hex}")


def read_range_ledger(spark: SparkSession, path: str, sync_type: str, table: str) -> DataFrame:
    """Records of one table. A ledger that cannot be read is an error, a missing one is empty."""
    records = read_or_empty(spark, path, RANGE_LEDGER).select(*RANGE_LEDGER.fieldNames()).where(
        (F.col("sync_type") == sync_type) & (F.col("table_name") == table)
    )
    return records.dropDuplicates(["start_key", "end_key", "status"])


def mark_files(files: DataFrame, path: str) -> None:
    """Append one record per loaded file."""
    files.select("path", F.current_timestamp().alias("done_at")).write.mode("append").parquet(path)


def read_file_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, FILE_LEDGER)
