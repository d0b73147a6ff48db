"""Reads of the serving tables that a load with ``indexed=True`` has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from blockloom.model import ADDRESS_TABLE, RAW_TABLE, TX_ORDER, TX_TABLE
from blockloom.sources import tables


def transactions(spark: SparkSession, out: str, signatures: DataFrame) -> DataFrame:
    """Look-up rows of the given transactions (``row_key``). Only files that may hold one are opened."""
    return tables.read_keys(spark, f"{out}/tx", TX_TABLE, signatures, TX_ORDER)


def raw_blocks(spark: SparkSession, out: str, block_keys: DataFrame) -> DataFrame:
    """Stored payloads of the given blocks (``row_key``)."""
    return tables.read_keys(spark, f"{out}/blocks", RAW_TABLE, block_keys)


def address_history(spark: SparkSession, table: str, addresses: DataFrame, k: int) -> DataFrame:
    """The newest ``k`` lists of each address, newest first, with their ``place`` from 1.

    The keys of an address ascend as its slots descend, so this is a scan from the front that ends at the k-th key:
    files of older slots are not opened. ``addresses`` has (address, after); ``after`` is null for the newest, or the
    last key of the page before (``next_page``).
    """
    wanted = addresses.select(F.col("address").alias("prefix"), "after")
    return tables.scan_prefixes(spark, table, ADDRESS_TABLE, wanted, k)


def next_page(page: DataFrame, k: int) -> DataFrame:
    """Where the next page of each address begins: (address, after). Addresses whose page was not full have none."""
    return page.where(F.col("place") == k).select("address", F.col("row_key").alias("after"))
