"""Key/value cells: building them from files, picking one per row, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from blockloom.functions import keys
from blockloom.model import CELL_FAMILY, QUALIFIER_PROTO, SOURCE_TABLES

CELL_ORDER = ("family", "qualifier", "-ts")


def file_to_cell(files: DataFrame) -> DataFrame:
    """One cell per file (``path``, ``modificationTime``, ``content``), with its path kept for routing.

    The file's own time is the cell time, so reading a file again gives the same cell.
    """
    return files.select(
        "path",
        keys.file_stem(F.col("path")).alias("row_key"),
        F.lit(CELL_FAMILY).alias("family"),
        F.lit(QUALIFIER_PROTO).alias("qualifier"),
        F.unix_millis("modificationTime").alias("ts"),
        F.col("content").alias("value"),
    )


def with_folder(cells: DataFrame) -> DataFrame:
    return cells.withColumn("table_name", keys.parent_folder(F.col("path")))


def route_cells(cells: DataFrame) -> DataFrame:
    """Cells whose parent folder is a source table, with that ``table_name``."""
    return with_folder(cells).where(F.col("table_name").isin(*SOURCE_TABLES))


def rejected_cells(cells: DataFrame) -> DataFrame:
    """Cells below any other folder."""
    known = F.coalesce(F.col("table_name").isin(*SOURCE_TABLES), F.lit(False))
    return with_folder(cells).where(~known)


def _order(names: tuple[str, ...]) -> list[Column]:
    return [-F.col(name[1:]) if name.startswith("-") else F.col(name) for name in names]


def first_cell(cells: DataFrame, by: tuple[str, ...] = ("row_key",)) -> DataFrame:
    """The first cell of each row: lowest family and qualifier, then the newest.

    One struct minimum carries the value once and shrinks a hot row before the shuffle.
    """
    order = [c.alias(f"o{i}") for i, c in enumerate(_order(CELL_ORDER))]
    first = F.min(F.struct(*order, "value"))
    return cells.groupBy(*by).agg(first.alias("cell")).select(
        *by,
        F.col("cell.o1").alias("qualifier"),
        (-F.col("cell.o2")).alias("ts"),
        F.col("cell.value").alias("value"),
    )


def with_format(cells: DataFrame) -> DataFrame:
    """Add ``format``; it is null for qualifiers of neither layout."""
    return cells.withColumn("format", keys.payload_format(F.col("qualifier")))


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the values of each run of equal keys, keeping only the running hash.

    The values of a run lie next to each other in the batch, so a run is one update.
    """
    current, digest = None, hashlib.sha256()
    for batch in batches:
        row_keys, values = batch.column(0), batch.column(1).cast(pa.large_binary())
        if not len(row_keys):
            continue
        _, offsets, data = values.buffers()
        offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
        data = memoryview(data) if data is not None else memoryview(b"")
        changes = pc.not_equal(row_keys[1:], row_keys[:-1]).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(row_keys)]
        finished = []
        for start, stop in zip(starts, starts[1:]):
            row_key = row_keys[start].as_py()
            if row_key != current:
                if current is not None:
                    finished.append((current, digest.hexdigest()))
                current, digest = row_key, hashlib.sha256()
            digest.update(data[offsets[start] : offsets[stop]])
        if finished:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*finished)], ["row_key", "digest"])
    if current is not None:
        yield pa.RecordBatch.from_pydict({"row_key": [current], "digest": [digest.hexdigest()]})


def row_digest(cells: DataFrame, order: tuple[str, ...] = CELL_ORDER) -> DataFrame:
    """Lower-hex SHA-256 over a row's values in cell order.

    Cells are clustered and sorted by Spark and streamed through the hash, so a row with very many
    cells spills to disk instead of being gathered in memory.
    """
    sort = [c.alias(f"o{i}") for i, c in enumerate(_order(order))]
    ordered = (
        cells.select("row_key", "value", *sort)
        .repartition("row_key")
        .sortWithinPartitions("row_key", *[f"o{i}" for i in range(len(sort))], "value")
    )
    return ordered.select("row_key", "value").mapInArrow(_digest_runs, "row_key string, digest string")


def cell_digest(cells: DataFrame) -> DataFrame:
    """``row_digest`` for rows of exactly one cell: no shuffle and no Python."""
    return cells.select("row_key", F.sha2("value", 256).alias("digest"))


def digest_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row keys whose digest is missing or different on one side."""
    both = left.withColumnRenamed("digest", "left_digest").join(
        right.withColumnRenamed("digest", "right_digest"), "row_key", "full"
    )
    return both.where(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
