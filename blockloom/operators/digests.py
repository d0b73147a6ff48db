"""Digests of cells that add up: of parts, of ranges, of whole tables; and comparison from the top down.

A cell's SHA-256 is read as eight whole numbers. Their sums over any set of cells, with the number of cells, stand for
the set: sums of parts add up to those of their range, equal sets have equal sums in whatever order they come, and a
repeated cell counts as often as it is there. So nothing is sorted, and a row of very many cells is summed where its
cells are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blockloom.functions import keys
from blockloom.operators import ranges
from blockloom.session import stage

IDENTITY = ("row_key", "family", "qualifier", "ts")

#: A range's cells are dealt into so many parts by what they are called, not by row, so that a hot row is cut too.
PARTS = 64

_SUMS = [f"s{k}" for k in range(8)]


def _field(column: Column) -> Column:
    """Bytes that tell a null from any value, and where a value ends."""
    value = column.cast("binary")
    return F.when(column.isNull(), F.lit(b"-")).otherwise(
        F.concat(F.octet_length(value).cast("string").cast("binary"), F.lit(b":"), value)
    )


def cell_hash() -> Column:
    """Lower-hex SHA-256 of a cell: key, family, qualifier, time and value."""
    return F.sha2(F.concat(*[_field(F.col(name).cast("string")) for name in IDENTITY], _field(F.col("value"))), 256)


def with_part(cells: DataFrame, size: int, parts: int = PARTS) -> DataFrame:
    """Cells with ``range``, the first key of their range of ``size`` slots, and ``part`` of it.

    Keys that are no slots are a range of their own, with the empty name.
    """
    first = keys.slot_to_key(ranges.range_start(keys.key_to_slot(F.col("row_key")), size))
    return cells.withColumns({"range": F.coalesce(first, F.lit("")), "part": F.pmod(F.xxhash64(*IDENTITY), F.lit(parts)).cast("int")})


def part_sums(cells: DataFrame, size: int, parts: int = PARTS) -> DataFrame:
    """(range, part, cells, s0 to s7): what the digests above are made of. Sums are combined before the shuffle."""
    hashed = with_part(cells, size, parts).withColumn("hash", cell_hash())
    pieces = [F.conv(F.substring("hash", 8 * k + 1, 8), 16, 10).cast("decimal(38,0)") for k in range(8)]
    sums = [F.sum(piece).alias(name) for piece, name in zip(pieces, _SUMS)]
    return hashed.groupBy("range", "part").agg(F.count(F.lit(1)).alias("cells"), *sums)


def digests(sums: DataFrame, *by: str) -> DataFrame:
    """Digests of ``part_sums`` by range and part, by range, or of all (no name): (by, cells, digest)."""
    added = sums.groupBy(*by).agg(F.sum("cells").cast("bigint").alias("cells"), *[F.sum(name).alias(name) for name in _SUMS])
    text = F.concat_ws(",", "cells", *[F.col(name).cast("string") for name in _SUMS])
    return added.select(*by, F.coalesce("cells", F.lit(0)).alias("cells"), F.sha2(text, 256).alias("digest"))


def range_digests(cells: DataFrame, size: int) -> DataFrame:
    """(range, cells, digest) of each range that has cells."""
    return digests(part_sums(cells, size), "range")


def _unequal(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
    names = [F.coalesce(left[name], right[name]).alias(name) for name in by]
    on = [left[name] == right[name] for name in by]
    both = left.join(right, on, "full").where(~left["digest"].eqNullSafe(right["digest"]))
    return both.select(*names)


def cell_differences(left: DataFrame, right: DataFrame, size: int, parts: int = PARTS) -> DataFrame:
    """Cells that two tables do not have equally often: (row_key, family, qualifier, ts, digest, left_cells, right_cells).

    ``digest`` is the value's SHA-256, null for a null value; a changed value is two rows. The tables are compared as a
    whole, then range by range, then part by part of unequal ranges, and only the cells of unequal parts are met with
    each other: equal tables cost one pass over each, and no join has more than the unequal parts.
    """
    sums = [stage(part_sums(cells, size, parts), "part-sums") for cells in (left, right)]
    whole = [digests(side).first()["digest"] for side in sums]
    if whole[0] == whole[1]:
        wrong = sums[0].select("range", "part").limit(0)
    else:
        spoilt = _unequal(*[digests(side, "range") for side in sums], "range")
        spoilt = stage(spoilt, "unequal-ranges")
        below = [digests(side.join(spoilt, "range", "left_semi"), "range", "part") for side in sums]
        wrong = stage(_unequal(*below, "range", "part"), "unequal-parts")
    met = None
    for cells, name in ((left, "left_cells"), (right, "right_cells")):
        chosen = with_part(cells, size, parts).join(wrong, ["range", "part"], "left_semi")
        rows = chosen.select(*IDENTITY, F.sha2("value", 256).alias("digest"), *[F.lit(int(name == n)).alias(n) for n in ("left_cells", "right_cells")])
        met = rows if met is None else met.union(rows)
    counted = met.groupBy(*IDENTITY, "digest").agg(*[F.sum(n).alias(n) for n in ("left_cells", "right_cells")])
    return counted.where("left_cells <> right_cells")
