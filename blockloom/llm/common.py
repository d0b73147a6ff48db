"""Helpers shared by the operators: held-out rows, grouped batches, block pairs, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from blockloom.session import stage

#: Words end at these characters and nowhere else.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(key: str) -> Column:
    """Rows that no model learns from: crc32 of the key as text leaves 2 when divided by 4. Null keys: false."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def may_learn(key: str) -> Column:
    """Rows that a model may learn from. Null keys: false."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 != 2, F.lit(False))


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Cut a partition that is sorted by the keys into its groups; one group is held at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        names = [rows.column(k).to_pylist() for k in keys]
        start = 0
        for at, key in enumerate(zip(*names, strict=True)):
            if key != last:
                if at > start:
                    held.append(rows.slice(start, at - start))
                if held:
                    yield pa.concat_tables(held).combine_chunks()
                held, start, last = [], at, key
        held.append(rows.slice(start))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def block_pairs(rows: DataFrame, keys: Sequence[str], member: str, limit: int) -> DataFrame:
    """Deal groups of rows out so that any two rows of a group meet in a task, and no task holds a large group.

    A group of n rows has ceil(n / limit) blocks, and each pair of blocks (``low`` <= ``high``) is a unit of work;
    ``block`` is the row's own. Groups of one row are left out. A row is repeated once for each block of its group.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    sizes = sizes.select(*keys, F.ceil(F.col("group_rows") / limit).cast("int").alias("blocks"))
    dealt = rows.join(sizes, list(keys)).withColumn(
        "block", F.pmod(F.xxhash64(F.col(member)), F.col("blocks")).cast("int")
    )
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        "*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    ).drop("other", "blocks")


def in_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key side by side in one partition, for ``groups``."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component) per node, component the smallest node.

    Alternates two steps until nothing changes. Large star: each node hands its larger neighbours to the smallest
    node it knows. Small star: each node hands its smaller neighbours to the smallest. Both are an aggregation with
    partial minima and a join, so a node of very many neighbours is combined before the shuffle. The minima are
    written before the join, as Spark splits a hot node only where both sides come from a plain shuffle. Every step is
    a table in the shared folder. Loops and repeated edges do no harm; no edges, no rows.
    """
    spark = edges.sparkSession
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, f"{label}-edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        smallest = stage(smallest, f"{label}-minima")
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), f"{label}-large")
        smallest = stage(large.groupBy("a").agg(F.min("b").alias("m")), f"{label}-minima")
        handed = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
        small = large.join(smallest, "a").select(handed.alias("a"), F.col("m").alias("b"))
        edges = stage(small.where("a <> b").distinct(), f"{label}-small")
        # A star forest keeps its edges; their number and sums tell whether the step changed any.
        after = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")
        ).first()
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def arrow_schema(ddl: str) -> pa.Schema:
    """A schema for ``table_of``; DDL is read on the driver only."""
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def table_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of plain columns: Arrow, numpy or lists."""
    arrays = []
    for column, field in zip(columns, schema, strict=True):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column if isinstance(column, pa.Array) else pa.array(column, field.type)
        arrays.append(column if column.type == field.type else column.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int) -> Iterator[pa.Table]:
    """Cut a partition that is sorted by the keys into tables of whole groups, of so many rows or more if there are."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size < rows:
            continue
        both = pa.Table.from_batches(held).combine_chunks()
        columns = [both.column(k) for k in keys]
        last, cut = [c[-1].as_py() for c in columns], both.num_rows - 1
        while cut and [c[cut - 1].as_py() for c in columns] == last:
            cut -= 1
        if cut:
            yield both.slice(0, cut).combine_chunks()
        held, size = both.slice(cut).combine_chunks().to_batches(), both.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
