"""Sharding by extendible hashing: only shards over the byte limit split on a further hash bit."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from blockloom.session import stage

#: Bits of a key's hash; rows that agree in all of them cannot be parted.
HASH_BITS = 60
#: The directory is first made this many bits deeper than the mean shard needs, then deepened where that is too little.
MARGIN = 4


def key_bits(key: Column) -> Column:
    """The first 60 bits of the key's MD5 as a number; null keys share one value."""
    digest = F.md5(F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(hash_bits: Column, depth: Column) -> Column:
    """The first ``depth`` bits."""
    return F.call_function("shiftright", hash_bits, (HASH_BITS - depth).cast("int"))


def directory(sized: DataFrame, limit: int) -> DataFrame:
    """The shards of rows (hash_bits, n_bytes): rows (depth, prefix, shard_bytes, shard_rows, oversized).

    A shard is a hash prefix that fits the limit while the prefix one bit shorter does not. The rows are summed per
    deep prefix once, with partial sums, and all shorter prefixes are summed from these sums. Prefixes that are over
    the limit at that depth go on from there, so skewed hashes deepen the directory only where they lie. A prefix of
    all bits that is still over the limit (one row, or equal keys) is a shard by itself, marked ``oversized``.
    """
    total = sized.agg(F.sum("n_bytes")).first()[0] or 0
    step = max(1, math.ceil(math.log2(max(1, total / limit)))) + MARGIN
    shards, base, live = None, 0, sized
    while True:
        deep = min(HASH_BITS, base + step)
        summed = live.groupBy(_prefix(F.col("hash_bits"), F.lit(deep)).alias("bits")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows")
        )
        summed = stage(summed, "prefixes")
        levels = summed.select("*", F.explode(F.sequence(F.lit(base), F.lit(deep))).alias("depth")).groupBy(
            "depth", F.expr(f"shiftright(bits, {deep} - depth)").alias("prefix")
        ).agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n_rows").alias("shard_rows"))
        levels = stage(levels, "levels")
        over = levels.where(F.col("shard_bytes") > limit)
        parents = over.select((F.col("depth") + 1).alias("depth"), F.shiftleft("prefix", 1).alias("parent"))
        fits = levels.where(F.col("shard_bytes") <= limit)
        # A prefix that fits is a shard if its parent is over the limit, or if it is the whole table.
        below = fits.withColumn("parent", F.shiftleft(F.expr("shiftright(prefix, 1)"), 1)).join(
            parents, ["depth", "parent"], "left_semi"
        )
        found = below.select("depth", "prefix", "shard_bytes", "shard_rows")
        if base == 0:
            found = found.union(fits.where("depth = 0").select(*found.columns))
        found = found.withColumn("oversized", F.lit(False))
        left = over.where(F.col("depth") == deep)
        if deep == HASH_BITS:
            last = left.select("depth", "prefix", "shard_bytes", "shard_rows", F.lit(True).alias("oversized"))
            found = found.union(last)
        shards = found if shards is None else shards.union(found)
        if deep == HASH_BITS or left.isEmpty():
            return stage(shards, "directory")
        live = live.withColumn("prefix", _prefix(F.col("hash_bits"), F.lit(deep))).join(
            left.select("prefix"), "prefix", "left_semi"
        ).drop("prefix")
        base = deep


def shard_rows(
    docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row's shard, as (id_col, n_bytes, shard, depth, shard_bytes, shard_rows, oversized).

    ``shard`` is the hash prefix as bits, empty for the only shard of a small table. Bytes are those of the text in
    UTF-8, none for a null text. Rows of equal keys, null ones too, share a shard. An empty table has no shards.
    Texts are measured where they are read and are not shuffled.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col), size.alias("n_bytes"), key_bits(F.col(id_col)).alias("hash_bits"))
    sized = stage(sized, "sized")
    shards = directory(sized.select("hash_bits", "n_bytes"), limit)
    return place(sized, shards).select(
        id_col, "n_bytes", "shard", "depth", "shard_bytes", "shard_rows", "oversized"
    )


def place(sized: DataFrame, shards: DataFrame) -> DataFrame:
    """Join rows with a ``hash_bits`` column to their shards. Depths are few, and rows try each of them."""
    depths = [r[0] for r in shards.select("depth").distinct().collect()]
    if not depths:
        return sized.join(shards, F.lit(False), "left").withColumn("shard", F.lit(None).cast("string")).limit(0)
    tried = sized.withColumn("depth", F.explode(F.array(*(F.lit(d) for d in sorted(depths)))))
    tried = tried.withColumn("prefix", F.expr(f"shiftright(hash_bits, {HASH_BITS} - depth)"))
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("right(lpad(bin(prefix), 64, '0'), depth)"))
    return tried.join(shards, ["depth", "prefix"]).withColumn("shard", bits)


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write each row of ``docs`` into the folder of its shard below ``path`` and return the directory.

    Rows are dealt out by shard; a shard is at most ``limit`` bytes of text, so no task grows with the data.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    keyed = docs.withColumns({"__bits": key_bits(F.col(id_col)), "__bytes": size})
    sized = keyed.select(F.col("__bits").alias("hash_bits"), F.col("__bytes").alias("n_bytes"))
    shards = directory(sized, limit)
    placed = place(keyed.withColumnRenamed("__bits", "hash_bits"), shards.select("depth", "prefix"))
    placed = placed.select(*docs.columns, F.concat(F.lit("b"), "shard").alias("__shard"))
    placed.repartition("__shard").write.partitionBy("__shard").parquet(path)
    return shards
