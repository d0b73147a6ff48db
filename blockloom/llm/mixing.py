"""Mixing sources to target weights by hierarchical budgeting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from blockloom.llm.common import SPACE
from blockloom.session import stage

#: Documents in a slice of a leaf's order; a task sorts slices, never a leaf.
SLICE = 2000


def n_words(text_col: str = "text") -> Column:
    """Words of a whole text, the tokens that budgets are counted in; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), SPACE), "")).cast("long")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: DataFrame, total: Column | int, epochs: int) -> DataFrame:
    """Each leaf's share of ``total`` tokens: the leaves with a ``target`` column.

    ``leaves`` has the level columns and ``supply``; ``weights`` has a row (level, name, weight) for nodes whose
    weight is not 1, names being a node's path joined by '/'. A leaf can give ``epochs`` times its supply, an inner
    node what its leaves can give. From the root down, a node's budget is split among its children by weight; where a
    child cannot give its part, its siblings take the rest by weight, and only when all of them are full the node
    itself is short, which its own siblings have then already made up for. So shortages are filled by siblings before
    ancestors. A weight of 0 gives nothing. Parts are rounded down to whole tokens.

    Splitting sorts the children of a node by capacity over weight: those are full whose ratio is below the level
    reached by what is left for the weights that are left. The tables here have one row per node.
    """
    nodes = leaves.withColumns({"capacity": F.col("supply") * epochs, "path0": F.lit("")})
    for k, level in enumerate(levels, 1):
        before = F.col(f"path{k - 1}")
        nodes = nodes.withColumn(f"path{k}", F.concat(before, F.lit("/" if k > 1 else ""), F.col(level)))
    nodes = stage(nodes, "leaves")
    last = len(levels)
    split = nodes.agg(F.coalesce(F.sum("capacity"), F.lit(0)).alias("capacity")).select(
        F.lit("").alias("path0"), F.least(F.lit(total).cast("long"), "capacity").alias("target")
    )
    for k in range(1, last + 1):
        own = weights.where(F.col("level") == levels[k - 1]).select(F.col("name").alias(f"path{k}"), "weight")
        children = nodes.groupBy(f"path{k - 1}", f"path{k}").agg(F.sum("capacity").alias("capacity"))
        children = children.join(own, f"path{k}", "left").withColumn("weight", F.coalesce("weight", F.lit(1)))
        children = children.where("weight > 0").join(split.withColumnRenamed("target", "budget"), f"path{k - 1}")
        ratio = F.col("capacity") / F.col("weight")
        order = Window.partitionBy(f"path{k - 1}").orderBy(ratio, f"path{k}")
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        left = F.col("budget") - F.coalesce(F.sum("capacity").over(earlier), F.lit(0))
        # Once a child is not full, neither are those after it; the first of them fixes the level for all.
        children = children.withColumns({"left": left, "rest": F.sum("weight").over(later)})
        full = F.col("capacity") * F.col("rest") <= F.col("left") * F.col("weight")
        children = children.withColumn("full", full)
        whole = Window.partitionBy(f"path{k - 1}")
        first = F.min(F.when(~F.col("full"), F.struct(ratio, f"path{k}", "left", "rest"))).over(whole)
        children = children.withColumn("first", first)
        share = F.expr("CAST(CAST(first.left AS DECIMAL(38, 0)) * weight DIV first.rest AS BIGINT)")
        split = children.select(f"path{k}", F.when(F.col("full"), F.col("capacity")).otherwise(share).alias("target"))
    return nodes.join(split, f"path{last}", "left").select(
        *leaves.columns, F.coalesce("target", F.lit(0)).cast("long").alias("target")
    )


def order_key(key: Column, seed: int, epoch: Column) -> Column:
    """A row's place in a seeded epoch: an MD5, ordered as text."""
    parts = F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.md5(parts.cast("binary"))


def mix(
    docs: DataFrame, levels: Sequence[str], weights: DataFrame, share: float, epochs: int, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None, carry: Sequence[str] = (),
) -> DataFrame:
    """The documents of the mixture, as (id_col, carry, levels, epoch, n_tokens): one row for each time one is taken.

    ``carry`` names more columns of ``docs`` that rows keep, such as a row number where ids repeat.

    ``share`` is the wanted number of tokens as a part of all tokens; ``epochs`` bounds how often a document may be
    taken. Each leaf is read in seeded epochs: as many whole ones as its target holds, then of the next the longest
    prefix of documents, in that epoch's own order, that stays within the target. Ties in the order are broken by id.
    Null levels form the node 'none'; a null text has no tokens and is taken in the whole epochs it falls into, and in
    a prefix; repeated rows are taken each. An empty table gives an empty one.

    Only numbers are shuffled. The order of a leaf is cut into slices of about ``SLICE`` documents by the leading
    digits of the order key; sums of slices tell which slice the prefix ends in, and only rows of a slice are sorted.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in levels]
    counted = docs.select(F.col(id_col), *carry, *names, (n_words(text_col) if tokens is None else tokens).alias("n_tokens"))
    counted = stage(counted, "counted")
    leaves = stage(
        counted.groupBy(*levels).agg(F.sum("n_tokens").alias("supply"), F.count(F.lit(1)).alias("n_docs")), "leaves"
    )
    wanted = leaves.agg(F.sum("supply")).first()[0] or 0
    plan = stage(budgets(leaves, levels, weights, int(wanted * share), epochs), "budgets")
    plan = plan.withColumn("whole", F.when(F.col("supply") > 0, F.expr("target DIV supply")).otherwise(0))
    plan = plan.withColumn("rest", F.when(F.col("supply") > 0, F.col("target") % F.col("supply")).otherwise(0))
    plan = plan.withColumn("slices", F.ceil(F.col("n_docs") / SLICE).cast("long")).drop("supply", "n_docs", "target")
    rows = counted.join(plan, list(levels))
    whole = rows.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)))
    out = [F.col(id_col), *(F.col(c) for c in carry), *(F.col(c) for c in levels), F.col("epoch"), F.col("n_tokens")]
    part = rows.where("rest > 0").withColumn("place", order_key(F.col(id_col), seed, F.col("whole")))
    lead = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    part = part.withColumn("slice", F.floor(lead * F.col("slices") / (1 << 32)).cast("long"))
    sums = part.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("slice_tokens"))
    before = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("slice_tokens").over(before), F.lit(0)))
    placed = part.join(starts, [*levels, "slice"]).where("start <= rest")
    inside = placed.where(F.col("start") + F.col("slice_tokens") <= F.col("rest"))
    cut = placed.where(F.col("start") + F.col("slice_tokens") > F.col("rest"))
    running = Window.partitionBy(*levels, "slice").orderBy("place", id_col, "n_tokens")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("sum", F.col("start") + F.sum("n_tokens").over(running)).where("sum <= rest")
    partial = inside.select(*out[:-2], F.col("whole").alias("epoch"), "n_tokens").union(
        cut.select(*out[:-2], F.col("whole").alias("epoch"), "n_tokens")
    )
    return whole.select(*out).union(partial)
