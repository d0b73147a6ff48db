"""The corpus pipeline: quality rules, language, near-duplicates, mixing to target weights, encoding.

Each stage takes what its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockloom.llm import bpe, language, mixing, near_dup, quality
from blockloom.llm.common import table
from blockloom.llm.queries import LEVELS, RANKS, SEED, weight_table, with_domain
from blockloom.session import stage

#: Tokens wanted of those that reach the mixing stage; a document is taken once at most.
SHARE, EPOCHS = 0.8, 1

#: Language identification and encoding have no SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the rules certified for their language keep. Empty ones go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known surely enough. Those without a letter go."""
    return language.identify(docs, language.learn(docs), into="__").where("__accepted").select(*docs.columns)


def with_row(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` as a table with a number of its own for each row, ``__row``: ids may be null or repeat."""
    return stage(docs.withColumn("__row", F.monotonically_increasing_id()), label)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group. Rows that repeat an id are one document; null ids stay."""
    judged = stage(near_dup.near_duplicates(docs).select("doc_id", "kept"), "judged")
    # The same plan at every size, and texts that are shuffled but not sorted: ids to drop are no bounded set.
    dropped = judged.where("NOT kept").select("doc_id").distinct().hint("shuffle_hash")
    left = docs.join(dropped, "doc_id", "left_anti")
    repeated = judged.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = stage(repeated, "repeated")
    if repeated.isEmpty():
        return left
    again = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").union(again)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the weights of their domain, language and source.

    A document's place in the draw goes by its id; where ids repeat or are null, by id and text, so that such rows are
    drawn each for itself.
    """
    rows = with_row(docs, "rows")
    text = F.coalesce("text", F.lit(""))
    known = rows.select(
        "__row", "doc_id", "lang", "source", F.md5(text.cast("binary")).alias("digest"), mixing.n_words("text").alias("n_tokens")
    )
    again = known.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("again"))
    again = stage(again, "repeated")
    if again.isEmpty():
        known = known.withColumn("again", F.col("doc_id").isNull())
    else:
        known = known.join(again, "doc_id", "left").withColumn("again", F.col("doc_id").isNull() | F.col("again").isNotNull())
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    known = known.withColumn("key", F.when(F.col("again"), F.concat_ws("-", name, "digest")).otherwise(name))
    drawn = mixing.mix(
        with_domain(known), LEVELS, weight_table(spark), SHARE, EPOCHS, SEED,
        id_col="key", tokens=F.col("n_tokens"), carry=["__row"],
    )
    return rows.join(drawn.select("__row"), "__row").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts, with the digests of the ids and of the decoded bytes."""
    return bpe.encode_texts(docs, bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("near-duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage leaves is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
