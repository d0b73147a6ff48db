"""Block records to serving rows.

A block is one row, and every (address, slot) group lies inside one block. All steps below are
therefore row-local: nothing is shuffled, and no group grows beyond the block it came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blockloom.functions import keys


def current_transaction(old: Column) -> Column:
    """A legacy transaction in the current shape; fields the old layout lacks get their default."""
    texts = "array<string>"
    meta = old["meta"]
    filled = F.struct(
        meta["err"].alias("err"),
        meta["fee"].alias("fee"),
        meta["pre_balances"].alias("pre_balances"),
        meta["post_balances"].alias("post_balances"),
        F.lit(None).cast(texts).alias("inner_instructions"),
        F.lit(None).cast(texts).alias("log_messages"),
        F.lit(None).cast(texts).alias("pre_token_balances"),
        F.lit(None).cast(texts).alias("post_token_balances"),
        F.lit(None).cast(texts).alias("rewards"),
        F.struct(
            F.array().cast(texts).alias("writable"), F.array().cast(texts).alias("readonly")
        ).alias("loaded_addresses"),
        F.lit(None).cast("string").alias("return_data"),
        F.lit(None).cast("decimal(20,0)").alias("compute_units_consumed"),
    )
    return F.struct(old["transaction"].alias("transaction"), F.when(meta.isNotNull(), filled).alias("meta"))


def current_reward(old: Column) -> Column:
    return F.struct(
        old["pubkey"].alias("pubkey"),
        old["lamports"].alias("lamports"),
        F.lit(0).cast("decimal(20,0)").alias("post_balance"),
        F.lit(None).cast("string").alias("reward_type"),
        F.lit(None).cast("int").alias("commission"),
    )


def normalise_block(legacy: DataFrame) -> DataFrame:
    """Legacy blocks in the current shape."""
    return legacy.withColumns(
        {
            "transactions": F.transform("transactions", current_transaction),
            "rewards": F.transform("rewards", current_reward),
            "num_partitions": F.lit(None).cast("decimal(20,0)"),
        }
    )


def flat_transaction(tx: Column) -> Column:
    """What the serving tables read of a current transaction.

    Addresses loaded through lookup tables follow the transaction's own keys, writable ones first.
    """
    loaded = tx["meta"]["loaded_addresses"]
    none = F.array().cast("array<string>")
    parts = [tx["transaction"]["account_keys"], loaded["writable"], loaded["readonly"]]
    account_keys = F.concat(*[F.coalesce(part, none) for part in parts])
    return F.struct(
        tx["transaction"]["signatures"].alias("signatures"),
        account_keys.alias("account_keys"),
        tx["transaction"]["memo"].alias("memo"),
        F.when(tx["meta"].isNotNull(), F.struct(tx["meta"]["err"].alias("err"))).alias("meta"),
    )


def flat_transactions(blocks: DataFrame) -> DataFrame:
    """Current blocks with ``transactions`` reduced to what the steps below read."""
    return blocks.withColumn("transactions", F.transform("transactions", flat_transaction))


def tx_completeness(blocks: DataFrame) -> DataFrame:
    """``missing`` or ``complete`` per transaction, by whether it has metadata."""
    state = F.when(F.col("tx.meta").isNull(), "missing").otherwise("complete")
    return blocks.select("slot", F.posexplode("transactions").alias("index", "tx")).select(
        "slot", "index", state.alias("completeness")
    )


def _is_complete() -> Column:
    return F.forall("transactions", lambda tx: tx["meta"].isNotNull())


def complete_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks whose every transaction has metadata; one missing keeps the whole block out."""
    return blocks.where(_is_complete())


def incomplete_blocks(blocks: DataFrame) -> DataFrame:
    """Slots that ``complete_blocks`` leaves out, with the number of transactions lacking metadata."""
    missing = F.filter("transactions", lambda tx: tx["meta"].isNull())
    return blocks.where(~_is_complete()).select("slot", F.size(missing).alias("missing"))


def explode_transactions(blocks: DataFrame) -> DataFrame:
    """One row per transaction with its position in the block."""
    exploded = blocks.select("slot", "block_time", F.posexplode("transactions").alias("index", "tx"))
    return exploded.select(
        "slot",
        "block_time",
        F.col("index").cast("bigint").alias("index"),
        F.col("tx.signatures")[0].alias("signature"),
        tx_status_err(F.col("tx")).alias("err"),
        F.col("tx.memo").alias("memo"),
        F.col("tx.account_keys").alias("account_keys"),
    )


def tx_status_err(tx: Column) -> Column:
    """Error of a transaction; null means success."""
    return tx["meta"]["err"]


def tx_table(blocks: DataFrame) -> DataFrame:
    """Look-up rows of complete blocks, keyed by the first signature."""
    return explode_transactions(complete_blocks(blocks)).select(
        F.col("signature").alias("row_key"), "slot", "index", "err", "memo"
    )


def explode_accounts(transactions: DataFrame) -> DataFrame:
    """One row per account key of a transaction; repeated keys stay repeated."""
    return transactions.withColumn("address", F.explode("account_keys")).drop("account_keys")


def drop_reserved(rows: DataFrame, reserved: DataFrame) -> DataFrame:
    """Rows whose ``address`` is not reserved. Spark broadcasts the set only below its size limit."""
    return rows.join(reserved.select("address"), "address", "left_anti")


def tx_by_addr(blocks: DataFrame, reserved: DataFrame) -> DataFrame:
    """Per (address, slot): the block's transactions that name the address, in ascending index.

    (address, index) pairs of a block are sorted, cut where the address changes, and filled in from
    the block's own transactions. Reserved addresses leave as whole groups afterwards.
    """
    pairs = F.flatten(
        F.transform(
            "transactions",
            lambda tx, i: F.transform(
                F.coalesce(tx["account_keys"], F.array().cast("array<string>")),
                lambda a: F.struct(a.alias("address"), i.alias("index")),
            ),
        )
    )
    sorted_pairs = complete_blocks(blocks).select(
        "slot", "block_time", "transactions", F.sort_array(pairs).alias("pairs")
    )
    positions = F.when(F.size("pairs") > 0, F.sequence(F.lit(0), F.size("pairs") - 1))
    starts = F.filter(
        positions,
        lambda i: (i == 0) | ~F.get("pairs", i)["address"].eqNullSafe(F.get("pairs", i - 1)["address"]),
    )

    def entry(pair: Column) -> Column:
        tx = F.get("transactions", pair["index"])
        return F.struct(
            tx["signatures"][0].alias("signature"),
            tx_status_err(tx).alias("err"),
            pair["index"].cast("bigint").alias("index"),
            tx["memo"].alias("memo"),
            F.col("block_time").alias("block_time"),
        )

    def group(start: Column, number: Column) -> Column:
        stop = F.coalesce(F.get("starts", number + 1), F.size("pairs"))
        members = F.slice("pairs", start + 1, stop - start)
        return F.struct(
            F.get("pairs", start)["address"].alias("address"), F.transform(members, entry).alias("entries")
        )

    groups = (
        sorted_pairs.withColumn("starts", starts)
        .select("slot", F.explode(F.transform("starts", group)).alias("group"))
        .select("group.address", "slot", "group.entries")
    )
    return drop_reserved(groups, reserved).select(
        keys.address_slot_key(F.col("address"), F.col("slot")).alias("row_key"), "address", "slot", "entries"
    )
