"""Table names, fixed values and schemas shared by every job."""

from pyspark.sql import types as T

# Table names, cell names and codec tags of the stored data.
SOURCE_TABLES = ("blocks", "entries")
SERVING_TABLES = ("blocks", "entries", "tx", "tx-by-addr", "snapshots")
CELL_FAMILY = "x"
QUALIFIER_PROTO = "proto"
QUALIFIER_BIN = "bin"
CODECS = ("none", "bzip2", "gzip", "zstd")  # the position is the stored tag
TAG_BYTES = 4
PLAIN_BELOW_BYTES = 128
MAX_PAYLOAD_BYTES = 100 << 20  # the largest cell
RANGE_PATTERN = r"range_([0-9a-fA-F]+)_([0-9a-fA-F]+)"

STATUS_DONE = "done"
STATUS_FAILED = "failed"
STATUS_PENDING = "pending"


_TEXT, _LONG, _BYTES = T.StringType(), T.LongType(), T.BinaryType()
_AMOUNT = T.DecimalType(20, 0)  # unsigned 64-bit values do not fit a LONG


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _list(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


CELL = struct(row_key=_TEXT, family=_TEXT, qualifier=_TEXT, ts=_LONG, value=_BYTES)

ARCHIVE = T.StructType(
    [*CELL.fields, *struct(sync_type=_TEXT, table_name=_TEXT, range=_TEXT, commit_id=_LONG).fields]
)
ARCHIVE_PARTITIONS = ("sync_type", "table_name", "range", "commit_id")

RANGE_LEDGER = struct(
    sync_type=_TEXT, table_name=_TEXT, start_key=_TEXT, end_key=_TEXT, size=_LONG, status=_TEXT
)
FILE_LEDGER = struct(path=_TEXT, done_at=T.TimestampType())

FILE_LISTING = struct(path=_TEXT, modificationTime=T.TimestampType(), length=_LONG)
BINARY_FILE = struct(path=_TEXT, modificationTime=T.TimestampType(), length=_LONG, content=_BYTES)

# Serving tables.
RAW_TABLE = struct(row_key=_TEXT, qualifier=_TEXT, ts=_LONG, value=_BYTES)
TX_TABLE = struct(row_key=_TEXT, slot=_LONG, index=_LONG, err=_TEXT, memo=_TEXT)
TX_ORDER = ("slot", "index")
ADDRESS_TABLE = struct(
    row_key=_TEXT,
    address=_TEXT,
    slot=_LONG,
    entries=_list(struct(signature=_TEXT, err=_TEXT, index=_LONG, memo=_TEXT, block_time=_LONG)),
)

# Block layouts.
_TRANSACTION = struct(signatures=_list(_TEXT), account_keys=_list(_TEXT), memo=_TEXT)
_LEGACY_META = struct(err=_TEXT, fee=_AMOUNT, pre_balances=_list(_AMOUNT), post_balances=_list(_AMOUNT))
_ADDED_META = struct(
    inner_instructions=_list(_TEXT),
    log_messages=_list(_TEXT),
    pre_token_balances=_list(_TEXT),
    post_token_balances=_list(_TEXT),
    rewards=_list(_TEXT),
    loaded_addresses=struct(writable=_list(_TEXT), readonly=_list(_TEXT)),
    return_data=_TEXT,
    compute_units_consumed=_AMOUNT,
)
_META = T.StructType([*_LEGACY_META.fields, *_ADDED_META.fields])

LEGACY_BLOCK = struct(
    previous_blockhash=_TEXT,
    blockhash=_TEXT,
    parent_slot=_LONG,
    transactions=_list(struct(transaction=_TRANSACTION, meta=_LEGACY_META)),
    rewards=_list(struct(pubkey=_TEXT, lamports=_LONG)),
    block_time=_LONG,
    block_height=_AMOUNT,
)
BLOCK = struct(
    previous_blockhash=_TEXT,
    blockhash=_TEXT,
    parent_slot=_LONG,
    transactions=_list(struct(transaction=_TRANSACTION, meta=_META)),
    rewards=_list(
        struct(
            pubkey=_TEXT, lamports=_LONG, post_balance=_AMOUNT, reward_type=_TEXT, commission=T.IntegerType()
        )
    ),
    num_partitions=_AMOUNT,
    block_time=_LONG,
    block_height=_AMOUNT,
)
