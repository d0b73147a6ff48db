"""Codec-tagged payloads: a little-endian codec number, then the encoded bytes."""

from __future__ import annotations

import bz2
import functools
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from blockloom.model import CODECS, MAX_PAYLOAD_BYTES, PLAIN_BELOW_BYTES, TAG_BYTES

# Output batches stay near this size, so large cells do not build up in a task.
_BATCH_BYTES = 32 << 20


def _gzip(data: bytes) -> bytes:
    stream = zlib.compressobj(wbits=31)
    return stream.compress(data) + stream.flush()


class TooLarge(ValueError):
    """A payload has more bytes than it may have."""


def _whole(plain: bytes, ended: bool, limit: int) -> bytes:
    if len(plain) > limit:
        raise TooLarge(f"more than {limit} bytes")
    if not ended:
        raise ValueError("encoded data ends early")
    return plain


def _inflate(stream, data: bytes, limit: int) -> bytes:
    """All of a stream that can stop at a length; one byte beyond the limit tells that there is more."""
    plain = stream.decompress(data, limit + 1)
    return _whole(plain, stream.eof, limit)


#: Bytes of zstd that are decoded at once: a block of 128 KB takes four, so a step makes 32 MB at most.
_ZSTD_STEP = 1024


def _decode_zstd(data: bytes, limit: int) -> bytes:
    """All frames of a value, a step at a time, as its streams cannot stop at a length."""
    plain, frame, start = bytearray(), None, 0
    while start < len(data) or frame is None:
        frame = zstandard.ZstdDecompressor().decompressobj()
        while start < len(data) and not frame.eof:
            step = data[start : start + _ZSTD_STEP]
            plain += frame.decompress(step)
            start += len(step) - len(frame.unused_data)
            if len(plain) > limit:
                raise TooLarge(f"more than {limit} bytes")
    return _whole(bytes(plain), frame.eof, limit)


def _bzip2(data: bytes) -> bytes:
    """The bytes of level 9, whose large tables cost more than a short value itself.

    The level is the size of a block: a value that fits into one of a lower level has the same bytes there but for the
    level's digit. A block counts bytes after runs are shortened, which makes five of four at the most.
    """
    level = min(9, 1 + len(data) * 5 // 4 // 99_000)
    return b"BZh9" + bz2.compress(data, level)[4:]


@functools.cache
def _zstd() -> zstandard.ZstdCompressor:
    """One for all values of a process: a new one costs as much as a short value itself, and the bytes are the same."""
    return zstandard.ZstdCompressor(write_content_size=False)


_ENCODE: dict[str, Callable[[bytes], bytes]] = {
    "none": bytes,
    "bzip2": _bzip2,
    "gzip": _gzip,
    "zstd": lambda data: _zstd().compress(data),
}
_DECODE: dict[str, Callable[[bytes, int], bytes]] = {
    "none": lambda data, limit: _whole(bytes(data), True, limit),
    "bzip2": lambda data, limit: _inflate(bz2.BZ2Decompressor(), data, limit),
    "gzip": lambda data, limit: _inflate(zlib.decompressobj(wbits=31), data, limit),
    "zstd": _decode_zstd,
}


def _encode(data: bytes) -> tuple[str, bytes]:
    """Smallest encoding, the first codec on ties; short values are stored as they are."""
    codecs = CODECS if len(data) >= PLAIN_BELOW_BYTES else CODECS[:1]
    encoded = [(codec, _ENCODE[codec](data)) for codec in codecs]
    codec, body = min(encoded, key=lambda pair: len(pair[1]))
    return codec, CODECS.index(codec).to_bytes(TAG_BYTES, "little") + body


def _decode(data: bytes, limit: int) -> tuple[bytes | None, str | None]:
    if len(data) < TAG_BYTES:
        return None, f"value too short: {len(data)} bytes"
    tag = int.from_bytes(data[:TAG_BYTES], "little")
    if tag >= len(CODECS):
        return None, f"unknown codec: {tag}"
    try:
        return _DECODE[CODECS[tag]](data[TAG_BYTES:], limit), None
    except (OSError, EOFError, ValueError, zlib.error, zstandard.ZstdError) as error:
        return None, f"{CODECS[tag]}: {error}"


def _map_values(rows: DataFrame, column: str, convert: Callable, added: dict[str, T.DataType]) -> DataFrame:
    """Replace a binary column by the columns ``convert`` returns per value, keeping the others."""
    kept = [name for name in rows.columns if name != column]
    schema = T.StructType([rows.schema[name] for name in kept])
    for name, kind in added.items():
        schema = schema.add(name, kind)
    kinds = [pa.binary() if isinstance(kind, T.BinaryType) else pa.string() for kind in added.values()]

    def flush(batch: pa.RecordBatch, start: int, results: list[tuple]) -> pa.RecordBatch:
        part = batch.slice(start, len(results))
        columns = [pa.array(c, kind) for c, kind in zip(zip(*results), kinds)]
        return pa.RecordBatch.from_arrays(part.columns[:-1] + columns, schema.fieldNames())

    def convert_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, results = 0, 0, []
            for value in batch.column(len(kept)):
                result = convert(value.as_py())
                results.append(result)
                held += sum(len(item) for item in result if isinstance(item, bytes))
                if held >= _BATCH_BYTES:
                    yield flush(batch, start, results)
                    start, held, results = start + len(results), 0, []
            if results:
                yield flush(batch, start, results)

    return rows.select(*kept, column).mapInArrow(convert_batches, schema)


def encode_payloads(rows: DataFrame, column: str = "value") -> DataFrame:
    """Replace ``column`` by ``codec`` and the tagged ``value``; nulls stay null."""

    def encode(data: bytes | None) -> tuple[str | None, bytes | None]:
        return (None, None) if data is None else _encode(data)

    return _map_values(rows, column, encode, {"codec": T.StringType(), "value": T.BinaryType()})


def decode_payloads(rows: DataFrame, column: str = "value", limit: int = MAX_PAYLOAD_BYTES) -> DataFrame:
    """Replace ``column`` by ``payload`` and ``error``; exactly one of them is null.

    A payload of more than ``limit`` bytes is an error: decoding stops there, so a few bytes that stand for very many
    take no more memory than the limit and a step of it.
    """

    def decode(data: bytes | None) -> tuple[bytes | None, str | None]:
        return (None, "no value") if data is None else _decode(data, limit)

    return _map_values(rows, column, decode, {"payload": T.BinaryType(), "error": T.StringType()})


def codec_report(rows: DataFrame, column: str = "value") -> DataFrame:
    """Rows and bytes before and after encoding, per chosen codec."""
    encoded = encode_payloads(rows.select(F.octet_length(column).alias("bytes_in"), column), column)
    return encoded.groupBy("codec").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("bytes_in").cast("bigint")).alias("bytes_in"),
        F.sum(F.octet_length("value").cast("bigint")).alias("bytes_out"),
    )
