"""Byte-level BPE encoding and decoding with a rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

#: Texts above this many characters are encoded piece by piece.
CHUNK_CHARS = 1 << 16

#: Between these two characters no match of the pattern can lie: a match has white space only at its start (and is
#: then followed by one kind of character) or is white space alone, and letters never share a match with digits.
_SAFE = re.compile(r"[A-Za-z](?=[ \n0-9])|[0-9](?=[ \nA-Za-z])")

_ENCODERS: dict[str, tuple[tiktoken.Encoding, list[str]]] = {}


def read_ranks(path: str) -> bytes:
    """The rank file's content. Its size is that of a vocabulary and does not grow with the data."""
    with open(path, "rb") as file:
        return file.read()


def encoder(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[str]]:
    """The encoding of a rank file, made once per process, and the decimal text of each id."""
    name = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if name not in _ENCODERS:
        pairs = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        made = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        _ENCODERS[name] = made, [str(i) for i in range(max(merges.values()) + 1)]
    return _ENCODERS[name]


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """Cut a text at safe boundaries into chunks of at least ``size`` characters where such boundaries occur.

    The encodings of the chunks, one after the other, are the encoding of the text.
    """
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size - 1)
        if found is None:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def encode(text: str, encoding: tiktoken.Encoding, size: int = CHUNK_CHARS) -> Iterator[list[int]]:
    """The ids of a text, chunk by chunk."""
    for chunk in chunks(text, size):
        yield encoding.encode_ordinary(chunk)


def encode_texts(
    docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True
) -> DataFrame:
    """Token ids of every whole text, and their decoding.

    Returns (id_col, n_tokens, token_ids, ids_sha256, decoded_sha256): the hashes are of the decimal ids joined by
    commas and of the bytes that the ids decode to. ``ids=False`` leaves token_ids out. Null texts count as empty:
    no tokens, and hashes of nothing. A null id stays null, repeated rows give repeated rows, other columns of the
    input are not read, and an empty table gives an empty table. Long texts are encoded in chunks that end where no
    token can span, so memory does not grow beyond a text and its ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kinds = [("n_tokens", pa.int64()), *([("token_ids", pa.list_(pa.int32()))] if ids else [])]
    kinds += [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, names = encoder(shared.value, pattern)
        for batch in batches:
            counts, found, digests, decoded = [], [], [], []
            for text in batch.column(1):
                n, out, hashed, back = 0, [], hashlib.sha256(), hashlib.sha256()
                for part in encode(text.as_py() or "", encoding):
                    if part:
                        hashed.update(("," * bool(n) + ",".join([names[i] for i in part])).encode())
                        back.update(encoding.decode_bytes(part))
                        n += len(part)
                        if ids:
                            out += part
                counts.append(n)
                found.append(out)
                digests.append(hashed.hexdigest())
                decoded.append(back.hexdigest())
            columns = [counts, *([found] if ids else []), digests, decoded]
            arrays = [pa.array(c, type=kind) for c, (_, kind) in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_col, *(k for k, _ in kinds)])

    chosen = docs.select(id_col, text_col)
    ids_type = chosen.schema[id_col].dataType.simpleString()
    middle = "token_ids array<int>, " if ids else ""
    schema = f"`{id_col}` {ids_type}, n_tokens long, {middle}ids_sha256 string, decoded_sha256 string"
    return chosen.mapInArrow(run, schema)


def decode_ids(
    rows: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids"
) -> DataFrame:
    """The bytes that each row's ids stand for, as (id_col, bytes).

    Bytes, not text: ids may end inside a character. Null ids give null bytes, no ids give no bytes; an id outside
    the vocabulary ends the job with an error.
    """
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = encoder(shared.value, pattern)
        for batch in batches:
            found = [None if ids is None else encoding.decode_bytes(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=[id_col, "bytes"])

    chosen = rows.select(id_col, ids_col)
    return chosen.mapInArrow(run, f"`{id_col}` {chosen.schema[id_col].dataType.simpleString()}, bytes binary")
