"""Token counts by way of a dictionary of pre-tokens."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from blockloom.session import stage

#: So many of the commonest pre-tokens are counted where the texts are; the others travel to their counts.
COMMON = 1 << 18

#: A task sends its dictionary on when it has so many entries.
HELD = 1 << 19

_LOADED: dict[str, tuple] = {}


def read_tokenizer(path: str) -> bytes:
    """The tokenizer file's content. Its size is that of a vocabulary and does not grow with the data."""
    with open(path, "rb") as file:
        return file.read()


class Splitter:
    """Normalises and splits texts as the tokenizer does, up to but without the merges."""

    def __init__(self, content: bytes):
        self.tokenizer = Tokenizer.from_str(content.decode())
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError("added tokens are expected to match as they stand")
        texts = sorted((t.content for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, texts))) if texts else None
        # The pattern of the tokenizer file. Below U+0250 both libraries agree on its classes.
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.plain = regex.compile(r"[\x09\x0a\x0d\x20-\x7e\xa0-ɏ]*+")
        self.parts = regex.compile(r"[^ ]+")

    def special(self, text: str) -> tuple[int, list[str]]:
        """The number of added tokens in a text, and the stretches between them."""
        if self.added is None or "<" not in text:
            return 0, [text]
        parts = self.added.split(text)
        return len(parts) - 1, parts

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a stretch, before their bytes are mapped."""
        if self.plain.fullmatch(text) and "İ" not in text:
            return self.words.findall(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def count(self, piece: str) -> int:
        """Merged pieces of one pre-token."""
        return sum(len(self.tokenizer.model.tokenize(x)) for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece))


def splitter(content: bytes) -> Splitter:
    name = hashlib.sha256(content).hexdigest()
    if name not in _LOADED:
        _LOADED[name] = Splitter(content)
    return _LOADED[name]


def _frequencies(text: str | None, own: Splitter) -> tuple[int, Counter]:
    """Added tokens of a text, and how often each pre-token occurs in it."""
    special, parts = own.special(text or "")
    found: Counter = Counter()
    for part in parts:
        found.update(own.pieces(part))
    return special, found


def dictionary(docs: DataFrame, content: bytes, text_col: str = "text") -> DataFrame:
    """Every distinct pre-token of the texts with its frequency, as (piece, n). Null texts have none."""
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(shared.value)
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64()]
            made = [pa.array(x, type=k) for x, k in zip((held.keys(), held.values()), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(made, names=["piece", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update(_frequencies(text.as_py(), own)[1])
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    return docs.select(text_col).mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def count_pieces(pieces: DataFrame, content: bytes) -> DataFrame:
    """The merged pieces of each pre-token, as (piece, n, pieces). Each row is merged once."""
    shared = pieces.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(shared.value)
        for batch in batches:
            counts = pa.array([own.count(x.as_py()) for x in batch.column(0)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=["piece", "n", "pieces"])

    return pieces.select("piece", "n").mapInArrow(run, "piece string, n long, pieces int")


def _commonest(counted: DataFrame) -> DataFrame:
    """At most ``COMMON`` rows: those from a frequency on. It is found among some hundred levels of frequency, so that
    no task has to gather and sort the candidates."""
    level = F.floor(F.log2("n") * 16).cast("int")
    lowest, rows = None, 0
    for at, many in sorted(counted.groupBy(level).count().collect(), reverse=True):
        rows += many
        if rows > COMMON:
            break
        lowest = at
    return counted.limit(0) if lowest is None else counted.where(level >= lowest)


def count_tokens(
    docs: DataFrame, content: bytes, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """Tokens of every whole text, as (id_col, n_bytes, n_tokens, over_limit).

    The distinct pre-tokens of all texts are merged once each. Every document's pre-token frequencies then meet these
    counts: those of the ``COMMON`` commonest pre-tokens, a table of fixed size, where the document is read, and the
    others in a join on the pre-token, which has no hot keys left. No ids are made. Added tokens count one each, as
    the library has it. Null and empty texts have 0 bytes and 0 tokens, a null id stays null, repeated rows stay
    apart, other columns are not read, and an empty table gives an empty table.
    """
    counted = stage(count_pieces(dictionary(docs, content, text_col), content), "pieces")
    top = _commonest(counted).select("piece", "pieces").toArrow()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((content, dict(zip(*(c.to_pylist() for c in top.columns), strict=True))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, common = shared.value
        own = splitter(content)
        for batch in batches:
            known, rest = [], []
            for text in batch.column(3):
                total, found = _frequencies(text.as_py(), own)
                left = []
                for piece, n in found.items():
                    if (pieces := common.get(piece)) is None:
                        left.append((piece, n))
                    else:
                        total += pieces * n
                known.append(total)
                rest.append(left)
            flat = [x for left in rest for x in left]
            pairs = pa.StructArray.from_arrays(
                [pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.int64())],
                names=["piece", "n"],
            )
            ends = [0]
            for left in rest:
                ends.append(ends[-1] + len(left))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
            columns = [*batch.columns[:3], pa.array(known, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "n_bytes", "known", "rest"])

    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), size.alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, n_bytes long, known long, rest array<struct<piece: string, n: long>>"
    # A row's known part travels under a key of its own, which is no pre-token as it has a space in it.
    own = F.struct(F.concat(F.lit(" "), F.col("row").cast("string")).alias("piece"), F.col("known").alias("n"))
    parts = rows.mapInArrow(run, schema).select("row", "id", "n_bytes", F.explode(F.concat(F.array(own), "rest")).alias("part"))
    met = parts.select("row", "id", "n_bytes", "part.piece", F.col("part.n").alias("times")).join(
        counted.select("piece", "pieces"), "piece", "left"
    )
    total = met.groupBy("row", "id", "n_bytes").agg(
        F.sum(F.col("times") * F.coalesce("pieces", F.lit(1))).alias("n_tokens")
    )
    return total.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
