"""Removal of word windows that occur more than once, found by level-wise doubling.

Every window of ``length`` words has an anchor: of the short windows in it, the one of the smallest hash (the first of
equals). Copies of a window have their anchors at the same place, so counting short windows at anchors loses nothing.
Anchors that occur once are dropped. The others are extended to twice the length, to either side, and counted again;
around those that are left whole windows are counted. A level that leaves no candidate ends the search.

Counting goes by question and answer. The documents lie in blocks, stored by block. A block sends the distinct keys of
its candidates to the buckets of the key space; a bucket answers with a bit per key, whether another block has it too.
So a key costs a few bytes, a window that occurs everywhere is one key per block, and texts do not move.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from blockloom.llm.common import arrow_schema, table_of, whole_groups
from blockloom.session import scratch_path, stage

#: Text after which a block ends; it may pass this by one text.
BLOCK_BYTES = 4 << 20

#: Text in a stored partition, beyond which there are more than shuffles have; Spark allows 100,000.
STORED_BYTES, MOST_STORED = 512 << 20, 100_000

#: Keys that a bucket has at most on the average, whatever the level.
BUCKET_KEYS = 1 << 19

#: Texts are hashed in pieces of about so many bytes, cut between words.
PIECE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MADE = np.random.default_rng(20_240_613)
_BYTES = _MADE.integers(0, 1 << 64, 256, dtype=np.uint64)


def _odd() -> np.uint64:
    """A factor that leaves 3 when divided by 8: its powers differ early."""
    return np.uint64(int(_MADE.integers(0, 1 << 61, dtype=np.uint64)) << 3 | 3)


_OF_BYTES, _OF_WORDS, _OF_WORDS_TOO = _odd(), _odd(), _odd()


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, factor)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _sums(values: np.ndarray, factor: np.uint64, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial of each run of values: value times a power of the factor, from power 0 at its start."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(factor, len(values)))])
    back = _powers(np.uint64(pow(int(factor), -1, 1 << 64)), len(values) + 1)
    return (sums[end] - sums[start]) * back[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash per word; words end at white space."""
    parts, start = [np.zeros(0, np.uint64)], 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        data = np.frombuffer(text, np.uint8, min(end, len(text)) - start, start)
        edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        parts.append(_mixed(_sums(_BYTES[data], _OF_BYTES, first, last)))
        start = end
    return np.concatenate(parts)


def windows(words: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A hash per run of so many words, by its start."""
    start = np.arange(max(0, len(words) - length + 1))
    return _mixed(_sums(words, factor, start, start + length) + np.uint64(length))


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of so many values the place of its smallest, the first of equals."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[: max(0, len(at) - step)], at[step:]
        at, have = np.where(values[left] <= values[right], left, right), have + step
    return at


def lengths(length: int) -> tuple[int, int, int]:
    """Window lengths of the levels. A window holds the double of its anchor's window on one side at least."""
    if length < 3:
        raise ValueError("windows need three words")
    short = -(-length // 4)
    return short, 2 * short, length


class Distinct:
    """Keys in order, without repeats: ``high`` and ``low`` words, the key of each item, and which keys repeat."""

    def __init__(self, high: np.ndarray, low: np.ndarray | None):
        order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
        high, low = high[order], None if low is None else low[order]
        new = np.ones(len(high), bool)
        new[1:] = high[1:] != high[:-1]
        if low is not None:
            new[1:] |= low[1:] != low[:-1]
        self.high, self.low = high[new], None if low is None else low[new]
        self.of = np.empty(len(high), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.many = np.diff(np.append(np.flatnonzero(new), len(high))) > 1

    def buckets(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The buckets that the keys fall into, by their leading bits, and where each begins among the keys."""
        numbers = self.high >> np.uint64(64 - bits) if bits else np.zeros(len(self.high), np.uint64)
        first = np.flatnonzero(np.concatenate([numbers[:1] == numbers[:1], numbers[1:] != numbers[:-1]]))
        return numbers[first].astype(np.int64), np.append(first, len(numbers))


class Block:
    """The candidates of one block of documents, as its answers narrow them."""

    def __init__(self, texts: list[bytes], length: int, bits: int):
        self.length, self.bits = length, bits
        self.levels = lengths(length)
        each = [word_hashes(text) for text in texts]
        self.sizes = np.array([len(w) for w in each], np.int64)
        self.words = np.concatenate([np.zeros(0, np.uint64), *each])
        end = np.repeat(np.cumsum(self.sizes), self.sizes)
        at = np.arange(len(self.words))
        self.left, self.right = at - (end - np.repeat(self.sizes, self.sizes)), end - at  # words before; from here on
        self.starts = np.flatnonzero(self.right >= length)  # of whole windows
        short = windows(self.words, self.levels[0], _OF_WORDS)
        anchor = first_smallest(short, length - self.levels[0] + 1)[self.starts]
        self.anchors, self.anchor_of = np.unique(anchor, return_inverse=True)
        self.keys = Distinct(short[self.anchors], None)
        self.level = 0

    def narrow(self, bits: dict[int, bytes]) -> None:
        """Take in the answers of a level, by bucket, and go on to the next: keys of this or another block twice."""
        twice = self.keys.many.copy()
        numbers, edges = self.keys.buckets(self.bits)
        for bucket, low, high in zip(numbers.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
            if bucket in bits:
                twice[low:high] |= np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=high - low).astype(bool)
        alive = twice[self.keys.of]
        self.level += 1
        if self.level == 1:
            short, double = self.levels[0], self.levels[1]
            self.anchors = np.where(alive, self.anchors, -1)
            self.fits = [
                alive & (self.right[self.anchors] >= double),
                alive & (self.left[self.anchors] >= double - short),
            ]
            hashes = windows(self.words, double, _OF_WORDS)
            self.keys = Distinct(np.concatenate([hashes[self.anchors[fit] - back] for fit, back in zip(self.fits, (0, double - short))]), None)
        elif self.level == 2:
            self.candidates = self._whole(alive)
            hashes = windows(self.words, self.length, _OF_WORDS)[self.candidates]
            more = windows(self.words, self.length, _OF_WORDS_TOO)[self.candidates]
            self.keys = Distinct(hashes, (more >> np.uint64(32)).astype(np.uint32))
        else:
            self.repeated = self.candidates[alive]

    def _whole(self, alive: np.ndarray) -> np.ndarray:
        """Starts of whole windows that hold a repeated double of their anchor, and none that is not."""
        ahead, back = self.fits[0].copy(), self.fits[1].copy()
        n = int(ahead.sum())
        ahead[ahead], back[back] = alive[:n], alive[n:]
        anchor = self.anchors[self.anchor_of]
        double, shift = self.levels[1], self.levels[1] - self.levels[0]
        holds_ahead = self.starts + self.length >= anchor + double
        holds_back = self.starts <= anchor - shift
        good = (~holds_ahead | ahead[self.anchor_of]) & (~holds_back | back[self.anchor_of])
        return self.starts[(anchor >= 0) & good]

    def removed(self) -> np.ndarray:
        """Words that a repeated window covers."""
        change = np.zeros(len(self.words) + 1, np.int64)
        change[self.repeated] += 1
        change[self.repeated + self.length] -= 1
        return np.cumsum(change[:-1]) > 0


def stored_blocks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Documents in blocks, (block, rows): the rows are compressed Arrow; and the bytes of all texts.

    The blocks are stored in buckets by their number, at least as many as shuffles have, so joins with a block's
    answers leave them where they are.
    """
    spark = docs.sparkSession
    schema = arrow_schema("block long, rows binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def packed() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            return table_of(schema, [block], [sink.getvalue().to_pybytes()])

        for batch in batches:
            sizes = np.cumsum(pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy())
            start = 0
            while start < batch.num_rows:
                before = sizes[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES - size, "right")))
                held.append(batch.slice(start, end - start))
                size += int(sizes[end - 1] - before)
                start = end
                if size >= BLOCK_BYTES or start < batch.num_rows:
                    yield packed()
                    block, held, size = block + 1, [], 0
        if held:
            yield packed()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_STORED, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // STORED_BYTES)))
    name = f"blocks_{uuid.uuid4().hex}"
    blocks = rows.mapInArrow(run, "block long, rows binary").repartition(parts, "block")
    blocks.write.bucketBy(parts, "block").option("path", scratch_path(spark, "blocks")).saveAsTable(name, format="parquet")
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are not the catalog's
    return stored, total


def _read(rows: bytes) -> tuple[pa.Array, list[bytes]]:
    table = pa.ipc.open_stream(rows).read_all().combine_chunks()
    return table.column("id"), [text or b"" for text in table.column("text").to_pylist()]


def _block(texts: list[bytes], length: int, bits: int, answers: list[dict] | None, levels: int) -> Block | None:
    """A block after so many levels, or none if a level without an answer has ended its search."""
    block = Block(texts, length, bits)
    for level in range(levels):
        mine = {a["bucket"]: a["bits"] for a in answers or () if a["level"] == level}
        if not mine:
            return None
        block.narrow(mine)
    return block


def _questions(stored: DataFrame, answers: DataFrame | None, level: int, length: int, bits: int) -> DataFrame:
    """The distinct keys of each block's candidates by bucket; ``own``: some of them occur twice in the block."""
    schema = arrow_schema("bucket int, block long, n int, keys binary, own boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, rows, *given = (batch.column(k)[row].as_py() for k in range(batch.num_columns))
                block = _block(_read(rows)[1], length, bits, given[0] if given else None, level)
                if block is None or not len(block.keys.high):
                    continue
                keys = block.keys
                numbers, edges = keys.buckets(bits)
                packed, own = [], []
                for low, high in zip(edges[:-1], edges[1:]):
                    packed.append(keys.high[low:high].tobytes() + (b"" if keys.low is None else keys.low[low:high].tobytes()))
                    own.append(bool(keys.many[low:high].any()))
                yield table_of(schema, numbers, np.full(len(numbers), number), np.diff(edges), packed, own)

    rows = stored if answers is None else stored.join(answers.hint("shuffle_hash"), "block")
    return rows.mapInArrow(run, "bucket int, block long, n int, keys binary, own boolean")


def _answers(questions: DataFrame, level: int) -> DataFrame:
    """A bit per key that another block asked for too: (block, level, bucket, bits). No row without a repeated key."""
    schema = arrow_schema("block long, level int, bucket int, bits binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for both in whole_groups(batches, ["bucket"], 1):
            numbers = both.column("bucket").to_numpy()
            for bucket in np.unique(numbers):
                rows = both.filter(pa.array(numbers == bucket))
                blobs, n = rows.column("keys").to_pylist(), rows.column("n").to_numpy()
                high = np.concatenate([np.frombuffer(b, np.uint64, k) for b, k in zip(blobs, n)])
                wide = len(blobs[0]) > 8 * n[0]
                low = np.concatenate([np.frombuffer(b, np.uint32, k, 8 * k) for b, k in zip(blobs, n)]) if wide else None
                keys = Distinct(high, low)
                twice = np.split(keys.many[keys.of], np.cumsum(n)[:-1])
                kept = [k for k, own in enumerate(rows.column("own").to_pylist()) if own or twice[k].any()]
                bits = [np.packbits(twice[k]).tobytes() for k in kept]
                yield table_of(schema, rows.column("block").take(pa.array(kept, pa.int64())), np.full(len(kept), level), np.full(len(kept), bucket), bits)

    dealt = questions.repartition("bucket").sortWithinPartitions("bucket")
    return stage(dealt.mapInArrow(run, "block long, level int, bucket int, bits binary"), f"answers-{level}")


def remove_repeats(docs: DataFrame, length: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words that repeated windows cover: (id_col, n_words, n_removed, kept).

    Words end at white space and are taken as they are. A window is ``length`` words of one document; it is repeated if
    its words also start anywhere else, be it in the same document, overlapping or in an equal row. All its occurrences
    go, judged on the input. ``kept`` has the other words, joined by one space.

    Null and empty texts have no words and keep the empty text; texts of fewer words than a window keep them all. Null
    and repeated ids do no harm, as ids are carried only; other columns are not read; no rows give no rows.

    Whole windows are told apart by 96 bits of two hashes and the shorter ones, which only choose candidates, by 64. A
    block of ``BLOCK_BYTES``, or of one text more, is held at a time, and in a bucket about ``BUCKET_KEYS`` keys and
    one more for each block that has a very common window.
    """
    ids = docs.schema[id_col].dataType.simpleString()
    stored, total = stored_blocks(docs, id_col, text_col)
    bits = max(0, (total // 2 // BUCKET_KEYS).bit_length())  # a word has two bytes at least, with its space
    given, answers = None, None
    for level in range(len(lengths(length))):
        found = _answers(_questions(stored, answers, level, length, bits), level)
        if found.isEmpty():
            given = None
            break
        given = found if given is None else given.union(found)
        last = found.select("block").distinct()  # only these have candidates left
        told = given.groupBy("block").agg(F.collect_list(F.struct("level", "bucket", "bits")).alias("answers"))
        answers = told.join(last, "block", "left_semi")
    schema = arrow_schema(f"id {ids}, n_words long, n_removed long, kept string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                rows, *told = (batch.column(k)[row].as_py() for k in range(1, batch.num_columns))
                names, texts = _read(rows)
                block = _block(texts, length, bits, told[0], 3) if told and told[0] else None
                gone = block.removed() if block else None
                sizes, dropped, kept, at = [], [], [], 0
                for text in texts:
                    words = text.split()
                    if gone is not None:
                        mine = gone[at : at + len(words)]
                        at += len(words)
                        left = list(compress(words, ~mine)) if mine.any() else words
                    else:
                        left = words
                    sizes.append(len(words))
                    dropped.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode(errors="replace"))
                yield table_of(schema, names, sizes, dropped, kept)

    rows = stored if given is None else stored.join(answers.hint("shuffle_hash"), "block", "left")
    done = rows.mapInArrow(run, f"id {ids}, n_words long, n_removed long, kept string")
    return done.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept")
