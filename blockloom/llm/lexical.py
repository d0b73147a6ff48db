"""Ranked lexical search over K2-treaps of the term-document grid.

The documents are cut into segments. A segment's grid has a row per asked term and a column per document, and a point
where the term occurs, whose weight is the term's impact there. The grid is halved both ways again and again; every
cell that is not empty keeps the maximum below it. An item goes down the paths of all its rows at once, best document
range first: the weighted maxima of the rows' cells bound every document of the range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from blockloom.llm.common import arrow_schema, table_of
from blockloom.session import stage

#: Items whose texts have about so many bytes together are searched at once; their terms are sent to all tasks.
ITEM_BYTES = 4 << 20

#: A segment ends with so many documents or points.
SEGMENT_DOCS, SEGMENT_POINTS = 8192, 1 << 20

#: Document ranges that are opened at once.
OPENED = 128

#: Long texts are cut into pieces of about so many bytes, between terms.
PIECE = 1 << 20

#: Ids that are null rank behind all others.
NO_ID = np.iinfo(np.int64).max

#: Bytes of terms are 0-9, A-Z (lower-cased), a-z, and all of characters beyond ASCII; others end terms.
_TERM_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_ONES = np.array([bin(n).count("1") for n in range(16)], np.int64)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, piece by piece."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and _TERM_BYTES[text[end]] != 0x20:  # ends between terms
            end += 1
        yield text[start:end].translate(_TERM_BYTES).split()
        start = end


def counted(texts: pa.Array, rows: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per text; and text, row and occurrences of each asked term in each text."""
    sizes, found, owners = np.zeros(len(texts), np.int64), [], []
    for k, text in enumerate(texts):
        for terms in terms_of(text.as_py() or b""):
            sizes[k] += len(terms)
            ids = [n for n in map(rows.get, terms) if n is not None]
            if ids:
                ids, times = np.unique(ids, return_counts=True)
                found.append(np.stack([ids, times]))
                owners.append(np.full(len(ids), k))
    if not found:
        empty = np.zeros(0, np.int64)
        return sizes, empty, empty, empty
    (row, times), text = np.concatenate(found, 1), np.concatenate(owners)
    cells, place = np.unique(text * len(rows) + row, return_inverse=True)  # a long text has several pieces
    return sizes, cells // len(rows), cells % len(rows), np.bincount(place, times).astype(np.int64)


def _spread(numbers: np.ndarray) -> np.ndarray:
    """The bits of each number in every second place."""
    out = np.zeros(len(numbers), np.uint64)
    for bit in range(int(numbers.max(initial=0)).bit_length()):
        out |= ((numbers >> bit) & 1).astype(np.uint64) << np.uint64(2 * bit)
    return out


class Treap:
    """The cells of a grid of 2^depth rows and columns, level by level from the whole grid to its points.

    ``children`` has four bits per cell for its quarters (two for the upper rows, two for the lower), ``first`` the
    number of its first child, ``most`` the maximum of its points. A level's cells are in the order of their parents.
    """

    def __init__(self, depth: int, children: np.ndarray, most: np.ndarray):
        self.depth, self.children, self.most = depth, children, most
        counts = _ONES[children]
        self.first = 1 + np.cumsum(counts) - counts

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, weights: np.ndarray, depth: int) -> Treap:
        place = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(place)
        place, most = place[order], weights[order]
        levels = [(np.zeros(len(place), np.int64), most)]
        for _ in range(depth):
            bits = np.int64(1) << (place & np.uint64(3)).astype(np.int64)
            place = place >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            place, most = place[starts], np.maximum.reduceat(most, starts)
            levels.append((np.bitwise_or.reduceat(bits, starts), most))
        return cls(depth, *(np.concatenate(parts) for parts in zip(*levels[::-1])))

    def packed(self) -> tuple[bytes, bytes]:
        """Two cells a byte for the children; for the maxima the largest, then what each lacks of its parent's."""
        inner = self.children[: len(self.children) - int((self.children == 0).sum())]
        bits = np.append(inner, 0)[: len(inner) + len(inner) % 2].astype(np.uint8)
        lacks = np.repeat(self.most[: len(inner)], _ONES[inner]) - self.most[1:]
        kind = next(t for t in ("u1", "u2", "u4", "u8") if lacks.max(initial=0) <= np.iinfo(t).max)
        head = np.array([self.depth, len(inner), int(kind[1]), self.most[0]], "<i8")
        return (bits[::2] | bits[1::2] << 4).tobytes(), head.tobytes() + lacks.astype(f"<{kind}").tobytes()

    @classmethod
    def unpacked(cls, bits: bytes, maxima: bytes) -> Treap:
        depth, inner, size, top = np.frombuffer(maxima, "<i8", 4).tolist()
        lacks = np.frombuffer(maxima, f"<u{size}", offset=32).astype(np.int64)
        pairs = np.frombuffer(bits, np.uint8)
        children = np.zeros(len(lacks) + 1, np.int64)
        children[:inner] = np.stack([pairs & 15, pairs >> 4], 1).ravel()[:inner]
        parent = np.repeat(np.arange(inner), _ONES[children[:inner]])
        most, start, end = np.full(len(children), top, np.int64), 1, 1 + int(_ONES[children[0]])
        while start < len(children):  # a level at a time
            most[start:end] = most[parent[start - 1 : end - 1]] - lacks[start - 1 : end - 1]
            start, end = end, end + int(_ONES[children[start:end]].sum())
        return cls(depth, children, most)

    def best(self, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """The k best of ``best`` and this grid's documents, as (-score, id) in order; scores of 0 are none.

        ``ids`` are the columns' ids in ascending order, so a range's first id is its smallest.
        """
        bound = np.array([int(self.most[0]) * int(weights.sum())])
        low, level, cells = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int64)
        while True:
            limit = best[-1] if len(best) >= k else (0, NO_ID)
            alive = (bound > -limit[0]) | ((bound == -limit[0]) & (ids[low] < limit[1]) & (bound > 0))
            if not alive.any():
                return best
            bound, low, level, cells = bound[alive], low[alive], level[alive], cells[alive]
            order = np.lexsort((low, -bound))
            now, later = order[:OPENED], order[OPENED:]
            half = (self.depth - 1 - level[now])[:, None]
            parts = [(bound[later], low[later], level[later], cells[later])]
            lower, bits, first = (rows >> half) & 1, np.where(cells[now] >= 0, self.children[cells[now]], 0), self.first[cells[now]]
            for right in (0, 1):
                quarter = 2 * lower + right
                there = (bits >> quarter) & 1 == 1
                child = np.where(there, first + _ONES[bits & ((1 << quarter) - 1)], -1)
                bounds = np.where(there, self.most[child], 0) @ weights
                parts.append((bounds, low[now] + (right << half[:, 0]), level[now] + 1, child))
            bound, low, level, cells = (np.concatenate(p) for p in zip(*parts))
            points = (level == self.depth) & (bound > 0)
            if points.any():
                best = sorted([*best, *zip((-bound[points]).tolist(), ids[low[points]].tolist())])[:k]
            inner = (level < self.depth) & (bound > 0)
            bound, low, level, cells = bound[inner], low[inner], level[inner], cells[inner]


def corpus_counts(docs: DataFrame, rows: dict[bytes, int], text_col: str = "text") -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with repeats, and the documents that hold each asked term."""
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    schema = arrow_schema("row long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(shared.value) + 2, np.int64)  # the last two: documents, terms
        for batch in batches:
            sizes, _, row, _ = counted(batch.column(0), shared.value)
            held[:-2] += np.bincount(row, minlength=len(held) - 2)
            held[-2:] += (sizes > 0).sum(), sizes.sum()
        some = np.flatnonzero(held)
        yield table_of(schema, some, held[some])

    parts = docs.select(F.col(text_col).cast("binary")).mapInArrow(run, "row long, n long")
    totals = np.zeros(len(rows) + 2, np.int64)
    for row, n in parts.groupBy("row").agg(F.sum("n")).collect():  # a row per asked term
        totals[row] = n
    return int(totals[-2]), int(totals[-1]), totals[:-2]


def index_segments(docs: DataFrame, rows: dict[bytes, int], n_docs: int, n_terms: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """K2-treaps of all documents over the asked terms, a row per segment: doc_ids (ascending), children, maxima."""
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    schema = arrow_schema("doc_ids array<bigint>, children binary, maxima binary")

    def segment(ids: np.ndarray, text: np.ndarray, row: np.ndarray, impact: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        column = np.argsort(order)[text]
        depth = max(1, int(max(len(ids), len(shared.value)) - 1).bit_length())
        children, maxima = Treap.of(row, column, impact, depth).packed()
        return table_of(schema, pa.array([ids[order]], pa.list_(pa.int64())), [children], [maxima])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        docs_held = points = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, text, row, tf = counted(part.column(1), shared.value)
                if not len(text):
                    continue
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                # 90 n N may not fit 64 bits.
                length = np.array([10 + 90 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)
                held.append((ids, text + docs_held, row, 1_000_000_000 * tf // (1000 * tf + 8 * length[text])))
                docs_held, points = docs_held + len(ids), points + len(text)
                if docs_held >= SEGMENT_DOCS or points >= SEGMENT_POINTS:
                    yield segment(*(np.concatenate(p) for p in zip(*held)))
                    held, docs_held, points = [], 0, 0
        if held:
            yield segment(*(np.concatenate(p) for p in zip(*held)))

    chosen = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("binary"))
    return chosen.mapInArrow(run, "doc_ids array<bigint>, children binary, maxima binary")


def search_segments(segments: DataFrame, asked: Sequence[tuple[int, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """The best documents of each task for each item (number, rows, weights): (item, doc_id, score)."""
    shared = segments.sparkSession.sparkContext.broadcast(list(asked))
    schema = arrow_schema("item long, doc_id long, score long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            for ids, children, maxima in zip(*batch.columns):
                treap, ids = Treap.unpacked(children.as_py(), maxima.as_py()), ids.values.to_numpy()
                ids = np.append(ids, np.full((1 << treap.depth) - len(ids), NO_ID))  # empty columns
                for item, rows, weights in shared.value:
                    best[item] = treap.best(rows, weights, ids, best.get(item, []), k)
        for item, found in best.items():
            if found:
                scores, ids = (np.array(x, np.int64) for x in zip(*found))
                yield table_of(schema, np.full(len(ids), item), pa.array(ids, mask=ids == NO_ID), -scores)

    return segments.mapInArrow(run, "item long, doc_id long, score long")


def _item_blocks(items: DataFrame) -> list[DataFrame]:
    """Items dealt into blocks whose texts have at most ``ITEM_BYTES`` bytes, or that hold one item."""
    sized = items.withColumn("size", F.coalesce(F.octet_length("words"), F.lit(0)) + 1)
    blocks = -(-(sized.agg(F.sum("size")).first()[0] or 0) // ITEM_BYTES)
    while blocks:
        block = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))
        full = sized.groupBy(block.alias("b")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
        if full.where((F.col("s") > 2 * ITEM_BYTES) & (F.col("n") > 1)).isEmpty():
            return [items.where(block == b) for b in range(blocks)]
        blocks *= 2
    return []


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best per item, by way of 256 groups of tasks, so that the rows of very many tasks do not meet in one."""
    for by in (["item", "dealt"], ["item"]):
        first = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        if len(by) == 2:
            found = found.withColumn("dealt", F.pmod(F.spark_partition_id(), F.lit(256)))
        found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return found.select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The k best documents of every item: (item_col, rank, doc_id, score), scores above 0 only.

    Terms, weights and scores are as in the contract of the query: whole numbers, equal scores by ascending id. Texts
    that are null or empty have no term; a document without one is found by no item, an item without one finds none.
    Null ids come behind all others of their score, rows of equal ids are documents of their own, equal item rows
    count once, and rows of one item id with different texts are ranked apart. Other columns are not read; an empty
    table on either side gives no rows.

    Items are searched in blocks of about ``ITEM_BYTES``, so what is sent to the tasks is bounded: a block's terms.
    Each block reads the documents twice, for the counts and for the grids; no text is shuffled, and a task returns
    k rows per item.
    """
    spark = docs.sparkSession
    ids, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType.simpleString()
    asked = stage(items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("binary").alias("words")).distinct(), "items")
    found = None
    for block in _item_blocks(asked):
        texts = block.collect()
        wanted = [{t for terms in terms_of(bytes(words or b"")) for t in terms} for _, words in texts]
        rows = {t: n for n, t in enumerate(sorted(set().union(*wanted)))}
        if not rows:
            continue
        n_docs, n_terms, held = corpus_counts(docs, rows, text_col)
        if not n_terms:
            break
        # Rows of like frequency side by side: they share cells.
        order = sorted(rows, key=lambda t: (-held[rows[t]], t))
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(held[rows[t]]) + 1))) for t in order]
        rows = {t: n for n, t in enumerate(order)}
        queries = []
        for number, terms in enumerate(wanted):
            mine = np.array(sorted(rows[t] for t in terms), np.int64)
            if len(mine):
                queries.append((number, mine, np.array([weight[n] for n in mine], np.int64)))
        best = _merged(search_segments(index_segments(docs, rows, n_docs, n_terms, id_col, text_col), queries, k), k)
        names = spark.createDataFrame([(n, item) for n, (item, _) in enumerate(texts)], f"item long, item_id {item_type}")
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.union(best)
    if found is None:
        return spark.createDataFrame([], f"`{item_col}` {item_type}, rank int, doc_id {ids.simpleString()}, score long")
    return found.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").cast(ids).alias("doc_id"), "score")
