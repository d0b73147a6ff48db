"""Near-duplicate documents by HyperMinHash sketches of word shingles, with exact confirmation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from blockloom.llm.common import block_pairs, components, groups, in_groups
from blockloom.session import stage

SHINGLE = 5
#: Linked are documents with 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A sketch has 2^7 registers of 6 bits for leading zeros and 10 bits of mantissa; 0 is an empty one.
BUCKET_BITS, MANTISSA_BITS = 7, 10
BUCKETS = 1 << BUCKET_BITS
REST_BITS = 64 - BUCKET_BITS
#: Registers in a band. Of two documents at the threshold, all 32 bands differ in one of 200,000 cases.
ROWS = 4
#: A pair is given up when its estimate is so many standard errors below the threshold.
ERRORS = 4.5
#: Rows of a group that meet in one task: sketches, and texts.
SKETCH_BLOCK, TEXT_BLOCK = 1024, 256
#: A task forgets the words it has hashed when it holds so many.
HELD = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: For each bucket, the order in which an empty one looks for a full one to borrow from.
_DONORS = np.argsort(np.random.default_rng(4).random((BUCKETS, BUCKETS)), axis=1)


class Hashes(dict):
    """64-bit hashes of words, each made once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, hashes: Hashes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles: A-Z in lower case, words between ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    width = min(SHINGLE, len(words))
    word = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = (total ^ word[k : k + len(total)]) * _ODD
        total ^= total >> np.uint64(31)
    total *= _MIX
    return np.unique(total ^ (total >> np.uint64(29)))


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of hashes: per bucket the leading zeros and mantissa of its smallest rest."""
    sketch = np.zeros(BUCKETS, dtype=np.uint16)
    bucket, first = np.unique(found >> np.uint64(REST_BITS), return_index=True)
    rest = found[first] & np.uint64((1 << REST_BITS) - 1)
    fraction, exponent = np.frexp(rest.astype(np.float64) + 1.0)
    mantissa = np.minimum((fraction - 0.5) * (2 << MANTISSA_BITS), (1 << MANTISSA_BITS) - 1).astype(np.int64)
    zeros = np.maximum(REST_BITS - exponent, 0)
    sketch[bucket.astype(np.int64)] = (zeros << MANTISSA_BITS) + mantissa + 1
    return sketch


def bands(sketch: np.ndarray) -> np.ndarray:
    """Keys of the bands. Empty registers borrow from a full one, so a few shingles cannot make up a band's key."""
    full = sketch > 0
    if not full.all():
        donors = _DONORS[np.arange(BUCKETS), full[_DONORS].argmax(axis=1)]
        sketch = np.where(full, sketch, sketch[donors])
    return np.ascontiguousarray(sketch).view(np.int64)


_GRID = np.geomspace(1e-3, 1e9, 400)
_LEVELS = 2.0 ** -np.arange(1, REST_BITS + 1)
_CHANCE = np.array(
    [(_LEVELS / (1 << MANTISSA_BITS) * s * (np.exp(-s * _LEVELS) - np.exp(-2 * s * _LEVELS))).sum() for s in _GRID]
)


def collisions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Expected equal registers of two sets of these sizes that have nothing in common.

    With x and y hashes a bucket, the smallest rests have densities x exp(-x t) and y exp(-y t); the chance to fall
    into one cell is summed over the leading-zero levels, each of which has equally wide cells.
    """
    x, y = a / BUCKETS, b / BUCKETS
    return BUCKETS * x * y / (x + y) ** 2 * np.interp(np.log(x + y), np.log(_GRID), _CHANCE)


def likely(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Which pairs may reach the threshold: sizes that allow it, and a collision-corrected estimate near it or above.

    The estimate's standard error is that of a share among the buckets full in either sketch, so small sets, which
    fill few buckets, are given up far more carefully. Returned are the estimates, -1 where a pair is given up.
    """
    share = PERCENT / 100
    low, high = np.minimum.outer(size_a, size_b), np.maximum.outer(size_a, size_b)
    out = np.full(low.shape, -1.0)
    equal = np.zeros(low.shape, dtype=np.uint8)
    for k in range(BUCKETS):
        column = a[:, k]
        equal += (column[:, None] == b[None, :, k]) & (column > 0)[:, None]
    full_a, full_b = (a > 0).astype(np.float32), (b > 0).astype(np.float32)
    either = full_a.sum(axis=1)[:, None] + full_b.sum(axis=1)[None, :] - full_a @ full_b.T
    i, j = np.nonzero((100 * low >= PERCENT * high) & (equal >= (share - 0.5) * either - 1) | (high < 16) & (100 * low >= PERCENT * high))
    n = either[i, j].astype(float)
    estimate = (equal[i, j] - collisions(size_a[i].astype(float), size_b[j].astype(float))) / n
    kept = estimate >= share - ERRORS * np.sqrt(share * (1 - share) / n)
    out[i[kept], j[kept]] = np.maximum(estimate[kept], 0.0)
    return out


def spanning(near: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component in a symmetric boolean matrix."""
    label = np.arange(len(near))
    while True:
        best = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
        best = best[best]
        if (best == label).all():
            return label
        label = best


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the lower and of the higher block; of one block, all rows twice."""
    low, high, block = (rows.column(c).to_numpy() for c in ("low", "high", "block"))
    return np.nonzero(block == low[0])[0], np.nonzero(block == high[0])[0]


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=_EDGE)


def _similar_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that span the pairs of a unit of work whose estimates are near the threshold or above."""
    for rows in groups(batches, ("group", "low", "high")):
        low, high = _sides(rows)
        ids, sizes = rows.column("id").to_numpy(), rows.column("n_shingles").to_numpy()
        data = b"".join(rows.column("sketch").to_pylist())
        sketch = np.frombuffer(data, dtype=np.uint16).reshape(-1, BUCKETS)
        near = np.zeros((len(ids), len(ids)), dtype=bool)
        near[np.ix_(low, high)] = likely(sketch[low], sizes[low], sketch[high], sizes[high]) >= 0
        label = spanning(near | near.T)
        moved = np.nonzero(label != np.arange(len(label)))[0]
        yield _edges([(int(ids[i]), int(ids[label[i]])) for i in moved])


def _linked_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between documents of a unit of work whose full sets reach the threshold, as many as span them."""
    hashes = Hashes()
    for rows in groups(batches, ("group", "low", "high")):
        low, high = _sides(rows)
        ids = rows.column("id").to_numpy()
        sets = [shingles(t.as_py(), hashes) for t in rows.column("text")]
        sizes = np.array([len(s) for s in sets])
        sketch = np.stack([registers(s) for s in sets])
        chance = likely(sketch[low], sizes[low], sketch[high], sizes[high])
        root, found = list(range(len(ids))), []

        def top(i: int, root: list[int] = root) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        at = np.nonzero(chance >= 0)
        order = np.argsort(-chance[at], kind="stable")
        for i, j in zip(low[at[0][order]].tolist(), high[at[1][order]].tolist(), strict=True):
            if i == j or top(i) == top(j):
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= PERCENT * (len(sets[i]) + len(sets[j]) - common):
                root[top(i)] = top(j)
                found.append((int(ids[i]), int(ids[j])))
        yield _edges(found)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each document's set size, digest of the whole set, and registers: (id, n_shingles, set_key, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            sets = [shingles(t.as_py(), hashes) for t in batch.column(1)]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            arrays = [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", "n_shingles", "set_key", "sketch"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, set_key binary, sketch binary")


def _bucket_edges(reps: DataFrame) -> DataFrame:
    """Documents that share a band's key, each linked to the smallest id of the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [bands(np.frombuffer(s.as_py(), dtype=np.uint16)) for s in batch.column(1)]
            arrays = [batch.column(0), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "keys"])

    keyed = reps.select("id", "sketch").mapInArrow(run, "id long, keys array<bigint>")
    banded = keyed.select("id", F.posexplode("keys").alias("band", "key"))
    firsts = banded.groupBy("band", "key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    shared = firsts.where("first <> last").select("band", "key", "first")
    return banded.join(shared, ["band", "key"]).where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of near-duplicates among all documents, as (id_col, n_shingles, component_id, kept).

    1. Every text is read once for its sketch. Documents of equal sets form a class, found by an aggregation; from
       here on the smallest id stands for its class.
    2. Bands of registers that agree link documents to the smallest id of their bucket: no pairs are made.
    3. In each group so linked, sketches are compared, and pairs whose estimate is too low are given up.
    4. In each group still linked, texts are compared as full sets. Links found join components.
    Large groups are cut into blocks, and each pair of blocks is a task of its own, so that any two members meet
    while no task gets more than two blocks; only edges that span what was found leave a task. All
    members are compared; there is no cap.

    Null and empty texts, and texts without a word, have no shingles and link with nothing. A null id links with
    nothing, has a null component and is kept. Rows that repeat an id are one document for the links, whatever their
    texts, and one row each in the result. Ids are whole numbers. Other columns are not read, and an empty table
    gives an empty one.
    """
    rows = stage(sketches(docs, id_col, text_col), "sketches")
    usable = rows.where("n_shingles > 0 AND id IS NOT NULL")
    classes = usable.groupBy("set_key").agg(F.min("id").alias("rep"))
    members = usable.join(classes, "set_key")
    reps = stage(members.where("id = rep").select("id", "n_shingles", "sketch"), "reps")
    met = components(_bucket_edges(reps), "met").select(F.col("node").alias("id"), F.col("component").alias("group"))
    dealt = block_pairs(met.join(reps, "id"), ["group"], "id", SKETCH_BLOCK)
    dealt = dealt.select("group", "low", "high", "block", "id", "n_shingles", "sketch")
    near = in_groups(dealt, ["group", "low", "high"]).mapInArrow(_similar_sketches, "a long, b long")
    near = components(near, "near").select(F.col("node").alias("id"), F.col("component").alias("group"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = block_pairs(texts.join(near.hint("shuffle_hash"), "id"), ["group"], "id", TEXT_BLOCK)
    dealt = dealt.select("group", "low", "high", "block", "id", "text")
    linked = in_groups(dealt, ["group", "low", "high"]).mapInArrow(_linked_texts, "a long, b long")
    found = components(linked.union(_same_class(members)), "linked")
    # A class hangs together by links to its smallest id, so each id has its component.
    out = rows.select("id", "n_shingles").join(found.withColumnRenamed("node", "id"), "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _same_class(members: DataFrame) -> DataFrame:
    return members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
