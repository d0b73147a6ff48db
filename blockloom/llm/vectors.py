"""Near-duplicate vectors: binary codes by iterative quantisation, Hamming tables, and the cosine of the vectors."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from blockloom.llm.common import components, groups, in_groups
from blockloom.session import stage

#: The rotations of a length are fitted on about so many vectors.
SAMPLE = 8192
#: Wanted chance to find a pair whose cosine is just the threshold.
RECALL = 0.99
#: Wanted vectors in a bucket of a table.
BUCKET = 256
#: Pairs at the threshold that are made to count the tables on, of each kind.
PAIRS = 2000
#: Vectors of a bucket that meet in one task.
BLOCK = 1024
#: Bits of a code that are compared.
CODE = 256
#: Share of pairs at the threshold that may lie beyond the Hamming radius.
MISSED = 0.001
#: Lengths of so many rows or fewer are compared whole.
FEW = 256
#: What is met at once: a bucket of a length's tables, or two blocks of it.
UNIT = ("width", "bucket", "low", "high")


def rotations(sample: np.ndarray, many: int, rounds: int = 50, seed: int | list[int] = 3) -> np.ndarray:
    """Iterative quantisation: rotations under which centred vectors lie close to the corners of a cube.

    Each starts from another random rotation; a round fixes the signs as codes and solves for the rotation that maps
    the vectors closest to them (orthogonal Procrustes).
    """
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(many):
        rotation = np.linalg.qr(rng.normal(size=(sample.shape[1], sample.shape[1])))[0]
        for _ in range(rounds if len(sample) else 0):
            codes = np.where(sample @ rotation > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(sample.T @ codes)
            rotation = left @ right
        found.append(rotation)
    return np.stack(found)


def plan(rows: int, width: int, cosine: float, recall: float = RECALL) -> tuple[int, int, int]:
    """Bits of a table's key, tables, and rotations, so that buckets stay near ``BUCKET`` rows at any number of rows.

    A bit of two unit vectors at an angle a differs with chance a / pi; a table finds a pair if all its bits agree,
    and as many tables are taken as the wanted recall asks for. A rotation's code is cut into tables.
    """
    bits = min(32, max(4, math.ceil(math.log2(max(1, rows / BUCKET)))), width)
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))
    each = width // bits
    return bits, tables, -(-tables // each)


def pairs_at(sample: np.ndarray, cosine: float, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at the threshold, kind by kind: turned from vectors of the sample to any side, turned
    towards other vectors of the sample, and the sample's own pairs just above the threshold if they are many.
    """
    rng = np.random.default_rng(seed)
    first = sample[rng.integers(0, len(sample), PAIRS)]
    made = []
    for side in (rng.normal(size=first.shape), sample[rng.integers(0, len(sample), PAIRS)]):
        side = side - (side * first).sum(axis=1, keepdims=True) * first
        length = np.linalg.norm(side, axis=1, keepdims=True)
        there = length[:, 0] > 1e-9
        made.append((first[there], (cosine * first + math.sqrt(1 - cosine**2) * side / np.maximum(length, 1e-9))[there]))
    i, j = [], []
    for at in range(0, len(sample), BLOCK):
        near = sample[at : at + BLOCK] @ sample.T
        a, b = np.nonzero((near >= cosine) & (near < cosine + (1 - cosine) / 4))
        a, b = a[a + at < b] + at, b[a + at < b]
        some = rng.permutation(len(a))[:PAIRS]
        i.append(a[some])
        j.append(b[some])
    i, j = (np.concatenate(x) if x else np.zeros(0, dtype=int) for x in (i, j))
    some = rng.permutation(len(i))[:PAIRS]
    made.append((sample[i[some]], sample[j[some]]))
    return [(a, b) for a, b in made if len(a) >= PAIRS // 20]


def table_keys(centred: np.ndarray, turns: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A row of the tables' keys for each centred vector."""
    each = turns.shape[1] // bits if bits else tables
    keys = np.zeros((len(centred), tables), dtype=np.int64)
    for t in range(tables):
        turned = centred @ turns[t // each][:, t % each * bits : (t % each + 1) * bits] > 0
        keys[:, t] = turned @ (1 << np.arange(bits, dtype=np.int64))
    return keys


def learnt_tables(
    sample: np.ndarray, rows: int, cosine: float, recall: float = RECALL
) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The mean of a sample of unit vectors, rotations, bits and tables that find pairs at the threshold.

    Centring changes angles, so the tables of ``plan`` are only the least: pairs made at the threshold go through the
    rotations themselves, and tables are added until each kind of pair is found with the wanted recall. Bits are given
    up, to none and a single bucket, where more tables cost more than larger buckets.
    """
    width = sample.shape[1]
    bits, tables, turns = plan(rows, width, cosine, recall)
    mean = sample.mean(axis=0) if len(sample) else np.zeros(width)
    centred = sample - mean
    found = list(rotations(centred, max(turns, -(-256 // width))))
    kinds = pairs_at(sample, cosine) if len(sample) else []
    if not kinds:
        return mean, np.stack(found), bits, tables
    codes = [tuple(np.concatenate([(x - mean) @ t > 0 for t in found], axis=1) for x in kind) for kind in kinds]
    agree = [(a == b).mean(axis=1) for a, b in codes]

    def wanted(bits: int) -> float:
        """Tables that each kind of pair needs if its bits agree independently."""
        few, many = 0.0, 1.0
        chances = [np.minimum(p**bits, 1 - 1e-12) for p in agree]

        def enough(n: float) -> bool:
            return all((-np.expm1(n * np.log1p(-c))).mean() >= recall for c in chances)

        while not enough(many):
            few, many = many, many * 2
            if many > 1e12:
                return many
        while many - few > max(1.0, many / 1000):
            middle = (few + many) / 2
            few, many = (few, middle) if enough(middle) else (middle, many)
        return many

    def cost(b: int) -> float:
        many = max(wanted(b), tables if b == bits else 1)
        return many * (1 + many / width + rows / 2**b / BUCKET)  # a row's vector, its keys, and whom it meets

    best = min(range(bits, -1, -1), key=cost)
    if best == 0:
        return mean, np.stack(found), 0, 1
    least = tables if best == bits else 1
    each, bits, tables = width // best, best, 0
    caught = [np.zeros(len(a), dtype=bool) for a, _ in kinds]
    while tables < least or min(c.mean() for c in caught) < recall:
        at, place = tables // each, tables % each * bits
        if at == len(found):
            found.append(rotations(centred, 1, seed=[3, at])[0])
        turn = found[at][:, place : place + bits]
        for c, (a, b) in zip(caught, kinds, strict=True):
            c |= (((a - mean) @ turn > 0) == ((b - mean) @ turn > 0)).all(axis=1)
        tables += 1
    return mean, np.stack(found[: -(-tables // each)]), bits, tables


def code_of(centred: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """The first ``CODE`` bits of each centred vector's whole code, rotation after rotation."""
    width = centred.shape[1]
    turned = [centred @ turn > 0 for turn in turns[: -(-CODE // width)]]
    return np.concatenate(turned, axis=1)[:, :CODE]


def hamming_radius(sample: np.ndarray, mean: np.ndarray, turns: np.ndarray, cosine: float) -> int:
    """Bits in which codes may differ, so that of each kind of pairs made at the threshold ``MISSED`` lie beyond it."""
    kinds = pairs_at(sample, cosine) if len(sample) else []
    if not kinds:
        return min(CODE, turns.shape[0] * turns.shape[1])
    apart = [(code_of(a - mean, turns) != code_of(b - mean, turns)).sum(axis=1) for a, b in kinds]
    return int(max(np.quantile(x, 1 - MISSED, method="higher") for x in apart))


class Model(NamedTuple):
    """What is learnt for the vectors of one length."""

    mean: np.ndarray
    turns: np.ndarray
    bits: int
    tables: int
    radius: int

    def spans(self) -> list[tuple[int, int]]:
        """Where the tables' substrings lie in the stored code, for those that lie in it whole."""
        width = self.turns.shape[1]
        each = width // self.bits if self.bits else 1
        starts = [t // each * width + t % each * self.bits for t in range(self.tables)]
        return [(a, a + self.bits) for a in starts if a + self.bits <= min(CODE, len(self.turns) * width)]


def _usable(vector: list | None) -> np.ndarray | None:
    if not vector or any(x is None for x in vector):
        return None
    found = np.array(vector, dtype=np.float64) + 0.0
    return found if np.isfinite(found).all() and found.any() else None


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def learnt_models(rows: DataFrame, cosine: float, recall: float) -> dict[int, Model]:
    """A model for each length that more than ``FEW`` rows have, from about ``SAMPLE`` different vectors of it.

    The sample goes by a hash of the vector alone, so repeated vectors and ids do not enlarge it.
    """
    lengths = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("width")).count()
    common = {r[0]: r[1] for r in lengths.where(F.col("count") > FEW).collect()}
    if not common:
        return {}
    unit = F.pmod(F.xxhash64(F.lit("itq"), F.col("vector")), F.lit(1 << 20)) / (1 << 20)
    wanted = reduce(or_, ((F.size("vector") == w) & (unit < SAMPLE / n) for w, n in common.items()))
    taken = rows.where(wanted).select("vector").distinct().toArrow().column("vector").to_pylist()
    usable = sorted((x for v in taken if (x := _usable(v)) is not None), key=lambda x: x.tobytes())
    models = {}
    for width, many in common.items():
        sample = [x for x in usable if len(x) == width]
        sample = _unit(np.stack(sample)) if sample else np.zeros((0, width))
        mean, turns, bits, tables = learnt_tables(sample, many, cosine, recall)
        models[width] = Model(mean, turns, bits, tables, hamming_radius(sample, mean, turns, cosine))
    return models


def _coded(vectors: DataFrame, shared: Broadcast[dict[int, Model]], kind: str) -> DataFrame:
    """Rows (id, width, vector_key, vector, code, buckets); all but the id are null for vectors that cannot link.

    A bucket is a table's number and the code's substring in it. Lengths without a model have one bucket and no code.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [None if i is None else _usable(v) for i, v in zip(ids, batch.column(1).to_pylist(), strict=True)]
            widths = [None if v is None else len(v) for v in found]
            digests, data, codes, buckets = ([None] * len(ids) for _ in range(4))
            for width in {w for w in widths if w is not None}:
                good = [i for i, w in enumerate(widths) if w == width]
                rows = np.stack([found[i] for i in good])
                code, filed = np.zeros((len(good), 0), dtype=bool), np.zeros((len(good), 1), dtype=np.int64)
                if width in models:
                    model = models[width]
                    centred = _unit(rows) - model.mean
                    code = code_of(centred, model.turns)
                    filed = table_keys(centred, model.turns, model.bits, model.tables)
                    filed += np.arange(model.tables, dtype=np.int64) << 32
                packed = np.packbits(code, axis=1)
                for i, row, bits, keys in zip(good, rows.astype(kind), packed, filed, strict=True):
                    data[i], codes[i], buckets[i] = row.tobytes(), bits.tobytes(), keys
                    digests[i] = hashlib.blake2b(data[i], digest_size=16).digest()
            arrays = [
                batch.column(0), pa.array(widths, pa.int32()), pa.array(digests, pa.binary()), pa.array(data, pa.binary()),
                pa.array(codes, pa.binary()), pa.array(buckets, pa.list_(pa.int64())),
            ]
            names = ["id", "width", "vector_key", "vector", "code", "buckets"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return vectors.mapInArrow(
        run, "id long, width int, vector_key binary, vector binary, code binary, buckets array<bigint>"
    )


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1)


def _near_codes(shared: Broadcast[dict[int, Model]]):
    """Work on units of buckets: members whose code is within the radius of another's not met in an earlier table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for rows in groups(batches, UNIT):
            low, high, block = (rows.column(c).to_numpy() for c in ("low", "high", "block"))
            model = models.get(rows.column("width")[0].as_py())
            near = np.ones((rows.num_rows, rows.num_rows), dtype=bool)
            if model is not None:
                code = np.unpackbits(_matrix(rows.column("code"), "u1"), axis=1)
                sides = code.astype(np.float32) * 2 - 1  # the filling bits of the last byte agree
                near = code.shape[1] - sides @ sides.T <= 2 * model.radius
            if low[0] != high[0]:
                near &= block[:, None] != block[None, :]
            np.fill_diagonal(near, False)
            i, j = np.nonzero(near)
            if model is not None:
                for start, end in model.spans()[: rows.column("bucket")[0].as_py() >> 32]:
                    new = (code[i, start:end] != code[j, start:end]).any(axis=1)
                    i, j = i[new], j[new]
            chosen = np.unique(np.concatenate([i, j]))
            if len(chosen):
                yield from rows.drop(["code"]).take(pa.array(chosen)).combine_chunks().to_batches()

    return run


def _links(cosine: float, kind: str):
    """Work on units of buckets: each member's linked rows that are counted here, and spanning edges of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, UNIT):
            ids, sizes = rows.column("id").to_numpy(), rows.column("size").to_numpy()
            low, high, block = (rows.column(c).to_numpy() for c in ("low", "high", "block"))
            vectors = _matrix(rows.column("vector"), kind).astype(np.float64)
            buckets = np.array(rows.column("buckets").to_pylist(), dtype=np.int64)
            vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            norm = np.linalg.norm(vectors, axis=1)
            near = (vectors @ vectors.T) / np.outer(norm, norm) >= cosine
            if low[0] != high[0]:
                near &= block[:, None] != block[None, :]
            np.fill_diagonal(near, False)
            i, j = np.nonzero(near)
            for earlier in range(rows.column("bucket")[0].as_py() >> 32):  # a pair counts in the first table that has it
                new = buckets[i, earlier] != buckets[j, earlier]
                i, j = i[new], j[new]
            links = np.bincount(i, sizes[j], minlength=len(ids)).astype(np.int64)
            label = np.arange(len(ids))
            while True:
                best = np.minimum(label, np.where(near, label[None, :], len(label)).min(axis=1))
                best = best[best]
                if (best == label).all():
                    break
                label = best
            chosen = np.nonzero(near.any(axis=1))[0]
            arrays = [
                rows.column("n").take(pa.array(chosen)).combine_chunks(),
                pa.array(ids[chosen], pa.int64()),
                pa.array(ids[label[chosen]], pa.int64()),
                pa.array(links[chosen], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["n", "a", "b", "links"])

    return run


def _dealt(filed: DataFrame) -> DataFrame:
    """Rows with the units (low, high) of their bucket and their own block, as ``common.block_pairs`` deals them.

    Only buckets over ``BLOCK`` rows are cut, and their list is written first: Spark sees its size and sends it out if
    it is small, so that codes are shuffled once.
    """
    large = filed.groupBy("width", "bucket").count().where(F.col("count") > BLOCK)
    large = large.select("width", "bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    dealt = filed.join(stage(large, "large"), ["width", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        "width", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "n", "code",
    )


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9,
    recall: float = RECALL,
) -> DataFrame:
    """Groups of vectors by links of cosine >= ``cosine``, as (id_col, n_links, component_id, kept).

    Equal vectors form a class, found by an aggregation, and are linked with each other without being paired. The
    whole code of a class, from one or a few learnt rotations, is cut into substrings, and the class is filed in a
    table for each of them. Members of a bucket meet with their codes alone, large buckets in pairs of blocks; those
    within the Hamming radius of another, in a bucket that is the first they share, are met again with their
    vectors, whose cosine in double precision decides. Tables are as many as the wanted recall asks for at the
    threshold itself, on pairs made there (``learnt_tables``), and the radius keeps such pairs too
    (``hamming_radius``); nearer pairs are found more surely. No link below the threshold is ever reported, and none
    is counted twice.

    Vectors link with those of their own length, each length by a model of its own; lengths of at most ``FEW`` rows
    are compared whole. Null vectors, zero vectors, those with null or non-finite components, or with a null id link
    with nothing; the latter have a null component and are kept. Rows that repeat an id are one vertex; their links
    are counted for each row's own vector. Other columns are not read; an empty table gives an empty one.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    shared = vectors.sparkSession.sparkContext.broadcast(learnt_models(rows, cosine, recall))
    coded = stage(_coded(rows, shared, kind).withColumn("n", F.monotonically_increasing_id()), "coded")

    classes = coded.where("vector_key IS NOT NULL").groupBy("vector_key").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"), F.min("n").alias("n"),
    )
    classes = stage(classes, "classes")
    firsts = coded.join(classes.select("n", "rep", "size"), "n")
    dealt = _dealt(firsts.select("width", "n", "code", F.explode("buckets").alias("bucket")))
    near = in_groups(dealt, UNIT).mapInArrow(
        _near_codes(shared), "width int, bucket long, low int, high int, block int, n long"
    )
    near = stage(near, "near")
    met = near.join(firsts.select("n", F.col("rep").alias("id"), "size", "vector", "buckets"), "n")
    found = in_groups(met, UNIT).mapInArrow(_links(cosine, kind), "n long, a long, b long, links long")
    found = stage(found, "links")
    counts = classes.join(found.groupBy("n").agg(F.sum("links").alias("links")), "n", "left").drop("n")
    members = coded.select("id", "vector_key").join(counts, "vector_key", "left")
    same = members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    joined = components(found.select("a", "b").union(same), "vectors").withColumnRenamed("node", "id")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    n_links = F.coalesce(F.col("size") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return members.join(joined, "id", "left").select(
        F.col("id").alias(id_col), n_links.alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
