"""Merkle manifest of a table: a tree per source, a tree over the sources, and proofs folded from kept hash states.

A node hashes the hex digests of at most three children. One hex digest fills one SHA-256 block, so the state before
each child slot is just eight words: a parent keeps a copy of it per slot. Folding a replaced child resumes the state
of its slot with the replacement and hashes right siblings only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from blockloom.llm.common import arrow_schema, table_of, whole_groups
from blockloom.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

ARITY = 3
#: Levels of a tree that one task builds and folds: subtrees of 3^6 leaves.
LEVELS = 6
SPAN = ARITY**LEVELS

WORD = np.uint32


def _root_bits(n: int, power: int) -> int:
    """The first 32 bits of the fraction of a root of n, by whole numbers."""
    scaled = n << (32 * power)
    low, high = 0, 1 << 40
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**power <= scaled else (low, middle - 1)
    return low & 0xFFFFFFFF


_PRIMES = [n for n in range(2, 312) if all(n % k for k in range(2, int(n**0.5) + 1))]
#: FIPS 180-4: fractions of the square roots of 8 primes, and of the cube roots of 64.
START = np.array([_root_bits(p, 2) for p in _PRIMES[:8]], WORD)
ROUNDS = np.array([_root_bits(p, 3) for p in _PRIMES[:64]], WORD)

_HEX = np.frombuffer("".join(f"{n:04x}" for n in range(1 << 16)).encode(), ">u4").astype(WORD)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> WORD(n)) | (x << WORD(32 - n))


def _rows(columns: np.ndarray) -> np.ndarray:
    """Turned round, with each word of all items side by side in memory."""
    return np.ascontiguousarray(columns.T)


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (8, n) after one block (16, n) each."""
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        small = _turn(x, 7) ^ _turn(x, 18) ^ (x >> WORD(3))
        w.append(w[t - 16] + small + w[t - 7] + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> WORD(10))))
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUNDS[t] + w[t]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def absorb(states: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States (n, 8) after the hex text of one digest (n, 8) each."""
    out = np.empty_like(states)
    for k in range(0, len(states), 4096):  # arrays that stay in the cache
        words = digests[k : k + 4096]
        halves = np.stack([words >> WORD(16), words & WORD(0xFFFF)], 2).reshape(len(words), 16)
        out[k : k + 4096] = _compress(_rows(states[k : k + 4096]), _rows(_HEX[halves])).T
    return out


def finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 8) of states that have taken in so many blocks each."""
    out = np.empty_like(states)
    for k in range(0, len(states), 4096):
        bits = blocks[k : k + 4096].astype(np.uint64) * np.uint64(512)
        last = np.zeros((16, len(bits)), WORD)
        last[0] = 1 << 31
        last[14], last[15] = (bits >> np.uint64(32)).astype(WORD), bits.astype(WORD)
        out[k : k + 4096] = _compress(_rows(states[k : k + 4096]), last).T
    return out


def words_of(column: pa.Array) -> np.ndarray:
    """A column of 32-byte values as (n, 8) words."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(WORD).reshape(-1, 8)


def bytes_of(words: np.ndarray) -> list[bytes]:
    raw = words.astype(">u4").tobytes()
    return [raw[k : k + 32] for k in range(0, len(raw), 32)]


class Step:
    """What nodes need of their parents: slot, number of children, the state before the slot, the siblings in order."""

    #: slot, children, state, two siblings
    RECORD = np.dtype([("slot", "u1"), ("children", "u1"), ("before", ">u4", 8), ("siblings", ">u4", (2, 8))])

    def __init__(self, slot: np.ndarray, children: np.ndarray, before: np.ndarray, siblings: np.ndarray):
        self.slot, self.children, self.before, self.siblings = slot, children, before, siblings

    def records(self) -> np.ndarray:
        packed = np.zeros(len(self.slot), self.RECORD)
        for name in self.RECORD.names:
            packed[name] = getattr(self, name)
        return packed

    @classmethod
    def of(cls, records: np.ndarray) -> Step:
        return cls(
            records["slot"].astype(np.int64), records["children"].astype(np.int64),
            records["before"].astype(WORD), records["siblings"].astype(WORD),
        )

    def fold(self, digests: np.ndarray) -> np.ndarray:
        """The parents' digests with these in the nodes' slots."""
        states = absorb(self.before, digests)
        for k in range(ARITY - 1):
            right = np.flatnonzero((k >= self.slot) & (k < self.children - 1))
            if len(right):
                states[right] = absorb(states[right], self.siblings[right, k])
        return finish(states, self.children)

    def prove(self, states: np.ndarray, blocks: np.ndarray) -> None:
        """Take the siblings into the proofs' states, in place."""
        for k in range(ARITY - 1):
            there = np.flatnonzero(k < self.children - 1)
            if len(there):
                states[there] = absorb(states[there], self.siblings[there, k])
                blocks[there] += 1


def climb(group: np.ndarray, pos: np.ndarray, total: np.ndarray, digests: np.ndarray):
    """Build subtrees over nodes that are sorted by group and position.

    Returns the digests of the subtrees' roots per node, how many nodes their level has, and for each level the nodes
    that have a parent there, with their ``Step``. A node without another beside it on its level is a root and stays.
    """
    at = np.arange(len(pos))  # the ancestor of each input node on the level
    steps: list[tuple[np.ndarray, Step]] = []
    for _ in range(LEVELS):
        below = total > 1
        if not below.any():
            break
        up = np.where(below, pos // ARITY, pos)
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (up[1:] != up[:-1])])
        parent = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        children = np.diff(np.append(first, len(pos)))
        slot = np.arange(len(pos)) - first[parent]
        real = below[first]
        before = np.zeros((len(first), ARITY, 8), WORD)
        child = np.zeros((len(first), ARITY, 8), WORD)
        state = np.tile(START, (len(first), 1))
        for k in range(ARITY):
            has = np.flatnonzero(real & (k < children))
            before[:, k] = state
            child[has, k] = digests[first[has] + k]
            if len(has):
                state[has] = absorb(state[has], child[has, k])
        mine = np.flatnonzero(below[at])
        p, s = parent[at[mine]], slot[at[mine]]
        others = np.stack([np.where(s == 0, 1, 0), np.where(s == 2, 1, 2)], 1)
        steps.append((mine, Step(s, children[p], before[p, s], child[p[:, None], others])))
        above = digests[first].copy()
        done = np.flatnonzero(real)
        above[done] = finish(state[done], children[done])
        group, pos, digests = group[first], up[first], above
        total = np.where(real, -(-total[first] // ARITY), 1)
        at = parent[at]
    return digests[at], total[at], steps


def _nodes(rows: pa.Table, chunk: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group numbers, positions and level sizes of rows that are sorted by source and position."""
    source = np.asarray(rows.column("branch").combine_chunks().dictionary_encode().indices)
    part = rows.column(chunk).to_numpy()
    new = (source[1:] != source[:-1]) | (part[1:] != part[:-1])
    return np.concatenate([[0], np.cumsum(new)]), rows.column("pos").to_numpy(), rows.column("total").to_numpy()


def placed(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Rows with ``pos``, their place in ``branch`` by ``order`` from 0, and ``total``, the rows of the branch.

    The rows are sorted over the cluster by ranges. Each range counts its rows per branch, and only these counts are
    summed along a branch: no task sorts a hot branch.
    """
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), f"{label}-rows")
    keys = ["branch", *order, "row"]  # the row number deals out even equal rows

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("branch").dictionary_encode()
            at = np.asarray(codes.indices)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            sizes = np.diff(np.append(first, len(at)))
            within = np.arange(len(at)) - np.repeat(first, sizes)
            names = codes.dictionary.to_pylist()
            if names[at[0]] == last:
                within[: sizes[0]] += count
            last, count = names[at[-1]], int(within[-1]) + 1
            columns = [*batch.drop_columns(["row"]).columns, pa.array(np.full(len(at), part, np.int64)), pa.array(within, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.fieldNames())

    out = rows.drop("row").schema.add("part", "long").add("within", "long")
    ranged = rows.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(number, out)
    ranged = stage(ranged, f"{label}-ranged")
    parts = ranged.groupBy("branch", "part").agg(F.count(F.lit(1)).alias("rows"))
    parts = stage(parts, f"{label}-parts")
    totals = parts.groupBy("branch").agg(F.sum("rows").alias("total"))
    # A branch has at most one row here per range.
    before = F.expr("sum(rows) OVER (PARTITION BY branch ORDER BY part) - rows")
    offsets = stage(parts.withColumn("before", before).join(totals, "branch").drop("rows"), f"{label}-offsets")
    joined = ranged.join(offsets, ["branch", "part"])
    return joined.withColumn("pos", F.col("before") + F.col("within")).drop("part", "within", "before")


def ascend(nodes: DataFrame, label: str) -> DataFrame:
    """The way up from each node (branch, pos, total, digest): (branch, pos, steps, top).

    ``steps`` has the records of all levels above the node and ``top`` is the digest of the branch's root. A round
    builds subtrees of ``SPAN`` nodes; their roots are the nodes of the next.
    """
    if (nodes.agg(F.max("total")).first()[0] or 1) == 1:
        return nodes.select("branch", "pos", F.lit(b"").alias("steps"), F.col("digest").alias("top"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["branch", "up"], 4096):
            group, pos, total = _nodes(rows, "up")
            roots, above, levels = climb(group, pos, total, words_of(rows.column("digest")))
            steps = [b""] * len(pos)
            for mine, step in levels:
                packed, size = step.records().tobytes(), Step.RECORD.itemsize
                for k, n in enumerate(mine):
                    steps[n] += packed[k * size : (k + 1) * size]
            yield table_of(packed_schema, rows.column("branch"), pos, rows.column("up"), steps, bytes_of(roots), above)

    schema = "branch string, pos long, up long, steps binary, digest binary, total long"
    packed_schema = arrow_schema(schema)
    dealt = nodes.withColumn("up", F.expr(f"pos div {SPAN}")).repartition("branch", "up")
    built = dealt.sortWithinPartitions("branch", "up", "pos").mapInArrow(run, schema)
    built = stage(built, f"{label}-nodes")
    roots = built.where(f"pos % {SPAN} = 0").select("branch", F.col("up").alias("pos"), "total", "digest")
    above = ascend(roots, label).select("branch", F.col("pos").alias("up"), F.col("steps").alias("rest"), "top")
    joined = built.drop("digest", "total").join(above, ["branch", "up"])
    return stage(joined.select("branch", "pos", F.concat("steps", "rest").alias("steps"), "top"), f"{label}-ways")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame, tampered: Column | None = None, text_col: str = "text", changed: Column | None = None) -> DataFrame:
    """Leaf digests of documents: (branch, doc_id, leaf, changed); ``branch`` stands for the source.

    ``changed`` is the digest with the text ``changed`` where ``tampered`` holds, and else the leaf. A null column
    counts as ``-``; every row is a leaf, also an equal one.
    """

    def digest(text: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*[_field(text if name == text_col else F.col(name)) for name in FIELDS]), 256))

    rows = docs.select(*FIELDS)
    leaf = digest(F.col(text_col))
    other = leaf if tampered is None else F.when(tampered, digest(changed)).otherwise(leaf)
    branch = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("+"), "source"))
    return rows.select(branch.alias("branch"), "doc_id", leaf.alias("leaf"), other.alias("changed"))


def fold(leaf_rows: DataFrame) -> DataFrame:
    """Build the manifest of ``leaves`` and fold every ``changed`` leaf to a root through the states its parents keep.

    Returns one row per leaf: doc_id, leaf, subroot (of its source), root, proof_sha256 (of its siblings' digests,
    level by level), folded_root, verified (folded_root is root); digests are lowercase hex. Leaves of a source
    ascend by doc_id, nulls first, equal ids by their digests; equal rows get places of their own, so the rows as a
    whole do not depend on their order. Sources ascend by their bytes, null first. A source of one leaf has it as
    subroot, and a single source its subroot as root; a proof without siblings hashes nothing. No rows, no rows.

    A task builds subtrees of ``SPAN`` leaves, so neither a hot source nor the number of sources gathers anywhere;
    a row carries digests and states only, never texts.
    """

    def bottom(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["branch", "chunk"], 4096):
            group, pos, total = _nodes(rows, "chunk")
            roots, above, levels = climb(group, pos, total, words_of(rows.column("leaf")))
            folded = words_of(rows.column("changed"))
            proof, blocks = np.tile(START, (len(pos), 1)), np.zeros(len(pos), np.int64)
            for mine, step in levels:
                folded[mine] = step.fold(folded[mine])
                states, counts = proof[mine], blocks[mine]
                step.prove(states, counts)
                proof[mine], blocks[mine] = states, counts
            kept = [rows.column(k) for k in ("branch", "chunk", "pos", "doc_id", "leaf")]
            yield table_of(low_schema, *kept, bytes_of(folded), bytes_of(proof), blocks, bytes_of(roots), above)

    ids = leaf_rows.schema["doc_id"].dataType.simpleString()
    middle = f"branch string, chunk long, pos long, doc_id {ids}, leaf binary, folded binary, proof binary, blocks long, digest binary, total long"
    low_schema = arrow_schema(middle)
    chunked = placed(leaf_rows, ["doc_id", "leaf"], "leaves").withColumn("chunk", F.expr(f"pos div {SPAN}"))
    sorted_rows = chunked.repartition("branch", "chunk").sortWithinPartitions("branch", "chunk", "pos")
    low = stage(sorted_rows.mapInArrow(bottom, middle), "low-trees")

    nodes = low.where(f"pos % {SPAN} = 0").select("branch", F.col("chunk").alias("pos"), "total", "digest")
    ways = ascend(nodes, "branch")
    subroots = ways.where("pos = 0").select(F.lit("").alias("branch"), F.col("branch").alias("name"), F.col("top").alias("digest"))
    ranked = stage(placed(subroots, ["name"], "subroots"), "ranked-subroots")
    above = ascend(ranked.drop("name"), "top").select("pos", F.col("steps").alias("rest"), F.col("top").alias("root"))
    above = ranked.select("pos", F.col("name").alias("branch")).join(above, "pos").drop("pos")
    ways = ways.join(above, "branch").select(
        "branch", F.col("pos").alias("chunk"), F.concat("steps", "rest").alias("steps"), F.col("top").alias("subroot"), "root"
    )
    # The way of a chunk goes ahead of its leaves, once.
    both = low.drop("digest", "total").unionByName(ways.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)

    def upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["branch", "chunk"], 4096):
            head = rows.column("pos").to_numpy() < 0
            way = (np.cumsum(head) - 1)[~head]
            heads, rows = rows.filter(pa.array(head)), rows.filter(pa.array(~head))
            packed = heads.column("steps").to_pylist()
            counts = np.array([len(p) // Step.RECORD.itemsize for p in packed])
            starts = np.cumsum(counts) - counts
            records = np.frombuffer(b"".join(packed), Step.RECORD)
            folded, proof = words_of(rows.column("folded")), words_of(rows.column("proof"))
            blocks = rows.column("blocks").to_numpy().copy()
            for k in range(counts.max(initial=0)):
                mine = np.flatnonzero(counts[way] > k)
                step = Step.of(records[starts[way[mine]] + k])
                folded[mine] = step.fold(folded[mine])
                states, number = proof[mine], blocks[mine]
                step.prove(states, number)
                proof[mine], blocks[mine] = states, number
            subroot, root = (heads.column(k).take(pa.array(way)) for k in ("subroot", "root"))
            yield table_of(out_schema, rows.column("doc_id"), rows.column("leaf"), subroot, root, bytes_of(finish(proof, blocks)), bytes_of(folded))

    last = f"doc_id {ids}, leaf binary, subroot binary, root binary, proof_sha256 binary, folded_root binary"
    out_schema = arrow_schema(last)
    done = both.repartition("branch", "chunk").sortWithinPartitions("branch", "chunk", "pos").mapInArrow(upper, last)
    digests = [F.lower(F.hex(k)).alias(k) for k in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    return done.select("doc_id", *digests, (F.col("root") == F.col("folded_root")).alias("verified"))


def manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, checked against documents that have lost their line ends where 2 divides the crc32 of
    their id; see ``fold``. Null ids and null texts are not tampered with."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    return fold(leaves(docs, tampered, changed=F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
