import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blockloom.llm import common


def by_hand(edges):
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {x: top(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("shape", ("random", "chain", "star", "none"))
def test_components(spark, shape):
    made = random.Random(1)
    edges = {
        "random": [(made.randrange(300), made.randrange(300)) for _ in range(200)] + [(5, 5), (7, 7)],
        "chain": [(i, i + 1) for i in range(120)][::-1],
        "star": [(500, i) for i in range(200)] + [(900, 901)],
        "none": [],
    }[shape]
    found = common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    assert {r.node: r.component for r in found} == by_hand(edges) and len(found) == len(by_hand(edges))


def test_groups_are_whole():
    keys = [1, 1, 2, 3, 3, 3, 4, 4]
    batches = [pa.RecordBatch.from_pydict({"k": keys[a:b], "v": list(range(a, b))}) for a, b in ((0, 1), (1, 4), (4, 4), (4, 8))]
    found = [(t.column("k")[0].as_py(), t.column("v").to_pylist()) for t in common.groups(iter(batches), ["k"])]
    assert found == [(1, [0, 1]), (2, [2]), (3, [3, 4, 5]), (4, [6, 7])]


def test_any_two_rows_of_a_group_meet_once(spark):
    rows = spark.range(60).select((F.col("id") % 3).alias("g"), F.col("id")).where("id <> 2 AND NOT (g = 2 AND id > 5)")
    dealt = common.block_pairs(rows, ["g"], "id", 4).collect()
    units = {}
    for r in dealt:
        units.setdefault((r.g, r.low, r.high), []).append(r)
    met = {}
    for (g, low, high), members in units.items():
        for a in members:
            for b in members:
                if a.id < b.id and {a.block, b.block} == {low, high}:
                    met[a.id, b.id] = met.get((a.id, b.id), 0) + 1
    ids = {g: [i for i in range(60) if i % 3 == g] for g in (0, 1)}
    assert met == {(a, b): 1 for x in ids.values() for a in x for b in x if a < b}
