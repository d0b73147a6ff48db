import hashlib
import random

import pytest

from blockloom.llm import sharding


def bits(key):
    return int(hashlib.md5(b"" if key is None else f"k{key}".encode()).hexdigest()[:15], 16)


def brute_force(rows, limit):
    sized = [(i, len((t or "").encode()), bits(i)) for i, t in rows]
    found = []
    for i, n, h in sized:
        for depth in range(61):
            same = [m for _, m, g in sized if g >> (60 - depth) == h >> (60 - depth)]
            if sum(same) <= limit or depth == 60:
                break
        prefix = f"{h >> (60 - depth):0{depth}b}" if depth else ""
        found.append((i, n, prefix, depth, sum(same), len(same), sum(same) > limit))
    return sorted(found, key=repr)


@pytest.mark.parametrize("limit", (10**9, 3000, 300, 50))
@pytest.mark.parametrize("margin", (4, 0))
def test_equals_brute_force(docs, monkeypatch, limit, margin):
    monkeypatch.setattr(sharding, "MARGIN", margin)
    made = random.Random(3)
    rows = [(i, "x" * made.choice((0, 1, 10, 40, 120))) for i in range(150)] + [(7, "é" * 90)] * 3 + [(None, "n" * 45), (None, None)]
    found = sharding.shard_rows(docs(rows), limit).collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows, limit)


def test_empty_table(docs, tmp_path):
    assert sharding.shard_rows(docs([]), 100).count() == 0


def test_written_shards(docs, spark, tmp_path):
    rows = docs([(i, "x" * 50) for i in range(200)]).drop("n_tokens")
    shards = sharding.write_shards(rows, str(tmp_path / "out"), 1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    sizes = {r[0]: r[1] for r in back.groupBy("__shard").count().collect()}
    assert sum(sizes.values()) == 200 and max(sizes.values()) * 50 <= 1000
    assert sorted(sizes.values()) == sorted(r.shard_rows for r in shards.collect())
