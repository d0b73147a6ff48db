import numpy as np
import pytest

from blockloom.llm import vectors


def made(seed=0, n=600, width=32):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width))
    for i in range(n // 3):  # pairs of every nearness around the threshold, and some chains
        angle = rng.uniform(0.05, 0.7)
        side = rng.normal(size=width)
        base = rows[rng.integers(n // 2, n)]
        side -= side @ base / (base @ base) * base
        rows[i] = np.cos(angle) * base + np.sin(angle) * side / np.linalg.norm(side) * np.linalg.norm(base)
    rows[n - 40 :] = rows[n - 41] + rng.normal(size=(40, width)) * 0.05
    rows[10:20] = rows[9]
    return rows.astype(np.float32)


def brute_force(rows, cosine=0.9):
    x = rows.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        best = np.minimum(label, np.where(near, label[None, :], len(x)).min(axis=1))
        if (best == label).all():
            return near.sum(axis=1), label
        label = best


@pytest.fixture(scope="module")
def table(spark):
    kind = "vec_id long, embedding array<float>, label int, links long, size int, vector string"

    def make(rows):
        return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, None, None, None) for i, v in rows], kind)

    return make


def test_no_false_links_and_recall(table, monkeypatch):
    links = found = 0
    for seed, block in ((0, 1024), (1, 16)):
        monkeypatch.setattr(vectors, "BLOCK", block)
        rows = made(seed)
        n, label = brute_force(rows)
        got = {r[0]: r for r in vectors.near_vectors(table(enumerate(rows))).collect()}
        mine = np.array([got[i].n_links for i in range(len(rows))])
        assert len(got) == len(rows) and (mine <= n).all()
        assert all(label[got[i].component_id] == label[i] and got[i].kept == (got[i].component_id == i) for i in got)
        links, found = links + n.sum(), found + mine.sum()
    assert found >= 0.97 * links


def test_hopeless_vectors_link_with_nothing(table):
    good = [1.0, 2.0, 3.0]
    rows = [
        (1, good), (2, [2.0, 4.0, 6.0]), (3, None), (4, [0.0] * 3), (5, [float("nan"), 1, 1]), (6, [float("inf"), 1, 1]),
        (7, [None, 2.0, 3.0]), (8, [1.0, 2.0]), (9, []), (None, good), (2, [-3.0, 0.0, 1.0]), (1, good), (12, [1e30, 2e30, 3e30]),
    ]
    found = sorted((tuple(r) for r in vectors.near_vectors(table(rows)).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    wanted = [(1, 3, 1, True)] * 2 + [(12, 3, 1, False), (2, 3, 1, False), (2, 0, 1, False), (None, 0, None, True)]
    assert found == sorted(alone + wanted, key=repr)


def test_empty_table(table):
    assert vectors.near_vectors(table([])).count() == 0


def test_plan_meets_the_recall_at_any_size():
    for rows in (10, 10**4, 10**7, 10**10):
        bits, tables, turns = vectors.plan(rows, 64, 0.9)
        missed = (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables
        assert missed <= 0.01 + 1e-9 and turns * (64 // bits) >= tables


def test_rotations_are_rotations():
    sample = np.random.default_rng(2).normal(size=(500, 8)) * np.arange(1, 9)
    for turn in vectors.rotations(sample, 2):
        assert np.allclose(turn.T @ turn, np.eye(8))


@pytest.mark.parametrize("norm", [0.71, 0.83])
def test_recall_with_a_common_mean_under_the_tables_of_ten_million_rows(norm):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    mean = np.r_[norm, np.zeros(63)]
    made = unit(mean + np.sqrt(1 - norm**2) * unit(rng.normal(size=(6000, 64))))
    sample, x = made[:3000], made[3000:]
    side = rng.normal(size=x.shape)
    side = unit(side - (side * x).sum(axis=1, keepdims=True) * x)
    cosine = rng.uniform(0.9, 0.92, (len(x), 1))
    y = cosine * x + np.sqrt(1 - cosine**2) * side
    middle, turns, bits, tables = vectors.learnt_tables(sample, 10**7, 0.9)
    keys = [vectors.table_keys(v - middle, turns, bits, tables) for v in (x, y)]
    assert (keys[0] == keys[1]).any(axis=1).mean() >= 0.985


def test_vectors_that_are_all_near_their_mean_share_a_bucket():
    rng = np.random.default_rng(6)
    sample = np.r_[1.0, np.zeros(31)] + 0.01 * rng.normal(size=(500, 32))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    mean, turns, bits, tables = vectors.learnt_tables(sample, 10**5, 0.9)
    assert bits * tables < 2000
    assert vectors.table_keys(sample - mean, turns, bits, tables).shape == (500, tables)


def test_vectors_link_with_those_of_their_own_length(table):
    rng = np.random.default_rng(7)
    long, short = rng.normal(size=(400, 16)), rng.normal(size=(300, 8))
    long[:60] = long[100:160] + 0.1 * rng.normal(size=(60, 16))
    short[:40] = short[100:140] * 3
    rare = [[1.0, 2.0, 3.0], [2.0, 4.0, 6.1]]
    rows = [*long.astype(np.float32), *short.astype(np.float32), *np.float32(rare)]
    found = {r.vec_id: r for r in vectors.near_vectors(table(enumerate(rows))).collect()}
    assert len(found) == len(rows)
    for start, part in ((0, long), (400, short), (700, np.array(rare))):
        n, label = brute_force(part.astype(np.float32))
        mine = [found[start + i] for i in range(len(part))]
        assert sum(r.n_links for r in mine) >= 0.97 * n.sum() and all(r.n_links <= m for r, m in zip(mine, n, strict=True))
        assert all(r.component_id >= start and label[r.component_id - start] == label[i] for i, r in enumerate(mine))


def test_many_rows_of_one_id_are_sampled_by_their_vectors(table):
    rows = made(3)
    found = vectors.near_vectors(table([(5, v) for v in rows] + [(5, rows[0])] * 300 + [(None, rows[1])] * 50)).collect()
    n, _ = brute_force(np.concatenate([rows, rows[:1].repeat(300, axis=0)]))
    mine = [r.n_links for r in found if r.vec_id is not None]
    assert len(mine) == 900 and 0.97 * n.sum() <= sum(mine) <= n.sum()
    assert all(r.component_id == r.vec_id and r.kept for r in found)
    assert sum(r.vec_id is None and r.n_links == 0 for r in found) == 50


def test_radius_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    sample, x = unit(rng.normal(size=(3000, 64))), unit(rng.normal(size=(3000, 64)))
    side = rng.normal(size=x.shape)
    side = unit(side - (side * x).sum(axis=1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * side
    mean, turns, bits, tables = vectors.learnt_tables(sample, 50_000, 0.9)
    radius = vectors.hamming_radius(sample, mean, turns, 0.9)
    codes = [vectors.code_of(v - mean, turns) for v in (x, y, x[::-1])]
    assert ((codes[0] != codes[1]).sum(axis=1) <= radius).mean() >= 0.997
    assert ((codes[0] != codes[2]).sum(axis=1) <= radius).mean() <= 0.005
    model = vectors.Model(mean, turns, bits, tables, radius)
    keys = vectors.table_keys(x - mean, turns, bits, tables)
    for t, (start, end) in enumerate(model.spans()):
        assert (codes[0][:, start:end] @ (1 << np.arange(bits)) == keys[:, t]).all()


def test_tables_shuffle_codes_only(spark, table):
    rows = spark.createDataFrame([(i, 16, i, bytes(8), [1, 2]) for i in range(4)], "n long, width int, id long, code binary, buckets array<long>")
    dealt = vectors._dealt(rows.selectExpr("width", "n", "code", "explode(buckets) AS bucket"))
    assert dealt.columns == ["width", "bucket", "low", "high", "block", "n", "code"] and dealt.count() == 8
