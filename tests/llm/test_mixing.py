import pytest

from blockloom.llm import mixing

LEVELS = ("domain", "lang", "source")


def targets(spark, leaves, weights, total, epochs):
    table = spark.createDataFrame([(*k.split("/"), n) for k, n in leaves.items()], "domain string, lang string, source string, supply long")
    known = spark.createDataFrame(weights, "level string, name string, weight long")
    return {"/".join(r[:3]): r.target for r in mixing.budgets(table, LEVELS, known, total, epochs).collect()}


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = {"w/en/a": 1000, "w/en/b": 10, "w/de/c": 1000, "b/en/d": 1000}
    found = targets(spark, leaves, [("domain", "w", 3)], 400, 1)
    # w gets 300 and each language of it 150; b is short, so its sibling a takes what is left, and de keeps its part.
    assert found == {"w/en/a": 140, "w/en/b": 10, "w/de/c": 150, "b/en/d": 100}
    leaves = {"w/en/a": 20, "w/en/b": 10, "w/de/c": 1000, "b/en/d": 1000}
    found = targets(spark, leaves, [("domain", "w", 3)], 400, 1)
    assert found == {"w/en/a": 20, "w/en/b": 10, "w/de/c": 270, "b/en/d": 100}
    leaves = {"w/en/a": 20, "w/en/b": 10, "w/de/c": 50, "b/en/d": 1000}
    assert targets(spark, leaves, [("domain", "w", 3)], 400, 1) == {"w/en/a": 20, "w/en/b": 10, "w/de/c": 50, "b/en/d": 320}


def test_epochs_and_weights(spark):
    leaves = {"w/en/a": 100, "w/en/b": 100, "w/en/c": 100}
    found = targets(spark, leaves, [("source", "w/en/a", 5), ("source", "w/en/c", 0)], 600, 3)
    assert found == {"w/en/a": 300, "w/en/b": 300, "w/en/c": 0}
    assert sum(targets(spark, leaves, [], 10**12, 2).values()) == 600


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 3)


def test_prefixes_of_seeded_epochs(docs, spark, small_slices):
    rows = [(i, "w " * (i % 7), "en", f"s{i % 2}") for i in range(60)] + [(100, None, None, None), (101, "a b", None, "s0"), (5, "w " * 5, "en", "s1"), (None, "a", "en", "s0")]
    weights = spark.createDataFrame([("source", "en/s0", 3)], "level string, name string, weight long")
    for seed in (1, 2):
        found = mixing.mix(docs(rows), ("lang", "source"), weights, 1.3, 2, seed).collect()
        for leaf in {(r.lang, r.source) for r in found}:
            mine = [(i, len((t or "").split())) for i, t, lang, source in rows if (lang or "none", source or "none") == leaf]
            supply = sum(n for _, n in mine)
            taken = [r for r in found if (r.lang, r.source) == leaf]
            target = sum(r.n_tokens for r in taken)
            for epoch in {r.epoch for r in taken}:
                got = sorted(((r.doc_id, r.n_tokens) for r in taken if r.epoch == epoch), key=repr)
                if epoch < target // supply:
                    assert got == sorted(mine, key=repr)
                    continue
                import hashlib

                order = sorted(mine, key=lambda x: (hashlib.md5(f"{seed}-{epoch}-{'null' if x[0] is None else x[0]}".encode()).hexdigest(), x[1]))
                assert got == sorted(order[: len(got)], key=repr)


def test_empty_table(docs, spark):
    weights = spark.createDataFrame([], "level string, name string, weight long")
    assert mixing.mix(docs([]), ("lang", "source"), weights, 0.5, 2).count() == 0
