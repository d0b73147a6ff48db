import random
import re

import numpy as np
import pytest

from blockloom.llm import near_dup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([" ".join(words)]) if words else frozenset()
    return frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """Sets and components by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return sorted(((i, len(s), top(i), top(i) == i) if i is not None else (i, len(s), None, True) for i, s in sets), key=repr)


def corpus(seed=0):
    """Prose with exact copies, chains of near copies, a group of them, shared passages, and short texts."""
    made = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    prose = lambda n: [made.choice(vocabulary) for _ in range(n)]
    rows = [" ".join(prose(made.randint(3, 300))) for _ in range(120)]
    for size, copies, edits in ((40, 30, 2), (150, 60, 8), (400, 20, 12)):
        base = prose(size)
        for _ in range(copies):
            words = list(base)
            for _ in range(made.randint(0, edits)):
                words[made.randrange(size)] = made.choice(vocabulary)
            rows.append(" ".join(words))
        base = prose(size)
        for _ in range(15):  # each a step from the one before
            base = list(base)
            base[made.randrange(size)] = made.choice(vocabulary)
            rows.append(" ".join(base))
    passage = " ".join(prose(60))
    rows += [" ".join([*prose(made.randint(10, 150)), passage, *prose(10)]) for _ in range(60)]
    rows += [rows[5]] * 40 + [rows[6].upper(), rows[6].replace(" ", "\n\t")]
    rows += ["a b", "A  b", "a b c d e", "a b c d e f", "", " ", None, "é é é é é é", "E e e e e e"]
    made.shuffle(rows)
    return list(enumerate(rows))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(near_dup, "SKETCH_BLOCK", 16)
    monkeypatch.setattr(near_dup, "TEXT_BLOCK", 8)


def found(docs, rows):
    return sorted((tuple(r) for r in near_dup.near_duplicates(docs(rows)).collect()), key=repr)


def test_equals_brute_force(docs):
    rows = corpus()
    assert found(docs, rows) == brute_force(rows)


def test_blocks_lose_no_link(docs, small_blocks):
    rows = corpus(1)
    assert found(docs, rows) == brute_force(rows)


def test_repeated_and_null_ids(docs):
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(3, long), (3, "other words here now and then"), (9, long), (4, "other words here now and then"), (None, long), (None, None), (5, None)]
    assert found(docs, rows) == brute_force(rows)


def test_empty_table(docs):
    assert found(docs, []) == []


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(5)
    for share in (0.0, 0.3, 0.75, 0.95):
        errors = []
        for _ in range(30):
            n = 4000
            both = rng.integers(0, 2**63, int(2 * n * share / (1 + share)), dtype=np.uint64) * np.uint64(2)
            own = [rng.integers(0, 2**63, n - len(both), dtype=np.uint64) * np.uint64(2) for _ in range(2)]
            a, b = (np.unique(np.r_[both, x]) for x in own)
            x, y = near_dup.registers(a), near_dup.registers(b)
            expected = near_dup.collisions(np.array([float(len(a))]), np.array([float(len(b))]))[0]
            errors.append(((x == y).sum() - expected) / near_dup.BUCKETS - share)
        assert abs(np.mean(errors)) < 0.03


def test_collisions_of_unrelated_sets():
    rng = np.random.default_rng(6)
    equal = 0
    for _ in range(3000):
        x, y = (near_dup.registers(np.unique(rng.integers(0, 2**64, 2000, dtype=np.uint64))) for _ in range(2))
        equal += (x == y).sum()
    expected = near_dup.collisions(np.array([2000.0]), np.array([2000.0]))[0]
    assert equal / 3000 == pytest.approx(expected, rel=0.25)
