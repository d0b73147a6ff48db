import hashlib
import random
import zlib

import numpy as np
import pytest

from blockloom.llm import manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    if value is None:
        return "-"
    return f"{len(str(value).encode())}:{value}"


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return H(*[field(x) for x in (doc_id, source, lang, n_chars, text)])


def proofs(nodes):
    """The root over nodes, and for each node its levels: the digests of its run and its place there."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 3] for k in range(0, len(nodes), 3)]
        for k, place in enumerate(at):
            ways[k].append((runs[place // 3], place % 3))
        at = [place // 3 for place in at]
        nodes = [H(*run) for run in runs]
    return nodes[0], ways


def brute_force(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, its in by_source.items():
        its.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = proofs([leaf(r) for r in its])
    root, tops = proofs([trees[s][0] for s in order])
    out = []
    for source, top in zip(order, tops):
        subroot, ways = trees[source]
        for row, way in zip(by_source[source], ways):
            changed = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                changed[1] = row[1].replace("\n", "")
            folded, siblings = leaf(changed), []
            for run, place in way + top:
                siblings += run[:place] + run[place + 1 :]
                folded = H(*run[:place], folded, *run[place + 1 :])
            out.append((row[0], leaf(row), subroot, root, H(*siblings), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(frame, rows):
    # The fixture's tables have the length of the text as n_chars.
    full = [(*row, *[None] * (4 - len(row)), len(row[1] or "")) for row in rows]
    assert frame.columns == COLUMNS
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == brute_force(full)


def test_equals_plain_python(spark, docs, odd):
    made = random.Random(3)
    rows = [(made.randrange(4000), f"line {k}\nof {made.randrange(9)}\n", made.choice(["en", None]), made.choice(["a", "b", "é", "", None, "z"])) for k in range(700)]
    rows += [(5000 + k, text, "en", f"own{k}") for k, text in enumerate(odd)]
    rows += [(None, "no\nid", "en", "a"), (None, "no\nid", "en", "a"), (None, None, None, None), *[(7, "same\n", "de", "a")] * 40]
    check(manifest.manifest(docs(rows)), rows)


def test_sources_of_any_size(docs):
    rows = [(k * 7 % 1009 * 10_000 + k, f"{size}-{k}\n", "en", f"s{size}") for size in (1, 2, 3, 4, 9, 10, 728, 730, 2300) for k in range(size)]
    check(manifest.manifest(docs(rows)), rows)


@pytest.mark.parametrize("size", [1, 800])
def test_one_source(docs, size):
    rows = [(k, f"t{k}\n", "en", "only") for k in range(size)]
    check(manifest.manifest(docs(rows)), rows)


def test_many_sources_of_one_document(docs):
    rows = [(k, f"t{k}\n", "en", f"s{k * 31 % 997}") for k in range(997)]
    check(manifest.manifest(docs(rows)), rows)


def test_empty_table(docs):
    assert manifest.manifest(docs([])).collect() == []


def test_states_are_those_of_sha256():
    made = np.random.default_rng(1)
    digests = made.integers(0, 1 << 32, (5, 8)).astype(np.uint32)
    states = np.tile(manifest.START, (5, 1))
    for count in range(4):
        text = [h.hex() * count for h in manifest.bytes_of(digests)]
        found = manifest.finish(states, np.full(5, count))
        assert [h.hex() for h in manifest.bytes_of(found)] == [H(t) for t in text]
        states = manifest.absorb(states, digests)


def test_folding_uses_right_siblings_only():
    made = np.random.default_rng(2)
    run = made.integers(0, 1 << 32, (3, 8)).astype(np.uint32)
    group, pos, total = np.zeros(3, int), np.arange(3), np.full(3, 3)
    roots, _, ((mine, step),) = manifest.climb(group, pos, total, run)
    assert list(mine) == [0, 1, 2] and (roots == roots[0]).all()
    step.siblings[2] = 0  # the last child has no right sibling: what stands left is in the state
    step.siblings[1, 0] = 0
    assert (step.fold(run) == roots).all()
    other = run.copy()
    other[1, 3] ^= 1
    assert (step.fold(other)[1] != roots[1]).any()
