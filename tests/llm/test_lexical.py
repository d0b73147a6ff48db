import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from blockloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(rows, items, k=10):
    counts = [(i, Counter(terms(text))) for i, text in rows]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    held = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (i, c), n in zip(counts, sizes):
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def items_table(spark, items):
    return spark.createDataFrame([(*item, "x", 1) for item in items], "item_id long, text string, doc_id string, score long")


def check(spark, docs, rows, items, k=10):
    frame = lexical.search(docs(rows), items_table(spark, items), k)
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == brute_force(rows, items, k)


@pytest.fixture
def small(monkeypatch):
    """Many segments per task, and few ranges opened at once."""
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 50)
    monkeypatch.setattr(lexical, "OPENED", 3)


def corpus(seed, size):
    made = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(300)] + ["Über", "éa", "日本", "X9", "x9"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    prose = lambda n: " ".join(made.choices(vocabulary, weights, k=n)).replace(" ", made.choice([" ", ", ", "\n", "\x00-"]))
    rows = [(made.randrange(10 * size), prose(made.randint(1, 200))) for _ in range(size)]
    return rows, [(n, prose(made.randint(1, 40))) for n in range(30)]


def test_equals_plain_python(spark, docs, odd):
    rows, items = corpus(1, 600)
    rows += [(70_000 + n, text) for n, text in enumerate(odd)]
    rows += [(None, rows[3][1]), (None, rows[3][1]), *[(5, rows[4][1])] * 30, *[(90_000 - n, rows[5][1]) for n in range(40)]]
    items += [(100, None), (101, ""), (102, "..."), (103, "nowhere found"), (104, rows[3][1]), (105, rows[5][1]), (106, rows[4][1])]
    items += [(0, items[0][1]), (1, "w1 w2 w3"), (None, "w4")]
    check(spark, docs, rows, items)


def test_many_segments_and_ties(small, spark, docs):
    rows, items = corpus(2, 500)
    rows += [(1_000_000 - n, "w7 w9 w11") for n in range(300)]
    check(spark, docs, rows, [*items, (50, "w9 w11 W7")], 7)


def test_empty_tables(spark, docs):
    rows, items = corpus(3, 5)
    check(spark, docs, [], items)
    check(spark, docs, rows, [])
    check(spark, docs, [(1, None), (2, " . ")], items)


def test_blocks_of_items(monkeypatch, spark, docs):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 200)
    rows, items = corpus(4, 60)
    assert len(lexical._item_blocks(items_table(spark, items).selectExpr("item_id", "cast(text as binary) words"))) > 5
    check(spark, docs, rows, items)


def test_pieces_do_not_cut_terms(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 7)
    text = "ab ABCDEFGHIJKLM.. é" + "日" * 30 + " x" * 9
    assert [t.decode() for piece in lexical.terms_of(text.encode()) for t in piece] == terms(text)


def test_packed_cells_are_the_same():
    made = np.random.default_rng(5)
    cells = np.unique(made.integers(0, 1 << 14, 900))
    weights = made.integers(0, 1_000_000, len(cells))
    treap = lexical.Treap.of(cells >> 7, cells & 127, weights, 7)
    again = lexical.Treap.unpacked(*treap.packed())
    assert again.depth == 7 and (again.children == treap.children).all() and (again.most == treap.most).all()


def test_opens_few_ranges_where_one_document_stands_out(monkeypatch):
    """Best first: with one far better document, the rest of the grid stays closed."""
    monkeypatch.setattr(lexical, "OPENED", 1)
    opened = []
    treap = lexical.Treap.of(np.zeros(4096, int), np.arange(4096), np.where(np.arange(4096) == 77, 900, 3), 12)
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: opened.append(1) or lexsort(keys))
    assert treap.best(np.array([0]), np.array([2]), np.arange(4096), [], 1) == [(-1800, 77)]
    assert len(opened) <= 13
