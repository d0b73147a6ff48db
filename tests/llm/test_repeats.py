import random
import re
from collections import Counter

import numpy as np
import pytest

from blockloom.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, length):
    split = [(i, WORD.findall(text or "")) for i, text in rows]
    times = Counter(tuple(w[p : p + length]) for _, w in split for p in range(len(w) - length + 1))
    out = []
    for i, words in split:
        gone = {q for p in range(len(words) - length + 1) if times[tuple(words[p : p + length])] > 1 for q in range(p, p + length)}
        out.append((i, len(words), len(gone), " ".join(w for q, w in enumerate(words) if q not in gone)))
    return sorted(out, key=repr)


def check(docs, rows, length=35):
    frame = repeats.remove_repeats(docs(rows), length)
    assert frame.columns == ["doc_id", "n_words", "n_removed", "kept"]
    found = sorted((tuple(r) for r in frame.collect()), key=repr)
    assert found == brute_force(rows, length)
    return found


def corpus(seed, size, words=400):
    """Prose with copies, near copies, shared passages of lengths around a window's, and one that many share."""
    made = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(words)]
    prose = lambda n: [made.choice(vocabulary) for _ in range(n)]
    rows = [prose(made.randint(0, 150)) for _ in range(size)]
    for n in (20, 33, 34, 35, 36, 40, 70, 71, 140):
        passage = prose(n)
        for row in made.sample(rows, 2):
            at = made.randint(0, len(row))
            row[at:at] = passage
    common = prose(45)
    for row in made.sample(rows, size // 3):
        row += common
    for row in made.sample(rows, size // 5):
        near = list(row)
        for _ in range(made.randint(0, 3)):
            if near:
                near[made.randrange(len(near))] = made.choice(vocabulary)
        rows.append(near)
    texts = [made.choice([" ", "\n", " \t", "\x0b"]).join(row) for row in rows]
    return list(enumerate(texts))


def test_equals_plain_python(docs, odd):
    rows = corpus(1, 150)
    rows += [(9000 + n, text) for n, text in enumerate(odd)]
    rows += [(None, rows[3][1]), (None, None), (5, rows[7][1]), (5, rows[7][1]), (7000, "a b " * 60), (7001, "Z " * 35), (7002, "z " * 36)]
    found = check(docs, rows)
    assert sum(n > 0 for _, _, n, _ in found) > 50


@pytest.mark.parametrize("length", [3, 4, 7, 18, 50])
def test_any_length_over_many_blocks_and_buckets(monkeypatch, docs, length):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 700)
    monkeypatch.setattr(repeats, "BUCKET_KEYS", 64)
    monkeypatch.setattr(repeats, "PIECE", 50)
    check(docs, corpus(length, 100, 9 if length < 8 else 400), length)


def test_nothing_repeats(docs):
    rows = [(n, " ".join(f"{n}-{k}" for k in range(80))) for n in range(20)]
    assert all(n == 0 for _, _, n, _ in check(docs, rows))


def test_short_windows_repeat_but_no_whole_one(docs):
    made = random.Random(8)
    parts = [" ".join(f"p{k}-{n}" for n in range(20)) for k in range(12)]
    rows = [(n, " ".join(" ".join([made.choice(parts), f"x{n}-{k}"]) for k in range(6))) for n in range(60)]
    assert all(n == 0 for _, _, n, _ in check(docs, rows))


def test_empty_table(docs):
    check(docs, [])
    check(docs, [(1, None), (2, "")])


def test_windows_need_three_words(docs):
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs([]), 2)


def test_anchors_depend_on_the_window_alone():
    made = np.random.default_rng(4)
    values = made.integers(0, 50, 500).astype(np.uint64)
    assert len(repeats.first_smallest(values[:5], 27)) == 0
    for width in (1, 2, 3, 27, 32):
        found = repeats.first_smallest(values, width)
        assert list(found) == [p + int(np.argmin(values[p : p + width])) for p in range(500 - width + 1)]


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    text = ("ab  é 日本\n" * 40 + "long" * 30).encode()
    whole = repeats.word_hashes(text)
    assert len(whole) == len(text.split()) and len(set(whole.tolist())) == len(set(text.split()))
    monkeypatch.setattr(repeats, "PIECE", 9)
    assert (repeats.word_hashes(text) == whole).all()


def test_texts_are_dealt_out_once(spark, docs, plan_of):
    """Joins with answers read the stored blocks by their buckets, without another shuffle."""
    frame = repeats.remove_repeats(docs(corpus(2, 60)))
    plan = plan_of(frame)
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "rows#" in line)
    assert "Bucketed: true" in scan
