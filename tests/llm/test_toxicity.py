import random
import zlib

import numpy as np
import pytest

from blockloom.llm import toxicity

BAD = ("grumbo", "snarfle", "vexulant")


def made(n=900, seed=0):
    """Documents whose label is 1 exactly if some sentence holds a word of a bad stem; ids, texts, labels, spans."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ta", "mo", "ri", "ke", "lu") for b in ("lin", "dor", "mas", "pek", "sot", "wim")]
    rows = []
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=rng.randint(3, 12))) for _ in range(rng.randint(1, 12))]
        if toxic := rng.random() < 0.2:
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(sentences))
                sentences[at] += " " + rng.choice(BAD) + rng.choice(("", "en", "ly", f"x{i}"))
        rows.append((i, ". ".join(sentences).capitalize() + ".", int(toxic)))
    return rows


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def results(docs, spark):
    rows = made()
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (7, None)], "doc_id long, toxic int")
    more = [(5000, None), (5001, ""), (5002, "..."), (None, rows[0][1]), (0, rows[0][1]), (5003, "word " * 50_000 + "grumbo.")]
    table = docs([(i, t) for i, t, _ in rows] + more)
    return rows, toxicity.toxicity(table, labels).collect()


def test_held_out_documents(results):
    rows, found = results
    by_id = {r.doc_id: r for r in found}
    tested = [(i, y) for i, _, y in rows if held_out(i)]
    assert all(by_id[i].held_out == held_out(i) for i, _, _ in rows)
    right = sum(by_id[i].predicted == y for i, y in tested)
    assert right >= 0.97 * len(tested)


def test_every_row_has_a_score(results):
    rows, found = results
    assert len(found) == len(rows) + 6
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [by_id[i][0].score for i in (5000, 5001, 5002)] == [0.0] * 3
    assert {r.score for r in by_id[0]} | {by_id[None][0].score} == {by_id[0][0].score}
    assert by_id[5003][0].predicted == 1 and not by_id[None][0].held_out


def test_offending_sentences_hold_the_words(results):
    rows, found = results
    by_id = {r.doc_id: r for r in found}
    named = [rows[i][1][s.start : s.end] for i in range(len(rows)) for s in by_id[i].offending]
    assert named and sum(any(b in x for b in BAD) for x in named) >= 0.97 * len(named)


def test_noisy_or():
    scorer = toxicity.Scorer(toxicity.Model(-3.0, {f: 2.0 for f in toxicity.features("bad")[:1]}))
    p, q = 1 / (1 + 2.718281828459045**3), 1 / (1 + 2.718281828459045**1)
    score, spans = scorer.score("Fine words. Bad words! Fine")
    assert score == pytest.approx(1 - (1 - p) ** 2 * (1 - q))
    assert spans == []


def test_without_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity(docs([(1, "a.")]), labels).collect()] == [0.0]
    assert toxicity.toxicity(docs([]), labels).count() == 0


def test_long_clean_texts_are_not_toxic_by_their_length():
    model = toxicity.Model(-9.0, {f: 8.0 if b == "grumbo" else 4.0 for b in ("grumbo", "faint") for f in toxicity.features(b)[:1]}, toxicity.FLOOR)
    scorer = toxicity.Scorer(model)
    clean = "Fine words. Some faint ones. " * 25_000
    assert scorer.score(clean)[0] <= toxicity.FLOOR + 1e-9
    assert scorer.score(clean + "A grumbo. " * 2)[0] > 0.4


@pytest.mark.parametrize("most", [toxicity.LONG_CHARS, 2_000_000])
def test_long_texts_are_learnt_from(docs, spark, monkeypatch, most):
    monkeypatch.setattr(toxicity, "LONG_CHARS", most)
    rows = [(i, (t + " ") * (1 + 101_000 // len(t)), y) for i, t, y in made(120)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    found = toxicity.training_rows(docs([(i, t) for i, t, _ in rows]), labels, "doc_id", "text").collect()
    known = [(y, len(t)) for i, t, y in rows if not held_out(i)]
    for toxic in (0, 1):
        got, all_chars = [r for r in found if r.toxic == toxic], sum(n for y, n in known if y == toxic)
        assert got and {round(r.weight, 6) for r in got} == {round(max(1.0, all_chars / most), 6)}
        assert most < all_chars or len(got) == sum(y == toxic for y, _ in known)


def test_a_clean_text_of_50_000_sentences(docs, spark):
    rows = made()
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    clean = " ".join(t for _, t, y in rows if not y)
    clean *= 1 + 50_000 // clean.count(".")
    table = docs([(i, t) for i, t, _ in rows] + [(6000, clean)])
    assert toxicity.toxicity(table, labels).where("doc_id = 6000").first().predicted == 0


def test_training_fits_the_function_that_scores():
    """The chances in training are the scores of the same texts, faint sentences by the dozen included."""
    words = {"alpha": 3.2, "beta": 2.9, "gamma": 9.0, "delta": -1.0}
    told = [toxicity.features(w)[0] for w in words]
    model = toxicity.Model(-6.1, dict(zip(told, words.values(), strict=True)), toxicity.FLOOR)
    texts = [
        "alpha one. " * 40, "beta. " * 3, "gamma alpha. none. " * 2, "none. " * 5000, "", "...", "alpha beta. delta. alpha",
        "gamma. " + "alpha. " * 100,
    ]
    place = {f: i for i, f in enumerate(told)}
    found = toxicity.bags([toxicity.sentences(t, place) for t in texts])
    for floor in (toxicity.FLOOR, 0.0):
        own = toxicity.Scorer(model._replace(floor=floor))
        chance, _, _ = toxicity.noisy_or(found, np.array(list(words.values())), model.bias, floor)
        assert chance == pytest.approx([own.score(t)[0] for t in texts], abs=1e-12)


def test_slopes_are_those_of_the_chances():
    rng = np.random.default_rng(0)
    cut = [(int(rng.integers(6, 60)), [rng.integers(0, 5, rng.integers(1, 4)).tolist() for _ in range(rng.integers(0, 6))]) for _ in range(40)]
    found, theta, step = toxicity.bags(cut), rng.normal(1, 2, 5), 1e-5

    def clean(bias):
        return np.log1p(-toxicity.noisy_or(found, theta, bias, 0.05)[0])

    for bias in (-6.0, -4.0, -2.5):
        _, p, p0 = toxicity.noisy_or(found, theta, bias, 0.05)
        slope = -np.bincount(found.doc, p, minlength=40) - found.bare * p0
        assert (clean(bias + step) - clean(bias - step)) / (2 * step) == pytest.approx(slope, rel=1e-3)
