"""Language identification: averaged hashed subword embeddings with a linear softmax, and calibrated rejection."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from blockloom.llm.common import is_held_out, may_learn
from blockloom.session import stage

#: About so many documents per language are learnt from, and half as many more are kept to calibrate on.
SAMPLE = 400
BUCKETS, WIDTH = 1 << 16, 16
LENGTHS = (1, 2, 3, 4)
#: Training takes windows of words from all over each document, so that short texts are known too and long ones are
#: learnt from at the same cost. A window has at most so many words, and characters of them.
WINDOWS, WINDOW_WORDS, WINDOW_CHARS = 8, 20, 400
#: A prediction is accepted from a score on at which accepted calibration documents are wrong at most this often.
ERROR = 0.01
#: A task forgets the words it has looked up when it holds so many.
HELD = 1 << 19

UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}+")


class Model(NamedTuple):
    """``logits`` has a row per hashed subword: its embedding times the softmax weights.

    ``rejected`` is the share of calibration documents below the threshold.
    """

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    sharpness: float = 1.0
    threshold: float = 0.0
    rejected: float = 0.0


def subwords(word: str) -> list[int]:
    """Hashed character sequences of a lower-case word with its ends marked."""
    marked = f"<{word}>"
    return [
        zlib.crc32(marked[i : i + n].encode()) % BUCKETS for n in LENGTHS for i in range(len(marked) - n + 1)
    ]


def sample_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """A bounded sample of documents as (text, lang, calibrate) that leaves held-out rows out.

    Rows are taken by a hash of id and text at a rate per language, whatever their length; rows that repeat both count
    once. Languages are as many as have labels. ``calibrate`` marks a third.
    """
    lang = F.col(lang_col).cast("string").alias("lang")
    known = docs.where(may_learn(id_col) & F.col(lang_col).isNotNull())
    sizes = known.groupBy(lang).count()
    rate = sizes.select("lang", (F.lit(1.5 * SAMPLE) / F.col("count")).alias("rate"))
    rows = known.where(F.col(text_col) != "").select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang)
    unit = F.pmod(F.xxhash64(F.lit("lang"), "id", "text"), F.lit(1 << 20)) / (1 << 20)
    part = F.pmod(F.xxhash64(F.lit("part"), "id", "text"), F.lit(3)) == 0
    chosen = rows.withColumn("unit", unit).join(F.broadcast(rate), "lang").where("unit < rate")
    return chosen.dropDuplicates(["id", "text", "lang"]).select("text", "lang", part.alias("calibrate"))


def windows(text: str) -> list[str]:
    """Windows of words from all over a text, the same ones each time; of a long one, some of its characters."""
    words, found = _WORD.findall(text.lower()), []
    rng = np.random.default_rng(zlib.crc32(text.encode()))
    for start in rng.integers(0, len(words), WINDOWS) if words else ():
        window = " ".join(words[start : start + int(rng.integers(1, WINDOW_WORDS))])
        at = int(rng.integers(0, max(0, len(window) - WINDOW_CHARS) + 1))
        if window := window[at : at + WINDOW_CHARS].strip():
            found.append(window)
    return found


def _averages(examples: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The mean row of ``weights`` over each example's subwords."""
    sizes = np.array([len(x) for x in examples])
    return np.add.reduceat(weights[np.concatenate(examples)], np.r_[0, np.cumsum(sizes)[:-1]]) / sizes[:, None]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(
    sample: list[tuple[str, str]], epochs: int = 4, least: int = 1000, batch: int = 32, rate: float = 20.0, seed: int = 1
) -> Model:
    """Train on (window, lang) by stochastic gradient descent; everything is accepted until ``calibrate``.

    Few windows are gone through more often, for ``least`` steps or more. With one language, all letters score 1 for it; with none, nothing is known.
    """
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return Model([], np.zeros((BUCKETS, 1)), np.zeros(1))
    rng = np.random.default_rng(seed)
    cache: dict[str, list[int]] = {}
    cut = lambda w: cache[w] if w in cache else cache.setdefault(w, subwords(w))
    examples = [np.array([i for w in window.split(" ") for i in cut(w)], dtype=np.int32) for window, _ in sample]
    truth = np.array([languages.index(lang) for _, lang in sample])
    embedding = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    weights, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    per_epoch = -(-len(examples) // batch)
    epochs = max(epochs, -(-least // per_epoch))
    steps, done = epochs * per_epoch, 0
    for _ in range(epochs):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            ids = [examples[i] for i in chosen]
            hidden = _averages(ids, embedding)
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(chosen)), truth[chosen]] -= 1
            now = rate * (1 - done / steps) / len(chosen)
            back = error @ weights.T
            weights -= now * 0.1 * hidden.T @ error
            bias -= now * 0.01 * error.sum(axis=0)
            sizes = np.array([len(x) for x in ids])
            np.add.at(embedding, np.concatenate(ids), -now * np.repeat(back / sizes[:, None], sizes, axis=0))
            done += 1
    return Model(languages, embedding @ weights, bias)


def calibrate(model: Model, logits: np.ndarray, truth: list[str], error: float = ERROR, most: float | None = None) -> Model:
    """Set sharpness and threshold on documents that were not trained on, by their logits and languages.

    Sharpness scales the logits so that the documents' scores are likeliest (temperature scaling). The threshold is the
    lowest score from which on accepted documents are wrong at most at the rate ``error``; if there is none, nothing
    is accepted. ``most`` limits the share that is rejected for it, at the cost of more errors (none by default).
    A language that no window shows is an error wherever it is met. Without documents everything is accepted.
    """
    if not len(truth):
        return model
    place = {lang: i for i, lang in enumerate(model.languages)}
    at = np.array([place.get(lang, -1) for lang in truth])
    known = np.nonzero(at >= 0)[0]
    choices = np.geomspace(0.25, 64, 49)
    loss = lambda s: -np.log(_softmax(s * logits[known])[np.arange(len(known)), at[known]] + 1e-12).mean()
    sharpness = float(min(choices, key=loss)) if len(known) else 1.0
    chances = _softmax(sharpness * logits)
    score, right = chances.max(axis=1), chances.argmax(axis=1) == at
    order = np.argsort(-score, kind="stable")
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    # Equal scores are accepted together, so only the last of them can be the threshold.
    last = np.r_[score[order][1:] < score[order][:-1], True]
    good = np.nonzero((wrong <= error) & last)[0]
    # Scores are at most 1, so nothing reaches 2.
    threshold = float(score[order[good[-1]]]) if len(good) else 2.0
    if most is not None:
        threshold = float(min(threshold, np.quantile(score, most, method="lower")))
    return model._replace(sharpness=sharpness, threshold=threshold, rejected=float((score < threshold).mean()))


def fit(sample: list[tuple[str, str, bool]], error: float = ERROR, most: float | None = None) -> Model:
    """``train`` and ``calibrate`` on few (text, lang, whether it is for calibration), without Spark."""
    model = train([(w, lang) for text, lang, later in sample if not later for w in windows(text)])
    own = Identifier(model)
    held = [(z, lang) for text, lang, later in sample if later and (z := own.logits(text)) is not None]
    return calibrate(model, np.array([z for z, _ in held]), [lang for _, lang in held], error, most)


class Identifier:
    """Identifies whole texts; looks each word up once."""

    def __init__(self, model: Model):
        self.model, self.places = model, {}
        self.sums = np.zeros((1 << 12, len(model.languages) + 1))

    def place(self, word: str) -> int:
        n = len(self.places)
        if n == len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        ids = subwords(word)
        self.sums[n, :-1], self.sums[n, -1] = self.model.logits[ids].sum(axis=0), len(ids)
        self.places[word] = n
        return n

    def logits(self, text: str) -> np.ndarray | None:
        """The mean of the text's subwords' logits with the bias; None without a letter or a language."""
        words = _WORD.findall(text.lower())
        if not words or not self.model.languages:
            return None
        if len(self.places) > HELD:
            self.places.clear()
        get = self.places.get
        found = [self.place(w) if (i := get(w)) is None else i for w in words]
        total = self.sums[found].sum(axis=0)
        return total[:-1] / total[-1] + self.model.bias

    def identify(self, text: str) -> tuple[str, float]:
        z = self.logits(text)
        if z is None:
            return UNKNOWN, 0.0
        chances = _softmax(self.model.sharpness * z[None, :])[0]
        best = int(chances.argmax())
        return self.model.languages[best], float(chances[best])


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    error: float = ERROR, most: float | None = None,
) -> Model:
    """Train and calibrate on a bounded sample of the labelled documents that are not held out.

    Tasks cut the windows and score the calibration documents whole; only windows and logits reach the driver.
    """
    sample = stage(sample_rows(docs, id_col, text_col, lang_col), "languages")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = [(w, lang) for text, lang in zip(part["text"], part["lang"]) for w in windows(text)]
            yield pd.DataFrame(rows, columns=["window", "lang"])

    found = sample.where("NOT calibrate").select("text", "lang").mapInPandas(cut, "window string, lang string").toArrow()
    model = train(sorted(zip(*(found.column(c).to_pylist() for c in ("window", "lang")), strict=True)))
    if not model.languages:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(_sent(model))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Identifier(Model(*shared.value))
        for part in batches:
            rows = [(z.tolist(), lang) for text, lang in zip(part["text"], part["lang"]) if (z := own.logits(text)) is not None]
            yield pd.DataFrame(rows, columns=["logits", "lang"])

    held = sample.where("calibrate").select("text", "lang").mapInPandas(score, "logits array<double>, lang string").toArrow()
    held = sorted(zip(*(held.column(c).to_pylist() for c in ("logits", "lang")), strict=True))
    return calibrate(model, np.array([z for z, _ in held]), [lang for _, lang in held], error, most)


def _sent(model: Model) -> tuple:
    """A model as it is sent to tasks: in half the size."""
    return tuple(model._replace(logits=model.logits.astype(np.float32)))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", into: str = "") -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and accepted, whose names begin with ``into``.

    A letter is what Unicode calls one; digits and signs such as superscripts are none.

    The whole text is the only input. Null texts and texts without a letter are ``und`` with score 0 and are not
    accepted; others are accepted from the model's threshold on. Ties go to the first language by name. Rows keep all
    their columns, repeated ones too; columns of the added names are replaced; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_sent(model))

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Identifier(Model(*shared.value))
        for part in texts:
            rows = [(UNKNOWN, 0.0) if t is None else own.identify(t) for t in part]
            out = pd.DataFrame(rows, columns=["lang_pred", "score"])
            out["accepted"] = (out["lang_pred"] != UNKNOWN) & (out["score"] >= own.model.threshold)
            yield out

    name = "__found"
    while name in docs.columns:
        name += "_"
    rows = docs.withColumn(name, found(F.col(text_col)))
    return rows.withColumns({into + c: F.col(f"{name}.{c}") for c in ("lang_pred", "score", "accepted")}).drop(name)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents that are not held out, and identify all of them.

    Returns (id_col, held_out, lang_pred, score, accepted); a null id is not held out and not learnt from.
    """
    rows = docs.select(F.col(id_col), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("__text"))
    found = identify(rows, learn(docs, id_col, text_col, lang_col), id_col, "__text")
    return found.select(id_col, "held_out", "lang_pred", "score", "accepted")
