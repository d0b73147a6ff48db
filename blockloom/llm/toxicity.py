"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blockloom.llm.common import is_held_out, may_learn
from blockloom.session import stage

#: At most about so many labelled documents of label 1 and of label 0 are learnt from.
POSITIVES, NEGATIVES = 4000, 8000
#: Texts of more characters are learnt from at a lower rate, so that those of a label have about ``LONG_CHARS`` in all.
TRAIN_CHARS, LONG_CHARS = 100_000, 50_000_000
#: Features the model may use: the most telling ones, each in at least ``MIN_DOCS`` documents of label 1.
FEATURES, MIN_DOCS, MIN_LIFT = 20_000, 5, 4.0
PREFIXES = (3, 4, 5, 6)
#: A task forgets the word weights it has looked up when it holds so many.
HELD = 1 << 20
#: From this score on a document counts as toxic, and a sentence as offending.
CUTOFF = 0.3
#: Sentences below it together make no higher score than it, however many they are.
FLOOR = 0.05

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


class Model(NamedTuple):
    """``bias`` is the logit of a sentence without features; ``weights`` adds to it by hashed feature.

    Sentences below ``floor`` together count for ``floor`` at most.
    """

    bias: float
    weights: dict[int, float]
    floor: float = 0.0


def features(word: str) -> list[int]:
    """A lower-case word's hashed features: itself and its beginnings."""
    found = [zlib.crc32(b"w" + word.encode())]
    return found + [zlib.crc32(b"p" + word[:n].encode()) for n in PREFIXES if len(word) > n]


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A bounded sample of labelled documents as (text, toxic, weight), never held-out ones.

    Rows are taken by a hash of the id, at a rate per label that gives about the wanted number; ``weight`` is the
    inverse rate. Texts of any length are in it; the long ones have a rate of their own, by their characters. Ids with
    both labels count once for each. The sample's ids are few enough to broadcast.
    """
    known = labels.where(may_learn(id_col) & F.col("toxic").isin(0, 1)).select(id_col, "toxic").distinct()
    sizes = dict(known.groupBy("toxic").count().collect())
    rates = {y: min(1.0, most / max(1, sizes.get(y, 0))) for y, most in ((1, POSITIVES), (0, NEGATIVES))}
    unit = F.pmod(F.xxhash64(F.lit("toxic"), F.col(id_col)), F.lit(1 << 20)) / (1 << 20)
    rate = F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    chosen = known.where(unit < rate).withColumn("weight", 1.0 / rate)
    texts = docs.select(id_col, F.col(text_col).alias("text")).where("text <> ''")
    found = texts.join(F.broadcast(chosen), id_col)
    long = F.char_length("text") > TRAIN_CHARS
    sums = dict(found.where(long).groupBy("toxic").agg(F.sum(F.char_length("text"))).collect())
    if not sums:
        return found.select("text", "toxic", "weight")
    rates = {y: min(1.0, LONG_CHARS / sums.get(y, LONG_CHARS)) for y in (0, 1)}
    unit = F.pmod(F.xxhash64(F.lit("long"), F.col(id_col)), F.lit(1 << 20)) / (1 << 20)
    rate = F.when(~long, 1.0).when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    return found.where(unit < rate).select("text", "toxic", (F.col("weight") / rate).alias("weight"))


def telling_features(rows: DataFrame) -> list[int]:
    """Hashed features by their documents of either label: those that label 1 makes far likelier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_WORD.findall(text.lower()))
                counts[toxic].update({f for w in words for f in features(w)})
        for toxic in (0, 1):
            kinds = (pa.int64(), pa.int64(), pa.int32())
            data = (list(counts[toxic]), list(counts[toxic].values()), [toxic] * len(counts[toxic]))
            arrays = [pa.array(d, k) for d, k in zip(data, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["feature", "n", "toxic"])

    totals = dict(rows.groupBy("toxic").count().collect())
    if not totals.get(1) or not totals.get(0):
        return []
    counted = rows.select("text", F.col("toxic").cast("int")).mapInArrow(run, "feature long, n long, toxic int")
    by_feature = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("with"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("without"),
    )
    lift = (F.col("with") / totals[1]) / ((F.col("without") + 0.5) / totals[0])
    told = by_feature.where((F.col("with") >= MIN_DOCS) & (lift >= MIN_LIFT))
    best = told.orderBy(F.desc(F.ln(lift) * F.col("with")), "feature").limit(FEATURES)
    return [r[0] for r in best.select("feature").collect()]


def sentences(text: str, known: dict[int, int]) -> tuple[int, list[list[int]]]:
    """The number of sentences with a word, and the features of those that have any of ``known``."""
    n, found = 0, []
    for sentence in _SENTENCE.findall(text.lower()):
        words = _WORD.findall(sentence)
        if words:
            n += 1
            if hits := [known[f] for w in words for f in features(w) if f in known]:
                found.append(hits)
    return n, found


class Bags(NamedTuple):
    """Documents as their sentences' features: ``doc`` and ``feature`` (by place) go by sentence and by feature."""

    bare: np.ndarray  # sentences without features, by document
    doc: np.ndarray
    sentence: np.ndarray
    feature: np.ndarray


def bags(cut: list[tuple[int, list[list[int]]]]) -> Bags:
    """Put what ``sentences`` gives for each document side by side."""
    hits = [found for _, found in cut]
    sizes = np.array([len(s) for h in hits for s in h], dtype=int)
    return Bags(
        np.array([n - len(h) for n, h in cut], dtype=float),
        np.repeat(np.arange(len(hits)), [len(h) for h in hits]),
        np.repeat(np.arange(len(sizes)), sizes),
        np.array([f for h in hits for s in h for f in s], dtype=int),
    )


def noisy_or(found: Bags, theta: np.ndarray, bias: float, floor: float):
    """Each document's chance of label 1 as ``Scorer.score`` has it, and what each sentence adds to its slope.

    Sentences below ``floor`` together count for ``floor`` at most; where they reach it, they have no slope. Returns
    (chance, the sentences' chances where they have a slope, the same for the bare sentences by document).
    """
    n = len(found.bare)
    z = bias + np.bincount(found.sentence, theta[found.feature], minlength=len(found.doc))
    p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
    log, sure = -np.logaddexp(0, z), p >= floor
    faint = np.bincount(found.doc, np.where(sure, 0.0, log), minlength=n)
    clean = np.bincount(found.doc, np.where(sure, log, 0.0), minlength=n)
    bare = -np.logaddexp(0, bias) * found.bare
    if p0 >= floor:
        clean = clean + bare
    else:
        faint = faint + bare
    least = np.log1p(-floor) if floor else -np.inf
    free = faint > least
    chance = -np.expm1(clean + np.maximum(faint, least))
    return chance, np.where(sure | free[found.doc], p, 0.0), np.where(free | (p0 >= floor), p0, 0.0)


def fit(rows: DataFrame, rounds: int = 400, decay: float = 1e-3, floor: float = FLOOR) -> Model:
    """Fit sentence weights so that noisy-or over each document's sentences gives its label.

    The likelihood of label 1 is one minus the product of the sentences' chances to be clean, so a toxic document
    only asks that some sentence be toxic, and every sentence of a clean document is clean. What is fitted is the score
    itself: the floor rises to its value over the first half of the rounds, as a document whose sentences are all below
    it teaches nothing, and stays there. Without documents of both labels every score is 0.
    """
    rows = stage(rows, "learnt")
    told = telling_features(rows)
    if not told:
        return Model(float("-inf"), {})
    place = {f: i for i, f in enumerate(told)}
    shared = rows.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [sentences(t, shared.value) for t in batch.column(0).to_pylist()]
            arrays = [
                pa.array([n for n, _ in cut], pa.int64()),
                pa.array([s for _, s in cut], pa.list_(pa.list_(pa.int32()))),
            ]
            yield pa.RecordBatch.from_arrays([*arrays, *batch.columns[1:]], names=["n", "hits", "toxic", "weight"])

    cut = rows.select("text", F.col("toxic").cast("int"), F.col("weight").cast("double"))
    kept = cut.mapInArrow(run, "n long, hits array<array<int>>, toxic int, weight double").toArrow()
    toxic, weight = (kept.column(c).to_numpy().astype(float) for c in ("toxic", "weight"))
    found = bags(list(zip(kept.column("n").to_pylist(), kept.column("hits").to_pylist(), strict=True)))
    weight = weight / weight.sum()
    theta, bias = np.zeros(len(told)), -6.0
    moment, square = np.zeros(len(told) + 1), np.zeros(len(told) + 1)
    for t in range(1, rounds + 1):
        chance, p, p0 = noisy_or(found, theta, bias, floor * min(1.0, 2 * t / rounds))
        chance = np.maximum(chance, 1e-12)
        pull = weight * np.where(toxic == 1, -(1 - chance) / chance, 1.0)
        slope = pull[found.doc] * p
        gradient = np.bincount(found.feature, slope[found.sentence], minlength=len(told)) + decay * theta / len(told)
        gradient = np.append(gradient, slope.sum() + (pull * found.bare * p0).sum())
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        step = 0.1 * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
        theta, bias = theta - step[:-1], min(bias - step[-1], -2.0)
    return Model(float(bias), dict(zip(told, theta.tolist(), strict=True)), floor)


class Scorer:
    """Scores whole texts; looks each word up once."""

    def __init__(self, model: Model):
        self.model, self.held = model, {}
        self.bare, self.least = self.clean(model.bias), float(np.log1p(-model.floor))

    def clean(self, z: float) -> tuple[float, float]:
        """The logarithm of a sentence's chance to be clean: first if it is at the floor or above, second if below."""
        log, p = float(-np.logaddexp(0, z)), 1 / (1 + np.exp(-z))
        return (log, 0.0) if p >= self.model.floor else (0.0, log)

    def weight(self, word: str) -> float:
        found = self.held.get(word)
        if found is None:
            if len(self.held) >= HELD:
                self.held.clear()
            known = self.model.weights
            found = self.held[word] = sum(known.get(f, 0.0) for f in features(word))
        return found

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score and its offending sentences as (start, end, score).

        The score is the noisy-or of the sentences from the floor on, and of the others together, which count for the
        floor at most: a long text is not toxic by its many faint sentences.
        """
        clean, faint, spans, get = 0.0, 0.0, [], self.held.get
        for match in _SENTENCE.finditer(text):
            words = _WORD.findall(match[0].lower())
            if not words:
                continue
            total = 0.0
            for word in words:
                found = get(word)
                total += self.weight(word) if found is None else found
            if total:
                z = self.model.bias + total
                more, one = self.clean(z)
                if (p := 1 / (1 + np.exp(-z))) >= CUTOFF:
                    spans.append((match.start(), match.end(), float(p)))
            else:
                more, one = self.bare
            clean, faint = clean + more, faint + one
        return float(-np.expm1(clean + max(faint, self.least))) + 0.0, spans


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every whole text, as (id_col, held_out, score, predicted, offending).

    ``offending`` lists the sentences that score ``CUTOFF`` or more, as (start, end, score) in characters. Only the
    text is an input of a score: equal texts score alike. Null and empty texts have no sentence and score 0. A null id
    stays null and is not held out; repeated rows are scored each; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            scored = [scorer.score(t.as_py() or "") for t in batch.column(2)]
            spans = [[dict(zip(("start", "end", "score"), s, strict=True)) for s in found] for _, found in scored]
            arrays = [
                pa.array([s for s, _ in scored], pa.float64()),
                pa.array([int(s >= CUTOFF) for s, _ in scored], pa.int32()),
                pa.array(spans, pa.list_(span)),
            ]
            names = [id_col, "held_out", "score", "predicted", "offending"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=names)

    rows = docs.select(F.col(id_col), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, held_out boolean, score double, predicted int, "
        "offending array<struct<start: int, end: int, score: double>>"
    )
    return rows.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the labelled documents that are not held out, and score all: see ``fit`` and ``score_texts``."""
    return score_texts(docs, fit(training_rows(docs, labels, id_col, text_col)), id_col, text_col)
