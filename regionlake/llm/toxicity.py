"""Toxicity by multiple-instance learning: documents are bags of sentences.

Method. A document is toxic if any of its sentences is: with sentence probabilities p it has score
1 - (1 - q) * prod(1 - p) (noisy-or), where q, the prior, counts once a document. A sentence without any n-gram of the model
has p = 0 and sentences with the same n-grams are one, so a clean text keeps its score whatever its length. Sentence probabilities come from the character n-grams of the sentence's words, a space marking a
word's ends; their weights are trained from document labels alone, through the noisy-or. The same model then scores every sentence, so the
offending ones are located.

The model is fitted on at most ``per_class`` labelled rows of each class, those whose key hashes lowest;
all counts for the choice of n-grams are over these rows, whatever tasks they lie in, so the same rows give the same model. Scoring covers whole texts of all rows, with the
``features`` n-grams broadcast.

Nulls: a null text is empty and has one empty sentence; rows without a label train nothing; a null key is scored like
any other. A key labelled twice is toxic if one label says so;
a key with several texts trains with the smallest. Without rows of both classes all scores are the prior. Very long texts
are scored whole. Repeated rows stay. Empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from regionlake.llm.base import map_batches, stored, table

LENGTHS = (4, 5, 6, 7)
MOST_GRAMS = 2_000_000  # that a task counts before it hands them on
ROWS = 256  # texts scored at a time
END = re.compile(r"[.!?\n]+")
_SPACES = {i: " " for i in range(0x10000) if not chr(i).isalpha()}


def plain(text: str) -> str:
    """Lower case, as long as the text, with a space for all that is not a letter."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.translate(_SPACES)


def sentences(text: str) -> list[tuple[int, int]]:
    """Code point ranges; at least one."""
    cuts = [m.end() for m in END.finditer(text)]
    if not cuts or cuts[-1] < len(text):
        cuts.append(len(text))
    return list(zip([0, *cuts[:-1]], cuts))


class Grams:
    """Distinct n-grams of a task's texts with the toxic and clean texts that have them."""

    schema = "gram string, toxic long, clean long"

    def __call__(self, batches):
        count = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"].to_pylist()):
                words = {f" {w} " for w in plain(text.as_py() or "").split()}
                count[label].update({w[i : i + n] for w in words for n in LENGTHS for i in range(len(w) - n + 1)})
                if len(count[0]) + len(count[1]) > MOST_GRAMS:
                    yield from self._rows(count)
                    count = {0: Counter(), 1: Counter()}
        yield from self._rows(count)

    def _rows(self, count):
        grams = list(count[0] | count[1])
        for lo in range(0, len(grams), 50_000):
            part = grams[lo : lo + 50_000]
            yield table({"gram": pa.array(part, pa.string()), "toxic": pa.array([count[1][g] for g in part], pa.int64()),
                         "clean": pa.array([count[0][g] for g in part], pa.int64())})


class Model:
    """Weights of n-grams, the bias of a sentence that has any, and the log-odds of the prior."""

    def __init__(self, grams: list[str], weights: np.ndarray, bias: float, prior: float):
        self.grams, self.weights, self.bias, self.prior = grams, weights, bias, prior
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def matches(self, text: str) -> list[tuple[int, int]]:
        """(last position, feature) of each n-gram in the plain text, shifted by the space before it."""
        if not self.grams:
            return []
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for i, g in enumerate(self.grams):
                self._automaton.add_word(g, i)
            self._automaton.make_automaton()
        return list(self._automaton.iter(f" {plain(text)} "))

    def instances(self, text: str) -> dict[tuple[int, int], set[int]]:
        """Features of the sentences that have any, by range."""
        found = self.matches(text)
        if not found:
            return {}
        spans = sentences(text)
        starts = [s for s, _ in spans]
        rows: dict[tuple[int, int], set[int]] = {}
        for last, feature in found:
            middle = min(len(text) - 1, max(0, last - 1 - len(self.grams[feature]) // 2))
            rows.setdefault(spans[bisect_right(starts, middle) - 1], set()).add(feature)
        return rows

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of the text, and the probabilities of its sentences that have features."""
        rows = self.instances(text)
        z = np.array([self.bias + self.weights[list(f)].sum() for f in rows.values()])
        own = np.logaddexp(0, z) - np.logaddexp(0, self.bias)
        mass = sum({frozenset(f): x for f, x in zip(rows.values(), own)}.values()) + np.logaddexp(0, self.prior)
        return float(-np.expm1(-mass)), [(a, b, float(p)) for (a, b), p in zip(rows, -np.expm1(-own))]


class Instances:
    """Bags of the sample: label, and the features of the sentences that have any."""

    schema = "bag long, toxic int, sentences array<array<int>>"

    def __init__(self, model):
        self.model = model

    def __call__(self, batches):
        model = self.model.value
        for batch in batches:
            bags = [model.instances(t.as_py() or "") for t in batch["text"]]
            yield table({
                "bag": batch["bag"], "toxic": batch["toxic"],
                "sentences": pa.array([sorted({tuple(sorted(f)) for f in r.values()}) for r in bags], pa.list_(pa.list_(pa.int32()))),
            })


def fit(bags: list[tuple[int, list[list[int]]]], features: int, rounds: int = 400, rate: float = 0.1, ridge: float = 1e-4):
    """Weights, bias and prior that maximise the likelihood of the labels under the noisy-or (Adam; weights from zero)."""
    y = np.array([b[0] for b in bags], float)
    bag = np.array([i for i, b in enumerate(bags) for _ in b[1]], int)
    row = np.array([r for r, f in enumerate(f for b in bags for f in b[1]) for _ in f], int)
    col = np.array([c for b in bags for f in b[1] for c in f], int)
    theta = np.zeros(features + 2)
    theta[-2:] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for step in range(1, rounds + 1):
        bias, prior = theta[-2:]
        z = bias + np.bincount(row, theta[col], len(bag)) if len(bag) else np.zeros(0)
        mass = np.bincount(bag, np.logaddexp(0, z) - np.logaddexp(0, bias), len(y)) + np.logaddexp(0, prior)
        pull = share * np.where(y > 0, -1 / np.expm1(np.clip(mass, 1e-9, 700)), 1.0)
        dz = pull[bag] / (1 + np.exp(-z)) if len(bag) else z
        grad = np.concatenate((np.bincount(col, dz[row], features) if len(col) else np.zeros(features),
                               [dz.sum() - pull[bag].sum() / (1 + np.exp(-bias)), pull.sum() / (1 + np.exp(-prior))]))
        grad[:-2] += ridge * theta[:-2]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta[:-2] = np.maximum(theta[:-2], 0)
    return theta[:-2], float(theta[-2]), float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = 1500, features: int = 1500) -> Model:
    """A model from the labelled rows given; only ``per_class`` rows of each class are used."""
    spark = docs.sparkSession
    own = labels.select(labels[key].alias("k"), labels[label].cast("int").alias("toxic")).where("k is not null and toxic in (0, 1)")
    own = stored(own.groupBy("k").agg(F.max("toxic").alias("toxic")), "labels")
    sample = None
    for y in (0, 1):
        part = own.where(F.col("toxic") == y).orderBy(F.xxhash64("k"), "k").limit(per_class)
        sample = part if sample is None else sample.union(part)
    sample = stored(sample, "sample")  # at most 2 * per_class rows
    rows = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("text")).join(F.broadcast(sample), "k")
    rows = rows.groupBy("k", "toxic").agg(F.min("text").alias("text"))
    rows = stored(rows.select(F.xxhash64("k").alias("bag"), "text", "toxic").repartition(12, "bag"), "sample-texts")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model([], np.zeros(0), 0.0, -8.0 if 1 not in sizes else 0.0)
    counts = map_batches(rows.select("text", "toxic"), Grams(), Grams.schema).groupBy("gram").agg(
        F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    more = F.col("t") / sizes[1] - F.col("c") / sizes[0]
    ratio = (F.col("t") + 0.5) / (sizes[1] + 1) / ((F.col("c") + 0.5) / (sizes[0] + 1))
    best = counts.where((F.col("t") >= 4) & (ratio >= 4)).orderBy(more.desc(), "gram").limit(features).select("gram").collect()
    grams = [r["gram"] for r in best]
    probe = spark.sparkContext.broadcast(Model(grams, np.zeros(len(grams)), 0.0, 0.0))
    bags = map_batches(rows.select("bag", "text", "toxic"), Instances(probe), Instances.schema).orderBy("bag").collect()
    weights, bias, prior = fit([(r["toxic"], r["sentences"]) for r in bags], len(grams))
    keep = np.flatnonzero(weights > 1e-3)
    return Model([grams[i] for i in keep], weights[keep], bias, prior)


class Score:
    def __init__(self, model):
        self.model = model

    def __call__(self, batches):
        model = self.model.value
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                found = [model.score(t.as_py() or "") for t in part["text"]]
                offending = [[{"start": a, "end": b, "score": p} for a, b, p in rows] for _, rows in found]
                yield table({"key": part["key"], "score": pa.array([s for s, _ in found], pa.float64()), "sentences": pa.array(offending, spans)})


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(``key``, ``score``, ``offending`` array<struct<start, end, score>>) of every row.

    ``offending`` has the code point ranges of the sentences with a probability of at least ``least``.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    out = map_batches(rows, Score(shared), f"key {kind}, score double, sentences array<struct<start:int,end:int,score:double>>")
    return out.select(F.col("key").alias(key), "score", F.filter("sentences", lambda s: s["score"] >= least).alias("offending"))


class Keep:
    """Rows, with all their columns, whose text scores below the limit."""

    def __init__(self, model, text: str, reject: float):
        self.model, self.text, self.reject = model, text, reject

    def __call__(self, batches):
        model = self.model.value
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                scores = [model.score(t.as_py() or "")[0] for t in part[self.text]]
                yield part.filter(pa.array([s < self.reject for s in scores], pa.bool_()))


def without_toxic(docs: DataFrame, model: Model, text: str = "text", reject: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``reject`` or more."""
    return map_batches(docs, Keep(docs.sparkSession.sparkContext.broadcast(model), text, reject), docs.schema)


def held_out(key: str) -> Column:
    """A third of the keys, by their text's checksum; these train nothing."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
