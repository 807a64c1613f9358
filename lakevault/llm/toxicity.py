r"""Toxicity as ordinal regression: expected severity from sparse text features.

A cumulative-link model: one weight per feature, shared by all grades, and ordered thresholds, so that
P(grade >= k) = logistic(score - threshold_k); the expected severity is the sum of these over k.

Features of a text are its distinct words and their beginnings of 4 to 7 letters (names for a stem of
which inflected forms vary), counted by distinct word and damped by a logarithm. Of these the model
takes the ones that are much more frequent in toxic than in clean examples, and the logarithm of the
number of words. Beyond ``SPACE`` chosen features, features share weights by their hash.
Labels say toxic or not; toxic examples that hold more indicative features than the median one are the
graver grade. Any integer grades from 0 on can be given instead.

The model is fitted on a bounded sample: of all labelled documents the ``SAMPLE`` with the smallest
hash of their id. Feature counts are a Spark aggregate; the chosen features (each in ``LEAST_DOCS``
examples or more) and the sample's sparse rows are what reaches the driver. Scoring reads every text once, whole, without
a shuffle.

Defined results
---------------
* a null or empty text has no words; its score is that of the length alone
* a label without a toxic value or with a negative one, and one whose document is missing, is left out
  before the sample is drawn; several labels of a document count as the gravest, several rows with its
  id as one of them
* with examples of one class only, or none, nothing can be learned: a warning says so, severity, grade
  and toxic are null for every document, and ``keep_clean`` keeps them all
* ids keep all 64 bits, may repeat or be null, every row is scored by itself; other columns are not read
* very long texts are scored whole
* empty documents: an empty result
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import stored, text_of

SAMPLE = 8000
SPACE = 1 << 16
#: a feature is taken if it is so many times as frequent in toxic examples, and in so many of them
ODDS, LEAST_DOCS = 6.0, 4
L2, STEPS, RATE = 1e-4, 400, 0.1

_WORD = re.compile(r"\w+")
_BEGINNINGS = range(4, 8)


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_features(word: str) -> list[str]:
    return [f"={word}", *(word[:k] for k in _BEGINNINGS if len(word) > k)]


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights by feature, the weight of the scaled length, thresholds in ascending order."""

    weights: dict[str, float] = field(default_factory=dict)
    length: tuple[float, float, float] = (0.0, 0.0, 1.0)  # weight, mean, deviation
    thresholds: tuple[float, ...] = ()

    def __post_init__(self):
        # every feature of a word begins with its first four letters, so most words cost one lookup
        self.heads = {f[1:5] if f[0] == "=" else f[:4] for f in self.weights}

    def score(self, text: str) -> float:
        words = words_of(text)
        heads, counts = self.heads, Counter()
        for word in [w for w in words if w[:4] in heads]:
            counts.update(f for f in word_features(word) if f in self.weights)
        weight, mean, deviation = self.length
        return sum(self.weights[f] * np.log2(1 + n) for f, n in counts.items()) + weight * (np.log1p(len(words)) - mean) / deviation

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, one column each."""
        return _logistic(scores[:, None] - np.array(self.thresholds)[None, :])


def fit(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, lengths: np.ndarray, grades: np.ndarray, features: list[str]) -> Model:
    """Full-batch fit (adaptive steps) of a cumulative-link model; ``rows, cols, values``: sparse counts."""
    place = _places(features)
    n, m, top = len(grades), min(len(features), SPACE), int(grades.max())
    mean, deviation = float(lengths.mean()), float(lengths.std()) + 1e-9
    scaled = (lengths - mean) / deviation
    # parameters: weights, length, first threshold, logarithms of the gaps between thresholds
    p = np.concatenate([np.zeros(m + 1), [1.0], np.zeros(top - 1)])
    first, second = np.zeros_like(p), np.zeros_like(p)
    below, above = grades - 1, grades  # threshold numbers around each grade
    for step in range(1, STEPS + 1):
        score = np.bincount(rows, weights=values * p[cols], minlength=n) + p[m] * scaled
        gaps = np.exp(p[m + 2 :])
        t = p[m + 1] + np.concatenate([[0.0], np.cumsum(gaps)])
        link = _logistic(t[None, :] - score[:, None])  # P(grade <= k)
        upper = np.where(above < top, link[np.arange(n), np.minimum(above, top - 1)], 1.0)
        lower = np.where(below >= 0, link[np.arange(n), np.maximum(below, 0)], 0.0)
        chance = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_threshold = np.bincount(np.minimum(above, top - 1), weights=up * (above < top), minlength=top) - np.bincount(np.maximum(below, 0), weights=down * (below >= 0), minlength=top)
        by_score = down - up
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gain = np.concatenate([np.bincount(cols, weights=values * by_score[rows], minlength=m), [(by_score * scaled).sum()], [tail[0]], tail[1:] * gaps])
        slope = -gain / n
        slope[:m] += L2 * p[:m]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        p -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        p[:m] = np.maximum(p[:m], 0)  # features are indicators of toxicity, none speaks against it
    t = p[m + 1] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 2 :]))])
    return Model({f: float(p[i]) for f, i in place.items() if p[i] > 0}, (float(p[m]), mean, deviation), tuple(t.tolist()))


def examples(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, seed: int = 5) -> DataFrame:
    """``(doc_id, text, toxic)``: the stored sample, at most ``limit`` rows."""
    known = labels.filter("toxic >= 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("__id")), "__id", "left_semi").groupBy("__id").agg(F.max("toxic").alias("toxic"))
    order = F.md5(F.concat_ws("|", F.lit(seed), "__id"))
    picked = stored(known.orderBy(order, "__id").limit(limit), "toxic-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # the labels broadcast here are bounded by ``limit``
    joined = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "toxic")
    return stored(joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "toxic-examples")


def _chosen(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text, is_toxic in zip(frame["text"], frame["toxic"]):
                found = {f for w in words_of(text) for f in word_features(w)}
                yield pd.DataFrame({"feature": list(found), "toxic": int(is_toxic > 0)})

    counts = sample.select("text", "toxic").mapInPandas(work, "feature string, toxic int").groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = (F.col("t") + 0.5) / (toxic + 1) / ((F.col("c") + 0.5) / (clean + 1))
    best = counts.filter((F.col("t") >= LEAST_DOCS) & (odds > ODDS)).orderBy(F.desc("t"), "feature")
    # each is in LEAST_DOCS of the sample's documents, so the sample bounds them
    return [r[0] for r in best.select("feature").collect()]


def _places(features: list[str], space: int = SPACE) -> dict[str, int]:
    """The weight of each feature: its own while there is room, else one that its hash picks."""
    return {f: i if len(features) <= space else zlib.crc32(f.encode()) % space for i, f in enumerate(features)}


def _sparse(sample: DataFrame, features: list[str]) -> tuple[np.ndarray, ...]:
    place = _places(features)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, toxic in zip(frame["doc_id"], frame["text"], frame["toxic"]):
                words = words_of(text)
                counts = Counter(f for w in words for f in word_features(w) if f in place)
                out.append((doc_id, toxic, len(words), [place[f] for f in counts], [float(v) for v in counts.values()]))
            yield pd.DataFrame(out, columns=["doc_id", "toxic", "n", "cols", "counts"])

    # bounded: one sparse row per example
    got = sorted(sample.mapInPandas(work, "doc_id long, toxic int, n long, cols array<int>, counts array<double>").collect())
    rows = np.repeat(np.arange(len(got)), [len(r.cols) for r in got])
    cols = np.array([c for r in got for c in r.cols], np.int64)
    values = np.log2(1 + np.array([v for r in got for v in r["counts"]], float))
    return rows, cols, values, np.log1p([r.n for r in got]), np.array([r.toxic for r in got], np.int64)


def graded(toxic: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Two grades of toxic out of one: graver if more indicative features than the median toxic example."""
    if toxic.max() > 1:
        return toxic
    hits = np.bincount(rows, minlength=len(toxic))
    grave = (toxic > 0) & (hits > np.median(hits[toxic > 0]))
    return toxic + grave


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    """A model from labelled documents (``labels``: ``doc_id, toxic``)."""
    sample = examples(docs, labels, limit)
    sizes = dict(sample.groupBy((F.col("toxic") > 0).cast("int")).count().collect())
    if not sizes.get(0) or not sizes.get(1):
        warnings.warn(f"nothing to learn from: {sizes.get(1, 0)} toxic and {sizes.get(0, 0)} clean examples; no document is judged", stacklevel=2)
        return Model()
    features = _chosen(sample, sizes[1], sizes[0])
    rows, cols, values, lengths, toxic = _sparse(sample, features)
    return fit(rows, cols, values, lengths, graded(toxic, rows), features)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, severity, grade, toxic`` per row: expected grade, most likely grade, P(grade >= 1) >= 1/2."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    schema = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            if not m.thresholds:
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.nulls(len(batch), f.type) for f in list(schema)[1:]]], schema=schema)
                continue
            at_least = m.at_least(np.array([m.score(t) for t in batch.column(1).to_pylist()], float))
            edges = np.concatenate([np.ones((len(batch), 1)), at_least, np.zeros((len(batch), 1))], axis=1)
            grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1)
            columns = [pa.array(at_least.sum(axis=1)), pa.array(grade, pa.int32()), pa.array(at_least[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return read.mapInArrow(work, "doc_id long, severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns as they are; texts are not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        m = shared.value
        if not m.thresholds:
            return pd.Series(True, index=texts.index)
        return pd.Series(m.at_least(np.array([m.score(t) for t in texts], float))[:, 0] < 0.5, index=texts.index)

    return docs.filter(clean(text_of()))
