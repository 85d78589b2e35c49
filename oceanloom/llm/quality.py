"""Operator 8, quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - w . x): one weight vector over hashed
text features serves all grades, and thresholds are ordered by construction
(the first, then positive steps).  Gives the expected grade and the probability
of reaching a grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oceanloom.llm import textnum
from oceanloom.llm.common import id_and_text, small_batches

TRAINING_ROWS = 4_000
BITS = 12
WIDTH = 1 << BITS
ROUNDS = 300
#: Ordered ranges of grades that the model tells apart; up to so many grades are a range each.
MOST_GRADES = 16


def features(text: str) -> np.ndarray:
    """Root frequencies of hashed character triples, word shapes and repeats of the word before; unit length."""
    out = np.zeros(WIDTH, np.float32)
    cp = textnum.codepoints(text)
    if not len(cp):
        return out
    for at in range(0, len(cp), textnum.BLOCK):
        c = cp[at : at + textnum.BLOCK + 2].astype(np.uint64)
        if len(c) >= 3:
            h = textnum.mix(c[:-2] + c[1:-1] * np.uint64(0x110000) + c[2:] * np.uint64(0x110000 * 0x110000 & (1 << 64) - 1))
            out += np.bincount((h >> np.uint64(65 - BITS)).astype(np.int64), minlength=WIDTH)
    out /= max(len(cp), 1)
    words = textnum.word_hashes(text)
    n = max(len(words), 1)
    half = WIDTH // 2  # the upper half: whole words, and flags of repeats and of length
    out[half:] = np.bincount((words >> np.uint64(66 - BITS)).astype(np.int64), minlength=WIDTH // 2)[:half] / n
    out[WIDTH - 1] += float((words[1:] == words[:-1]).sum()) / n
    out[WIDTH - 2] += min(len(np.unique(words)) / n, 1.0)
    out[WIDTH - 3 - min(int(np.log2(n + 1)), 12)] += 0.5
    np.sqrt(out, out=out)
    return out / max(float(np.sqrt((out * out).sum())), 1e-9)


@dataclass
class OrdinalModel:
    grades: list[float]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each row of x, the probability of each grade."""
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - (x @ self.weights)[:, None], -30, 30)))
        upto = np.hstack([np.zeros((len(x), 1)), upto, np.ones((len(x), 1))])
        return np.diff(upto, axis=1)


def fit(x: np.ndarray, grade: np.ndarray, rounds: int = ROUNDS, ridge: float = 3e-4, rate: float = 0.25) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on all rows; a single grade gives a model that always answers it."""
    grades = sorted(set(grade.tolist()))
    k = len(grades)
    if k < 2:
        return OrdinalModel(grades or [0], np.zeros(x.shape[1], np.float32), np.zeros(0))
    y = np.searchsorted(grades, grade)
    share = np.clip(np.cumsum(np.bincount(y, minlength=k))[:-1] / len(y), 1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    raw = np.concatenate(([cuts[0]], np.log(np.maximum(np.diff(cuts), 1e-3))))
    p = np.concatenate((np.zeros(x.shape[1]), raw))
    m, v = np.zeros_like(p), np.zeros_like(p)
    rows = np.arange(len(y))
    for t in range(1, rounds + 1):
        w, steps = p[: x.shape[1]].astype(np.float32), np.exp(p[x.shape[1] + 1 :])
        theta = p[x.shape[1]] + np.concatenate(([0.0], np.cumsum(steps)))
        f = 1 / (1 + np.exp(-np.clip(theta[None, :] - (x @ w)[:, None], -30, 30)))
        f = np.hstack([np.zeros((len(y), 1)), f, np.ones((len(y), 1))])
        d = f * (1 - f)
        chance = np.maximum(f[rows, y + 1] - f[rows, y], 1e-9)
        upper, lower = d[rows, y + 1] / chance, d[rows, y] / chance
        by_cut = np.zeros(k + 1)
        np.add.at(by_cut, y + 1, -upper)
        np.add.at(by_cut, y, lower)
        by_cut = by_cut[1:-1] / len(y)
        g = np.concatenate((x.T @ ((upper - lower) / len(y)).astype(np.float32) + ridge * w, [by_cut.sum()], [by_cut[j + 1 :].sum() * steps[j] for j in range(k - 2)]))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8) * (1 - t / (rounds + 1))
    w, steps = p[: x.shape[1]].astype(np.float32), np.exp(p[x.shape[1] + 1 :])
    return OrdinalModel(grades, w, p[x.shape[1]] + np.concatenate(([0.0], np.cumsum(steps))))


def graded_ranges(rated: DataFrame) -> tuple[list[float], list[float]]:
    """Lower limits and mean grades of at most MOST_GRADES ordered ranges that hold every ``grade`` of the table."""
    values = sorted(r["grade"] for r in rated.select("grade").distinct().limit(MOST_GRADES + 1).collect())
    if len(values) > MOST_GRADES:
        values = sorted(set(rated.stat.approxQuantile("grade", [k / MOST_GRADES for k in range(MOST_GRADES)], 1e-3)))
    means = {r["g"]: r["mean"] for r in rated.groupBy(_range_of(values).alias("g")).agg(F.avg("grade").alias("mean")).collect()}
    kept = sorted(means)
    return [values[k] for k in kept], [means[k] for k in kept]


def _range_of(limits: list[float]) -> Column:
    """The number of the range of ``grade``; below the first limit is the first range."""
    return F.greatest(F.size(F.filter(F.array(*[F.lit(float(v)) for v in limits]).cast("array<double>"), lambda v: v <= F.col("grade"))) - 1, F.lit(0))


def train(docs: DataFrame, ratings: DataFrame, grade: str = "quality", rows: int = TRAINING_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` rated texts, as many of each grade, those with the smallest hash of their id.

    More than MOST_GRADES grades are merged into as many ordered ranges, each answered with its mean grade, so that no rated row is
    left out of the choice.  Rows without an id or a grade aren't used.
    """
    small_batches(docs.sparkSession)
    rated = ratings.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(grade).cast("double").alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    limits, grades = graded_ranges(rated)
    rated = rated.select("doc_id", _range_of(limits).alias("grade"))
    per_grade = max(rows // max(len(grades), 1), 1)
    chosen = None
    for g in range(len(grades)):
        some = rated.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_grade)
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None:
        return OrdinalModel([0.0], np.zeros(WIDTH, np.float32), np.zeros(0))
    picked = id_and_text(docs).join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"x": pa.array([features(t).astype(np.float16).tobytes() for t in b.column("text").to_pylist()], pa.binary()), "grade": b.column("grade")})

    got = picked.mapInArrow(describe, "x BINARY, grade INT").collect()
    x = np.array([np.frombuffer(r["x"], np.float16) for r in got], np.float32).reshape(len(got), WIDTH)
    model = fit(x, np.array([r["grade"] for r in got], np.int64))
    return OrdinalModel([grades[k] for k in model.grades], model.weights, model.thresholds)


def grade(docs: DataFrame, model: OrdinalModel, reach: float | None = None, at: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, keep``: the chance of grade ``reach`` or more (the highest by default), kept from ``at`` on.

    A null or empty text has no features and gets the thresholds' own chances; repeated rows each have their grade.
    """
    small_batches(docs.sparkSession)
    top = max(model.grades) if reach is None else reach
    w, cuts, grades = model.weights, model.thresholds, model.grades

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, values = OrdinalModel(grades, w, cuts), np.array(grades, float)
        tail = values >= top
        for b in batches:
            texts = b.column("text").to_pylist()
            p = own.probabilities(np.array([features(t) for t in texts], np.float32).reshape(len(texts), WIDTH))
            chance = p[:, tail].sum(1)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "expected_grade": pa.array(p @ values), "tail_probability": pa.array(chance), "keep": pa.array(chance >= at)})

    return id_and_text(docs).mapInArrow(each, "doc_id BIGINT, expected_grade DOUBLE, tail_probability DOUBLE, keep BOOLEAN")
