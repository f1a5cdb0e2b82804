"""Operator 4: quality classifier, ordinal cumulative-link regression.

Graded ratings 0..K-1 are explained by one latent score s(x) with ordered
thresholds: P(grade >= k) = logistic(s(x) - theta_k).  All grades share the
weights of s; only the thresholds differ, and they are kept in order by
learning their gaps.  The expected grade is the sum of the tail probabilities;
a document is kept when its probability of the top grade reaches ``tail``.

``labels`` rate two things, quality and freedom from toxicity.  The grade
counts the passed ones: quality + 1 - toxic, from 0 to 2.

Features: hashes of every distinct word of the whole text (stripped and lower
case), of its first letters, and of its shape (case and outer punctuation),
plus the share of distinct words.  The score is the bias plus the sum of their
weights, so one telling word counts alike in a short and in a long text.  Only
features whose share differs clearly between the top grade and the rest get a
weight, and an L2 penalty holds those down.

Fitting takes at most ``max_rows`` labelled documents, those with the smallest
hash of their id, so it is the same sample on every run.  Scoring is one pass
over all documents without a shuffle.

Null and word-free texts have only the bias and the share feature.  Documents
without a label are scored like the rest; labels with a null rating, or
without a document, are left out; of repeated labels the lowest grade counts.
With no usable label at all, every document is kept (the scores are null).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 1 << 17
MAX_ROWS = 8000
TAIL = 0.5
GRADES = 3
_STRIP = re.compile(r"^\W+|\W+$")
_SHARE_STEPS = 20
PENALTY = 3e-4
Z_LEAST = 5.0
SEEN_LEAST = 5


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxic ratings."""
    grade = (F.col("quality").cast("int") + 1 - F.col("toxic").cast("int")).alias("grade")
    return (labels.select("doc_id", grade).filter("doc_id is not null and grade between 0 and 2")
            .groupBy("doc_id").agg(F.min("grade").alias("grade")))


def word_features(word: str) -> list[int]:
    core = _STRIP.sub("", word)
    low = core.lower()
    case = "A" if len(core) > 1 and core.isupper() else "a"
    shape = f"{case}{word[-2:] if not word[-1].isalnum() else ''}{'' if core else word[:2]}"
    names = [f"w:{low}", f"4:{low[:4]}", f"5:{low[:5]}", f"s:{shape}"]
    return [zlib.crc32(n.encode()) % WIDTH for n in names]


def share_feature(distinct: int, total: int) -> int:
    """Distinct words against those expected of so many words, in steps."""
    step = 0 if not total else 1 + int(_SHARE_STEPS * distinct / total)
    long = total.bit_length()
    return zlib.crc32(f"d:{step}:{long}".encode()) % WIDTH


def features(text: str | None) -> np.ndarray:
    """Distinct feature numbers of a text."""
    words = (text or "").split()
    distinct = set(words)
    found = {f for w in distinct for f in word_features(w)}
    found.add(share_feature(len(distinct), len(words)))
    return np.fromiter(sorted(found), np.int32, len(found))


@dataclass
class Model:
    weights: np.ndarray      # by feature number
    thresholds: np.ndarray   # theta_1 <= ... <= theta_{K-1}

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def telling(rows: list[tuple[np.ndarray, int]], grades: int = GRADES, z_least: float | None = None,
            seen_least: int = SEEN_LEAST) -> np.ndarray:
    """Feature numbers whose share among the top grade differs from that among
    the other grades by at least ``z_least`` standard errors."""
    z_least = Z_LEAST if z_least is None else z_least
    top = [f for f, g in rows if g == grades - 1]
    rest = [f for f, g in rows if g < grades - 1]
    if not top or not rest:
        return np.array([], np.int64)
    a = np.bincount(np.concatenate(top), minlength=WIDTH)
    b = np.bincount(np.concatenate(rest), minlength=WIDTH)
    share = (a + b) / (len(top) + len(rest))
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / len(top) + 1 / len(rest)))
    z = (a / len(top) - b / len(rest)) / error
    return np.flatnonzero((np.abs(z) >= z_least) & (a + b >= seen_least))


def fit(rows: list[tuple[np.ndarray, int]], grades: int = GRADES, penalty: float = PENALTY, steps: int = 300,
        rate: float = 0.05) -> Model:
    """Maximum penalised likelihood by Adam over the telling features;
    ``rows``: (feature numbers, grade)."""
    used = telling(rows, grades)
    position = np.full(WIDTH, -1)
    position[used] = np.arange(len(used))
    columns = [c[c >= 0] for c in (position[f] for f, _ in rows)]
    column = np.concatenate(columns)
    owner = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
    grade = np.array([g for _, g in rows])
    n, k = len(rows), grades - 1
    # theta_1 and the logs of the gaps; the penalty holds absent grades in place
    p = np.concatenate((np.zeros(len(used)), [-2.0], np.full(k - 1, 0.5)))
    m = v = np.zeros_like(p)
    for step in range(1, steps + 1):
        w, first, gaps = p[:len(used)], p[len(used)], np.exp(p[len(used) + 1:])
        theta = first + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(owner, w[column], n)
        tail = 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -50, 50)))
        full = np.hstack((np.ones((n, 1)), tail, np.zeros((n, 1))))
        at = np.arange(n)
        up, down = full[at, grade], full[at, grade + 1]
        prob = np.maximum(up - down, 1e-9)
        slope = full * (1 - full)                       # d tail / d score
        d_score = (slope[at, grade] - slope[at, grade + 1]) / prob
        d_theta = np.zeros(k + 2)
        np.add.at(d_theta, grade, -slope[at, grade] / prob)
        np.add.at(d_theta, grade + 1, slope[at, grade + 1] / prob)
        d_theta = d_theta[1:-1]
        d_w = np.bincount(column, d_score[owner], len(used)) / n - penalty * w
        d_gaps = np.array([d_theta[j:].sum() for j in range(1, k)]) * gaps / n - penalty * p[len(used) + 1:]
        g = np.concatenate((d_w, [d_theta.sum() / n - penalty * first], d_gaps))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(WIDTH)
    weights[used] = p[:len(used)]
    return Model(weights, p[len(used)] + np.concatenate(([0.0], np.cumsum(np.exp(p[len(used) + 1:])))))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """A model from a bounded sample of the labelled documents."""
    rated = grades(labels)
    sample = rated.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_rows rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array([f.tobytes() for f in found], pa.binary())], ["grade", "features"])

    rows = texts.select("doc_id", "text", "grade").mapInArrow(run, "grade int, features binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.grade, bytes(r.features)))
    return fit([(np.frombuffer(r.features, np.int32), r.grade) for r in rows])


class Scorer:
    """Scores texts; remembers the summed weights of the words met lately."""

    def __init__(self, weights: np.ndarray, limit: int = 500_000):
        self.weights, self.limit = weights.tolist(), limit
        self.known: dict[str, float] = {}
        self.parts: dict[str, list[int]] = {}

    def score(self, text: str | None) -> float:
        words = (text or "").split()
        distinct = set(words)
        if not distinct:
            return self.weights[share_feature(0, 0)]
        if len(self.known) > self.limit:
            self.known.clear()
        # only features with a weight matter; each counts once in a text
        found: set[int] = set()
        known, weights = self.known, self.weights
        for w in distinct:
            got = known.get(w)
            if got is None:
                got = known[w] = tuple(f for f in word_features(w) if weights[f])
            found.update(got)
        found.add(share_feature(len(distinct), len(words)))
        return sum(map(weights.__getitem__, sorted(found)))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, tail: float = TAIL) -> DataFrame:
    """Every column of ``docs`` but the text, with score, expected_grade,
    tail_probability (of the top grade) and kept."""
    return _apply(docs, train(docs, labels, max_rows), tail, keep_text=False)


def select_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, tail: float = TAIL) -> DataFrame:
    """The documents that ``classify`` keeps, whole."""
    scored = _apply(docs, train(docs, labels, max_rows), tail, keep_text=True)
    return scored.filter("`__verdict`.kept").select(*[F.col(f"`{c}`") for c in docs.columns])


_VERDICT = "score double, expected_grade double, tail_probability double, kept boolean"


def _apply(docs: DataFrame, model: Model | None, tail: float, keep_text: bool) -> DataFrame:
    columns = [c for c in docs.columns if keep_text or c != "text"]
    if model is None:
        verdict = F.from_json(F.lit('{"kept": true}'), _VERDICT).alias("__verdict")
        scored = docs.select(*[F.col(f"`{c}`") for c in columns], verdict)
        return scored if keep_text else scored.select(*[F.col(f"`{c}`") for c in columns], "__verdict.*")
    weights = np.where(np.abs(model.weights) > 1e-4, model.weights, 0.0)
    shared = docs.sparkSession.sparkContext.broadcast((weights, model.thresholds))  # WIDTH numbers

    @F.pandas_udf(_VERDICT)
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, thresholds = shared.value
        scorer, model = Scorer(weights), Model(weights, thresholds)
        for series in texts:
            score = np.array([scorer.score(t) for t in series], float)
            tails = model.tails(score)
            yield pd.DataFrame({"score": score, "expected_grade": tails.sum(axis=1),
                                "tail_probability": tails[:, -1], "kept": tails[:, -1] >= tail})

    scored = docs.select(*[F.col(f"`{c}`") for c in columns], judge("text").alias("__verdict"))
    return scored if keep_text else scored.select(*[F.col(f"`{c}`") for c in columns], "__verdict.*")
