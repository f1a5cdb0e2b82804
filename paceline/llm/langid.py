"""Operator 6: language identification by hierarchical discrimination.

First the language family is predicted, then one-versus-one linear support
vector machines separate the languages inside it.  Both levels are linear
machines with squared hinge loss over hashed byte trigrams of the whole text
(lower-case ASCII, every byte of the text in some trigram), normalised to
length one after a square root.  Between families and inside one, the label
with most one-versus-one wins is taken, ties by the summed margins.

``FAMILIES`` names the family of a language code; a code that it lacks is a
family of its own, so any set of labels can be learned.  The machines are fit
on at most ``per_language`` documents of each language, those with the
smallest hash of their id.  The score is the product of the winner's logistic
margins against its closest rival at both levels.

A text that is null or has no letter is ``und`` with score 0.  With no
labelled document at all, every text is ``und``.  Labels are never read when
predicting.  Repeated rows repeat; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 4096
PER_LANGUAGE = 1500
UNKNOWN = "und"
# Families of common ISO 639-1 codes.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "be"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu", "ne"),
    "semitic": ("ar", "he", "am", "mt"),
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes}
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[ord("A"):ord("Z") + 1] += 32
_PIECE = 1 << 20  # bytes turned into trigrams at a time


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang, f"own:{lang}")


def has_letter(text: str | None) -> bool:
    """True if some character is a letter (Unicode category L)."""
    return bool(text) and any(c.isalpha() for m in _LETTER.finditer(text) for c in m.group())


def trigrams(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of a text, of length one (zero if it has none)."""
    raw = _FOLD[np.frombuffer(f" {text or ''} ".encode(), np.uint8)]
    counts = np.zeros(WIDTH)
    for at in range(0, max(1, len(raw) - 2), _PIECE):
        b = raw[at:at + _PIECE + 2]
        code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
        counts += np.bincount(code >> np.uint32(20), minlength=WIDTH)
    x = np.sqrt(counts)
    norm = np.linalg.norm(x)
    return x / norm if norm else x


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 80) -> np.ndarray:
    """Weights (the bias last) of a squared-hinge machine, by Nesterov steps;
    ``x`` in single precision and never copied, as it is the driver's largest table."""
    y = y.astype(np.float32)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = z = np.zeros(x.shape[1] + 1, np.float32)
    rate, t = 1 / (1 + 4 * c), 1.0
    for _ in range(steps):
        pull = share * y * np.maximum(0, 1 - y * (x @ z[:-1] + z[-1]))
        grad = z - 2 * c * np.append(x.T @ pull, pull.sum())
        after, t1 = z - rate * grad, (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, w, t = (after + (t - 1) / t1 * (after - w)).astype(np.float32), after.astype(np.float32), t1
    return w


@dataclass
class Duel:
    """One-versus-one machines between labels."""

    labels: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, labels: list[str]) -> Duel:
        out = cls(labels, list(itertools.combinations(range(len(labels)), 2)))
        if out.pairs:
            ws = []
            for i, j in out.pairs:
                mine = (y == labels[i]) | (y == labels[j])
                ws.append(svm(x if mine.all() else x[mine], np.where(y[mine] == labels[i], 1.0, -1.0)))
            out.weights = np.array(ws, np.float32).T
        return out

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the winning label and its confidence, for each row."""
        if not self.pairs:
            return np.zeros(len(x), int), np.ones(len(x))
        margin = x @ self.weights[:-1] + self.weights[-1]
        votes = np.zeros((len(x), len(self.labels)))
        least = np.full(votes.shape, np.inf)
        for k, (i, j) in enumerate(self.pairs):
            m = margin[:, k].astype(float)
            votes[:, i] += (m >= 0) + 1e-3 * np.tanh(m)
            votes[:, j] += (m < 0) - 1e-3 * np.tanh(m)
            least[:, i], least[:, j] = np.minimum(least[:, i], m), np.minimum(least[:, j], -m)
        best = votes.argmax(axis=1)
        return best, 1 / (1 + np.exp(-3 * np.clip(least[np.arange(len(x)), best], -50, 50)))


@dataclass
class Hierarchy:
    families: Duel
    inside: list[Duel]

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> Hierarchy:
        of = np.array([family(v) for v in langs])
        names = sorted(set(of))
        inside = [Duel.fit(x[of == f], langs[of == f], sorted(set(langs[of == f]))) for f in names]
        return cls(Duel.fit(x, of, names), inside)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        which, sure = self.families.predict(x)
        out, score = [""] * len(x), sure.copy()
        for f, duel in enumerate(self.inside):
            at = np.flatnonzero(which == f)
            if len(at):
                best, own = duel.predict(x[at])
                score[at] *= own
                for i, b in zip(at, best):
                    out[i] = duel.labels[b]
        return out, score


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Hierarchy | None:
    """Machines from (doc_id, text, lang), ``per_language`` rows of each."""
    known = labelled.filter("lang is not null and text is not null")
    order = F.xxhash64(F.lit("langid"), F.col("doc_id"))
    ranked = _smallest(known.select("lang", order.alias("o")), per_language)
    picked = known.select("text", "lang", order.alias("o")).join(F.broadcast(ranked), ["lang", "o"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = [], []
            for t in batch.column(1):
                full = trigrams(t.as_py())
                some = np.flatnonzero(full)
                at.append(some.astype("<u2").tobytes())
                x.append(full[some].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at, pa.binary()), pa.array(x, pa.binary()), batch.column(2)],
                ["lang", "at", "x", "o"])

    # only the trigrams that occur: a small part of WIDTH
    rows = picked.select("lang", "text", "o").mapInArrow(run, "lang string, at binary, x binary, o long").collect()
    rows = sorted((r.lang, r.o, bytes(r.at), bytes(r.x)) for r in rows if r.at)
    if not rows:
        return None
    langs = np.array([r[0] for r in rows])
    x = np.zeros((len(rows), WIDTH), np.float32)
    for i, (_, _, at, values) in enumerate(rows):
        x[i, np.frombuffer(at, "<u2")] = np.frombuffer(values, "<f4")
    del rows
    return Hierarchy.fit(x, langs)


def _smallest(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest distinct ``o`` of every ``lang``.  Buckets of a hash
    are cut to their ``n`` smallest first, so no task sorts a whole language."""
    bucket = F.pmod(F.hash("o"), F.lit(64))
    first = Window.partitionBy("lang", bucket).orderBy("o")
    last = Window.partitionBy("lang").orderBy("o")
    few = rows.distinct().withColumn("k", F.row_number().over(first)).filter(F.col("k") <= n)
    return few.withColumn("k", F.row_number().over(last)).filter(F.col("k") <= n).select("lang", "o")


def identify(docs: DataFrame, model: Hierarchy | None, keep: list[Column] | None = None) -> DataFrame:
    """(doc_id, columns of ``keep``, lang_pred, score) from the texts alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH numbers for each pair of labels

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for series in texts:
            for at in range(0, max(1, len(series)), 1024):
                part = series.iloc[at:at + 1024]
                lang, score = [UNKNOWN] * len(part), np.zeros(len(part))
                if model is not None and len(part):
                    got, sure = model.predict(np.array([trigrams(t) for t in part], np.float32))
                    for i, t in enumerate(part):
                        if has_letter(t):
                            lang[i], score[i] = got[i], sure[i]
                frames = pd.DataFrame({"lang_pred": lang, "score": score.astype(float)})
                out = frames if at == 0 else pd.concat((out, frames), ignore_index=True)
            yield out

    return docs.select("doc_id", *(keep or []), predict("text").alias("p")).select(
        "doc_id", *(docs.select(*keep).columns if keep else []), "p.*")
