"""Operator 12: periodic runs of words by an online sparse diagonal DP.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``min_length`` words and ``min_exponent`` periods long, that no
neighbouring word extends.

A diagonal is a lag.  For each word, its earlier occurrences increment the
match lengths of their lags; a diagonal that ends with sufficient length emits
its run at once.  Counting every earlier occurrence of a frequent word takes
quadratic time, so an occurrence here is one of the word together with the
words before it, 2^b of them in all, and each word looks at one earlier
occurrence a band b: the nearest.  Its lag counts if it lies in the band,
2^(b-1) < lag <= 2^b.  That loses nothing: inside a run of smallest period q a
stretch of q to 2q - 1 words never recurs at a distance below q, since it
would then have a smaller period (Fine and Wilf), and it does recur at q.  So
in each band a run is a maximal series of neighbouring words with the lag q.
Only words whose stretch occurs twice go on to the next band.

Each document is scanned by itself, in time n log^2 n and memory n, however
often its words repeat; numpy works on a few megabytes of documents at once.
There is no shuffle.

Words are maximal runs without ASCII white space, compared byte by byte.  Null
and empty texts have no words and no runs; a null text's collapsed text is
empty.  Repeated rows and ids are judged row by row, null ids like any other.
Extra columns stay; columns named ``n_words``, ``runs`` or ``collapsed_text``
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_LENGTH = 6
MIN_EXPONENT = 4
BATCH_BYTES = 4 << 20
ADDED = ["n_words", "runs", "collapsed_text"]
RUNS_TYPE = "array<struct<start:long,length:long,period:long>>"


def diagonals(words: np.ndarray, longest: int, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period.  ``words``:
    numbers of the words of several documents, no number in two of them;
    ``longest``: words of the longest document."""
    found = []
    at, ids = np.arange(len(words)), words.astype(np.int64)     # ends of the stretches, and which stretch it is
    width = 1
    while len(at) and width // 2 + 1 <= longest // min_exponent:
        order = np.argsort(ids, kind="stable")
        same = ids[order[1:]] == ids[order[:-1]]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        # match lengths of the diagonals of this band
        on = np.flatnonzero((lag > width // 2) & (lag <= width))
        if len(on):
            ends = np.flatnonzero((np.diff(at[on]) != 1) | (np.diff(lag[on]) != 0))
            first, last = on[np.append(0, ends + 1)], on[np.append(ends, len(on) - 1)]
            period = lag[first]
            length = at[last] - at[first] + period + width
            long = (length >= min_length) & (length >= min_exponent * period)
            found.append(np.stack((at[first] - period - width + 1, length, period), axis=1)[long])
        # twice as many words, where both halves occur twice
        full = np.full(len(words), -1, np.int64)
        full[at[twice]] = np.unique(ids[twice], return_inverse=True)[1]
        at = at[twice & (at >= width)]
        at = at[full[at - width] >= 0]
        ids = full[at - width] * len(words) + full[at]
        width *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def scan(texts: list[bytes], min_length: int, min_exponent: int) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    """Per text: number of words, runs as rows (start, length, period), and
    the words that stay, joined by one space."""
    split = [t.split() for t in texts]                  # bytes.split: ASCII white space
    sizes = np.array([len(w) for w in split], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    number, total = _Numbers(), int(offsets[-1])
    flat = np.fromiter((number[w] for ws in split for w in ws), np.int64, total)
    flat += np.repeat(np.arange(len(texts)), sizes) * len(number)     # no number in two documents
    start, length, period = diagonals(flat, int(sizes.max(initial=0)), min_length, min_exponent)
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    gone = np.cumsum(edge)[:total] > 0
    owner = np.searchsorted(offsets, start, side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs, kept = [], []
    for i, ws in enumerate(split):
        a, b = cuts[i], cuts[i + 1]
        runs.append(np.stack((start[a:b] - offsets[i], length[a:b], period[a:b]), axis=1))
        if a < b:
            ws = [ws[j] for j in np.flatnonzero(~gone[offsets[i]:offsets[i + 1]])]
        kept.append(b" ".join(ws))
    return sizes.tolist(), runs, kept


def detect(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (by start, then period) and
    ``collapsed_text``: the text without the words that some run holds after
    its first period, words joined by one space."""
    if min_exponent < 3:
        raise ValueError("a run has at least three periods")
    others = [c for c in docs.columns if c not in ("text", *ADDED)]
    row = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("row")
    packed = docs.select(row, "text")
    kept_fields = packed.schema["row"].dataType.fields[:-1]
    schema = T.StructType([*kept_fields, T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T._parse_datatype_string(RUNS_TYPE)),
                           T.StructField("collapsed_text", T.StringType())])

    def judged(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(v.as_py() or "").encode() for v in rows.column(1)]
        n_words, runs, kept = scan(texts, min_length, min_exponent)
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        struct = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], ["start", "length", "period"])
        offsets = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in runs]))), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*rows.column(0).flatten()[:-1], rows.column(1), pa.array(n_words, pa.int64()),
             pa.ListArray.from_arrays(offsets, struct), pa.array([k.decode() for k in kept], pa.string())], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(1)]
            start = size = 0
            for i, s in enumerate(sizes):
                if size + s > BATCH_BYTES and i > start:
                    yield judged(batch.slice(start, i - start))
                    start, size = i, 0
                size += s
            if batch.num_rows > start:
                yield judged(batch.slice(start))

    found = packed.mapInArrow(run, schema)
    order = [c for c in docs.columns if c not in ADDED]
    return found.select(*[F.col(f"`{c}`") for c in order], *ADDED)
