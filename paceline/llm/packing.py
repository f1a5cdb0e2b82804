"""Operator 9: mixture-controlled packing of tokenized documents.

Every source is a queue of documents.  Output windows (``window_sequences``
sequences of ``sequence_length`` tokens) are filled by deficit round-robin:
in each window a source may send its target share of the window's tokens plus
the deficit it carries from earlier windows, cutting documents freely.  What
a source has sent after w windows is its share of w windows, give or take as
many tokens as there are sources, and follows from w alone.  So any partition
can place its documents without waiting for the windows before: only the
number of tokens of a source in earlier partitions has to be known.  A source that runs dry leaves the round-robin and
the others' shares grow in proportion (one more *phase*).  Targets are whole
numbers or shares of any scale.  Sources without a target follow when those
with one have run dry, and with no targets at all every source is such a one:
their shares are those of the corpus, so they end together.  A target whose
source does not occur is an error.

Only the last sequence can be partial, so the padding is under one sequence.

Steps: (1) tokenize once into a table of ids, two bytes each, in the shared
folder, counting tokens per queue inside every input partition; (2) add up the
counts per (queue, partition), a table of that many rows; (3) read the ids,
give each document its place in its queue, and cut it into pieces.

Null and empty texts are one end token.  A null source is a queue of its own.
Repeated rows are packed as often as they come; extra columns are ignored.
Of more than ``MAX_QUEUES`` sources, those without a target are hashed into
that many queues, which bounds the table of shares on the driver; a source with
a target always has a queue of its own.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import json
import math
import zlib
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.common import spool

SEQUENCE_LENGTH = 1024
WINDOW_SEQUENCES = 64
MAX_QUEUES = 4096
END_ID = 0
_SLICE = 256
_TOKEN_SCHEMA = "doc_id {kind}, queue string, part int, before long, n_ids long, ids binary"
_PIECE_SCHEMA = ("doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                 "sequence_id long, offset long, queue string")


def byte_chars() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary file:
    printable Latin-1 bytes stand for themselves, the others follow U+00FF."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


def check_merges(vocabulary: bytes) -> None:
    """Raise unless ids rank the merges: the merges make every piece of more
    than one byte, in the order of its id.  ``JsonBpe`` relies on it."""
    spec = json.loads(vocabulary)
    added = {t["content"] for t in spec.get("added_tokens", ())}
    vocab = spec["model"]["vocab"]
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
    if None in made or made != sorted(made):
        raise ValueError("the merges of the vocabulary are not in the order of its ids")
    if set(made) != {i for t, i in vocab.items() if len(t) > 1 and t not in added}:
        raise ValueError("the vocabulary has pieces that no merge makes")


class JsonBpe:
    """Ids of a byte-level BPE vocabulary in ``tokenizers`` JSON form.

    The ids of such a file are its merge ranks (``check_merges``), which is what tiktoken merges
    by; its merge loop is several times faster.  A text is cut at the file's
    added tokens, which have ids of their own.  Ids equal those of the
    ``tokenizers`` library in its default setting with add_special_tokens=False.
    """

    def __init__(self, vocabulary: bytes, pattern: str):
        import tiktoken

        of = byte_chars()
        spec = json.loads(vocabulary)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        for t in spec.get("added_tokens", ()):
            if t.get("lstrip") or t.get("rstrip") or t.get("single_word"):
                raise ValueError(f"added token {t['content']!r} asks for stripping or whole words")
        if any(a != b and a in b for a in added for b in added):
            raise ValueError("an added token is part of another one")
        ranks = {bytes(map(of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in added}
        if max([*ranks.values(), *added.values()]) > 0xFFFF:
            raise ValueError("ids must fit two bytes")
        self.merge = tiktoken.Encoding("json", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str) -> np.ndarray:
        return self.merge.encode_to_numpy(text, allowed_special="all").astype("<u2")

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 16-bit integers."""
        return [self.encode(t).tobytes() for t in texts]


def present(docs: DataFrame, targets: dict) -> dict:
    """The targets of those sources that ``docs`` hold."""
    rows = docs.select(F.col("source").cast("string").alias("q")).distinct()
    named = rows.filter(F.col("q").isNull() | F.col("q").isin([q for q in targets if q is not None]))
    found = {r.q for r in named.collect()}  # at most one row a target, and null
    return {q: t for q, t in targets.items() if q in found}


def tokenize(docs: DataFrame, vocabulary: str, pattern: str, max_queues: int = MAX_QUEUES,
             targeted: Iterable = ()) -> DataFrame:
    """Ids of every document, its queue, and the queue's tokens before it in
    the same input partition.  Spool the result: ``part`` and ``before`` tell
    of the partitions of this one run.  Sources in ``targeted`` keep queues of
    their own."""
    with open(vocabulary, "rb") as f:
        raw = f.read()
    check_merges(raw)
    shared = docs.sparkSession.sparkContext.broadcast(raw)  # one vocabulary, under 2 MB
    kind = docs.schema["doc_id"].dataType.simpleString()
    few = docs.select("source").distinct().count() <= max_queues
    queue = F.col("source").cast("string")
    if not few:
        own = [q for q in targeted if q is not None]
        # more marks than any targeted name begins with
        mark = "#" * (1 + max((len(q) - len(q.lstrip("#")) for q in own), default=0))
        bucket = F.concat(F.lit(mark), F.pmod(F.crc32(queue.cast("binary")), F.lit(max_queues)).cast("string"))
        queue = F.when(queue.isin(own), queue).otherwise(bucket)
    schema = _TOKEN_SCHEMA.format(kind=kind)
    names = ["doc_id", "queue", "part", "before", "n_ids", "ids"]
    end = np.array([END_ID], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = JsonBpe(shared.value, pattern)
        part, sent = TaskContext.get().partitionId(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                rows = batch.slice(at, _SLICE)
                ids = [i + end for i in bpe.encode_batch([t or "" for t in rows.column(2).to_pylist()])]
                sizes, before = [len(i) // 2 for i in ids], []
                for q, n in zip(rows.column(1).to_pylist(), sizes):
                    before.append(sent.get(q, 0))
                    sent[q] = before[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array([part] * len(ids), pa.int32()),
                     pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())], names)

    return docs.select("doc_id", queue.alias("queue"), "text").mapInArrow(run, schema)


def whole_shares(targets: dict) -> dict:
    """Targets as whole numbers in the same proportions (0.7 is seven tenths)."""
    shares = {q: Fraction(str(t)) for q, t in targets.items()}
    if any(t < 0 for t in shares.values()):
        raise ValueError("targets must not be negative")
    unit = math.lcm(*(t.denominator for t in shares.values()))
    return {q: int(t * unit) for q, t in shares.items()}


class Mixture:
    """Where the tokens of every queue go.

    ``totals``: (queue, tokens), ``targets``: shares by queue (none: those of
    the totals).  A phase is a stretch of the output in which the same queues
    are served.  ``_sent`` gives what each queue has sent after n tokens of a
    phase: token t of a queue with weight w is due at (t + 1) / w, and tokens
    go in the order of their due times.  So a queue has always sent at least
    its share, rounded down, and no count ever falls.
    """

    def __init__(self, totals: list[tuple], targets: dict | None, window: int):
        self.window = window
        left = {q: n for q, n in totals if n}
        shares = whole_shares(targets or {})
        unknown = set(shares) - {q for q, _ in totals}
        if totals and unknown:
            raise ValueError(f"targets without a queue: {sorted(map(str, unknown))[:5]}")
        weight = {q: shares.get(q, 0) for q in left}
        self.phases: list[tuple] = []      # (start, end, weights)
        self.by_queue: dict = {}           # queue -> [(tokens sent before, phase, index)]
        self.sums: OrderedDict = OrderedDict()
        served, start = dict.fromkeys(left, 0), 0
        while left:
            # queues without a target are served when the others have run dry
            live = sorted((q for q in left if weight[q]), key=str) or sorted(left, key=str)
            weights = [weight[q] or left[q] for q in live]
            n = self._length(weights, [left[q] for q in live])
            for i, (q, sent) in enumerate(zip(live, self._sent(weights, n))):
                self.by_queue.setdefault(q, []).append((served[q], len(self.phases), i))
                served[q] += sent
                left[q] -= sent
            self.phases.append((start, start + n, weights))
            left = {q: k for q, k in left.items() if k}
            start += n

    @staticmethod
    def _sent(weights: list[int], n: int) -> list[int]:
        total = sum(weights)
        sent = [n * w // total for w in weights]
        due = [(Fraction(s + 1, w), i) for i, (s, w) in enumerate(zip(sent, weights))]
        heapq.heapify(due)
        for _ in range(n - sum(sent)):
            _, i = due[0]
            sent[i] += 1
            heapq.heapreplace(due, (Fraction(sent[i] + 1, weights[i]), i))
        return sent

    def _length(self, weights: list[int], left: list[int]) -> int:
        """Tokens until a queue has sent all it has."""
        low, high = 1, sum(left)
        while low < high:
            middle = (low + high + 1) // 2
            if all(s <= k for s, k in zip(self._sent(weights, middle), left)):
                low = middle
            else:
                high = middle - 1
        return low

    def _before(self, phase: int, w: int) -> tuple[int, list[int]]:
        """Output position where window ``w`` begins within the phase, and the
        running sums over its queues of what they have sent until there."""
        start, end, weights = self.phases[phase]
        g = min(max(w * self.window, start), end)
        got = self.sums.get((phase, g))
        if got is None:
            got = self.sums[phase, g] = [0, *itertools.accumulate(self._sent(weights, g - start))]
            if len(self.sums) > 4096:
                self.sums.popitem(last=False)
        return g, got

    def place(self, queue, at: int, n: int) -> list[tuple[int, int]]:
        """Output stretches (position, length) of tokens at..at+n of a queue."""
        out = []
        spans = self.by_queue[queue]
        k = bisect.bisect_right(spans, at, key=lambda s: s[0]) - 1
        while n:
            while k + 1 < len(spans) and at >= spans[k + 1][0]:
                k += 1
            base, phase, i = spans[k]
            start, end, weights = self.phases[phase]
            # a queue is never behind its share: token t is out by t * total / weight
            g = min(start + (at - base + 1) * sum(weights) // weights[i], end)
            w = g // self.window
            while True:
                g0, s0 = self._before(phase, w)
                if s0[i + 1] - s0[i] <= at - base:
                    break
                w -= 1
            while True:
                g1, s1 = self._before(phase, w + 1)
                if s1[i + 1] - s1[i] > at - base:
                    break
                w, g0, s0 = w + 1, g1, s1
            inside = at - base - (s0[i + 1] - s0[i])
            take = min(n, s1[i + 1] - s1[i] - (at - base))
            out.append((g0 + s1[i] - s0[i] + inside, take))
            at, n = at + take, n - take
        return out


def pack(tokens: DataFrame, targets: dict | None = None, sequence_length: int = SEQUENCE_LENGTH,
         window_sequences: int = WINDOW_SEQUENCES) -> DataFrame:
    """Pieces of every document of ``tokenize`` (a spooled table)."""
    sums = tokens.groupBy("queue", "part").agg(F.sum("n_ids").alias("n"))
    order = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("queue").alias("q2"), F.col("part").alias("p2"),
                          F.coalesce(F.sum("n").over(order), F.lit(0)).alias("earlier"))
    # one row per queue: at most MAX_QUEUES, the targeted ones and null
    totals = [(r.queue, r.n) for r in tokens.groupBy("queue").agg(F.sum("n_ids").alias("n")).collect()]
    mixture = Mixture(totals, targets, sequence_length * window_sequences)
    placed = tokens.join(offsets, F.col("queue").eqNullSafe(F.col("q2")) & (F.col("part") == F.col("p2")))
    kind = tokens.schema["doc_id"].dataType.simpleString()
    schema = _PIECE_SCHEMA.format(kind=kind)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            cols: list[list] = [[] for _ in range(6)]
            start, length, crc, total, sequence, offset = cols
            for k, (q, at, ids) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                                 batch.column(3).to_pylist())):
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                n, done = len(ids) // 2, 0
                for position, size in mixture.place(q, at, n):
                    while size:
                        s, o = divmod(position, sequence_length)
                        take = min(size, sequence_length - o)
                        rows.append(k)
                        start.append(done)
                        length.append(take)
                        crc.append(zlib.crc32(wide[4 * done:4 * (done + take)]))
                        total.append(n)
                        sequence.append(s)
                        offset.append(o)
                        position, size, done = position + take, size - take, done + take
            pick = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pick), *(pa.array(c, pa.int64()) for c in cols), batch.column(1).take(pick)],
                names)

    return placed.select("doc_id", "queue", (F.col("before") + F.col("earlier")).alias("at"), "ids"
                         ).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, targets: dict | None = None,
                   sequence_length: int = SEQUENCE_LENGTH, window_sequences: int = WINDOW_SEQUENCES,
                   max_queues: int = MAX_QUEUES) -> DataFrame:
    """Tokenize, spool the ids, and pack them."""
    ids = tokenize(docs, vocabulary, pattern, max_queues, targets or ())
    return pack(spool(ids, "pack-ids"), targets, sequence_length, window_sequences)
