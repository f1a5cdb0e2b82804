"""Operator 5: substring dedup by level-wise doubling.

A window of ``window`` consecutive words is removed when the same words also
start earlier: in a document with a smaller id, or earlier in the document.

The lengths of the levels double: from at most ``BASE`` words up to the window
(10 and 20; 10, 20, 40 and 80).  A long window can only repeat if every shorter
window inside it repeats, so at each level one of them, chosen by its content
alone (the smallest hash, leftmost), stands for it; equal windows choose the
same one.  At 10 of 20 words about one in six is chosen.  The chosen ones that
occur once in the whole corpus rule out all windows they stand for, and only
the others go on to twice the length, until none is left or the last level
finds for each whole window the first place where it starts.  Every other
candidate is removed.

Nothing but (hash, document, number) rows is grouped: counts and first places
are pre-aggregated before the shuffle, so a passage in a third of all
documents leaves each task as one row.  Each level answers with the numbers of
a document's windows, which come back by document id; the texts travel
compressed and are cut up in the task that holds them.

Hashes: a word's is mixed from its bytes, eight at a time (XXH3 of words over
``SHORT`` bytes), a window's from those of two shorter ones, so no pattern of
letters or words cancels out.  At the shorter
lengths equal hashes of different windows only let a candidate through; whole
windows are told apart by two hashes of 64 bits with different seeds.

Words are maximal runs without ASCII white space.  Null and empty texts have no words.  Rows that share a
doc_id follow one another by a hash of their text; a null doc_id comes last.
Removing everything leaves an empty text; extra columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.llm.common import spool

WINDOW = 20
BASE = 10
SHORT = 32                   # bytes of the words that are hashed together
TOGETHER = 128               # texts whose windows are hashed and sorted together
_LAST = (1 << 63) - 1
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)      # masks of so many bytes
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
_SPACE = np.zeros(256, np.int8)
_SPACE[[0x20, *range(0x09, 0x0E)]] = 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words."""
    edge = np.diff(_SPACE[np.frombuffer(raw, np.uint8)], prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


class _WordHashes(dict):
    """XXH3 of words."""

    def __init__(self, seed: int):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


_HASHES = [_WordHashes(0), _WordHashes(1)]


def _eights(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which words, their next eight bytes as a number) until all words of at
    most ``SHORT`` bytes are read; ``raw``: whole numbers, two more than the words need."""
    on = np.flatnonzero(size <= SHORT)
    at, left = start[on], size[on]
    while len(on):
        slot, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
        eight = raw[slot] >> shift | raw[slot + 1] << np.uint64(1) << (np.uint64(63) - shift)
        yield on, eight & _FIRST[np.minimum(left, 8)]
        more = left > 8
        on, at, left = on[more], at[more] + 8, left[more] - 8


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (none if there are fewer): two
    windows of half the length, then two that overlap for what is left."""
    h, width = words, 1
    while width < k and len(h):
        step = min(width, k - width)
        h = _mix(_mix(h[:-step] if step < len(h) else h[:0]) + h[step:] * _MIX1)
        width += step
    return h


def levels(window: int) -> list[int]:
    """Lengths below the window's: each at least half of the next."""
    lengths, n = [], window
    while not lengths or n > BASE:
        n = (n + 1) // 2
        lengths.insert(0, n)
    return lengths


class Words:
    """The words of a text: where they start and how many bytes they have."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.start, stop = word_spans(raw)
        self.size = stop - self.start
        self.eights = list(_eights(np.frombuffer(raw + bytes(24 - len(raw) % 8), "<u8"), self.start, self.size))

    def __getitem__(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.start[i] + self.size[i]]

    def hashes(self, which: int = 0) -> np.ndarray:
        """Of each word: eight bytes at a time are mixed in, after its size; XXH3 of long words."""
        h = _mix(self.size.astype(np.uint64) + _SEEDS[which])
        for on, eight in self.eights:
            h[on] = _mix((h[on] ^ eight) * _MIX1 + _SEEDS[which])
        for i in np.flatnonzero(self.size > SHORT).tolist():
            h[i] = _HASHES[which][self[i]]
        return h


class Windows:
    """The windows of some texts, one after the other; ``of``: the text of each
    word.  Places are counted over all texts.  ``alone``: for each level so far,
    (how many of each text, numbers) of the chosen shorter windows that no other
    place of the corpus has."""

    def __init__(self, texts: list[bytes | None], window: int):
        self.raw, self.window = texts, window
        self.words = Words(b" ".join([t or b"" for t in texts]))
        self.end = np.searchsorted(self.words.start, np.cumsum([len(t or b"") + 1 for t in texts]))
        self.n = np.diff(self.end, prepend=0)
        self.of = np.repeat(np.arange(len(texts)), self.n)

    def hashes(self, which: int = 0) -> np.ndarray:
        return self.words.hashes(which)

    def first(self, of: np.ndarray) -> np.ndarray:
        """Where each text begins in the ascending ``of``."""
        return np.searchsorted(of, np.arange(len(self.raw)))

    def chosen_of(self, lists: tuple[np.ndarray, np.ndarray], of: np.ndarray) -> np.ndarray:
        """Which of the distinct hashes (those of text ``of``) a column of lists names."""
        sizes, numbers = lists
        named = np.zeros(len(of), bool)
        named[numbers + np.repeat(self.first(of), sizes)] = True
        return named

    def anchors(self, at: np.ndarray, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows ``at``: each text's distinct hashes of the chosen
        windows of ``length`` words, the texts, how often each was chosen, and
        every window's one."""
        if not len(at):
            none = np.array([], np.int64)
            return none.astype(np.uint64), none, none, none
        g = window_hashes(words, length)
        place = _leftmost_least(g, self.window - length + 1)[at]
        new = np.append(True, place[1:] != place[:-1])              # places ascend
        chosen, of_window = place[new], np.cumsum(new) - 1
        of, h = self.of[chosen], g[chosen]
        order, new = _sorted(of, h)
        number = np.empty(len(chosen), np.int64)
        number[order] = np.cumsum(new) - 1
        return h[order[new]], of[order[new]], np.bincount(number), number[of_window]

    def candidates(self, alone: list[tuple], words: np.ndarray) -> np.ndarray:
        """Places of the windows that no level so far has ruled out."""
        at = np.flatnonzero(np.arange(len(self.of)) + self.window <= self.end[self.of])
        for length, unique in zip(levels(self.window), alone):
            hashes, of, count, of_window = self.anchors(at, words, length)
            once = self.chosen_of(unique, of) & (count == 1)
            at = at[~once[of_window]]
        return at

    def chosen(self, alone: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, text of each) that the next level asks about."""
        words = self.hashes()
        return self.anchors(self.candidates(alone, words), words, levels(self.window)[len(alone)])[:2]

    def whole(self, alone: list[tuple]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """The candidates, each text's distinct double hashes, the texts, first place of each, number of each."""
        words = self.hashes()
        at = self.candidates(alone, words)
        if not len(at):
            none = np.array([], np.int64)
            return at, [none.astype(np.uint64)] * 2, none, none, none
        of = self.of[at]
        pair = [window_hashes(h, self.window)[at] for h in (words, self.hashes(1))]
        order, new = _sorted(of, *pair)                           # stable: places ascend within equal pairs
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(new) - 1
        lead = order[new]
        return at, [h[lead] for h in pair], of[lead], at[lead], number

    def covered(self, alone: list[tuple], firsts: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """Which words of each text go; ``firsts``: numbers of the candidate
        hashes whose first place is in the text."""
        edge = np.zeros(len(self.of) + 1, np.int64)
        at, _, of, first, number = self.whole(alone)
        if len(at):
            ours = self.chosen_of(firsts, of)
            gone = at[~(ours[number] & (at == first[number]))]
            edge[gone] += 1                                       # every place once
            edge[gone + self.window] -= 1
        return np.split(np.cumsum(edge)[:-1] > 0, self.end[:-1])

    def kept_text(self, i: int, gone: np.ndarray) -> str:
        """Text ``i`` without the words of ``gone`` and the space after them."""
        raw = self.raw[i]
        if not gone.any():
            return raw.decode()
        start, _ = word_spans(raw)
        upto = np.append(start[1:], len(raw))
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        parts, at = [], 0
        for a, b in zip(edge[::2], edge[1::2]):
            parts.append(raw[at:start[a]])
            at = upto[b - 1]
        parts.append(raw[at:])
        return b"".join(parts).decode()

    def kept_digest(self, i: int, gone: np.ndarray) -> str:
        """SHA-256 of the kept words joined by one space."""
        words = (self.raw[i] or b"").split()
        if gone.any():
            words = list(compress(words, ~gone))
        return hashlib.sha256(b" ".join(words)).hexdigest()


def _sorted(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by the keys, which rows in that order differ from the one before); stable."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    return order, new


def _leftmost_least(g: np.ndarray, k: int) -> np.ndarray:
    """Place of the least of every k consecutive numbers, the leftmost of equal ones."""
    place, width = np.arange(len(g)), 1
    while width < k and len(place):
        step = min(width, k - width)
        left, right = place[:-step] if step < len(place) else place[:0], place[step:]
        place = np.where(g[left] <= g[right], left, right)
        width += step
    return place


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as (row, doc, text): ``row`` holds the other columns, ``doc``
    is a different long for every row, in the order of the documents."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")
    plain = docs.select(others, doc, "text")
    if not plain.groupBy("doc").count().filter("count > 1").limit(1).count():
        return plain
    # a global sort numbers the rows in order without putting them in one task
    ranked = plain.orderBy("doc", F.xxhash64("text")).withColumn("doc", F.monotonically_increasing_id())
    return spool(ranked, "substring-ranked")


def _lists(rows: DataFrame, name: str) -> DataFrame:
    """(doc, list of numbers); bounded by the windows of one document."""
    return rows.groupBy("doc").agg(F.collect_list("number").alias(name))


def remove_repeats(docs: DataFrame, window: int = WINDOW, want_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_sha256; with ``want_text``
    the text is what is left, else it is dropped."""
    if window < 2:
        raise ValueError("a window has two words or more")
    packed = _keyed(docs)
    keyed = packed.select("doc", "text")

    others = [c for c in docs.columns if c != "text"]
    row_type = packed.schema["row"].dataType
    z_schema = T.StructType([T.StructField("row", row_type), T.StructField("doc", T.LongType()),
                             T.StructField("z", T.BinaryType())])

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _squeezed(b.column(2))], ["row", "doc", "z"])

    def texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Windows]]:
        """Some rows at a time, and the windows of their texts."""
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in _parts(batch):
                yield part, Windows([None if z is None else unpack.decompress(z) for z in part.column(column).to_pylist()], window)

    def ask(level: int):
        """Rows (hash, document, number) of a level's chosen windows."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, w in texts(batches, 1):
                h, of = w.chosen([_int_lists(c) for c in batch.columns[2:]])
                yield _hash_rows(batch.column(0), w, of, h=h)
        return run

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, w in texts(batches, 1):
            _, (h, i), of, _, _ = w.whole([_int_lists(c) for c in batch.columns[2:]])
            yield _hash_rows(batch.column(0), w, of, h=h, i=i)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first level reads the texts as they are."""
        for batch in batches:
            for part in _parts(batch):
                w = Windows([None if t is None else t.encode() for t in part.column(1).to_pylist()], window)
                h, of = w.chosen([])
                yield _hash_rows(part.column(0), w, of, h=h)

    small = keyed.mapInArrow(lambda batches: (
        pa.RecordBatch.from_arrays([b.column(0), _squeezed(b.column(1))], ["doc", "z"]) for b in batches),
        "doc long, z binary")
    answers: list[DataFrame] = []
    asked = keyed.mapInArrow(plain, "h long, doc long, number int")
    for level in range(len(levels(window))):
        if level:
            asked = _joined(small, answers).mapInArrow(ask(level), "h long, doc long, number int")
            if asked.isEmpty():                          # no candidates survive
                break
        once = asked.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc"),
                                      F.min("number").alias("number")).filter("n = 1")
        answers.append(spool(_lists(once, f"alone{level}"), "substring-alone"))
    long = _joined(small, answers).mapInArrow(whole, "h long, i long, doc long, number int")
    firsts = _lists(long.groupBy("h", "i").agg(F.min("doc").alias("doc"), F.min_by("number", "doc").alias("number")),
                    "firsts")

    out_fields = [*row_type.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                  T.StructField("kept_sha256", T.StringType())]
    if want_text:
        out_fields.insert(0, T.StructField("text", T.StringType()))
    names = [f.name for f in out_fields]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, w in texts(batches, 1):
            firsts, *alone = [_int_lists(c) for c in batch.columns[2:]]
            gone = w.covered(alone, firsts)
            cols = [*batch.column(0).flatten(), pa.array(w.n), pa.array([int(g.sum()) for g in gone], pa.int64()),
                    pa.array([w.kept_digest(i, g) for i, g in enumerate(gone)], pa.string())]
            if want_text:
                cols.insert(0, pa.array([None if w.raw[i] is None else w.kept_text(i, g) for i, g in enumerate(gone)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names)

    marked = _joined(packed.mapInArrow(squeeze, z_schema).join(firsts, "doc", "left"), answers).drop("doc")
    result = marked.mapInArrow(finish, T.StructType(out_fields))
    order = docs.columns if want_text else others
    return result.select(*[F.col(f"`{c}`") for c in order], "n_words", "n_removed", "kept_sha256")


def _joined(texts: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """``texts`` with the answers of all levels so far, in their order."""
    for answer in answers:
        texts = texts.join(answer, "doc", "left")
    return texts


def _squeezed(column: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=3)
    return pa.array([None if (v := t.as_py()) is None else pack.compress(v.encode()) for t in column], pa.binary())


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, TOGETHER):
        yield batch.slice(at, TOGETHER)


def _int_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(size of each list, all numbers); null: none."""
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(), column.flatten().to_numpy()


def _hash_rows(docs: pa.Array, w: Windows, of: np.ndarray, **hashes: np.ndarray) -> pa.RecordBatch:
    """(hashes, doc, number) of every hash of every document; ``of``: the text of each."""
    number = np.arange(len(of)) - w.first(of)[of]
    return pa.RecordBatch.from_arrays([*(pa.array(h.view(np.int64)) for h in hashes.values()), docs.take(pa.array(of)),
                                       pa.array(number.astype(np.int32))], [*hashes, "doc", "number"])
