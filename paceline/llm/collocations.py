"""Operator 13: collocations, counted by double-array tries.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
pieces into words at spaces and tabs.  A phrase of two to ``max_words`` words
that occurs ``min_count`` times inside pieces is a candidate; its score is
2,000,000 times its count over the counts of the two parts of its weakest cut.

1. Words are counted exactly, pre-aggregated in each task.
2. Apriori-safe candidates.  Every phrase has a 64-bit hash; hashes are counted
   for pairs whose two words are frequent, then for longer phrases whose pairs
   all are.  Each part adds up a range of hashes.  Phrases that share a hash
   only add up, so a sum below ``min_count`` rules a phrase out for certain.  Hashes that pass are
   broadcast as a bitmap of at most ``2 ** BITMAP_BITS`` bits, three set for
   each hash, whatever their number (a fuller bitmap lets more through, never
   less).
3. One more pass takes from each place of a text its window: the longest phrase
   that starts there and whose hash and parts' hashes pass.  Windows that start
   with the same two words go to one part, equal ones of a task as one with
   their number.  The candidates are what the windows start with, also where
   several share a hash, so no phrase that occurs often enough is left out.
   A part's candidates make a trie; a part with more than ``TRIE_BYTES`` of
   different windows makes several, one after the other.  A trie is built as a double array
   (state and word give the next state by one addition and one comparison).
   Numpy advances the states of all its windows at once, level by level, and
   counts the accepting states with bincount; Spark adds up the counts of the
   tries.  These counts are exact and decide.  However many tries there are,
   each window is walked through one of them and the texts are read once.
4. Cuts, containment and ranks are joins and grouped aggregates; each
   language's best are first taken in buckets, so no language is sorted in one
   task.

Everything is per language (null: ``und``).  Null and empty texts have no
words; repeated rows count each time; ids and extra columns are not read.  An
empty table gives an empty result.  Products are decimals of 38 digits.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.llm.common import spool
from paceline.llm.substring import Words

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
COVER_PERCENT = 80           # a longer candidate this frequent covers a shorter one
SCALE = 2_000_000
BITMAP_BITS = 29             # 64 MB at most
TRIE_BYTES = 16 << 20        # of the windows whose phrases make a trie
BATCH_BYTES = 4 << 20
HELD = 300_000               # different words or windows that a task adds up before they go on
TOP_BUCKETS = 64
PART_HASHES = 2_000_000      # of phrases, as they are dealt to be added up
BREAK = b"\xff"              # between pieces; not a byte of UTF-8
_CUT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def tokens(text: str) -> bytes:
    """Words of a text, with BREAK between its pieces and at its end, in spaces."""
    raw = text.encode().lower().translate(_CUT)      # bytes.lower: A-Z only
    return raw.replace(BREAK, b" \xff ") + b" \xff"


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, tokens) of a few megabytes of texts at a time."""
    def grouped(rows: list[tuple[str, str]]) -> Iterator[tuple[str, bytes]]:
        by_lang: dict[str, list[str]] = {}
        for lang, text in rows:
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            yield lang, tokens("\n".join(texts))         # a line end is a break

    rows, size = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            rows.append((lang.as_py(), text.as_py()))
            size += len(rows[-1][1])
            if size > BATCH_BYTES:
                yield from grouped(rows)
                rows, size = [], 0
    yield from grouped(rows)


# ------------------------------------------------------------------ hashes

def step(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    x = (h ^ word) * _A
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def word_hashes(words: Words) -> np.ndarray:
    """Hash of each word; 0 is the break between pieces."""
    h = np.maximum(words.hashes(), np.uint64(1))
    h[np.frombuffer(words.raw, np.uint8)[words.start] == BREAK[0]] = 0       # no byte of UTF-8
    return h


def _seed(lang: str) -> np.uint64:
    # not the hash of a word: with it, "es" before a word in "en" would be "en" before it in "es"
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), 1))


class Bitmap:
    """Which hashes may be frequent, by ``bits`` of their bits in three places."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def has(self, h: np.ndarray) -> np.ndarray:
        on = np.arange(len(h))
        for shift in self.shifts(self.bits):
            slot = h[on] >> np.uint64(shift) & np.uint64((1 << self.bits) - 1)
            on = on[(self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)]
        out = np.zeros(len(h), bool)
        out[on] = True
        return out

    @staticmethod
    def shifts(bits: int) -> tuple[int, int, int]:
        return 64 - bits, 0, 18


def bitmap(hashes: DataFrame, most_bits: int = BITMAP_BITS) -> Bitmap:
    """Of the column ``h``: set bits are merged in Spark, the driver receives
    the words of a bitmap whose size is bounded."""
    n = hashes.count()
    bits = min(most_bits, max(12, math.ceil(math.log2(64 * n + 1))))
    slots = [F.shiftrightunsigned(F.col("h"), shift).bitwiseAND(F.lit((1 << bits) - 1)) for shift in Bitmap.shifts(bits)]
    slot = F.col("slot")
    marked = hashes.select(F.explode(F.array(*slots)).alias("slot")).select(
        F.shiftright(slot, 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int")).alias("bit"))
    words = np.zeros(1 << (bits - 6), np.uint64)
    found = marked.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words[found["word"].to_numpy()] = found["bit"].to_numpy().view(np.uint64)
    return Bitmap(bits, words)


def live(words: np.ndarray, seed: np.uint64, maps: list[Bitmap], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, positions, hashes) of the phrases of 1 to ``most`` words that may be
    frequent, as all their parts; ``maps``: by number of words.  Phrases of
    more words than there are maps are judged by the longest mapped parts."""
    at = np.flatnonzero(words)
    h = step(np.full(len(at), seed), words[at])
    for k in range(1, most + 1):
        if k <= len(maps):
            good = maps[k - 1].has(h)
            at, h = at[good], h[good]
        yield k, at, h
        # the phrase one word on must be live too; its last word is the next one
        both = np.flatnonzero(np.diff(at) == 1)
        h, at = step(h[both], words[at[both] + k]), at[both]


# ------------------------------------------------------------ passes over texts

def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, word, h, f) of every word, exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            for lang, words in counted.items():
                words.pop(BREAK, None)
                keys = list(words)
                h = step(np.full(len(keys), _seed(lang)), word_hashes(Words(b" ".join(keys))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array([w.decode() for w in keys], pa.string()),
                     pa.array(h.view(np.int64)), pa.array(list(words.values()), pa.int64())], ["lang", "word", "h", "f"])

        counted: dict[str, Counter] = {}
        for lang, raw in _batches(batches):
            counted.setdefault(lang, Counter()).update(raw.split())
            if sum(map(len, counted.values())) > HELD:
                yield from rows()
                counted = {}
        yield from rows()

    found = texts.mapInArrow(run, "lang string, word string, h long, f long")
    return found.groupBy("lang", "word").agg(F.max("h").alias("h"), F.sum("f").alias("f"))


def count_hashes(texts: DataFrame, maps: list[Bitmap], most: int, min_count: int, parts: int) -> DataFrame:
    """(k, h, n) of the phrase hashes that occur ``min_count`` times, for phrases
    of more words than ``maps`` covers, up to ``most``.  Each of the ``parts``
    has a range of hashes."""
    shared = texts.sparkSession.sparkContext.broadcast(maps)
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held: dict[int, list[np.ndarray]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for k, found in held.items():
                h, n = np.unique(np.concatenate(found), return_counts=True)
                cut = [0, *np.searchsorted(h, edges).tolist(), len(h)]
                on = [i for i in range(parts) if cut[i] < cut[i + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(on, pa.int32()), pa.array([k] * len(on), pa.int32()),
                     *(pa.array([x[cut[i]:cut[i + 1]].tobytes() for i in on], pa.binary()) for x in (h, n))], ["part", "k", "h", "n"])

        for lang, raw in _batches(batches):
            for k, _, h in live(word_hashes(Words(raw)), _seed(lang), known, most):
                if k > len(known) and len(h):
                    held.setdefault(k, []).append(h)
            if sum(len(h) for found in held.values() for h in found) > 3_000_000:
                yield from rows()
                held.clear()
        yield from rows()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        fresh = 0
        for batch in batches:
            for k, h, n in zip(*(batch.column(c).to_pylist() for c in ("k", "h", "n"))):
                found = held.setdefault(k, ([], []))
                found[0].append(np.frombuffer(h, np.uint64))
                found[1].append(np.frombuffer(n, np.int64))
                fresh += len(n) // 8
            if fresh > 2 * PART_HASHES:                  # a part of many equal hashes keeps each once
                held, fresh = {k: ([h], [n]) for k, (h, n) in ((k, _summed(*x)) for k, x in held.items())}, 0
        for k, found in held.items():
            h, n = _summed(*found)
            h, n = h[n >= min_count], n[n >= min_count]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k, np.int32)), pa.array(h.view(np.int64)), pa.array(n)],
                                             ["k", "h", "n"])

    dealt = texts.mapInArrow(run, "part int, k int, h binary, n binary").repartitionById(parts, "part")
    return dealt.mapInArrow(add, "k int, h long, n long")


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each different hash and the sum of its counts."""
    h, n = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")                 # of runs in order: merged
    h, n = h[order], n[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    return h[first], np.add.reduceat(n, first)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def windows(words: Words, h: np.ndarray, seed: np.uint64, maps: list[Bitmap]) -> list[bytes]:
    """From each place the longest phrase of two or more words that passes
    ``maps`` (by number of words), its words joined by single spaces."""
    sizes = np.zeros(len(h), np.int64)
    for k, at, _ in live(h, seed, maps, len(maps)):
        sizes[at] = k
    at = np.flatnonzero(sizes > 1)
    if not len(at):
        return []
    last = at + sizes[at] - 1
    length = words.start[last] + words.size[last] + 1 - words.start[at]     # and the byte behind it, for the break
    end = np.cumsum(length)
    place = np.repeat(words.start[at] - (end - length), length) + np.arange(end[-1])
    raw = np.frombuffer(words.raw, np.uint8)[place]
    raw[end - 1] = BREAK[0]
    joined = raw[:-1].tobytes().replace(b"\t", b" ")
    while b"  " in joined:
        joined = joined.replace(b"  ", b" ")
    return joined.split(BREAK)


def deal_windows(texts: DataFrame, maps: list[Bitmap], parts: int) -> DataFrame:
    """(part, lang, windows, n): windows, with BREAK between them, and how often
    each of them was found; those that start with the same two words are in one part."""
    shared = texts.sparkSession.sparkContext.broadcast(maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            dealt: list[tuple[int, str, bytes, bytes]] = []
            for lang, found in counted.items():
                if not found:
                    continue
                h = word_hashes(Words(b" \xff ".join(found)))
                first = np.flatnonzero(np.append(True, h[:-1] == 0))
                part = step(step(np.full(len(first), _seed(lang)), h[first]), h[first + 1]) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                keys, n = np.array(list(found), object)[order], np.array(list(found.values()), np.int64)[order]
                cut = np.flatnonzero(np.append(True, np.diff(part[order]) != 0)).tolist()
                for a, b in zip(cut, [*cut[1:], len(order)]):
                    dealt.append((int(part[order[a]]), lang, BREAK.join(keys[a:b].tolist()), n[a:b].tobytes()))
            kinds = pa.int32(), pa.string(), pa.binary(), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array([row[i] for row in dealt], kind) for i, kind in enumerate(kinds)],
                                              ["part", "lang", "windows", "n"])

        known = shared.value
        counted: dict[str, Counter] = {}
        for lang, raw in _batches(batches):
            words = Words(raw)
            counted.setdefault(lang, Counter()).update(windows(words, word_hashes(words), _seed(lang), known))
            if sum(map(len, counted.values())) > HELD:
                yield rows()
                counted = {}
        yield rows()

    return texts.mapInArrow(run, "part int, lang string, windows binary, n binary")


def starts(words: list[bytes], at: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Every different phrase of two or more words that a window starts with;
    ``at``, ``sizes``: each window's first word and number of words."""
    number = _Numbers()
    ids = np.fromiter((number[w] for w in words), np.int64, len(words))
    h = step(np.zeros(len(at), np.uint64), ids[at].astype(np.uint64))
    found: dict[bytes, None] = {}
    for k in range(2, int(sizes.max(initial=0)) + 1):
        on = sizes >= k
        at, h, sizes = at[on], h[on], sizes[on]
        h = step(h, ids[at + k - 1].astype(np.uint64))
        found.update(dict.fromkeys(b" ".join(words[i:i + k]) for i in at[_one_each(ids, at, h, k)].tolist()))
    return list(found)


def _one_each(ids: np.ndarray, at: np.ndarray, h: np.ndarray, k: int) -> np.ndarray:
    """Which of the places ``at`` to read: at least one of every different
    phrase, also of those that share a hash."""
    order = np.argsort(h, kind="stable")
    new = np.append(True, h[order[1:]] != h[order[:-1]])
    place = at[order]
    lead = place[new][np.cumsum(new) - 1]
    other = np.zeros(len(place), bool)
    for j in range(k):
        other |= ids[place + j] != ids[lead + j]
    return order[new | other]


# ------------------------------------------------------------------- tries

class DoubleArray:
    """A trie over phrases as two arrays: from state s, the word with code c
    leads to t = base[s] + c if check[t] == s.  ``number[t]``: the phrase that
    ends there, or -1.  The first symbol of a phrase is its language."""

    def __init__(self, langs: pa.Array, phrases: pa.Array):
        """Phrase i is ``phrases[i]``, words joined by spaces, in ``langs[i]``."""
        langs, split = langs.dictionary_encode(), pc.split_pattern(phrases, " ")
        words = split.flatten().dictionary_encode()
        self.lang = {x: i + 1 for i, x in enumerate(langs.dictionary.to_pylist())}
        self.code = {w.encode(): i + 1 for i, w in enumerate(words.dictionary.to_pylist())}
        first = split.offsets.to_numpy()
        codes, lengths = words.indices.to_numpy() + 1, np.diff(first)
        width = max(len(self.code), len(self.lang)) + 1
        # level by level: a node is a parent and a symbol
        parents, symbols, nodes = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1
        node, ends = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        on = np.arange(len(lengths))
        for depth in range(int(lengths.max(initial=0)) + 1):
            symbol = codes[first[on] + depth - 1] if depth else langs.indices.to_numpy() + 1
            edges, which = np.unique(node[on] * width + symbol, return_inverse=True)
            parents.append(edges // width)
            symbols.append(edges % width)
            node[on] = nodes + which
            nodes += len(edges)
            ends[on[lengths[on] == depth]] = node[on[lengths[on] == depth]]
            on = on[lengths[on] > depth]
        parent, symbol = np.concatenate(parents), np.concatenate(symbols)
        start, size = self._place(parent, symbol, width)
        state = start[parent] + symbol
        state[0] = 0
        self.base = np.zeros(size, np.int32)
        self.check, self.number = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.base[state] = start
        self.check[state[1:]] = state[parent[1:]]
        self.number[state[ends]] = np.arange(len(ends))

    @staticmethod
    def _place(parent: np.ndarray, symbol: np.ndarray, width: int) -> tuple[np.ndarray, int]:
        """Base of each state, so that no two children share a slot: the
        widest states first, single children into what is left."""
        nodes = len(parent)
        order = np.lexsort((symbol[1:], parent[1:])) + 1                # children, by parent
        counts = np.bincount(parent[1:], minlength=nodes)
        offset = np.concatenate(([0], np.cumsum(counts)))
        rng = np.random.default_rng(13)
        end = 6 * nodes + 4 * width                     # slots of lowest children; others lie up to a width behind
        used = np.zeros(end + width, bool)
        used[:width] = True                             # keeps bases positive, and slot 0 for the root
        start = np.zeros(nodes, np.int64)
        for node in np.argsort(-counts, kind="stable")[:(counts > 1).sum()].tolist():
            codes = symbol[order[offset[node]:offset[node + 1]]]
            reach = 1 << 12 if len(codes) < 1000 else 1 << 6
            while not start[node]:
                low = int(rng.integers(width, max(width + 1, end - reach)))
                if reach > 1 << 18:                     # a fresh area always has room
                    low, end = end + width, end + 4 * width
                    used = np.append(used, np.zeros(4 * width, bool))
                slots = low + np.flatnonzero(~used[low:min(low + reach, end)])
                for code in codes[1:].tolist():
                    slots = slots[~used[slots + (code - codes[0])]]
                    if not len(slots):
                        break
                if len(slots):
                    start[node] = slots[0] - codes[0]
                    used[start[node] + codes] = True
                reach *= 2
        single = np.flatnonzero(counts == 1)
        slots = np.flatnonzero(~used)
        if len(slots) < len(single):
            slots = np.append(slots, len(used) + np.arange(len(single)))
        start[single] = slots[:len(single)] - symbol[order[offset[single]]]
        return start, int(max(len(used), slots[len(single) - 1] + 1 if len(single) else 0)) + width

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Code of each word; 0: in no phrase."""
        return np.fromiter(map(self.code.get, words, repeat(0)), np.int64, len(words))

    def walk(self, lang: str, codes: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Level by level: which of the places ``at`` start a phrase, and the phrases' numbers."""
        root = self.base[0] + self.lang.get(lang, -1)
        if lang not in self.lang or self.check[root] != 0:
            return
        which, state, depth = np.arange(len(at)), np.full(len(at), root, np.int64), 0
        while len(at):
            word = codes[at + depth]
            to = self.base[state] + word
            on = (word > 0) & (self.check[to] == state)
            which, at, state = which[on], at[on], to[on]
            number = self.number[state]
            yield which[number >= 0], number[number >= 0]
            depth += 1
            inside = at + depth < len(codes)
            which, at, state = which[inside], at[inside], state[inside]

    def accepted(self, lang: str, codes: np.ndarray) -> Iterator[np.ndarray]:
        """Level by level: the numbers of the phrases that start anywhere."""
        for _, number in self.walk(lang, codes, np.flatnonzero(codes)):
            yield number


def count_starts(held: dict[str, dict[bytes, int]]) -> pa.RecordBatch:
    """(lang, phrase, f) of all phrases that windows start with; ``held``: how
    often each window was found, by language."""
    cut, langs, phrases = {}, [], []
    for lang, found in held.items():
        sizes = np.fromiter((w.count(b" ") + 1 for w in found), np.int64, len(found))
        cut[lang] = b" \xff ".join(found).split(), np.cumsum(sizes + 1) - sizes - 1, sizes
        phrases += [p.decode() for p in starts(*cut[lang])]
        langs += [lang] * (len(phrases) - len(langs))
    named = pa.array(langs, pa.string()), pa.array(phrases, pa.string())
    trie, counts = DoubleArray(*named), np.zeros(len(phrases), np.int64)
    for lang, found in held.items():
        words, at, _ = cut[lang]
        n = np.fromiter(found.values(), np.float64, len(found))      # whole numbers, below 2 ** 53 in a trie
        for which, numbers in trie.walk(lang, trie.codes(words), at):
            counts += np.bincount(numbers, n[which], len(counts)).astype(np.int64)
    return pa.RecordBatch.from_arrays([*named, pa.array(counts)], ["lang", "phrase", "f"])


def count_phrases(dealt: DataFrame, parts: int, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(lang, phrase, f): exact counts of the phrases that the windows start with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, defaultdict[bytes, int]] = {}
        size = 0
        for batch in batches:
            for lang, joined, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "windows", "n"))):
                found = held.setdefault(lang, defaultdict(int))
                before, keys = len(found), joined.split(BREAK)
                for key, times in zip(keys, np.frombuffer(n, np.int64).tolist()):
                    found[key] += times
                size += (len(found) - before) * (len(joined) // len(keys) + len(lang.encode()) + 32)
                if size > trie_bytes:
                    yield count_starts(held)
                    held, size = {}, 0
        if held:
            yield count_starts(held)

    found = dealt.repartitionById(parts, "part").mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


# ------------------------------------------------------------------ results

def _wide(c: Column | int) -> Column:
    return (F.lit(c) if isinstance(c, int) else c).cast("decimal(19,0)")


def _part(ws: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(ws, start, n), " ")


def weakest_cuts(phrases: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score); ``frequencies``: (lang, part, f) of words and phrases."""
    ws = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), ws.alias("ws"),
                          F.explode(F.sequence(F.lit(1), F.size(ws) - 1)).alias("k"))
    sides = F.array(F.struct(F.lit("l").alias("side"), _part(F.col("ws"), 1, F.col("k")).alias("part")),
                    F.struct(F.lit("r").alias("side"), _part(F.col("ws"), F.col("k") + 1, F.size("ws") - F.col("k")).alias("part")))
    halves = cuts.select("lang", "phrase", "a", "k", F.inline(sides))
    cut = halves.join(frequencies, ["lang", "part"]).groupBy("lang", "phrase", "k").agg(
        F.max("a").alias("a"), F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    # integral division of decimals: exact, and floored as all numbers are positive
    exact = cut.withColumns({"_a": _wide(SCALE) * _wide(F.col("a")), "_b": _wide(F.col("l")) + _wide(F.col("r"))})
    scored = exact.withColumn("score", F.expr("_a div _b"))
    return scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c")).select(
        "lang", "phrase", "c.a", "c.l", "c.r", "c.score")


def covering(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longest): the highest count of a longer phrase around each phrase."""
    ws, n = F.split("phrase", " "), F.size(F.split("phrase", " "))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.transform(
        F.sequence(F.lit(1), n - k + 1), lambda i: _part(F.col("ws"), i, k))))
    longer = phrases.filter(n > 2).withColumn("ws", ws)
    return (longer.select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longest")))


def best(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their rank, from the first of each bucket."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = scored.withColumn("_b", F.pmod(F.xxhash64("phrase"), F.lit(TOP_BUCKETS)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order)))
    some = some.filter(F.col("_r") <= top).drop("_b", "_r")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frequent(texts: DataFrame, words: DataFrame, min_count: int, max_words: int,
             bitmap_bits: int = BITMAP_BITS) -> tuple[DataFrame, list[Bitmap]]:
    """The hashes (k, h, n) that occur ``min_count`` times, and the bitmaps of
    words' and phrases' hashes by number of words."""
    maps = [bitmap(words.filter(F.col("f") >= min_count).select("h"), bitmap_bits)]
    places = words.agg(F.sum("f")).first()[0] or 0           # where phrases start

    def parts(lengths: int) -> int:
        return max(_partitions(texts), math.ceil(places * lengths / PART_HASHES))

    hashes = spool(count_hashes(texts, maps, 2, min_count, parts(1)), "collocations-pairs")
    maps.append(bitmap(hashes, bitmap_bits))
    if max_words > 2:
        more = spool(count_hashes(texts, maps, max_words, min_count, parts(max_words - 2)), "collocations-longer")
        hashes = hashes.unionByName(more)
        maps += [bitmap(more.filter(F.col("k") == k), bitmap_bits) for k in range(3, max_words + 1)]
    return hashes, maps


def part_count(hashes: DataFrame, trie_bytes: int) -> int:
    """How many parts windows are dealt into: so many that each one's phrases
    are a trie's, about, and as many as Spark makes of a shuffle at least."""
    size = hashes.agg(F.sum(F.col("k").cast("long") * 8 + 32)).first()[0] or 0
    return max(_partitions(hashes), math.ceil(size / trie_bytes))


def missed(hashes: DataFrame, counted: DataFrame) -> DataFrame:
    """The hashes that occur more often than the phrases ``counted`` with them (for tests)."""
    have = counted.groupBy("k", "h").agg(F.sum("f").alias("f"))
    return hashes.join(have, ["k", "h"], "left").filter(F.col("n") > F.coalesce("f", F.lit(0))).select("k", "h")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
         trie_bytes: int = TRIE_BYTES, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's collocations."""
    if max_words < 2 or min_count < 1:
        raise ValueError("phrases have two words or more and occur")
    texts = _texts(docs)
    words = spool(count_words(texts), "collocations-words")
    hashes, maps = frequent(texts, words, min_count, max_words, bitmap_bits)
    parts = part_count(hashes, trie_bytes)
    counted = count_phrases(deal_windows(texts, maps, parts), parts, trie_bytes)
    phrases = spool(counted.filter(F.col("f") >= min_count), "collocations-phrases")
    common = words.filter(F.col("f") >= min_count).select("lang", F.col("word").alias("part"), "f")
    scored = weakest_cuts(phrases, common.unionByName(phrases.select("lang", F.col("phrase").alias("part"), "f")))
    covered = F.coalesce(_wide(F.col("longest")) * _wide(100) >= _wide(F.col("a")) * _wide(COVER_PERCENT), F.lit(False))
    kept = scored.join(covering(phrases), ["lang", "phrase"], "left").filter(~covered).drop("longest")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best(kept, top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
