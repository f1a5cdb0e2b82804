"""Operator 11: language-model scoring with a log-bilinear model.

Tokens are the words of a text, A-Z in lower case, and one end.  Every token
of the training documents is counted.  A token's symbol is itself if it is one
of the ``HEAD`` most frequent words, else the class of words whose count has
the same number of binary digits; words that occur once share a class with the
unknown word.  The end is a symbol of its own.

Model: the vectors of the ``CONTEXT`` symbols before a token, each times a
matrix for its distance, add up to a predicted vector; a symbol's score is the
product of its own vector with it plus a bias.  It is trained in numpy by
noise-contrastive estimation: the model learns to tell a position's symbol
from ``NOISE`` symbols drawn by frequency, which a batch shares.  Tasks train
on their own documents from common parameters, and Spark averages the results,
weighted by tokens; a part of the documents comes first, the rest starts from
its average.  All training documents are read, each once.

A token's log-probability is normalised: the scores of all symbols, one matrix
product for all different contexts of a few megabytes of text, go through
log-sum-exp; within a class a word has its share of the class's occurrences.
The probabilities of all known words, the unknown one and the end add up to 1.

Texts are cut up once and travel in blocks of a few megabytes, as numbers of
the block's different words.  The most frequent words are broadcast with their
counts (``KNOWN`` words of at most 64 bytes); of the others, each block asks
for its own by a join, one row a word and block.  The driver holds those words, the parameters and 64 class sums, whatever the input.

Null and empty texts are one end.  Null training flags are false; without
training documents every token is unknown.  Rows are scored one by one,
repeated rows and ids too.  Extra columns stay; columns named like an added
one are replaced.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.llm.common import spool

HEAD = 512
KNOWN = 1 << 17
KNOWN_BYTES = 64
CLASSES = 40
CONTEXT = 2
DIMENSIONS = 16
NOISE = 24
RATE = 0.3
MINIBATCH = 2048
FIRST_PART = 8               # one block in so many trains before the others
BLOCK_BYTES = 8 << 20
END = 0
ADDED = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


# ------------------------------------------------------------------- blocks

def _blocks(docs: DataFrame, training: Column, want_text: bool = False) -> DataFrame:
    """(block, rows, train, lengths, tokens, words, seen): a few megabytes of
    documents in a row, cut up once; ``seen``: how often each word is in the
    block's training documents.  ``want_text`` adds (sizes, z), the texts."""
    others = [c for c in docs.columns if c not in ("text", *ADDED)]
    row = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_"))
    flat = docs.select(row.alias("row"), F.coalesce(training, F.lit(False)).alias("train"), "text")
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(flat.schema["row"].dataType)),
                           T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("lengths", ints),
                           *[T.StructField(c, T.BinaryType()) for c in ("tokens", "words", "seen")]])
    if want_text:
        schema = schema.add("sizes", ints).add("z", T.BinaryType())

    def one(rows: pa.RecordBatch, texts: list[bytes | None], number: int) -> pa.RecordBatch:
        block, whole = Block.of(texts), pa.array([0, len(texts)], pa.int32())
        lists = [pa.concat_arrays([rows.column(0)]), pa.concat_arrays([rows.column(1)]), pa.array(block.lengths.astype(np.int32))]
        mine = np.repeat(np.array(rows.column(1).to_pylist(), bool), block.lengths) & (block.flat >= 0)
        packed = [_squeezed(block.flat.astype(np.int32).tobytes()), _squeezed(b" ".join(block.number)),
                  _squeezed(np.bincount(block.flat[mine], minlength=len(block.number)).astype(np.int64).tobytes())]
        if want_text:
            lists.append(pa.array([-1 if t is None else len(t) for t in texts], pa.int32()))
            packed.append(_squeezed(b"".join(t or b"" for t in texts)))
        columns = [pa.ListArray.from_arrays(whole, x) for x in lists]
        columns[3:3] = [pa.array([z], pa.binary()) for z in packed[:3]]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *columns, *(pa.array([z], pa.binary()) for z in packed[3:])],
                                          schema.names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, size, start = [], 0, 0
            for i, value in enumerate(batch.column(2)):
                t = value.as_py().encode() if value.is_valid else None
                if texts and size + len(t or b"") > BLOCK_BYTES:
                    yield one(batch.slice(start, i - start), texts, number)
                    texts, size, start, number = [], 0, i, number + 1
                texts.append(t)
                size += len(t or b"")
            if texts:
                yield one(batch.slice(start), texts, number)
                number += 1

    return flat.mapInArrow(pack, schema)


def _squeezed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _loose(z: pa.Scalar) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z.as_py())


def _numbers(z: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(_loose(z), kind).astype(np.int64)


def _texts(sizes: list[int], raw: bytes) -> Iterator[bytes | None]:
    at = 0
    for n in sizes:
        yield None if n < 0 else raw[at:at + n]
        at += max(n, 0)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()                 # A-Z only, ASCII white space


class Block:
    """Tokens of a block's documents: ``flat`` has the number of each token's
    word in ``number``, in the order of first appearance, or -1 for the end."""

    def __init__(self, lengths: np.ndarray, flat: np.ndarray, number: list[bytes]):
        self.lengths, self.flat, self.number = lengths, flat, number
        self.start = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)

    @staticmethod
    def of(texts: list[bytes | None]) -> Block:
        words = _Numbers()
        number, lengths = words.__getitem__, []
        flat: list[int] = []
        for t in texts:
            split = _split(t)
            flat.extend(map(number, split))
            flat.append(-1)                              # the end
            lengths.append(len(split) + 1)
        return Block(np.array(lengths, np.int64), np.array(flat, np.int64), list(words))


# --------------------------------------------------------------- vocabulary

@dataclasses.dataclass
class Vocabulary:
    """Counts of the frequent words, and sums over all words."""

    counts: dict[bytes, int]      # the KNOWN most frequent
    head: dict[bytes, int]        # symbol of each of the HEAD most frequent
    class_sum: np.ndarray         # occurrences by class, of words outside the head
    singles: int                  # words that occur once, outside the head
    n: int                        # training tokens
    v: int                        # different ones
    ends: int

    @property
    def symbols(self) -> int:
        return 1 + HEAD + CLASSES

    def frequencies(self) -> np.ndarray:
        """How often each symbol is in the training text, 1/2 more."""
        out = np.zeros(self.symbols)
        out[END] = self.ends
        for w, s in self.head.items():
            out[s] = self.counts[w]
        out[1 + HEAD:] = self.class_sum
        return out + 0.5

    def counts_of(self, block: Block, rare: pa.Scalar | list) -> np.ndarray:
        """Count of each of a block's words; ``rare``: those outside ``counts``."""
        get = self.counts.get
        out = np.fromiter((get(w, 0) for w in block.number), np.int64, len(block.number))
        if isinstance(rare, pa.Scalar) and rare.is_valid:
            place, count = rare.values.flatten()
            out[place.to_numpy()] = count.to_numpy()
        return out

    def symbols_of(self, block: Block, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each of a block's words: its symbol, and its log share of it."""
        digits = np.frexp(np.maximum(counts, 1).astype(np.float64))[1] - 1      # 0: once or never
        get = self.head.get
        own = np.fromiter((get(w, -1) for w in block.number), np.int64, len(block.number))
        symbols = np.where(own >= 0, own, 1 + HEAD + digits)
        return symbols, self.shares(symbols, counts)

    def shares(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of each word: its log share of its symbol."""
        digits = np.maximum(symbols - 1 - HEAD, 0)
        share = np.log(np.maximum(counts, 1) / np.where(digits == 0, self.singles + 1, np.maximum(self.class_sum[digits], 1)))
        return np.where(symbols <= HEAD, 0.0, share)


def count_tokens(docs: DataFrame, training: Column) -> DataFrame:
    """(word, c) over the training documents, exactly."""
    return _counted(_blocks(docs, training))


def _counted(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, seen in zip(*batch.columns):
                words, seen = _loose(words).split(), _numbers(seen, np.int64)
                some = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array([words[i].decode() for i in some.tolist()], pa.string()),
                                                  pa.array(seen[some])], ["word", "n"])

    return blocks.select("words", "seen").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    best = counts.filter(F.octet_length("word") <= KNOWN_BYTES).orderBy(F.desc("c"), "word").limit(KNOWN).toArrow()
    known = dict(zip((w.encode() for w in best["word"].to_pylist()), best["c"].to_pylist()))
    head = {w: 1 + i for i, w in enumerate(list(known)[:HEAD])}
    least = list(head)[-1] if head else b""
    c, word = F.col("c"), F.col("word")
    # the head are the first words in the order of (count descending, word)
    outside = (F.octet_length(word) > KNOWN_BYTES) | (c < known.get(least, 0)) | (
        (c == known.get(least, 0)) & (word > least.decode()))
    digits = (F.length(F.conv(c.cast("string"), 10, 2)) - 1).alias("class")
    sums = counts.groupBy(outside.alias("outside"), digits).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()
    class_sum = np.zeros(CLASSES)
    for r in sums:
        if r.outside:
            class_sum[r["class"]] = r.c
    return Vocabulary(known, head, class_sum, next((r.n for r in sums if r.outside and r["class"] == 0), 0),
                      sum(r.c for r in sums) + ends, sum(r.n for r in sums) + (ends > 0), ends)


def _with_symbols(blocks: DataFrame, counts: DataFrame, known: Vocabulary) -> DataFrame:
    """``blocks`` with the count and the symbol of each of their words in place
    of the words; the counts outside the broadcast ones come by a join."""
    shared = blocks.sparkSession.sparkContext.broadcast(known)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = shared.value.counts
        for batch in batches:
            for number, words in zip(*batch.columns):
                rare = [(w.decode(), j) for j, w in enumerate(_loose(words).split()) if w not in have]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in rare], pa.string()), pa.array([number.as_py()] * len(rare), pa.int64()),
                     pa.array([j for _, j in rare], pa.int32())], ["word", "block", "j"])

    asked = blocks.select("block", "words").mapInArrow(ask, "word string, block long, j int")
    told = asked.join(counts, "word").groupBy("block").agg(F.collect_list(F.struct("j", "c")).alias("rare"))
    told = blocks.drop("seen").join(told, "block", "left")
    same = [c for c in told.columns if c not in ("words", "rare")]
    names = [*same, "counts", "symbols"]
    schema = T.StructType([told.schema[c] for c in same] + [T.StructField(c, T.BinaryType()) for c in names[-2:]])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            found = []
            for words, rare in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
                block = Block(np.array([], np.int64), np.array([], np.int64), _loose(words).split())
                counts = vocabulary.counts_of(block, rare)
                symbols, _ = vocabulary.symbols_of(block, counts)
                found.append((_squeezed(counts.tobytes()), _squeezed(symbols.astype(np.int16).tobytes())))
            yield pa.RecordBatch.from_arrays(batch.columns[:-2] + [pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], names)

    return told.select(*same, "words", "rare").mapInArrow(look_up, schema)


# -------------------------------------------------------------------- model

def _scatter(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``rows`` by ``at``."""
    d = rows.shape[1]
    places = (at[:, None] * d + np.arange(d)).ravel()
    return np.bincount(places, rows.ravel(), n * d).reshape(n, d)


def _different(code: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of one place of every different code, which of them each is)."""
    if most > 1 << 22:
        return np.unique(code, return_index=True, return_inverse=True)[1:]
    place = np.full(most, -1, np.int64)
    place[code] = np.arange(len(code))
    used = np.flatnonzero(place >= 0)
    number = np.empty(most, np.int64)
    number[used] = np.arange(len(used))
    return place[used], number[code]


class Model:
    """Context vectors, a matrix for each distance, output vectors, biases."""

    def __init__(self, frequencies: np.ndarray, seed: int = 11):
        rng, s = np.random.default_rng(seed), len(frequencies)
        noise = frequencies / frequencies.sum()
        self.parts = [rng.normal(0, 0.1, (s, DIMENSIONS)).astype(np.float32),
                      np.stack([np.eye(DIMENSIONS) * 0.7 ** i for i in range(CONTEXT)]).astype(np.float32),
                      rng.normal(0, 0.1, (s, DIMENSIONS)).astype(np.float32), np.log(noise).astype(np.float32)]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def with_parameters(self, flat: np.ndarray) -> Model:
        new, at = object.__new__(Model), 0
        new.parts = []
        for p in self.parts:
            new.parts.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return new

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        vectors, turn = self.parts[:2]
        return sum(vectors[contexts[:, i]] @ turn[i] for i in range(CONTEXT))

    def log_normaliser(self, predicted: np.ndarray) -> np.ndarray:
        """Log of the sum over all symbols, in products of some thousand rows."""
        out = np.empty(len(predicted), np.float32)
        for i in range(0, len(predicted), 2048):
            scores = predicted[i:i + 2048] @ self.parts[2].T + self.parts[3]
            top = scores.max(axis=1, keepdims=True)
            out[i:i + 2048] = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
        return out

    def log_probabilities(self, symbols: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Natural log of each symbol's normalised probability after its context."""
        code = np.zeros(len(symbols), np.int64)
        for i in range(CONTEXT):
            code = code * len(self.parts[3]) + contexts[:, i]
        first, which = _different(code, len(self.parts[3]) ** CONTEXT)
        predicted = self.predicted(contexts[first])
        norm = self.log_normaliser(predicted)
        out = np.empty(len(symbols))
        for i in range(0, len(symbols), 1 << 16):
            s, w = symbols[i:i + (1 << 16)], which[i:i + (1 << 16)]
            out[i:i + (1 << 16)] = np.einsum("td,td->t", predicted[w], self.parts[2][s]) + self.parts[3][s] - norm[w]
        return out


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps."""

    def __init__(self, model: Model, squares: Model, noise: np.ndarray, seed: int):
        self.parts = [p.copy() for p in model.parts]
        self.squares = [p.copy() for p in squares.parts]
        self.cumulative, self.rng = np.cumsum(noise), np.random.default_rng(seed)
        self.log_kp = np.log(NOISE * noise).astype(np.float32)
        self.tokens = 0

    def text(self, symbols: np.ndarray, contexts: np.ndarray) -> None:
        batches = -(-len(symbols) // MINIBATCH)             # each from all over the text
        for i in self.rng.permutation(batches).tolist():
            self.step(symbols[i::batches], contexts[i::batches])
        self.tokens += len(symbols)

    def step(self, target: np.ndarray, contexts: np.ndarray) -> None:
        vectors, turn, out, bias = self.parts
        n, s = len(target), len(bias)
        noise = np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1], side="right").clip(0, s - 1)
        before = [vectors[contexts[:, i]] for i in range(CONTEXT)]
        predicted = sum(b @ turn[i] for i, b in enumerate(before))
        ours = np.einsum("td,td->t", predicted, out[target]) + bias[target] - self.log_kp[target]
        theirs = predicted @ out[noise].T + bias[noise] - self.log_kp[noise]
        # gradients of the log-likelihood of telling data from noise
        up = 1 / (1 + np.exp(np.clip(ours, -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(theirs, -30, 30)))
        d_predicted = up[:, None] * out[target] + down @ out[noise]
        d_out = _scatter(target, up[:, None] * predicted, s)
        d_out += _scatter(noise, down.T @ predicted, s)
        d_bias = np.bincount(target, up, s) + np.bincount(noise, down.sum(axis=0), s)
        d_vectors = _scatter(contexts.T.ravel(), np.concatenate([d_predicted @ turn[i].T for i in range(CONTEXT)]), s)
        d_turn = np.stack([b.T @ d_predicted for b in before])
        for part, square, slope in zip(self.parts, self.squares, (d_vectors, d_turn, d_out, d_bias)):
            slope = (slope / n).astype(np.float32)
            square += slope * slope
            part += RATE * slope / np.sqrt(square)


def contexts_of(symbols: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CONTEXT symbols before each token, nearest first; the end before a text."""
    place = np.arange(len(symbols)) - np.repeat(start, lengths)
    out = np.full((len(symbols), CONTEXT), END, np.int64)
    for i in range(CONTEXT):
        inside = np.flatnonzero(place > i)
        out[inside, i] = symbols[inside - i - 1]
    return out


def _token_symbols(block: Block, of_word: np.ndarray) -> np.ndarray:
    return np.append(of_word, END)[block.flat]           # -1, the end, is the last


def train(ready: DataFrame, known: Vocabulary) -> Model:
    """The model after all training documents of ``ready``."""
    frequencies = known.frequencies()
    model = Model(frequencies)
    squares = model.with_parameters(np.full(len(model.flat()), 1e-3))      # of AdaGrad: averaged and handed on too
    ready = ready.filter(F.exists("train", lambda x: x))
    first = ready.agg(F.min("block")).first()[0]
    begin = F.col("block").eqNullSafe(F.lit(first))
    part = F.pmod(F.xxhash64("block"), F.lit(FIRST_PART)) == 0
    for blocks in (ready.filter(begin), ready.filter(~begin & part), ready.filter(~begin & ~part)):
        shared = ready.sparkSession.sparkContext.broadcast((model, squares, frequencies / frequencies.sum()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, steps, noise = shared.value
            trainer = None
            for batch in batches:
                for number, flags, lengths, tokens, of_word in zip(*batch.columns):
                    trainer = trainer or Trainer(start, steps, noise, number.as_py() % (1 << 31))
                    block = Block(np.array(lengths.as_py(), np.int64), _numbers(tokens, np.int32), [])
                    symbols = _token_symbols(block, _numbers(of_word, np.int16))
                    mine = np.repeat(np.array(flags.as_py(), bool), block.lengths)
                    trainer.text(symbols[mine], contexts_of(symbols, block.start, block.lengths)[mine])
            if trainer:
                flat = np.concatenate([p.ravel() for p in (*trainer.parts, *trainer.squares)]).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * trainer.tokens),
                     pa.array(np.full(len(flat), float(trainer.tokens)))], ["i", "x", "w"])

        learned = blocks.select("block", "train", "lengths", "tokens", "symbols").mapInArrow(run, "i int, x double, w double")
        rows = learned.groupBy("i").agg((F.sum("x") / F.sum("w")).alias("x")).toArrow()      # one number a parameter
        if rows.num_rows:
            flat = rows["x"].to_numpy()[np.argsort(rows["i"].to_numpy())]
            model, squares = (model.with_parameters(x) for x in np.split(flat, 2))
    return model


def score(docs: DataFrame, training: Column, want_text: bool = True) -> DataFrame:
    """``docs`` with, over each text's tokens: how many, how many known, the
    training tokens, and two log10 probabilities: ``base_score`` by add-one
    counts, ``score`` by the model.  The model learns from the documents that
    ``training`` chooses.  Without ``want_text`` the text is dropped."""
    training = F.coalesce(training, F.lit(False))
    blocks = spool(_blocks(docs, training, want_text), "lm-blocks")
    counts = spool(_counted(blocks), "lm-counts")
    known = vocabulary(counts, docs.filter(training).count())
    ready = spool(_with_symbols(blocks, counts, known), "lm-ready")
    shared = docs.sparkSession.sparkContext.broadcast((known, train(ready, known)))
    fields = list(blocks.schema["rows"].dataType.elementType.fields[:-1])
    if want_text:
        fields.append(T.StructField("text", T.StringType()))
    schema = T.StructType(fields + [T.StructField(c, T.LongType()) for c in ADDED[:3]]
                          + [T.StructField(c, T.DoubleType()) for c in ADDED[3:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = shared.value
        for batch in batches:
            for rows, lengths, tokens, counts, of_word, *texts in zip(*batch.columns):
                block = Block(np.array(lengths.as_py(), np.int64), _numbers(tokens, np.int32), [])
                counts, of_word = _numbers(counts, np.int64), _numbers(of_word, np.int16)
                share = vocabulary.shares(of_word, counts)
                symbols = _token_symbols(block, of_word)
                logs = model.log_probabilities(symbols, contexts_of(symbols, block.start, block.lengths))
                logs += np.append(share, 0.0)[block.flat]
                seen = np.append(counts, vocabulary.ends)[block.flat]
                base = np.log10((seen + 1) / (vocabulary.n + vocabulary.v + 1))

                def sums(x: np.ndarray) -> np.ndarray:
                    return np.add.reduceat(x, block.start)
                columns = [*rows.values.flatten()[:-1]]
                if want_text:
                    sizes, raw = texts[0].as_py(), _loose(texts[1])
                    columns.append(pa.array([None if t is None else t.decode() for t in _texts(sizes, raw)], pa.string()))
                columns += [pa.array(block.lengths), pa.array(sums((seen > 0).astype(np.int64))),
                            pa.array(np.full(len(block.lengths), vocabulary.n, np.int64)), pa.array(sums(base)),
                            pa.array(sums(logs) / np.log(10))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    texts = ["sizes", "z"] if want_text else []
    found = ready.select("rows", "lengths", "tokens", "counts", "symbols", *texts).mapInArrow(run, schema)
    order = [c for c in docs.columns if c not in ADDED and (want_text or c != "text")]
    return found.select(*[F.col(f"`{c}`") for c in order], *ADDED)
