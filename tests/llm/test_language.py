"""Operators 11 and 13 against brute-force counts."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from paceline.llm import collocations, logbilinear

DOCS = "doc_id long, lang string, text string"


def chain(rng, n):
    """Words that follow one another by rule, three times out of four."""
    words, w = [], "a"
    for _ in range(n):
        w = {"a": "b", "b": "c", "c": "a"}[w] if rng.random() < 0.75 else rng.choice("abc")
        words.append(w)
    return " ".join(words)


def known_counts(rows):
    c = Counter()
    for t in rows:
        c.update((t or "").encode().lower().split())
        c[b"\n"] += 1
    return c


def check_base(found, text_of, trained):
    c = known_counts(text_of[d] for d in trained)
    n, v = sum(c.values()), len(c)
    for r in found:
        tokens = [*(text_of[r.doc_id] or "").encode().lower().split(), b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens))
        assert r.score < 0


@pytest.mark.parametrize("block_bytes, known", [(4 << 20, 1 << 17), (300, 2)])
def test_counts_do_not_depend_on_blocks_or_on_what_is_broadcast(spark, monkeypatch, block_bytes, known):
    monkeypatch.setattr(logbilinear, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(logbilinear, "KNOWN", known)
    rng = random.Random(1)
    text_of = {i: None if i % 11 == 0 else chain(rng, rng.randint(0, 40)) + f" W{i % 7} É{i}" for i in range(80)}
    df = spark.createDataFrame([(i, "en", t) for i, t in text_of.items()], DOCS).repartition(3)
    found = logbilinear.score(df, F.col("doc_id") % 3 != 0).collect()
    assert {r.doc_id: r.text for r in found} == text_of
    check_base(found, text_of, [d for d in text_of if d % 3])


def test_the_model_learns_what_follows_what(spark, monkeypatch):
    monkeypatch.setattr(logbilinear, "MINIBATCH", 256)           # few tokens: smaller steps
    rng = random.Random(2)
    df = spark.createDataFrame([(i, "en", chain(rng, 400)) for i in range(400)], DOCS).repartition(2)
    found = logbilinear.score(df, F.col("doc_id") % 4 != 0).filter("doc_id % 4 = 0")
    r = found.agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    # entropy of the chain: 5/6 and twice 1/12; without context it is log10(3)
    entropy = 5 / 6 * math.log10(6 / 5) + math.log10(12) / 6
    assert r[1] < -0.45 and -entropy - 0.05 < r[0] < -entropy + 0.02


def test_probabilities_add_up_to_one(spark):
    words = [f"w{i}" for i in range(700) for _ in range(1 + i % 9)]
    random.Random(3).shuffle(words)
    df = spark.createDataFrame([(i, "en", " ".join(words[i::10])) for i in range(10)], DOCS)
    known = logbilinear.vocabulary(logbilinear.count_tokens(df, F.lit(True)), 10)
    assert (known.n, known.v, known.ends) == (len(words) + 10, 701, 10)
    model = logbilinear.Model(known.frequencies())
    block = logbilinear.Block.__new__(logbilinear.Block)
    block.number = {f"w{i}".encode(): i for i in range(701)}         # the last is unknown
    counts = known.counts_of(block, [])
    assert counts.tolist() == [1 + i % 9 for i in range(700)] + [0]
    symbol, share = known.symbols_of(block, counts)
    symbol, share = np.append(symbol, logbilinear.END), np.append(share, 0.0)
    rng = np.random.default_rng(4)
    for context in rng.integers(0, known.symbols, (5, logbilinear.CONTEXT)):
        logs = model.log_probabilities(symbol, np.tile(context, (len(symbol), 1))) + share
        empty = np.setdiff1d(np.arange(known.symbols), symbol)       # classes without words, unused heads
        spare = np.exp(model.log_probabilities(empty, np.tile(context, (len(empty), 1)))).sum()
        assert np.exp(logs).sum() + spare == pytest.approx(1, abs=1e-4)


def test_blocks_hold_texts_cut_up(spark):
    """Later passes read numbers, not texts."""
    df = spark.createDataFrame([(1, "en", "A b a"), (2, "en", None), (3, "en", "c\u00a0c b")], DOCS).coalesce(1)
    blocks = logbilinear._blocks(df, F.col("doc_id") < 3)
    assert not {"sizes", "z"} & set(blocks.columns)
    for r in blocks.toArrow().to_batches()[0].to_pylist():
        words = zstandard.ZstdDecompressor().decompress(r["words"]).split()
        tokens, seen = (np.frombuffer(zstandard.ZstdDecompressor().decompress(r[c]), k) for c, k in (("tokens", np.int32), ("seen", np.int64)))
        assert [words[i] if i >= 0 else None for i in tokens] == [b"a", b"b", b"a", None, None, "c\u00a0c".encode(), b"b", None]
        assert r["lengths"] == [4, 1, 3] and dict(zip(words, seen.tolist())) == {b"a": 2, b"b": 1, "c\u00a0c".encode(): 0}


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.selectExpr("*", "'x' AS score_", "1 AS n_tokens")
    found = logbilinear.score(clash, F.col("doc_id") < 5)
    assert found.columns == [c for c in clash.columns if c not in logbilinear.ADDED] + logbilinear.ADDED
    rows = found.collect()
    assert sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in odd_docs.collect())
    assert all(r.n_tokens == len((r.text or "").encode().split()) + 1 for r in rows)
    assert logbilinear.score(no_docs, F.lit(True)).count() == 0
    untrained = logbilinear.score(odd_docs, F.lit(None).cast("boolean"), want_text=False).collect()
    assert len(untrained) == len(rows) and all(r.n_known == 0 and r.base_score == 0 for r in untrained)


# ------------------------------------------------------------- collocations

def brute(rows, min_count, max_words, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items()):
                continue
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("max_words, trie_bytes, bits", [(4, 16 << 20, 29), (4, 400, 12), (2, 1000, 12), (6, 2000, 29)])
def test_collocations_equal_brute_force(spark, max_words, trie_bytes, bits):
    rng = random.Random(max_words)
    vocabulary = [*"abcdefgh", "É", "x\x1cy", "Aa", " "]
    rows = [(rng.choice(["en", "de", None, "und"]), None if i % 19 == 0 else "".join(
        rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!?"]) for _ in range(rng.randint(0, 60))))
        for i in range(150)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS).repartition(5)
    found = collocations.mine(df, 4, max_words, 40, trie_bytes, bits).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 4, max_words, 40)


def test_counts_may_pass_64_bits_in_products(spark):
    big = 9 * 10**18
    phrases = spark.createDataFrame([("en", "x y", big - 5)], "lang string, phrase string, f long")
    parts = spark.createDataFrame([("en", "x", big), ("en", "y", big - 1)], "lang string, part string, f long")
    r = collocations.weakest_cuts(phrases, parts).first()
    assert r.score == 2_000_000 * (big - 5) // (2 * big - 1) and (r.a, r.l, r.r) == (big - 5, big, big - 1)


def test_double_array_accepts_its_phrases_only():
    rng = random.Random(5)
    words = [f"w{i}".encode() for i in range(300)]
    phrases = list({(rng.choice(["x", "y"]), tuple(rng.choice(words[:rng.choice([3, 40, 300])])
                                                   for _ in range(rng.randint(2, 4)))) for _ in range(6000)})
    trie = collocations.DoubleArray(pa.array([x for x, _ in phrases]), pa.array([b" ".join(p).decode() for _, p in phrases]))
    number = {p: i for i, p in enumerate(phrases)}
    text = [rng.choice([*words[:40], b"unknown", collocations.BREAK]) for _ in range(20_000)]
    for lang in ("x", "y", "z"):
        expected = Counter(number[lang, q] for k in (2, 3, 4) for i in range(len(text))
                           if (lang, q := tuple(text[i:i + k])) in number and len(q) == k)
        got = Counter(n for level in trie.accepted(lang, trie.codes(text)) for n in level.tolist())
        assert got == expected


def test_phrases_that_share_a_hash_are_all_collected(spark):
    ids, at = np.array([1, 2, 3, 4, 1, 2]), np.array([0, 2, 4])
    places = at[collocations._one_each(ids, at, np.array([7, 7, 7], np.uint64), 2)]
    assert {tuple(ids[i:i + 2]) for i in places} == {(1, 2), (3, 4)}
    hashes = spark.createDataFrame([(2, 5, 50), (2, 6, 40), (3, 5, 30), (2, 9, 31)], "k int, h long, n long")
    counted = spark.createDataFrame([(2, 5, 20), (2, 5, 30), (2, 6, 39), (3, 5, 30)], "k int, h long, f long")
    assert sorted(tuple(r) for r in collocations.missed(hashes, counted).collect()) == [(2, 6), (2, 9)]


def test_a_word_that_names_a_language_shares_no_hash(spark):
    def of(lang, word):
        return collocations.step(collocations._seed(lang), collocations.word_hashes(collocations.Words(word)))
    assert of("es", b"en") != of("en", b"es")
    assert collocations.word_hashes(collocations.Words(collocations.tokens("a. b"))).tolist()[1::2] == [0, 0]


def test_bitmaps_let_few_others_through(spark):
    rng = np.random.default_rng(3)
    mine, others = rng.integers(0, 2**64, (2, 4000), np.uint64, endpoint=False)
    some = collocations.bitmap(spark.createDataFrame([(int(x),) for x in mine.view(np.int64)], "h long"))
    assert some.has(mine).all() and some.has(others).sum() < 8


def test_collocations_of_odd_rows(odd_docs, no_docs):
    assert collocations.mine(no_docs).count() == 0
    found = collocations.mine(odd_docs, min_count=2).collect()
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert sorted(tuple(r) for r in found) == brute(rows, 2, 4, 2000)


def test_texts_are_read_as_often_for_many_tries_as_for_one(spark):
    rng = random.Random(8)
    rows = [(i, "en", " ".join(rng.choice("abcdefgh") for _ in range(40))) for i in range(60)]
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, DOCS).mapInArrow(counting, DOCS)
    found, times = [], []
    for trie_bytes in (16 << 20, 600):
        before = read.value
        found.append(sorted(tuple(r) for r in collocations.mine(df, 4, 3, 40, trie_bytes).collect()))
        times.append((read.value - before) / len(rows))
    assert times[0] == times[1] <= 4
    assert found[0] == found[1] == brute([r[1:] for r in rows], 4, 3, 40)


def test_windows_are_the_longest_phrases_that_pass():
    words = collocations.Words(collocations.tokens("a b\t c. b  c d"))
    h, seed = collocations.word_hashes(words), collocations._seed("en")
    every = collocations.Bitmap(6, np.full(1, ~np.uint64(0)))
    assert collocations.windows(words, h, seed, [every] * 3) == [b"a b c", b"b c", b"b c d", b"c d"]
    assert collocations.windows(words, h, seed, [every, every, collocations.Bitmap(6, np.zeros(1, np.uint64))]) == [b"a b", b"b c", b"b c", b"c d"]
    held = {"en": {b"a b c": 2, b"a b": 3, b"b c": 1}, "de": {b"a b": 7}}
    assert sorted(map(tuple, (r.values() for r in collocations.count_starts(held).to_pylist()))) == [
        ("de", "a b", 7), ("en", "a b", 5), ("en", "a b c", 2), ("en", "b c", 1)]


def test_hash_counts_of_several_rows_add_up():
    h, n = collocations._summed([np.array([3, 9], np.uint64), np.array([3, 2**64 - 1], np.uint64), np.array([9], np.uint64)],
                                [np.array([1, 2]), np.array([10, 5]), np.array([30])])
    assert (h.tolist(), n.tolist()) == ([3, 9, 2**64 - 1], [11, 32, 5])
