"""Operator 12 against a brute-force search over all lags."""

import random

import numpy as np
import pytest

from paceline.llm import runs


def brute(w, min_length=6, min_exponent=4):
    n, out = len(w), []
    for q in range(1, n // min_exponent + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s, length = i - q, j - i + q
            if length >= max(min_length, min_exponent * q) and not any(
                    all(w[k] == w[k - d] for k in range(s + d, s + length)) for d in range(1, q)):
                out.append((s, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(rng):
    w = []
    for _ in range(rng.randint(0, 6)):
        part = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 9))]
        w += (part * rng.randint(1, 7))[:rng.randint(1, 60)]
    return w


@pytest.mark.parametrize("min_length, min_exponent", [(6, 4), (1, 3), (20, 5)])
def test_scan_equals_brute_force(min_length, min_exponent):
    rng = random.Random(min_length)
    for _ in range(250):
        docs = [periodic(rng) for _ in range(3)]
        sizes, found, kept = runs.scan([" ".join(d).encode() for d in docs], min_length, min_exponent)
        for d, n, r, k in zip(docs, sizes, found, kept):
            expected = brute(d, min_length, min_exponent)
            assert n == len(d) and [tuple(x) for x in r.tolist()] == expected
            assert k.decode() == collapsed(d, expected)


def test_detect_equals_brute_force_in_many_batches(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, None if i % 17 == 0 else "\n ".join(periodic(rng)) + "\t") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in runs.detect(df).collect():
        w = (r.text or "").split()
        assert r.text == rows[r.doc_id][1] and r.n_words == len(w)
        assert [tuple(x) for x in r.runs] == brute(w) and r.collapsed_text == collapsed(w, brute(w))


def test_one_word_repeated_is_one_run_in_little_time():
    (n,), (found,), (kept,) = runs.scan([b"word " * 200_000], 6, 4)
    assert n == 200_000 and found.tolist() == [[0, 200_000, 1]] and kept == b"word"


def test_texts_of_a_batch_do_not_meet():
    _, found, _ = runs.scan([b"a a a", b"a a a", b"", b"a a a a a a"], 6, 4)
    assert [f.tolist() for f in found] == [[], [], [], [[0, 6, 1]]]


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.selectExpr("*", "'x' AS runs", "1 AS n_words")
    found = runs.detect(clash)
    assert found.columns == [*odd_docs.columns, *runs.ADDED]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert [tuple(x) for x in r.runs] == ([(0, 30_000, 1)] if r.doc_id == 5 else [])
        assert r.collapsed_text == ("word" if r.doc_id == 5 else " ".join((r.text or "").split()))
    assert runs.detect(no_docs).count() == 0
    with pytest.raises(ValueError):
        runs.detect(no_docs, min_exponent=2)


def test_unicode_spaces_are_letters_of_words():
    sizes, found, kept = runs.scan(["x\u00a0y ".encode() * 6, ("é\x0bè\r" * 4).encode()], 6, 4)
    assert sizes == [6, 8] and [f.tolist() for f in found] == [[[0, 6, 1]], [[0, 8, 2]]]
    assert np.array_equal(kept, ["x\u00a0y".encode(), "é è".encode()])
