"""Operators 3, 4, 6 and 10, and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from paceline.llm import langid, line_quality, ordinal, pii
from paceline.llm.common import documents
from paceline.llm.queries import VOCABULARY

TEXTS = "doc_id long, text string"
WORD = r"[^\x20\x09-\x0D]+"


def base_counts(t):
    words, t = re.findall(WORD, t or ""), t or ""
    n, lines = len(words), [x for x in t.split("\n") if re.search(WORD, x)]
    grams = [tuple(words[i:i + 8]) for i in range(n - 7)]
    times, covered = Counter(grams), [0] * n
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered[i:i + 8] = [1] * 8
    repeat = sum(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeat,
            n < 20 or 100 * repeat > 30 * n)


def test_base_counts(spark, odd_docs, no_docs):
    rng = random.Random(1)
    pool = [None, "", "   ", "\n\n a\n a ", "a " * 3000, "x | y | z\n" * 4, "%%% $$$", "ÀÉ ü\tq\x0bw\x1cz y"]
    rows = [(i, rng.choice([*pool, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))])) for i in range(200)]
    for r in line_quality.judge(spark.createDataFrame(rows, TEXTS)).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base_counts(rows[r.doc_id][1])
    assert line_quality.judge(odd_docs).count() == odd_docs.count()
    assert line_quality.judge(no_docs).count() == 0


def test_line_rules(spark):
    prose = "A plain line of prose, long enough to count, that ends as lines of prose do, with a full stop."
    other = "Nothing of what the first one says comes again in this other sentence, which has its own words."
    cases = {"prose": (prose + "\n" + other, True),
             "menu": ("Home | About | News | Shop | Help | Login\n" * 3 + "few words of text are left after these lines here", False),
             "marks": ("Th$$$ on%%% er&&& is*** an### of$$$ to%%% re&&& " * 4, False),
             "licence": (prose + "\nLicensed under the Apache License, Version 2.0.\n" + other, True)}
    got = {r.doc_id: r for r in line_quality.judge(spark.createDataFrame(
        [(k, t) for k, (t, _) in cases.items()], "doc_id string, text string")).collect()}
    assert {k: got[k].kept for k in cases} == {k: keep for k, (_, keep) in cases.items()}
    assert got["licence"].n_lines_removed == 1 and "Apache" not in got["licence"].clean_text


def test_boilerplate_is_judged_in_lines_of_any_length(spark):
    notice = "We use cookies to give you the best experience on this site, and by staying on it you agree to that. "
    words = " ".join(f"word{i}" for i in range(700)) + ". "
    lines = {"a long notice": notice * 50, "long prose with a notice": words + notice, "short": notice,
             "no end": "all rights reserved " + "x " * 40_000, "prose": words}
    rows = [(k, f"{t}\n{words}") for k, t in lines.items()]
    got = {r.doc_id: r.n_lines_removed for r in line_quality.judge(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a long notice": 1, "long prose with a notice": 0, "short": 1, "no end": 0, "prose": 0}


def test_quality_on_held_out_labels(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.1"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = ordinal.train(docs, labels.filter(~third))
    assert list(model.thresholds) == sorted(model.thresholds)
    scored = ordinal._apply(docs.select("doc_id", "text"), model, 0.5, False).join(labels.filter(third), "doc_id").collect()
    clean = [r.kept for r in scored if r.quality and not r.toxic]
    bad = [r.kept for r in scored if not r.quality or r.toxic]
    assert sum(clean) / len(clean) > 0.97 and sum(bad) / len(bad) < 0.3
    assert all(0 <= r.expected_grade <= 2 for r in scored)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, 1, 1), (None, 1, 0), (5, None, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert ordinal.classify(odd_docs, labels).count() == odd_docs.count()
    kept = ordinal.select_documents(odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert ordinal.classify(no_docs, labels).count() == 0


def test_language_on_held_out_documents(spark, odd_docs, no_docs):
    docs = documents(spark, SF_ORACLE)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = langid.train(docs.filter(~held))
    got = langid.identify(docs.filter(held), model, [F.col("lang")]).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    odd = {r.text: r for r in langid.identify(odd_docs, model, [F.col("text")]).collect()}
    assert all(odd[t].lang_pred == "und" and odd[t].score == 0 for t in (None, "", " \n\t "))
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert langid.train(no_docs) is None
    assert {r.lang_pred for r in langid.identify(odd_docs, None).collect()} == {"und"}


def luhn(d):
    return sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


PARTS = ["a@b.c", "a@b.c@d.e.f", "a@b.com_x@y.z", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.1.1.1",
         "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "+1 (644) 555-4442", "+12345",
         "+1 23456789012345678", "é😀", " ", "x", ".", "mail joe at site dot org", "(415) 555-1234", "1" * 50, "@", "a@",
         "9" * 3000, "-", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "+1+2 3 4 5 6 7 8 9 0", "%@x.y.", " version 1.2.3.4"]


def test_base_spans_and_what_the_method_adds(spark, odd_docs, no_docs):
    rng = random.Random(4)
    rows = [(i, None if i % 20 == 0 else rng.choice(["", " "]).join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))))
            for i in range(300)]
    # thousands of labels in one match
    rows += [(300, "a@" + "b." * 8000 + "c"), (301, "joe at b" + ".b" * 8000)]
    df = spark.createDataFrame(rows, TEXTS)
    model = pii.train(df)
    for r in pii.report(df, model).collect():
        base = base_spans(rows[r.doc_id][1] or "")
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in pii.KINDS]
        assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))
    assert pii.report(odd_docs, model).count() == odd_docs.count()
    assert pii.report(no_docs, pii.train(no_docs)).count() == 0


LETTERS = {"email": ["jane.doe", "x", "@", " at ", "[at]", " (at) ", "example", " dot ", "[dot]", " [dot] ", "(dot)", ".", "org", "7", " "],
         "ip": ["1", "25", "255", ".", ":", "fe80", "a", "1:2:3:4:5:6:7", ":8", "1:2:3:4:5:6:7:8", "10.2.3.4", ".10", " "],
         "card": ["4", "4111", "1111", "0000", " ", "-", ".", "_", "/", "4111.1111", "4111_1111/4111"],
         "phone": ["+", "1", "555", "0199", "(555)", " ", ".", "-", "555-123-", "867"]}


@pytest.mark.parametrize("kind", pii.KINDS)
def test_every_match_of_a_pattern_has_its_hint(spark, kind):
    rng = random.Random(9)
    texts = ["".join(rng.choices(LETTERS[kind], k=rng.randint(2, 9))) for _ in range(20_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for pattern, hint in [(pii.BASE[kind], pii.HINT[kind]), (pii.LOOSE[kind], pii.LOOSE_HINT[kind])]:
        matched = df.filter(F.col("text").rlike(pattern))
        assert matched.count() > 10 and matched.filter(~F.col("text").rlike(hint)).collect() == []


@pytest.mark.parametrize("address", ["jane.doe at example[dot]com", "jane.doe at example [dot] com", "jane at example (dot) org",
                                     "jane at example.9net", "jane [at] example.com"])
def test_spelled_out_addresses_are_candidates_whatever_else_a_text_holds(spark, address):
    texts = [f"mail {address}", f"mail {address} or see the note (at) once"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", pii.candidates(F.col("text")).alias("found")).collect():
        assert [r.text[x.s:x.e] for x in r.found if not x.base] == [address]


def test_em_learns_which_labeler_to_trust():
    # labeler 0 is right, labeler 3 votes at random
    table = [(3, True, (1, 1, 1, 1), 1, 50), (3, True, (1, 1, 0, -1), 1, 50), (3, False, (1, 1, 0, 1), 1, 20),
             (3, False, (1, 1, 0, -1), 1, 20), (3, False, (-1, -1, 0, 1), 1, 30), (3, False, (-1, -1, 0, -1), 1, 30)]
    post, rates = pii.estimate(table)
    assert min(post[:4]) > 0.9 and max(post[4:]) < 0.1
    assert rates[3, 0, 1, 1] > 0.9 and abs(rates[3, 3, 1, 1] - rates[3, 3, 0, 1]) < 0.2


def test_redaction(spark, odd_docs):
    df = spark.createDataFrame([(1, "é mail a@b.com, +1 (644) 555-4442 x"), (2, None), (3, "clean")], TEXTS)
    got = {r.doc_id: r.text for r in pii.redact(df, pii.train(df)).collect()}
    assert got == {1: "é mail <EMAIL>, <PHONE> x", 2: None, 3: "clean"}
    assert pii.redact(odd_docs, pii.train(df)).columns == odd_docs.columns


def test_pipeline_stages(spark):
    docs, sf = documents(spark, SF_SMALL), SF_SMALL
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert after.columns == names
        seen[name] = (docs.count(), after.count())
        docs = after
    assert seen["simhash_near_dedup"][1] < seen["simhash_near_dedup"][0]
    assert seen["substring_dedup"][0] == seen["substring_dedup"][1]
    texts = [r.text or "" for r in docs.collect()]
    assert not any(base_spans(t) for t in texts)
    pieces = corpus_pipeline.packed(spark, docs, sf).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_run_equals_the_stages(spark):
    """run() against the stages applied one by one to collected tables and a
    plain tokenizer: the same documents, and each piece holds its ids."""
    docs = documents(spark, SF_SMALL)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), docs.schema)
    plain = Tokenizer.from_file(VOCABULARY)
    ids = {r.doc_id: [*plain.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    pieces = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        mine = ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length == len(mine)
        assert r.ids_crc32 == zlib.crc32(np.array(mine, "<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    assert set(pieces) == set(ids)
    for d, cut in pieces.items():
        ends = [0, *(a + n for a, n in sorted(cut))]
        assert [a for a, _ in sorted(cut)] == ends[:-1] and ends[-1] == len(ids[d])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
