"""Operators 2, 5, 7 and 8 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from paceline.llm import iblt, sharding, simhash, substring
from paceline.llm.common import documents

TEXTS = "doc_id long, text string"


def repeats(rows, window):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if k in seen:
                gone[i:i + window] = [True] * window
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("window", [20, 6, 21, 2, 45])
def test_substring_dedup_equals_brute_force(spark, passages, window):
    found = substring.remove_repeats(spark.createDataFrame(passages, TEXTS), window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == repeats(passages, window)
    for r in found:
        assert hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest() == r.kept_sha256


def test_levels_double_up_to_the_window():
    assert [substring.levels(w) for w in (2, 6, 20, 21, 80)] == [[1], [3], [10], [6, 11], [10, 20, 40]]


def test_windows_are_told_apart_whatever_their_letters(spark):
    """Two words that polynomial hashes modulo 2^64 cannot tell apart."""
    morse = "a"
    while len(morse) < 1024:
        morse += morse.translate({97: "b", 98: "a"})
    other = morse.translate({97: "b", 98: "a"})
    tail = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{morse} {tail}"), (2, f"{other} {tail}"), (3, f"{morse} {tail}")]
    found = substring.remove_repeats(spark.createDataFrame(rows, TEXTS)).collect()
    assert {r.doc_id: r.n_removed for r in found} == {1: 0, 2: 0, 3: 20}
    words = [b"a" if c == "a" else b"b" for c in morse]                      # and as a sequence of words
    h = [np.array([substring._HASHES[0][w] for w in ws], np.uint64) for ws in (words, [b"b" if w == b"a" else b"a" for w in words])]
    assert substring.window_hashes(h[0], 1024) != substring.window_hashes(h[1], 1024)


def test_words_hash_alike_wherever_they_stand():
    words = ["".join("ab"[i * n % 7 % 2] for i in range(n)) + tail for n in range(0, 45) for tail in ("", "a", "b", "\0", "é")][1:]
    texts = [None, "", *(" " * i + " ".join(words[i:] + words[:i]) for i in range(9)), " \n"]
    w = substring.Windows([None if t is None else t.encode() for t in texts], 20)
    assert w.n.tolist() == [0, 0, *[len(words)] * 9, 0]
    for which in (0, 1):
        h = w.hashes(which).reshape(9, -1)
        assert all((np.roll(h[i], i) == h[0]).all() for i in range(9))
        assert len(set(h[0].tolist())) == len(set(words))
    assert not set(w.hashes(0).tolist()) & set(w.hashes(1).tolist())


def test_substring_dedup_stops_when_no_candidate_is_left(spark):
    rows = [(i, " ".join(f"w{i}-{j}" for j in range(200))) for i in range(5)]
    found = substring.remove_repeats(spark.createDataFrame(rows, TEXTS), 80).collect()
    assert [r.n_removed for r in found] == [0] * 5


def test_substring_dedup_of_odd_rows(odd_docs, no_docs):
    got = substring.remove_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count() and set(odd_docs.columns) < set(got[0].asDict())
    long = next(r for r in got if r.doc_id == 5)
    assert long.n_words == 30_000 and long.n_removed == 30_000 - 1
    assert substring.remove_repeats(no_docs).count() == 0


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, odd_docs):
    for text in [None, "", "One", "a B c D e", "É é ß A", "x " * 50, "a b c d e f g h i j"]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2 ** 64
    assert spark_hash == xxh64_intdigest(b"a b c d", 42)


def test_covering_masks_find_every_pair_within_the_radius():
    rng, masks = np.random.default_rng(1), simhash.covering_masks(4)
    for _ in range(3000):
        diff = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
        assert any(diff & m == 0 for m in masks)


def components(fps, radius=4):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    values = sorted(parent)
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {f: root(f) for f in fps}


@pytest.mark.parametrize("block", [2048, 5])
def test_links_connect_what_all_pairs_connect(spark, block):
    rng = np.random.default_rng(7)
    fps = {int(x) for x in rng.integers(0, 2 ** 63, 40)}
    for centre in list(fps)[:6]:
        for _ in range(25):
            flips = rng.choice(63, rng.integers(1, 9), replace=False)
            fps.add(centre ^ sum(1 << int(b) for b in flips))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.fp: r.root for r in simhash.components(simhash.links(df, 4, block)).collect()}
    wanted = components(fps)
    assert all(roots.get(f, f) == wanted[f] for f in fps)


def test_near_duplicates_of_documents(spark):
    rows = documents(spark, SF_SMALL).select("doc_id", "text").collect()
    wanted = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    group = components(set(wanted.values()))
    least = {}
    for d, f in wanted.items():
        least[group[f]] = min(d, least.get(group[f], d))
    for r in simhash.near_duplicates(documents(spark, SF_SMALL)).collect():
        assert r.fp % 2 ** 64 == wanted[r.doc_id] and r.component_id == least[group[wanted[r.doc_id]]]


def test_one_document_of_each_group_stays(spark, odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.text for r in kept.collect() if r.text and "same text" in r.text) == {"same text here.": 1}
    assert simhash.keep_one(no_docs).count() == 0
    docs = documents(spark, SF_SMALL)
    ids = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert ids == {r.component_id for r in simhash.near_duplicates(docs).collect()}


def check_shards(found, shards=40):
    counts = Counter(r.shard for r in found)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))


def test_shards_are_even_and_keep_groups(spark):
    rows = [(i, f"unique {i}") for i in range(600)] + [(1000 + i, f"group {i % 20}") for i in range(160)]
    rows += [(2000 + i, "a group larger than a shard") for i in range(60)]
    found = sharding.assign(spark.createDataFrame(rows, TEXTS)).collect()
    check_shards(found)
    of = dict(rows)
    shards = defaultdict(Counter)
    for r in found:
        shards[of[r.doc_id]][r.shard] += 1
        assert r.size == len(of[r.doc_id].encode()) + 16 and r.law == "rows" and r.grown_shard is None
    small = [c for t, c in shards.items() if t.startswith("group")]
    assert sum(len(c) == 1 for c in small) >= 18
    assert len(shards["a group larger than a shard"]) <= 5


def test_shards_of_odd_rows(odd_docs, no_docs):
    check_shards(sharding.assign(odd_docs).collect())
    assert sharding.assign(no_docs).count() == 0


def paragraphs(t):
    return {p for p in re.split(r"\n|(?<=[.!?|*#$%&])[\x20\x09-\x0D]+", t) if re.search(r"[^\x20\x09-\x0D]", p)}


def jaccard(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def split_groups(found):
    groups = defaultdict(Counter)
    for r in found:
        groups[r.text_crc32][r.shard] += 1
    return sum(len(c) > 1 for c in groups.values())


def test_sharding_mends_pairs_when_no_text_is_alone(spark):
    texts = [f"text {i % 300}" for i in range(600)]
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts))
    found = sharding.assign(spark.createDataFrame(rows, TEXTS), 6).collect()
    assert set(Counter(r.shard for r in found).values()) == {100}
    assert split_groups(found) == 0


@pytest.mark.parametrize("cells, range_bytes", [(iblt.CELLS_PER_DIGEST, 4 << 20), (0.2, 40_000)])
def test_peeling_recovers_the_differences(spark, monkeypatch, cells, range_bytes):
    """With too few cells at first, retries give the same likeness."""
    monkeypatch.setattr(iblt, "RANGE_BYTES", range_bytes)
    if cells < iblt.CELLS_PER_DIGEST:
        monkeypatch.setattr(iblt, "LEAST_CELLS", 2)
    docs = documents(spark, SF_SMALL)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in iblt.compare_neighbours(docs, cells).collect()}
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited, r = t[:len(t) - half] + after[:half], got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(t, edited)) and r.near_next == pytest.approx(jaccard(t, after))
    by_text = {}
    for d, t in rows:
        assert by_text.setdefault(t, got[d].fingerprint) == got[d].fingerprint


def test_recovered_digests_are_those_that_differ(spark):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        shared, only_x, only_y = ([rng.randrange(-2**63, 2**63) for _ in range(rng.randint(0, 30))] for _ in range(3))
        rows.append((i, shared + only_x, only_y + shared))
    rows += [(60, [], []), (61, [5], []), (62, [0], [0])]
    found = iblt.differences(spark.createDataFrame(rows, "id int, x array<long>, y array<long>"), ["id"], 1.0, 8).collect()
    assert len(found) == len(rows) and sum(r.left == 0 for r in found) > 50
    for r in found:
        x, y = map(set, rows[r.id][1:])
        assert (r.n_x, r.n_y) == (len(x), len(y)) and set(r.plus) <= x - y and set(r.minus) <= y - x
        if not r.left:
            assert sorted(r.plus) == sorted(x - y) and sorted(r.minus) == sorted(y - x)


def test_fingerprints_are_sketches_that_subtract(spark):
    keys = [random.Random(7).randrange(-2**63, 2**63) for _ in range(70_000)]
    df = spark.createDataFrame([(keys[:-1], keys)], "a array<long>, b array<long>")
    a, b = df.select(iblt.fingerprint(F.col("a")), iblt.fingerprint(F.col("b"))).first()
    cells = [[(int(f[i:i + 8], 16), int(f[i + 8:i + 24], 16), int(f[i + 24:i + 32], 16)) for i in range(0, len(f), 32)] for f in (a, b)]
    assert sum(n for n, _, _ in cells[1]) == 4 * 70_000
    left = [(m - n, j ^ k) for (n, j, _), (m, k, _) in zip(*cells) if (n, j) != (m, k)]
    assert left == [(1, keys[-1] % 2**64)] * iblt.HASHES


def test_retries_read_only_what_is_left_open(spark, monkeypatch):
    monkeypatch.setattr(iblt, "LEAST_CELLS", 2)
    rows = [(i, " ".join(f"part {(i * 7 + j) % 90}." for j in range(12))) for i in range(60)]
    read, differences = [], iblt.differences

    def seen(pairs, *args):
        read.append(set(pairs.inputFiles()))
        return differences(pairs, *args)
    monkeypatch.setattr(iblt, "differences", seen)
    found = {r.doc_id: r for r in iblt.compare_neighbours(spark.createDataFrame(rows, TEXTS), 0.2).collect()}
    assert len(read) > 1 and read[0] and not any(read[0] & later for later in read[1:])
    assert all(found[i].near_next == pytest.approx(jaccard(t, rows[i - 1][1])) for i, t in rows)


def test_fingerprints_hash_a_digest_once(spark):
    def hashes(size):
        df = spark.createDataFrame([([1, 2],)], "a array<long>").select(iblt.fingerprint(F.col("a"), size))
        return df._jdf.queryExecution().optimizedPlan().toString().count("xxhash64(")
    assert hashes(2) == hashes(6) > 0       # not again for every cell


def test_ranges_cut_within_an_id(spark, monkeypatch):
    monkeypatch.setattr(iblt, "RANGE_BYTES", 500)
    rows = [(None if i % 2 else 7, f"text {i}. and more {i % 5}.") for i in range(200)]
    found, ranges = iblt.with_successor(spark.createDataFrame(rows, TEXTS))
    assert ranges > 5
    own = [r for r in found.collect() if not r.guest]
    assert len(own) == 200 and len({r.range for r in own}) == ranges
    assert max(Counter(r.range for r in own).values()) < 80 and all(r.next_text is not None for r in own)
    assert sorted(r.next_text for r in own) == sorted(t for _, t in rows)       # one circle


def test_texts_move_once_to_their_successors(spark, monkeypatch):
    monkeypatch.setattr(iblt, "RANGE_BYTES", 500)
    rows = [(i, f"text {i}. and more {i % 5}.") for i in range(200)]
    found, _ = iblt.with_successor(spark.createDataFrame(rows, TEXTS))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    found = iblt.compare_neighbours(odd_docs).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    assert sorted(str((r.doc_id, r.n_chars)) for r in found) == sorted(str((d, len(t))) for d, t in texts)
    for d, t in texts:
        mine = [r for r in found if r.doc_id == d and r.n_chars == len(t)]
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in mine)
    same = {r.fingerprint for r in found if r.n_chars == len("same text here.") and r.doc_id in (3, 4)}
    assert len(same) == 1
    lone = iblt.compare_neighbours(spark.createDataFrame([(1, "alone. here.")], TEXTS)).first()
    assert lone.near_next == 1.0 and iblt.compare_neighbours(no_docs).count() == 0
