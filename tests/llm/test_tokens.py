"""Operators 1 and 9 against tiktoken, tokenizers and the texts themselves."""

import hashlib
import itertools
import random
import json
import zlib

import public_tokenizers as P
import pytest
import tiktoken
from conftest import SF_ORACLE, SF_SMALL
from tokenizers import Tokenizer

from paceline.llm import bpe, packing
from paceline.llm.chunks import ChunkEncoder
from paceline.llm.common import documents
from paceline.llm.queries import PATTERN, RANKS, TARGETS, VOCABULARY, op9_packing

HARD = ["", " ", "a  b", "a \n b", "x  ", " lead", "  two", "a\n\nb c", "it's we'll 123 4 5", "tab\t x", "　 wide   nb",
        "1234567 a.b,c!!  ?? \n\n\n q", "emoji 😀😀 é́", "\x1c \x85 a b", "<|endoftext|> x", "a \n", "a b "]


@pytest.fixture(scope="module")
def ours():
    return bpe.ByteBpe(bpe.read_ranks(RANKS), PATTERN)


@pytest.fixture(scope="module")
def theirs(ours):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def packed_ids(ids, code="I"):
    import struct
    return struct.pack(f"<{len(ids)}{code}", *ids)


@pytest.mark.parametrize("text", HARD)
def test_ids_equal_tiktoken_and_decode_back(ours, theirs, text):
    assert ours.encode(text) == packed_ids(theirs.encode_ordinary(text))
    assert ours.decode(ours.encode(text)) == text.encode()


EDGES = ["foo bar\n", "x \nfoo", "a b ", "q \tfoo", "z \n\ny"]


def test_texts_of_a_batch_do_not_change_each_others_ids(ours, theirs):
    """Unseen chunks with white space at their edges, next to one another in every order."""
    def check(texts):
        ours.chunks = ChunkEncoder(ours.chunks.pre_tokens, ours._encode_tokens)
        assert ours.encode_batch(texts) == [packed_ids(theirs.encode_ordinary(t)) for t in texts]

    for texts in itertools.permutations(EDGES):
        check(list(texts))
    for seed in range(200):
        check(random.Random(seed).sample(HARD + EDGES, len(HARD + EDGES)))


def test_cache_does_not_change_ids(ours, theirs):
    tiny = bpe.ByteBpe(bpe.read_ranks(RANKS), PATTERN)
    tiny.chunks.chunks.limit = tiny.chunks.tokens.limit = 3
    texts = [f"word{i} other{i % 7} same, {i}" for i in range(40)]
    assert tiny.encode_batch(texts) == [packed_ids(theirs.encode_ordinary(t)) for t in texts]


def test_round_trip_query(spark, theirs):
    docs = documents(spark, SF_SMALL)
    got = {r.doc_id: r for r in bpe.round_trip(docs, RANKS, PATTERN).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = theirs.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(packed_ids(ids)).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_encode_then_decode_tables(spark, odd_docs, no_docs):
    ids = bpe.encode_documents(odd_docs, RANKS, PATTERN)
    back = [bytes(r.decoded).decode() for r in bpe.decode_ids(ids, RANKS, PATTERN).collect()]
    assert sorted(back) == sorted((r.text or "") for r in odd_docs.collect())
    assert bpe.round_trip(no_docs, RANKS, PATTERN).count() == 0


def test_a_gap_in_the_ranks_is_an_error():
    with pytest.raises(ValueError):
        bpe.sentencepiece_model({bytes([b]): b + (b > 9) for b in range(256)})


def test_mixture_places_every_token_once():
    rng = random.Random(3)
    for trial in range(30):
        totals = [(f"s{i}" if i else None, rng.choice([0, 1, 3, 50, rng.randint(1, 600)])) for i in range(rng.randint(1, 6))]
        targets = None if trial % 2 else {q: rng.choice([0, 1, 2, 5]) for q, _ in totals}
        mixture = packing.Mixture(totals, targets, rng.choice([1, 7, 64, 1000]))
        seen = bytearray(sum(n for _, n in totals))
        for q, n in totals:
            at = 0
            while at < n:
                size = min(n - at, rng.randint(1, 300))
                for g, length in mixture.place(q, at, size):
                    assert not any(seen[g:g + length])
                    seen[g:g + length] = b"\1" * length
                at += size
        assert all(seen)


def test_windows_hold_the_target_shares():
    totals, window = [("a", 7000), ("b", 2000), ("c", 1000)], 500
    mixture = packing.Mixture(totals, None, window)
    filled = {}
    for q, n in totals:
        for g, length in mixture.place(q, 0, n):
            for x in range(g, g + length):
                filled[x // window, q] = filled.get((x // window, q), 0) + 1
    for w in range(20):
        assert all(abs(filled[w, q] - n / 20) <= 3 for q, n in totals)


def check_pieces(docs, pieces):
    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    wanted = sorted(packed_ids([*model.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in docs.collect())
    by_crc = {}
    for p in pieces:
        by_crc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        assert 0 < p.length and p.offset + p.length <= 1024
    room = {}
    for p in pieces:
        room.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in room.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
    full = [sum(n for _, n in spans) for _, spans in sorted(room.items())]
    assert all(n == 1024 for n in full[:-1]) and sum(full) == sum(len(w) // 4 for w in wanted)
    return by_crc, wanted


def test_packing_keeps_every_id_in_one_piece(spark):
    docs = documents(spark, SF_SMALL)
    pieces = packing.pack_documents(docs, VOCABULARY, PATTERN).collect()
    by_doc, _ = check_pieces(docs.select("doc_id", "text"), pieces)
    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in docs.select("doc_id", "text").collect():
        ids = [*model.encode(r.text or "", add_special_tokens=False).ids, 0]
        own, at = sorted(by_doc[r.doc_id, len(ids)], key=lambda p: p.start), 0
        for p in own:
            assert p.start == at and p.ids_crc32 == zlib.crc32(packed_ids(ids[at:at + p.length]))
            at += p.length
        assert at == len(ids)


def test_packing_of_odd_rows(odd_docs, no_docs):
    check_pieces(odd_docs.select("doc_id", "text"), packing.pack_documents(odd_docs, VOCABULARY, PATTERN).collect())
    assert packing.pack_documents(no_docs, VOCABULARY, PATTERN).count() == 0
    few = packing.tokenize(odd_docs, VOCABULARY, PATTERN, max_queues=1).select("queue").distinct().count()
    assert few <= 2


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> \n", " <|endoftext|>  it's", "<|endoftext|", "<|END|>"]


@pytest.mark.parametrize("text", HARD + ADDED)
def test_packed_ids_equal_the_library_in_its_default_setting(text):
    model = Tokenizer.from_file(VOCABULARY)
    with open(VOCABULARY, "rb") as f:
        ours = packing.JsonBpe(f.read(), PATTERN)
    assert ours.encode(text).tolist() == model.encode(text, add_special_tokens=False).ids


def test_pieces_of_texts_that_hold_added_tokens(spark):
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string").selectExpr("*", "'a' AS source")
    model = Tokenizer.from_file(VOCABULARY)
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packing.pack_documents(docs, VOCABULARY, PATTERN).collect()}
    for i, text in enumerate(ADDED):
        ids = [*model.encode(text, add_special_tokens=False).ids, 0]
        assert got[i] == (len(ids), zlib.crc32(packed_ids(ids)))


def check_shares(pieces, targets, window, length):
    """Until a queue ends, what each has sent after every window is its share."""
    total, sent = {}, {}
    for p in pieces:
        total[p.queue] = total.get(p.queue, 0) + p.length
        w = (p.sequence_id * length + p.offset) // window
        sent[w, p.queue] = sent.get((w, p.queue), 0) + p.length
    so_far, checked = dict.fromkeys(targets, 0), 0
    for w in range(sum(total.values()) // window):
        for q in targets:
            so_far[q] += sent.get((w, q), 0)
        if any(so_far[q] == total[q] for q in targets):
            break
        for q, t in targets.items():
            assert abs(so_far[q] - (w + 1) * window * t / sum(targets.values())) <= len(targets)
        checked += 1
    return checked


@pytest.mark.parametrize("max_queues", [4096, 2])
def test_windows_hold_fractional_targets_of_few_and_many_sources(spark, max_queues):
    targets = {"web": 0.7, "books": 0.2, None: 0.1}
    rows = [(i, ["web", "books", None, "x", "y", "z"][i % 6], f"text number {i} of its own " * 3) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    pieces = packing.pack_documents(docs, VOCABULARY, PATTERN, targets, 16, 4, max_queues).collect()
    assert check_shares(pieces, targets, 64, 16) > 20
    rest = {p.queue for p in pieces} - set(targets)
    assert rest == {"x", "y", "z"} if max_queues > 2 else len(rest) <= 2
    first = min(p.sequence_id for p in pieces if p.queue in rest)
    assert first >= max(p.sequence_id for p in pieces if p.queue not in rest)


def test_registered_query_holds_its_documented_targets(spark):
    pieces = op9_packing(spark, SF_ORACLE).collect()
    assert {p.queue for p in pieces} == set(TARGETS)
    assert check_shares(pieces, TARGETS, 65536, 1024) >= 1


def test_targets_that_name_no_source_or_are_negative_are_errors(spark):
    for targets in [{"a": 1, "wbe": 1}, {"a": 1, "b": -1}]:
        with pytest.raises(ValueError):
            packing.Mixture([("a", 5), ("b", 5)], targets, 4)
    docs = spark.createDataFrame([("a",), (None,), ("c",)], "source string")
    assert packing.present(docs, {"a": 1, "b": 2, None: 3}) == {"a": 1, None: 3}


def test_a_vocabulary_whose_ids_do_not_rank_its_merges_is_an_error():
    with open(VOCABULARY, "rb") as f:
        raw = f.read()
    packing.check_merges(raw)
    spec = json.loads(raw)
    merges = spec["model"]["merges"]
    for changed in (merges[::-1], merges[:-1], [*merges[:-1], ["no", "piece"]]):
        spec["model"]["merges"] = changed
        with pytest.raises(ValueError):
            packing.check_merges(json.dumps(spec).encode())
