"""Encoding, counting and packing against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridsight.llm import bpe_tree, chunks, packing, token_counts
from tests.llm.helpers import empty, hard, hard_rows

ODD = st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "bc", "'s", "'", "1", "23", ".", "!", "é", "▁", "中", "\x85", "\xa0", "\x1c", "<|endoftext|>", "<s>", "🙂", " the", " x", "　"]), max_size=40).map("".join)
CODEC = bpe_tree.Codec(P.path(bpe_tree.VOCABULARY), P.PATTERN, leaf=3)
ENCODER = packing.Encoder(P.path(packing.VOCABULARY))
COUNTER = token_counts.Counter(P.path(token_counts.VOCABULARY))


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_tree_encodes_as_the_library(text):
    ids = CODEC.encode(text)
    assert bpe_tree.unpacked(ids) == CODEC.encoding.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_pieces_encode_as_the_libraries(text):
    assert bpe_tree.unpacked(ENCODER.encode(text)) == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert COUNTER.count([text]) == [len(COUNTER._model.encode(text))]


@settings(max_examples=200, deadline=None)
@given(ODD)
def test_cuts_keep_the_text(text):
    assert " ".join(chunks.CUT.split(text)) == text


def test_memo_is_cut_back(monkeypatch):
    monkeypatch.setattr(chunks, "MEMO_ENTRIES", 4)
    monkeypatch.setattr(chunks, "MEMO_KEPT", 2)
    memo = chunks.Memo(lambda parts: map(len, parts))
    for k in range(20):
        parts, sizes = memo.of(f"first a{k} bb{k} ccc{k} a{k}")
        assert sizes == [len(p) for p in parts[1:]]
    assert len(memo.known) <= 4 + 4


def test_large_pieces():
    for text in ("a" * 5000, " " * 3000, "é" * 3000 + " " + "b " * 2000):
        assert bpe_tree.unpacked(CODEC.encode(text)) == CODEC.encoding.encode_ordinary(text)
        assert COUNTER.count([text]) == [len(COUNTER._model.encode(text))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "the", "é", "中", "文", "字", "กิ", "1", "22", "!", "--", "'", "'l", "l", "ll", "\n", " ", "\t", "\u0378", "\U000323e7", "🙂", "\x1c", "\x85"]), max_size=200).map("".join))
def test_seams_without_blanks(text):
    """Long matches, space runs, contractions and unassigned characters over the seams of tiny leaves."""
    assert bpe_tree.unpacked(CODEC.encode(text)) == CODEC.encoding.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "st", "ing", "er", "中", "國", "é"]), min_size=1, max_size=400).map("".join), st.data())
def test_tokens_of_one_match_join(text, data):
    """Encoding is a monoid: wherever a match is cut, the halves' tokens join to the library's."""
    cut = data.draw(st.integers(0, len(text)))
    a, b = (CODEC.encoding.encode_ordinary(x) for x in (text[:cut], text[cut:]))
    assert (CODEC.join_tokens(a, b) if a and b else a or b) == CODEC.encoding.encode_ordinary(text)


def test_windows_stay_small():
    """Joining two long stretches encodes a few tokens again, not the stretches."""
    draw = random.Random(5)
    for letters in ("abcdefghij", "".join(map(chr, range(0x4E00, 0x4E80))), "ก่ข้ค", "a\nb\tc"):
        a, b = (CODEC.run("".join(draw.choices(letters, k=20_000))) for _ in range(2))
        sizes: list[int] = []
        inner = CODEC._piece
        CODEC._piece = lambda data: sizes.append(len(data)) or inner(data)
        try:
            CODEC.join_runs(a, b)
        finally:
            del CODEC._piece
        assert sum(sizes) < 2_000, letters[:3]


def test_counts_of_many_texts_together():
    """Texts in one batch are counted as alone, also those cut to stretches."""
    texts = ["", "a b", " x", "x ", "a  b c ▁ d", "é " * 50, "word " * 900_000, "last one\n"]
    assert COUNTER.count(texts) == [len(COUNTER._model.encode(t)) for t in texts]
    assert [" ".join(chunks.stretches(t, 7)) for t in texts] == texts


def test_batches_are_of_equal_bytes():
    calls: list[int] = []
    memo = chunks.Memo(lambda parts: calls.append(sum(len(p.encode()) for p in parts)) or map(len, parts), batch_bytes=1000)
    memo.all_of([" ".join(f"é{k}x{j}" for j in range(50)) for k in range(100)])
    assert all(1000 <= c < 1100 for c in calls[:-1]) and len(calls) > 10


def _texts() -> Counter:
    return Counter((r[0], r[1]) for r in hard_rows())


def test_round_trip_query(spark):
    got = Counter(tuple(r) for r in bpe_tree.round_trip(hard(spark)).collect())
    want = Counter()
    for (key, text), n in _texts().items():
        ids = bpe_tree.packed(CODEC.encoding.encode_ordinary(text or ""))
        want[(key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += n
    assert got == want
    assert bpe_tree.round_trip(empty(spark)).collect() == []


def test_encode_then_decode(spark):
    got = bpe_tree.decode(bpe_tree.encode(hard(spark))).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in got) == Counter((k, (t or "").encode()) for k, t in _texts().elements())


def test_counts_query(spark):
    got = Counter(tuple(r) for r in token_counts.count(hard(spark)).collect())
    want = Counter()
    for (key, text), n in _texts().items():
        size = len(COUNTER._model.encode(text or ""))
        want[(key, len((text or "").encode()), size, size > 4096)] += n
    assert got == want
    assert token_counts.count(empty(spark)).collect() == []


def test_lengths():
    assert packing.lengths(1) == [1]
    assert packing.lengths(2047) == [1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1]
    assert packing.lengths(1024) == [1024]
    with pytest.raises(ValueError):
        packing.pack(None, longest=1000)


def test_packing_encodes_pieces_of_many_texts_together(monkeypatch):
    """New pieces of many texts go to the tokenizer in few calls, and each gets its own ids."""
    at, calls = packing.Encoder(P.path(packing.VOCABULARY)), []
    ids = at._ids
    monkeypatch.setattr(at, "_ids", lambda text: calls.append(text) or ids(text))
    texts = [f"one word{k} it's{k} é{k},\nx <s>" for k in range(200)]
    assert [bpe_tree.unpacked(x) for x in at.encode_all(texts)] == [ids(x) for x in texts]
    assert len(calls) < 10
    assert list(at.encode_all([])) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=12))
def test_packing_of_texts_together(texts):
    assert [bpe_tree.unpacked(x) for x in packing.Encoder.encode_all(ENCODER, texts)] == [ENCODER._ids(x) for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=12))
def test_packing_tells_any_pieces_apart(parts):
    assert [bpe_tree.unpacked(x) for x in ENCODER._pieces(parts)] == [ENCODER._ids(" " + x) for x in parts]


def test_packing_query(spark):
    rows = [r.asDict() for r in packing.pack(hard(spark), with_ids=True).collect()]
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    by_doc = defaultdict(list)
    for r in rows:
        assert r["offset"] == 0 and r["length"] == 1 << r["bucket"] <= 1024
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"]].append(r)
    for key in {k for k, _ in _texts()}:
        want = Counter()
        for (k, text), n in _texts().items():
            if k == key:
                want[bpe_tree.packed([*ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, 0])] += n
        starts = Counter(r["start"] for r in by_doc[key])
        assert starts[0] == sum(want.values())
        assert sum(r["length"] for r in by_doc[key]) == sum(len(ids) // 4 * n for ids, n in want.items())
        if sum(want.values()) == 1:
            assert b"".join(bytes(r["ids"]) for r in sorted(by_doc[key], key=lambda r: r["start"])) in want
    assert packing.pack(empty(spark)).collect() == []
