"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from odd import LONG, ROWS, documents

from tillwise.llm import bytepairs
from tillwise.llm.queries import op12_byte_pairs

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ENCODER = bytepairs.Encoder(PATH, PATTERN)
VOCABULARY = ENCODER.vocabulary
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
ODD = [
    "", " ", "  \n\n x", "it's THE'RE we'll'd '' 's", "a" * 500, "ab" * 300, " " * 300 + "x", "日本語のテキスト、そして ½ ⅷ ٣٤ 𝔘𝔫𝔦 👩‍👩‍👧 é", "<|endoftext|>", "x\x00y﻿ z 　",
    "Straße, École — naïve… Ωμέγα Привет мир", "!?" * 90, "0123456789" * 30, "\r\n\t\x0b\x0c \x85",
]
TEXT = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeinst éß'  \n19.日本")), max_size=60)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids = ENCODER.encode(text)
    assert ids.tolist() == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids).tobytes() == text.encode()


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_any_text(text):
    assert ENCODER.encode(text).tolist() == LIBRARY.encode_ordinary(text) == bytepairs.Document(ENCODER, text).ids()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50255), min_size=1, max_size=6))
def test_any_run_of_tokens_as_one_piece(tokens):
    piece = b"".join(VOCABULARY.bytes[token] for token in tokens)
    prefixes = bytepairs.Prefixes(VOCABULARY, piece)
    assert prefixes.ids() == VOCABULARY.merged(piece) == LIBRARY._encode_single_piece(piece)
    # each prefix ends in the last token of its own encoding
    assert prefixes.last == [VOCABULARY.merged(piece[:i])[-1] for i in range(1, len(piece) + 1)]


def test_fit_is_what_merging_two_tokens_gives():
    rng = random.Random(7)
    common = list(range(2000))
    for _ in range(20_000):
        a, b = rng.choice(common), rng.randrange(50256)
        assert VOCABULARY.fit(a, b) == (VOCABULARY.merged(VOCABULARY.bytes[a] + VOCABULARY.bytes[b]) == [a, b])


def test_tokens_that_merges_do_not_lead_to():
    """'abcd' is a token, but its parts never meet; as a piece it is that token, inside a piece it never occurs."""
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 256, b"abcd": 257}
    own = bytepairs.Vocabulary(ranks)
    library = tiktoken.Encoding("few", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    for piece in (b"abcd", b"abcde", b"xabcd", b"bcbc"):
        assert bytepairs.Prefixes(own, piece).ids() == library.encode_ordinary(piece.decode())


def test_appends_are_exact_and_look_at_new_bytes_only():
    rng = random.Random(3)
    piece = bytes(rng.choice(b"abcdeinst") for _ in range(400))
    prefixes, at = bytepairs.Prefixes(VOCABULARY), 0
    while at < len(piece):
        step = rng.randrange(1, 9)
        prefixes.append(piece[at : at + step])
        at = min(at + step, len(piece))
        assert prefixes.ids() == LIBRARY._encode_single_piece(piece[:at])
    assert prefixes.looked_at == len(piece)


def test_an_edit_of_a_piece_looks_at_bytes_near_it():
    rng = random.Random(4)
    piece = bytes(rng.choice(b"abcdeinst") for _ in range(20_000))
    prefixes = bytepairs.Prefixes(VOCABULARY, piece)
    for _ in range(30):
        place, removed, added = rng.randrange(len(piece)), rng.randrange(5), bytes(rng.choice(b"xyz") for _ in range(rng.randrange(5)))
        seen = prefixes.looked_at
        piece = piece[:place] + added + piece[place + removed :]
        prefixes.edit(place, removed, added)
        assert prefixes.bytes == piece and prefixes.looked_at - seen < 400
    assert prefixes.last == bytepairs.Prefixes(VOCABULARY, piece).last


@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 70), st.integers(0, 12), TEXT.map(lambda t: t[:8])), max_size=5))
def test_edits_of_a_document(text, edits):
    document = bytepairs.Document(ENCODER, text)
    for place, removed, added in edits:
        place = min(place, len(text))
        text = text[:place] + added + text[place + removed :]
        document.edit(place, removed, added)
        assert document.text == text and document.ids() == LIBRARY.encode_ordinary(text)


def test_an_edit_of_a_long_document_splits_little_of_it():
    text = "Some words, and then some more of them.\n" * 2000
    document = bytepairs.Document(ENCODER, text)
    document.edit(40_000, 3, "new")
    document.append(" The end")
    text = text[:40_000] + "new" + text[40_003:] + " The end"
    assert document.ids() == LIBRARY.encode_ordinary(text) and document.split_again < 30


def test_a_small_table_forgets_and_long_texts_come_in_slices(monkeypatch):
    monkeypatch.setattr(bytepairs, "SLICE", 50)
    small = bytepairs.Encoder(PATH, PATTERN, limit=3)
    for text in [LONG[:5000], "one two three four five six", "q" * 300 + " five six"]:
        assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_table(spark):
    rows = bytepairs.decoded(bytepairs.encoded(documents(spark), PATH, PATTERN), PATH, PATTERN).collect()
    got = sorted(((r.doc_id, list(r.ids), bytes(r.bytes)) for r in rows), key=str)
    assert got == sorted(((d, LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in ROWS), key=str)


def test_empty_table(spark):
    assert bytepairs.decoded(bytepairs.encoded(documents(spark, []), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    for r in spark.read.parquet(f"{folder}/documents.parquet").join(op12_byte_pairs(spark, folder), "doc_id").collect():
        ids = LIBRARY.encode_ordinary(r.text or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
