"""Token ids, token files, packing and edits against the library's encoding of whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from odd import ROWS, documents

from tillwise.llm import edits, fano, slack
from tillwise.llm.wordids import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = WordEncoder(PATH)


def library(text):
    return ENCODER._tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = [
    "", "  ", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>,", "it's, THE'RE. x's.. d'accord's", "Å. É́, ½, x½. Ⅷ. ñ…, naïve!? 日本語。abc",
    "İ. K. ǅ, ﬁ. a b, c.\x1fd\x85e,", "0.5, 12!!! a_b_. a1.", "Œuvre ÉCOLE, ÀÉÎÕÜ ßtraße. œ æ ÆON ÿ Þorn ð. ñ÷a × aª º µm ſ Ĳ ŉ.", "\x00 ퟿ �",
]


def test_ids_equal_the_library_on_odd_texts():
    ids, counts = ENCODER.encode([text.encode() for text in ODD])
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == [library(text) for text in ODD]


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeé ñ.,'st!\n"))))
def test_ids_equal_the_library(text):
    assert ENCODER.encode([text.encode()])[0].tolist() == library(text)


def test_a_small_table_forgets():
    small = WordEncoder(PATH, limit=5)
    for text in ["one two three four five six seven", "eight nine ten one", "one two eleven"]:
        assert small.encode([text.encode()])[0].tolist() == library(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63), max_size=700).map(sorted) | st.lists(st.integers(0, 40), max_size=700).map(sorted))
def test_elias_fano(values):
    data = fano.EliasFano.of(np.array(values, np.uint64)).to_bytes()
    read, end = fano.EliasFano.read(b"??" + data, 2)
    assert end == len(data) + 2 and read.values().tolist() == values
    assert [read.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 50_000)).astype(np.uint64)
    bits = len(fano.EliasFano.of(ends).to_bytes()) * 8 / len(ends)
    assert bits < 2.2 + np.log2(1000) + 1


@pytest.mark.parametrize("ids_per_file", [1, 50, 1 << 20])
def test_token_files(spark, tmp_path, ids_per_file, monkeypatch):
    monkeypatch.setattr("tillwise.llm.wordids.SLICE_BYTES", 20)
    folder = str(tmp_path / "tokens")
    fano.write_token_files(documents(spark), folder, PATH, 2, ids_per_file=ids_per_file)
    got = fano.read_token_files(spark, folder).orderBy("start").collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for row, (doc_id, text, *_) in zip(got, order, strict=True):
        ids = [*library(text), 2]
        assert tuple(row) == (doc_id, start, len(ids), crc(ids))
        start += len(ids)
    # any document by two selects
    block = fano.TokenBlock.read(max(tmp_path.glob("tokens/part-*"), key=lambda p: p.stat().st_size).read_bytes())
    for i, doc_id in enumerate(block.document_ids()):
        assert block.document(i).tolist() in [[*library(text), 2] for d, text, *_ in ROWS if d == doc_id]


def test_token_files_of_an_empty_table(spark, tmp_path):
    fano.write_token_files(documents(spark, []), str(tmp_path / "t"), PATH, 2)
    assert fano.read_token_files(spark, str(tmp_path / "t")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 3), max_size=8), st.integers(0, 60))
def test_fullest_combination(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    chosen = slack.fullest(counts, room)
    assert all(0 < n <= counts[length] for length, n in chosen.items())
    assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= room)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_packing_is_whole_and_gapless(lengths):
    sequence, offset = slack.pack(np.array(lengths, np.int64), 64)
    for s in set(sequence.tolist()):
        inside = sorted((o, n) for q, o, n in zip(sequence.tolist(), offset.tolist(), lengths) if q == s)
        assert [o for o, _ in inside] == np.cumsum([0] + [n for _, n in inside])[:-1].tolist()
        assert sum(n for _, n in inside) <= 64


def test_packing_is_tight():
    lengths = np.random.default_rng(3).integers(1, 900, 16_000)
    assert slack.pack(lengths)[0].max() + 1 <= np.ceil(lengths.sum() / 2048) + 1


def test_packed_documents(spark):
    got = slack.packed(documents(spark), PATH, 0).collect()
    for doc_id, text, *_ in ROWS:
        ids = [*library(text), 0]
        pieces = {r.piece: r for r in got if r.doc_id == doc_id}
        assert sorted(pieces) == list(range(-(-len(ids) // 2048)))
        for k, r in pieces.items():
            part = ids[k * 2048 : (k + 1) * 2048]
            assert (r.start, r.length, r.ids_crc32) == (k * 2048, len(part), crc(part))
    assert len(got) == sum(-(-(len(library(text)) + 1) // 2048) for _, text, *_ in ROWS)
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in filled.values():
        inside.sort()
        assert [o for o, _ in inside] == np.cumsum([0] + [n for _, n in inside])[:-1].tolist() and sum(inside[-1]) <= 2048
    assert len(filled) == -(-sum(r.length for r in got) // 2048)


def test_groups_of_pieces_share_nothing(spark):
    pieces = spark.createDataFrame([(i, 0, 0, i % 50 + 1, 0) for i in range(2000)], slack.PIECES)
    got = slack.pack_pieces(pieces, 100, per_group=300).collect()
    assert len(got) == 2000 and len({r.sequence_id >> 32 for r in got}) == 7
    assert slack.packed(documents(spark, []), PATH, 0).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_edits_follow_the_text(seed):
    rnd = random.Random(seed)
    words = ["alpha", "Beta,", "naïve", "x", "it's", "12.5", " ", "\n\n", "zz!!", "日本"]
    text = " ".join(rnd.choices(words, k=rnd.choice([0, 1, 5, 900]))).encode()
    tree = edits.CountTree(text, ENCODER)
    for _ in range(40):
        place, removed, added = rnd.randint(0, len(text) + 3), rnd.choice([0, 1, 5, 300]), rnd.choice(["", " ", "new", "two words ", "\n"]).encode()
        tree.edit(place, removed, added)
        place = min(place, len(text))
        text = text[:place] + added + text[place + removed :]
        assert tree.text() == text and tree.bytes == len(text)
        # bytes may cut a character; a decoder puts one sign for it, here and in the library alike
        if text.decode("utf-8", "ignore").encode() == text:
            assert tree.tokens == len(library(text.decode()))


def test_an_edit_encodes_little_again():
    tree = edits.CountTree(b"some words " * 20_000, ENCODER)
    for place in (0, 100_000, 219_000):
        tree.edit(place, 3, b"other")
    assert tree.encoded < 15


def test_edited_counts(spark):
    from pyspark.sql import functions as F

    one = F.expr("IF(doc_id = 1, array(named_struct('place', 4L, 'removed', 4L, 'added', CAST('other' AS BINARY)), NULL,"
                 " named_struct('place', NULL, 'removed', 1L, 'added', CAST('' AS BINARY))), NULL)")
    got = {r.doc_id: r for r in edits.edited_counts(documents(spark), one.cast(edits.EDITS), PATH).collect()}
    assert (got[1].n_tokens, got[1].n_tokens_edited, got[1].n_edits) == (len(library(ROWS[0][1])), len(library("The other text, in two rows.")), 1)
    for doc_id, text, *_ in ROWS[1:]:
        assert (got[doc_id].n_tokens, got[doc_id].n_tokens_edited, got[doc_id].n_edits) == (len(library(text)), len(library(text)), 0)
    assert edits.edited_counts(documents(spark, []), one.cast(edits.EDITS), PATH).count() == 0


def test_private_data_is_taken_out(spark):
    text = "Mail a.b@c.example.com or +1 (499) 555-6503; token = \"abc\" card 4349 0004 9098 6231."
    out = text.encode()
    for place, removed, added in edits.redactions(out):
        out = out[:place] + added + out[place + removed :]
    assert out.decode() == "Mail [email] or [phone]; [secret] card [number]." and edits.redactions(b"") == []
    docs = documents(spark, [(1, text, "en", "a"), (2, None, None, None)])
    got = {r.doc_id: r for r in edits.edited_counts(docs, edits.redactions, PATH).collect()}
    assert (got[1].n_edits, got[1].n_tokens_edited) == (4, len(library(out.decode()))) and got[2].n_tokens == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=900).map(sorted) | st.lists(st.integers(0, 40), max_size=900).map(sorted), st.data())
def test_batch_select_reads_any_range(values, data):
    sequence = fano.EliasFano.of(np.array(values, np.uint64))
    first = data.draw(st.integers(0, len(values)))
    last = data.draw(st.integers(first, len(values)))
    assert sequence.selected(first, last).tolist() == values[first:last]


def test_token_files_are_read_by_select(spark, tmp_path, monkeypatch):
    """The reader never decodes a whole sequence."""
    ids, ends = [None, None, *range(5, 700)], np.arange(1, 698) * 3
    block = fano._block(0, 0, ids, np.diff(ends, prepend=0), np.zeros(697 * 3, "<u2"))
    monkeypatch.setattr(fano, "RUN", 100)
    monkeypatch.setattr(fano.EliasFano, "values", None)
    batch = fano.pa.RecordBatch.from_arrays([fano.pa.array([block], fano.pa.binary())], ["content"])
    rows = [row for part in fano._documents([batch]) for row in part.to_pylist()]
    assert [r["doc_id"] for r in rows] == ids and [r["start"] for r in rows] == (ends - 3).tolist() and {r["n_tokens"] for r in rows} == {3}


def test_every_document_has_a_tree_and_a_second_call_starts_from_its_leaves(spark, monkeypatch):
    docs = documents(spark)
    once = edits.edited_counts(docs, lambda text: [(0, 0, b"New words. ")], PATH, keep=True)
    again = edits.edited_counts(once, lambda text: [(4, 5, b"parts")], PATH, text="utf8", leaves="leaves").collect()
    want = sorted((len(library("New words. " + (t or ""))), len(library("New parts. " + (t or "")))) for _, t, *_ in ROWS)
    assert sorted((r.n_tokens, r.n_tokens_edited) for r in again) == want
    kept = once.collect()
    assert all(len(r.leaves) == len(edits._LEAF.findall(bytes(r.utf8))) and sum(r.leaves) == r.n_tokens_edited for r in kept)

    class Counting:
        """Encodes nothing but what an edit touches."""

        words = 0

        def word_counts(self, words):
            self.words += len(words)
            return ENCODER.word_counts(words)

    counting = Counting()
    text, tokens = bytes(kept[0].utf8), list(kept[0].leaves)
    tree = edits.CountTree(text, counting, tokens)
    assert tree.tokens == sum(tokens) and counting.words == 0
    tree.edit(4, 5, b"parts")
    assert 0 < counting.words <= 4


def test_cores_outlast_the_table_of_words():
    kept = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 8)
    first = [ids.tolist() for ids in kept.encode([b"alpha Alpha ALPHA alpha. Alpha. ALPHA. alpha, Alpha, ALPHA,"])]
    kept.encode([b"beta"])  # the words start anew
    assert b"alpha" in kept._parts and len(kept._rows) == 1  # it was forgotten with them before
    assert [ids.tolist() for ids in kept.encode([b"alpha Alpha ALPHA alpha. Alpha. ALPHA. alpha, Alpha, ALPHA,"])] == first
