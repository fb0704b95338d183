import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortloom.llm import token_files as t
from cohortloom.llm.common import documents
from cohortloom.session import shared_folder
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def theirs():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids + [2]


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(0, 40), max_size=300), st.integers(1, 50))
def test_round_trip(values, block):
    ids = np.array(values, np.uint32)
    names, lengths, back = t.unpack_segment(t.pack_segment([5, None], [len(ids), 0], ids, block))
    assert names == [5, None] and lengths.tolist() == [len(ids), 0] and back.tolist() == values


@pytest.mark.parametrize("ids", [
    np.random.default_rng(0).integers(0, 49408, 9000), np.full(9000, 7), np.arange(9000) % 1000, np.array([0, 2**32 - 1] * 4000),
    np.random.default_rng(1).zipf(1.3, 20000) % 49408,
])
def test_large_round_trip(ids):
    ids = ids.astype(np.uint32)
    data = t.pack_segment([1], [len(ids)], ids)
    assert (t.unpack_segment(data)[2] == ids).all()


def test_repetition_is_packed_well():
    ids = np.tile(np.random.default_rng(0).integers(0, 49408, 100), 200).astype(np.uint32)
    assert len(t.pack_segment([1], [len(ids)], ids)) < 0.35 * len(ids)


def test_damage_is_named():
    ids = np.random.default_rng(0).integers(0, 500, 3 * t.BLOCK_IDS).astype(np.uint32)
    data = bytearray(t.pack_segment([1], [len(ids)], ids))
    data[-40] ^= 255
    with pytest.raises(ValueError, match="block 2"):
        t.unpack_segment(bytes(data))
    with pytest.raises(ValueError, match="not a segment"):
        t.unpack_segment(b"other")
    data[len(t.MAGIC) + 30] ^= 255
    with pytest.raises(ValueError, match="directory"):
        t.unpack_segment(bytes(data))


def test_blocks_are_independent():
    ids = np.random.default_rng(2).zipf(1.2, 3 * t.BLOCK_IDS).astype(np.uint32) % 1000
    blocks = t.pack_blocks(ids)
    assert (t.unpack_blocks(blocks[1:2], t.BLOCK_IDS) == ids[t.BLOCK_IDS:2 * t.BLOCK_IDS]).all()


def test_words_against_the_library(theirs):
    own = t.Words(PATH)
    texts = [
        "", "  ", "The quick, brown fox. THE END!", "İstanbul ΑΣ. é é x́. ﬁ ß ①", "don't I'm x's. 'tis.' a.'s", "12ab34 ab.cd É.Ü!",
        "a\x1cb c\x85d e f g", "<|endoftext|> <|startoftext|>", "a" * 5000, "日本語 テスト。", "\u0000 �",
    ]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts, 2)] == [theirs(x) for x in texts]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(texts):
    own, tokenizer = t.words(PATH), t.words(PATH).tokenizer
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts, 2)] == [
        tokenizer.encode(x, add_special_tokens=False).ids + [2] for x in texts]


@pytest.mark.parametrize("segment_ids", [1, 50, t.SEGMENT_IDS])
def test_files(spark, docs_of, theirs, segment_ids):
    pairs = [*ODD, *[(100 + k, f"text number {k} " * (k % 9)) for k in range(80)]]
    folder = shared_folder(spark)
    t.write_ids(docs_of(pairs), folder, PATH, 2, segment_ids=segment_ids)
    rows = sorted(t.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    assert [r["doc_id"] for r in rows] == [i for i, _ in order]
    start = 0
    for r, (_, text) in zip(rows, order):
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert r["start"] == start and ids == theirs(text or "")
        start += len(ids)


def test_empty_table(spark, docs_of):
    folder = shared_folder(spark)
    t.write_ids(docs_of([]), folder, PATH, 2)
    assert t.read_ids(spark, folder).count() == 0


def test_query_checksums(spark, theirs):
    from cohortloom.llm.queries import op7_token_files

    texts = {r["doc_id"]: r["text"] for r in documents(spark, "/root/testdata/sf0.001").collect()}
    for r in op7_token_files(spark, "/root/testdata/sf0.001").collect():
        ids = theirs(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_strings_of_added_tokens(theirs):
    own = t.Words(PATH)
    for text in ("a <|endoftext|> b", "a<|endoftext|>b", "<|ENDOFTEXT|>", "<|endoftext|><|startoftext|>x", "don<|endoftext|>'t",
                 "é<|endoftext|>\u0301", "<|endoftext|", "\x1c<|startoftext|>\x1d y", "<|endoftext|>" * 50, "<|<|endoftext|>|>"):
        assert np.frombuffer(own.encode([text], 2)[0], "<u4").tolist() == theirs(text), text


class Counting:
    """A tokenizer that counts the words it is asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, 0

    def __getattr__(self, name):
        found = getattr(self.tokenizer, name)
        if not name.startswith("encode"):
            return found

        def counted(text, **options):
            self.words += sum(len(x.split()) for x in ([text] if isinstance(text, str) else text))
            return found(text, **options)

        return counted


def test_words_are_encoded_once_whatever_their_case_and_punctuation(theirs):
    own = t.Words(PATH)
    own.tokenizer = Counting(own.tokenizer)
    words = ["alpha", "beta", "größe", "été", "слово", "νερό"]
    texts = [f"{w} {w.title()}, {w.upper()}. ({w}" for w in words for _ in range(3)]
    first = own.encode(texts, 2)
    assert own.tokenizer.words <= 2 * len(words) + 3  # the word, "(" with it, and marks
    asked = own.tokenizer.words
    assert own.encode(texts, 2) == first and own.tokenizer.words == asked
    assert [np.frombuffer(x, "<u4").tolist() for x in first] == [theirs(x) for x in texts]


def test_kept_pieces_are_bounded(theirs, monkeypatch):
    monkeypatch.setattr(t, "KEPT_PIECES", 20)
    own = t.Words(PATH)
    for k in range(12):
        texts = [f"word{chr(97 + k)} Shared, a{k} {'x' * k}!"]
        assert np.frombuffer(own.encode(texts, 2)[0], "<u4").tolist() == theirs(texts[0])
        assert len(own.pieces) <= 30


def test_scripts_and_composition(theirs):
    own = t.Words(PATH)
    texts = ["한국어, 각 각!", "日本語。 ガ ｶﾞ", "Ǆ ǅ, ŉ. İi", "e\u0301, \u0301a. a\u0301b!", "ΟΔΟΣ, οδός.", "a² b½, Ⅷ.", "हिन्दी, ไทย!", "𝒜bc, 𐐀!"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts, 2)] == [theirs(x) for x in texts]


def test_texts_beyond_one_group(theirs, monkeypatch):
    monkeypatch.setattr(t, "TEXTS_BYTES", 30)
    batch = t.pa.RecordBatch.from_pydict({"id": t.pa.array(range(40)), "text": t.pa.array(["word " * (k % 13) for k in range(40)])})
    groups = list(t._grouped(batch))
    assert len(groups) > 5 and sum((g.column(0).to_pylist() for g in groups), []) == list(range(40))


def test_a_block_renews_its_probabilities_a_few_times(monkeypatch):
    renewed, renew = [], t.Model.renew
    monkeypatch.setattr(t.Model, "renew", lambda self: (renewed.append(self.lanes), renew(self))[1])
    ids = np.random.default_rng(3).zipf(1.2, 3 * t.BLOCK_IDS + 5).astype(np.uint32) % 3000
    blocks = t.pack_blocks(ids)
    assert (t.unpack_blocks(blocks, len(ids)) == ids).all()
    assert renewed == [4] * len(renewed) and len(renewed) <= 24


@pytest.mark.parametrize("block", [1, 2, 9, 1000, 5000, 20000])
def test_other_block_sizes(block):
    ids = np.random.default_rng(4).integers(0, 1 << 31, 12000).astype(np.uint32)
    ids[::3] = 7
    assert (t.unpack_segment(t.pack_segment([1], [len(ids)], ids[:12000], block))[2] == ids).all()


def test_any_damage_is_an_error():
    ids = np.random.default_rng(5).zipf(1.3, 9000).astype(np.uint32) % 2000
    whole = t.pack_segment([1], [len(ids)], ids)
    start = whole.index(t.pack_blocks(ids)[0][1])
    for at in range(start, start + 400, 40):
        data = bytearray(whole)
        data[at] ^= 90
        with pytest.raises(ValueError, match="block 0"):
            t.unpack_segment(bytes(data))
