import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import byte_bpe as b
from tests.llm.conftest import ODD

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=b.read_ranks(PATH), special_tokens={})


def odd_texts():
    rng = random.Random(3)
    pick = lambda s, n: "".join(rng.choice(s) for _ in range(n))
    return [
        "", "a" * 3001, " " * 777 + "x", "ab" * 500, pick("abcdefgh", 1500), pick([chr(c) for c in range(0x3B1, 0x3C9)], 400),
        pick([chr(c) for c in range(0x600, 0x6FF)], 800), "!?" * 300, "\n\n\n  \t x\r\n", "<|endoftext|>", "the" * 200,
        "aaaaaaab" * 40, "日本語テスト" * 30, "don't I'M we'll 12345 x²", "\u0000\u0001", "😀👍🏽" * 9,
    ]


def test_encode_and_decode(theirs):
    own, texts = b.engine(PATH, PATTERN), odd_texts()
    ids = [np.frombuffer(x, "<i4").tolist() for x in own.encode(texts)]
    assert ids == [theirs.encode_ordinary(t) for t in texts]
    assert own.decode(np.array(sum(ids, []), np.int32), np.cumsum([len(x) for x in ids])) == [t.encode() for t in texts]


def test_short_and_long_queries_agree():
    own = b.engine(PATH, PATTERN)
    words = [w.encode() for w in ("thwhesou", "ciónmente", "aaaaaaa", "abababab", "Ǆungla", "xx", "ꙮꙮꙮ")]
    assert own.contracted(words, b.SHORT_WORDS) == own.contracted(words, b.LONG_WORDS)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(texts):
    own = b.engine(PATH, PATTERN)
    ids = [np.frombuffer(x, "<i4") for x in own.encode(texts)]
    whole = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    assert [x.tolist() for x in ids] == [whole.encode_ordinary(t) for t in texts]
    flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
    assert own.decode(flat, np.cumsum([len(x) for x in ids], dtype=np.int64)) == [t.encode() for t in texts]


def test_long_words(theirs, monkeypatch):
    rng = random.Random(5)
    own = b.Engine(PATH, PATTERN)
    monkeypatch.setattr(b, "LONG_ROUNDS", 3)  # several queries for one word
    texts = [
        "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(5000)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4000)),
        "thanthing" * 60, "a" * 5000, "e" * 65, "".join(rng.choice("abcé日ßü") for _ in range(900)),
    ]
    assert [np.frombuffer(x, "<i4").tolist() for x in own.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]
    for text in texts:
        data = text.encode()
        parts = own.pieces(data)
        assert b"".join(parts) == data and all(parts)


@pytest.mark.parametrize("text", ["a" * 1_000_000, "ab" * 100_000, "the" * 60_000])
def test_long_words_take_linear_time(text):
    own = b.engine(PATH, PATTERN)
    began = time.process_time()
    ids = np.frombuffer(own.encode([text])[0], "<i4")
    assert time.process_time() - began < 30
    assert own.decode(ids, np.array([len(ids)])) == [text.encode()]


def test_occurrences_stop_at_a_smaller_rank(theirs):
    own, rng = b.engine(PATH, PATTERN), random.Random(7)
    for letters in ("ab", "theab", "aes", "xyab", "ei日"):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 300))) for _ in range(60)]
        got = own.contracted([w.encode() for w in words], b.LONG_WORDS)
        whole = [np.frombuffer(x, "<i4").tolist() for x in got]
        assert whole == [theirs._encode_single_piece(w) for w in words]


def test_generations_keep_results(monkeypatch, theirs):
    own = b.Engine(PATH, PATTERN)
    monkeypatch.setattr(b, "KEPT_WORDS", 8)
    for k in range(6):
        texts = [f"word{k} again other{k % 2} thewhole"]
        assert np.frombuffer(own.encode(texts)[0], "<i4").tolist() == theirs.encode_ordinary(texts[0])


def test_table(docs_of, theirs):
    encoded = b.encode(docs_of(ODD), PATH, PATTERN)
    decoded = b.decode(encoded, PATH, PATTERN)
    rows, back = encoded.collect(), decoded.collect()
    want = sorted((repr(i), ",".join(map(str, theirs.encode_ordinary(t or "")))) for i, t in ODD)
    assert sorted((repr(r["doc_id"]), ",".join(map(str, r["ids"]))) for r in rows) == want
    assert all(hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest() == r["ids_sha256"] for r in rows)
    assert sorted((repr(r["doc_id"]), bytes(r["decoded"])) for r in back) == sorted((repr(i), (t or "").encode()) for i, t in ODD)
    digest = lambda data: hashlib.sha256(data).hexdigest()
    whole = b.round_trip(docs_of(ODD), PATH, PATTERN).collect()
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in whole) == sorted(
        (repr(i), len(theirs.encode_ordinary(t or "")), digest(",".join(map(str, theirs.encode_ordinary(t or ""))).encode()), digest((t or "").encode()))
        for i, t in ODD)
    assert b.round_trip(docs_of([]), PATH, PATTERN).count() == 0
    assert b.decode(b.encode(docs_of([]), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_ascii_texts_have_the_same_words():
    own, rng = b.engine(PATH, PATTERN), random.Random(11)
    for _ in range(2000):
        text = "".join(chr(rng.randrange(128)) for _ in range(rng.randint(0, 40)))
        assert own.words(text) == own.pattern.findall(text), repr(text)
    assert b.ascii_pattern(r"\p{Lu}+|x") is None


def test_unknown_and_null_ids(spark):
    good = spark.createDataFrame([(1, [1, 2]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [len(r["decoded"]) > 0 for r in b.decode(good, PATH, PATTERN).orderBy("doc_id").collect()] == [True, False, False]
    for ids in ([10**6], [1, None]):
        bad = spark.createDataFrame([(1, ids)], "doc_id long, ids array<int>")
        with pytest.raises(Exception, match="not in the vocabulary|null"):
            b.decode(bad, PATH, PATTERN).collect()
