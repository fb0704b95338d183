import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm.queries import QUERIES
from cohortloom.llm.token_counts import Counter, count_tokens
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(PATH)


def test_query_against_library(spark, model):
    got = {r["doc_id"]: r for r in QUERIES["op13_token_counts"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        text, found = row["text"] or "", got[row["doc_id"]]
        n = len(model.encode(text))
        assert (found["n_bytes"], found["n_tokens"], found["over_limit"]) == (len(text.encode()), n, n > 4096)


PARTS = [" ", "  ", "   ", "\n", "\t", "a", "ab", "the", "The ", "é", "é", "▁", "　", "中文", "日", "ሀ", "1234", "<s>",
         "</s>", "<unk>", "<0x0A>", "🙂", "-", "...", "в", "привет", "\x00", "​", "oooooo", "    x"]


def test_cuts_change_no_count(model, counter):
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 60)))
        assert counter.counts([text], rng.choice([1, 2, 5, 20]), 40) == [len(model.encode(text))], repr(text)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(max_size=60), max_size=6), st.integers(1, 9))
def test_any_text(texts, size):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    own = Counter(PATH) if not hasattr(test_any_text, "own") else test_any_text.own
    test_any_text.own = own
    assert own.counts(texts, size, 30) == [len(own.model.encode(t)) for t in texts]


def test_long_texts_are_cut(model, counter):
    line = "One long line of words without any break, "
    for text in (line * 20_000, "中" * 300_000, "a" * 300_000, "x\n" * 100_000):
        assert counter.counts([text], 500, 1 << 20) == [len(model.encode(text))]
    assert max(len(p) for p, _ in counter.pieces(line * 20_000, 500)) < 600
    assert max(len(p) for p, _ in counter.pieces("中" * 300_000, 500)) < 600


def test_odd_rows(docs_of, model):
    got = count_tokens(docs_of(ODD), PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = sorted((i or -1, len((t or "").encode()), len(model.encode(t or ""))) for i, t in ODD)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got.collect()) == expected


def test_empty_table(docs_of):
    assert count_tokens(docs_of([]), PATH).collect() == []


def test_limit_is_exclusive(docs_of, model):
    n = len(model.encode("some words here"))
    docs = docs_of([(1, "some words here")])
    assert [count_tokens(docs, PATH, limit=k).first()["over_limit"] for k in (n, n - 1)] == [False, True]


def test_plan_has_no_exchange(docs_of):
    plan = count_tokens(docs_of([(1, "a")]), PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
