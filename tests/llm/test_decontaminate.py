import math
from collections import Counter

import numpy as np
import pytest

from cohortloom.llm import decontaminate as d
from cohortloom.llm.common import documents
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"
ITEM = ("The quick brown fox jumps over a lazy dog near the river bank. It then rests under an old oak tree until dusk.\n"
        "Which animal was lazy after all these events happened?")


def bm25(items, words):
    """Score of every item for a set of words, by the formula alone."""
    parsed = [d.words_of(t) for t in items]
    n, mean = len(parsed), sum(map(len, parsed)) / len(parsed)
    df = Counter(w for p in parsed for w in set(p))
    out = []
    for p in parsed:
        tf = Counter(p)
        score = lambda some: sum(
            math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * (d.K1 + 1) / (tf[w] + d.K1 * (1 - d.B + d.B * len(p) / mean)) for w in some if w in tf)
        out.append(score(words) / score(set(p)))
    return out


@pytest.mark.parametrize("block", [1, 4, 16])
def test_wand_finds_what_an_exhaustive_search_finds(spark, block):
    items = [(r["item_id"], r["text"]) for r in documents(spark, SF, "benchmark").collect()]
    index = d.build_index(items, block)
    texts = {i: t for i, t in items}
    found = 0
    for row in documents(spark, SF).limit(60).collect():
        words = d.words_of(row["text"])
        terms = np.array([index.terms.get(w, -1) for w in words], np.int64)
        starts, ends = d.windows(len(words), index.longest)
        got = {(p, index.items[k]): s for p, k, s in d.candidates(index, terms, starts, ends, 0.4, block)}
        for p, (a, b) in enumerate(zip(starts, ends)):
            for (item, _), score in zip(items, bm25([texts[i] for i, _ in items], set(words[a:b]))):
                if abs(score - 0.4) > 1e-6:
                    assert (score > 0.4) == ((p, item) in got)
                    if score > 0.4:
                        assert abs(got[p, item] - score) < 1e-6
                        found += 1
    assert found


def test_every_run_of_words_is_in_a_window():
    for n in range(1, 80):
        for longest in (1, 5, 13):
            starts, ends = d.windows(n, longest)
            for at in range(max(1, n - longest + 1)):
                assert any(a <= at and min(at + longest, n) <= b for a, b in zip(starts, ends))


def test_planted_items(spark, docs_of):
    noise = " ".join(f"noise{k % 700}" for k in range(5000))
    edited = ITEM.replace("quick", "swift").replace("\n", "  ").upper()
    half = ITEM[: len(ITEM) // 2]
    pairs = [*ODD, (20, noise + " " + ITEM + " " + noise), (21, f"{noise[:3000]} {edited} {noise}"), (22, noise), (23, f"{noise} {half}"), (24, ITEM)]
    benchmark = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "another item about something else entirely, is it not so?"), (5, ITEM)], "item_id long, text string")
    for chunk in (1, 4000):
        rows = d.contaminated(docs_of(pairs), benchmark, chunk=chunk).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(20, 1), (20, 5), (21, 1), (21, 5), (24, 1), (24, 5)]
    docs = docs_of(pairs)
    clean = d.drop_contaminated(docs, benchmark)
    assert clean.schema == docs.schema and clean.count() == len(pairs) - 3


def test_question_and_answer():
    assert d.question_and_answer("Q: why? Answer: because") == (["q", "why"], ["because"])
    assert d.question_and_answer("First one. Second two.") == (["first", "one"], ["second", "two"])
    assert d.question_and_answer("only") == (["only"], [])


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert d.contaminated(docs_of(ODD), none).count() == 0 and d.contaminated(docs_of([]), one).count() == 0
    assert d.drop_contaminated(docs_of(ODD), none).count() == len(ODD)


def test_all_verbatim_items_are_found(spark):
    docs, benchmark = documents(spark, SF), documents(spark, SF, "benchmark")
    want = {(r["doc_id"], i["item_id"]) for i in benchmark.collect() for r in docs.collect() if i["text"] in r["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, benchmark).collect()}
    assert want and want <= got
