"""Benchmark decontamination: BM25 with block-max WAND, then overlap of question and answer.

The test items form an inverted index. An item's BM25 impacts are divided by the score it
would give itself, so one threshold means the same share of every item. Items are laid out in
blocks, and per term the index holds the largest impact of the whole list and of each block.
Every passage of every document is a query: passages whose summed list bounds stay below the
threshold are skipped, of the rest the blocks whose summed block bounds stay below it, and all
items of the remaining blocks are scored exactly. Items above the threshold are then verified
on the passage: shared five-word shingles, and words of the question and of the answer.

Passages are windows of twice the longest item's words at steps of that length, so any run of
words as long as an item lies within one. The benchmark is a stated query set: its items are
indexed in chunks of a fixed size, and each chunk meets all documents.

Defined results: null or wordless texts and items match nothing; an item of fewer than five
words is one shingle; repeated documents are reported each, repeated items under each id; an
empty table gives an empty result; other columns are ignored, or kept by ``drop_contaminated``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import settled, text_of, worker_state

K1, B = 1.2, 0.75
#: Share of an item's score against itself that a passage must reach to be verified.
SCORE_SHARE = 0.5
SHINGLE_WORDS = 5
#: Share of an item's shingles, and of its question's and its answer's words, in a passage.
OVERLAP = 0.8
#: Items in a block of the index, and items in an index.
BLOCK_ITEMS = 16
CHUNK_ITEMS = 4000
#: Passages handled and scored at a time, and words of text.
BATCH_PASSAGES = 4096
SCORED_PASSAGES = 256
GROUP_WORDS = 200_000

WORD = re.compile(r"[^\W_]+")
ANSWER = re.compile(r"\banswer\s*:", re.I)
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words before and after the mark ``answer:``, else of all but the last line, else sentence.

    A text of one sentence is all question; its answer is empty and counts as found.
    """
    mark = ANSWER.search(text)
    if mark:
        return words_of(text[:mark.start()]), words_of(text[mark.end():])
    parts = [p for p in text.strip().split("\n") if words_of(p)]
    if len(parts) < 2:
        parts = [p for p in SENTENCE_END.split(text.strip()) if words_of(p)]
    if len(parts) < 2:
        return words_of(text), []
    return words_of(" ".join(parts[:-1])), words_of(parts[-1])


def shingles(terms: list, size: int = SHINGLE_WORDS) -> set[tuple]:
    return {tuple(terms[k:k + size]) for k in range(max(1, len(terms) - size + 1))} if terms else set()


@dataclass
class Index:
    """Inverted index over items; impacts are shares of an item's score against itself."""

    terms: dict[str, int]
    items: list[int]
    longest: int
    offsets: np.ndarray  # postings of term t: offsets[t] to offsets[t + 1]
    posting_item: np.ndarray
    posting_impact: np.ndarray
    list_max: np.ndarray  # per term
    block_max: np.ndarray  # per term and block
    item_shingles: list[set[tuple]]
    questions: list[set[int]]
    answers: list[set[int]]


@dataclass
class Statistics:
    """Items with words and their mean length, and in how many of them a word occurs."""

    items: int
    mean: float
    frequency: dict[str, int]


def build_index(rows: list[tuple[int, str]], block_items: int = BLOCK_ITEMS, known: Statistics | None = None) -> Index | None:
    """Index of (item_id, text); items without words are left out.

    ``known`` are the statistics of all items where ``rows`` are a part of them.
    """
    parsed = sorted(((words_of(text), item, text) for item, text in rows), key=lambda x: (len(x[0]), x[1]))
    parsed = [x for x in parsed if x[0]]
    if not parsed:
        return None
    terms: dict[str, int] = {}
    for words, _, _ in parsed:
        for word in words:
            terms.setdefault(word, len(terms))
    counts = [Counter(terms[w] for w in words) for words, _, _ in parsed]
    if known is None:
        known = Statistics(len(parsed), sum(len(x[0]) for x in parsed) / len(parsed), Counter(w for words, _, _ in parsed for w in set(words)))
    n, mean = known.items, known.mean
    idf = {t: math.log(1 + (n - f + 0.5) / (f + 0.5)) for w, t in terms.items() for f in (known.frequency[w],)}
    postings: list[list[tuple[int, float]]] = [[] for _ in terms]
    for k, (words, _, _) in enumerate(parsed):
        norm = K1 * (1 - B + B * len(words) / mean)
        impact = {t: idf[t] * tf * (K1 + 1) / (tf + norm) for t, tf in counts[k].items()}
        whole = sum(impact.values())
        for t, x in impact.items():
            postings[t].append((k, x / whole))
    block_max = np.zeros((len(terms), -(-n // block_items)), np.float32)
    for t, found in enumerate(postings):
        for k, x in found:
            block_max[t, k // block_items] = max(block_max[t, k // block_items], x)
    pairs = [question_and_answer(text) for _, _, text in parsed]
    as_terms = lambda words: [terms[w] for w in words if w in terms]
    return Index(
        terms, [item for _, item, _ in parsed], max(len(x[0]) for x in parsed),
        np.concatenate(([0], np.cumsum([len(p) for p in postings]))),
        np.array([k for p in postings for k, _ in p], np.int64), np.array([x for p in postings for _, x in p]),
        block_max.max(axis=1).astype(np.float64), block_max + np.float32(1e-7) * (block_max > 0),
        [shingles(as_terms(words)) for words, _, _ in parsed],
        [set(as_terms(q)) for q, _ in pairs], [set(as_terms(a)) for _, a in pairs],
    )


def candidates(index: Index, terms: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               share: float = SCORE_SHARE, block_items: int = BLOCK_ITEMS) -> list[tuple[int, int, float]]:
    """(passage, item, score) of all items at or above ``share``.

    ``terms`` are the term numbers of a text, -1 for words the index lacks; passage k is
    terms[starts[k]:ends[k]].
    """
    bound = np.concatenate(([0.0], np.cumsum(np.where(terms >= 0, index.list_max[terms], 0.0))))
    live = np.nonzero(bound[ends] - bound[starts] >= share - 1e-6)[0]
    found = []
    for at in range(0, len(live), BATCH_PASSAGES):
        passages = live[at:at + BATCH_PASSAGES]
        owner, place = _spans(starts[passages], ends[passages])
        term = terms[place]
        known = term >= 0
        pair = np.unique(owner[known] * len(index.terms) + term[known])  # distinct terms of a passage
        owner, term = np.divmod(pair, len(index.terms))
        total = np.bincount(owner, index.list_max[term], len(passages))
        keep = total[owner] >= share - 1e-6
        owner, term = owner[keep], term[keep]
        if not len(owner):
            continue
        first = np.concatenate(([0], np.nonzero(np.diff(owner))[0] + 1))
        last = np.concatenate((first[1:], [len(owner)]))
        blocks = np.add.reduceat(index.block_max[term], first, axis=0) >= share - 1e-4
        rows = np.nonzero(blocks.any(axis=1))[0]
        for part in range(0, len(rows), SCORED_PASSAGES):
            some = rows[part:part + SCORED_PASSAGES]
            of_row, at_term = _spans(first[some], last[some])
            of_term, at_posting = _spans(index.offsets[term[at_term]], index.offsets[term[at_term] + 1])
            cell = of_row[of_term] * len(index.items) + index.posting_item[at_posting]
            score = np.bincount(cell, index.posting_impact[at_posting], len(some) * len(index.items)).reshape(len(some), -1)
            inside = np.repeat(blocks[some], block_items, axis=1)[:, : len(index.items)]
            for r, item in zip(*np.nonzero(inside & (score >= share))):
                found.append((int(passages[owner[first[some[r]]]]), int(item), float(score[r, item])))
    return found


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For spans of places: the span of each place, and the places."""
    width = ends - starts
    owner = np.repeat(np.arange(len(starts)), width)
    return owner, np.arange(len(owner)) + np.repeat(starts - np.cumsum(width) + width, width)


def windows(n: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, max(1, n - longest), longest)
    return starts, np.minimum(starts + 2 * longest, n)


def matches(index: Index, texts: Iterable[str], share: float = SCORE_SHARE, overlap: float = OVERLAP) -> Iterator[list[tuple]]:
    """Per text: (item number, score, shingle, question and answer overlap) of each verified item, once."""
    held: list[np.ndarray] = []
    for text in texts:
        words = words_of(text)
        held.append(np.fromiter(map(index.terms.get, words, repeat(-1)), np.int64, len(words)))
        if sum(map(len, held)) >= GROUP_WORDS or len(held) == 1000:
            yield from _group_matches(index, held, share, overlap)
            held = []
    yield from _group_matches(index, held, share, overlap)


def _group_matches(index: Index, texts: list[np.ndarray], share: float, overlap: float) -> list[list[tuple]]:
    best: list[dict[int, tuple]] = [{} for _ in texts]
    filled = [k for k, terms in enumerate(texts) if len(terms)]
    if not filled:
        return [[] for _ in texts]
    terms = np.concatenate(texts)
    begin = np.cumsum([0, *map(len, texts)])
    cut = [windows(len(texts[k]), index.longest) for k in filled]
    owner = np.repeat(filled, [len(a) for a, _ in cut])
    starts = np.concatenate([a for a, _ in cut]) + begin[owner]
    ends = np.concatenate([b for _, b in cut]) + begin[owner]
    for passage, item, score in candidates(index, terms, starts, ends, share):
        inside = terms[starts[passage]:ends[passage]].tolist()
        own, wanted = set(inside), index.item_shingles[item]
        size = len(next(iter(wanted)))
        shared = len(wanted & shingles(inside, size)) / len(wanted)
        of = lambda part: len(part & own) / len(part) if part else 1.0
        question, answer = of(index.questions[item]), of(index.answers[item])
        if min(shared, question, answer) >= overlap:
            found = best[owner[passage]]
            found[item] = max(found.get(item, (0.0,) * 4), (shared, question, answer, score))
    return [[(item, b[3], *b[:3]) for item, b in sorted(found.items())] for found in best]


# --- on Spark ----------------------------------------------------------------------------


def word_frequencies(benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, items, words): items that hold a word; the empty word counts all items with words, and their words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, lengths = [], []
            for text in batch.column(0):
                found = words_of(text.as_py())
                if found:
                    own = sorted(set(found))
                    words += ["", *own]
                    lengths += [len(found), *[0] * len(own)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(lengths, pa.int64())], ["word", "words"])

    found = benchmark.select(text_of(text_col).alias("text")).mapInArrow(run, "word string, words long")
    return settled(found.groupBy("word").agg(F.count("*").alias("items"), F.sum("words").alias("words")))


def indexes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", chunk: int = CHUNK_ITEMS) -> Iterator[Index]:
    """Indexes over chunks of the items, by id; only one chunk is on the driver at a time.

    Frequencies and mean length are those of all items, so an item scores the same in any chunk.
    """
    frequencies = word_frequencies(benchmark, text_col)
    whole = frequencies.where("word = ''").first()
    if whole is None:
        return

    def index_of(rows: list[tuple]) -> Index | None:
        words = sorted({w for _, text in rows for w in words_of(text)})
        wanted = frequencies.sparkSession.createDataFrame([(w,) for w in words], "word string")
        found = frequencies.join(wanted, "word", "left_semi").collect()  # no more than the chunk's words
        known = Statistics(whole["items"], whole["words"] / whole["items"], {r["word"]: r["items"] for r in found})
        return build_index(rows, known=known)

    rows = []
    for row in benchmark.select(F.col(item_col).alias("item"), text_of(text_col).alias("text")).sort("item", "text").toLocalIterator():
        rows.append((row[0], row[1]))
        if len(rows) == chunk:
            if index := index_of(rows):
                yield index
            rows = []
    if rows and (index := index_of(rows)):
        yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", chunk: int = CHUNK_ITEMS) -> DataFrame:
    """(id, item_id, score, overlap, question_overlap, answer_overlap) per document and item in it."""
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, score double, overlap double, question_overlap double, answer_overlap double"
    out = None
    for index in indexes(benchmark, item_col, text_col, chunk):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # one chunk of items

        def search(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            worker_state("decontaminate", dict)
            index = shared.value
            for batch in batches:
                texts = (text.as_py() for text in batch.column(1))
                rows = [(k, index.items[m[0]], *m[1:]) for k, found in enumerate(matches(index, texts)) for m in found]
                columns = list(zip(*rows)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], ITEM_TYPES.get(item_kind)),
                     *[pa.array(c, pa.float64()) for c in columns[2:]]],
                    ["id", "item", "score", "overlap", "question_overlap", "answer_overlap"])

        part = slim.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


ITEM_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      chunk: int = CHUNK_ITEMS) -> DataFrame:
    """The rows of ``docs`` without any verified item, with their columns; nothing is exchanged."""
    for index in indexes(benchmark, item_col, "text", chunk):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        at = docs.columns.index(text_col)

        def clean(batches: Iterable[pa.RecordBatch], shared=shared, at=at) -> Iterator[pa.RecordBatch]:
            worker_state("decontaminate", dict)
            for batch in batches:
                texts = (text.as_py() or "" for text in batch.column(at))
                yield batch.filter(pa.array([not found for found in matches(shared.value, texts)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
