"""Toxicity by weak supervision.

Many voters judge a text: lexicons and word-beginning patterns mined from labelled rows, style
patterns, and the label of a labelled row itself. A generative label model estimates by
expectation maximisation how each voter votes for toxic and for clean texts, and how far
voters err together; correlated voters count for less. Its posterior is the label from which a
linear classifier learns, over the shares of mined words and beginnings in a text and the
voters' votes. A quarter of the sample is kept back to calibrate the classifier's score.

Voters, label model and classifier are fitted on a bounded sample of labelled rows, drawn per
class by hash of the id and weighted back to the classes' true sizes.

Defined results: null, empty and wordless texts get the score of a text without any known
word; without labels of both classes every score is the share of toxic labels, or 0; a row
labelled twice counts as toxic if any of its labels is; null ids are scored but never learned
from; an empty table gives an empty result; other columns are ignored, or kept by
``drop_toxic``.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import sampled, settled, text_of, worker_state

#: Bound of the training sample: rows per class.
ROWS_PER_CLASS = 3000
#: Lengths of word beginnings.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Mined tokens per kind, the least log-likelihood ratio of one, and voters per kind.
MINED = 400
LEAST_RATIO = 10.0
LEXICONS, PATTERNS = 8, 6
ROUNDS = 40
#: Steps of the classifier's training, their size, and the weight of its ridge penalty.
STEPS, RATE, RIDGE = 400, 0.1, 1.0
#: A score from here on is toxic.
THRESHOLD = 0.3
#: Words whose tokens a worker keeps.
KEPT_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SCALE = 100.0  # word shares in percent

ABSTAIN, CLEAN, TOXIC = 0, 1, 2
SIGN = (0.0, -1.0, 1.0)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in BEGINNINGS if n < len(word)]


# --- voters ------------------------------------------------------------------------------


class Voters:
    """Mined words and beginnings, each dealt to a lexicon or pattern voter, and style voters."""

    def __init__(self, words: list[str], starts: list[str]) -> None:
        self.words = {word: k for k, word in enumerate(words)}
        self.starts = {start: len(words) + k for k, start in enumerate(starts)}
        self.tokens = len(words) + len(starts)
        self.name = uuid.uuid4().hex
        self.kept: dict[str, tuple[int, ...]] = {}

    @contextmanager
    def keeping(self):
        """In a task: words seen are kept in the worker's state, not in the shared object."""
        self.kept = worker_state(("toxicity", self.name), dict)
        try:
            yield
        finally:
            self.kept = {}

    def tokens_of(self, word: str) -> tuple[int, ...]:
        """Numbers of the mined tokens in a word."""
        found = self.kept.get(word)
        if found is None:
            if len(self.kept) > KEPT_WORDS:
                self.kept.clear()
            own = (self.words[word],) if word in self.words else ()
            found = self.kept[word] = own + tuple(self.starts[b] for b in beginnings(word) if b in self.starts)
        return found

    def observe(self, text: str) -> tuple[list[int], Counter, int]:
        """(votes, mined tokens, words): lexicons, patterns, absence of both, style."""
        words = words_of(text)
        n, of = max(1, len(words)), self.tokens_of
        tokens = Counter(token for word in words for token in of(word))
        said, begun = [0] * LEXICONS, [0] * PATTERNS
        for token, times in tokens.items():
            if token < len(self.words):
                said[token % LEXICONS] += times
            else:
                begun[(token - len(self.words)) % PATTERNS] += times
        letters = sum(map(len, words)) or 1
        upper = len(UPPER.findall(text))
        style = [
            TOXIC if upper > 0.5 * letters else ABSTAIN,
            TOXIC if text.count("!!") * 50 > n else ABSTAIN,
            CLEAN if len(set(words)) > 0.9 * n else ABSTAIN,
        ]
        votes = [
            *(TOXIC if x * 500 >= n else ABSTAIN for x in said), *(TOXIC if x * 100 >= n else ABSTAIN for x in begun),
            ABSTAIN if any(said) else CLEAN, ABSTAIN if any(begun) else CLEAN, *style,
        ]
        return votes, tokens, n


VOTES = LEXICONS + PATTERNS + 5


# --- label model -------------------------------------------------------------------------


@dataclass
class LabelModel:
    table: np.ndarray  # [voter, vote, class]: probability of the vote
    share: np.ndarray  # [voter]: what a correlated voter counts for
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        gain = np.log(self.table[:, :, 1] / self.table[:, :, 0])
        voter = np.arange(votes.shape[1])
        logit = math.log(self.prior / (1 - self.prior)) + (gain[voter, votes] * self.share).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_label_model(votes: np.ndarray, start: np.ndarray, prior: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over votes in {ABSTAIN, CLEAN, TOXIC}.

    After each round the voters' errors, what of a vote its class doesn't explain, are
    correlated; a voter's share falls with the sum of its correlations with others.
    """
    q = np.clip(start, 0.05, 0.95)
    one_hot = np.eye(3)[votes]  # [row, voter, vote]
    model = None
    for _ in range(rounds):
        table = np.empty((votes.shape[1], 3, 2))
        for y, weight in ((0, 1 - q), (1, q)):
            table[:, :, y] = (np.einsum("r,rvk->vk", weight, one_hot) + 0.5) / (weight.sum() + 1.5)
        expected = (table[None, :, TOXIC, 0] - table[None, :, CLEAN, 0]) * (1 - q)[:, None] + (
            table[None, :, TOXIC, 1] - table[None, :, CLEAN, 1]) * q[:, None]
        error = one_hot[:, :, TOXIC] - one_hot[:, :, CLEAN] - expected
        error -= error.mean(axis=0)
        spread = np.sqrt((error**2).mean(axis=0)) + 1e-9
        correlation = np.abs((error.T @ error) / len(error) / np.outer(spread, spread))
        np.fill_diagonal(correlation, 0)
        share = 1 / (1 + np.where(correlation > 0.1, correlation, 0).sum(axis=1))
        model = LabelModel(table, share, prior)
        new = model.posterior(votes)
        if np.abs(new - q).max() < 1e-4:
            break
        q = new
    return model


# --- classifier --------------------------------------------------------------------------


@dataclass
class Model:
    voters: Voters | None
    weights: np.ndarray | None  # per mined token, then per vote
    bias: float

    def task(self):
        return self.voters.keeping() if self.voters else nullcontext()

    def score(self, text: str | None) -> float:
        logit = self.bias
        if self.voters:
            votes, tokens, n = self.voters.observe(text or "")
            weights = self.weights
            logit += sum(float(weights[self.voters.tokens + v]) * SIGN[vote] for v, vote in enumerate(votes) if vote)
            logit += sum(SCALE / n * times * float(weights[token]) for token, times in tokens.items())
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, logit))))


def train(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression on soft targets, by full gradient steps with Adam's step sizes."""
    w = np.zeros(x.shape[1] + 1)
    x = np.column_stack([x, np.ones(len(x))])
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - target)
        gradient[:-1] += RIDGE * w[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        w -= RATE * (1 - step / (STEPS + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def calibrated(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logits that fit the labels, by Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -40, 40)))
        g, h = weight * (p - label), weight * p * (1 - p)
        gradient = np.array([(g * logit).sum() + 0.1 * (a - 1), g.sum() + 0.1 * b])
        hessian = np.array([[(h * logit * logit).sum() + 0.1, (h * logit).sum()], [(h * logit).sum(), h.sum() + 0.1]])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
        a, b = max(0.05, a - step[0]), b - step[1]
    return a, b


# --- on Spark ----------------------------------------------------------------------------


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, token, toxic) once per text that has the token."""
    for batch in batches:
        kinds, tokens, toxic = [], [], []
        for y, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = set(words_of(text))
            found = [("word", w) for w in words] + [("beginning", b) for b in {b for w in words for b in beginnings(w)}]
            kinds += [k for k, _ in found]
            tokens += [t for _, t in found]
            toxic += [y] * len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(tokens, pa.string()), pa.array(toxic, pa.int32())], ["kind", "token", "toxic"])


def mine(sample: DataFrame, toxic: int, clean: int) -> Voters:
    """Voters over the tokens that most favour toxic texts of the sample, at most MINED per kind."""
    counted = sample.mapInArrow(_tokens, "kind string, token string, toxic int").groupBy("kind", "token").agg(
        F.sum("toxic").cast("int").alias("t"), F.count("*").cast("int").alias("n"))
    t, c, both = F.col("t"), F.col("n") - F.col("t"), toxic + clean
    term = lambda seen, size: F.when(seen > 0, 2 * seen * F.log(seen * both / (F.lit(size) * F.col("n")))).otherwise(0.0)
    scored = counted.where("t >= 2").where(t * clean > c * toxic).withColumn("ratio", term(t, toxic) + term(c, clean))
    scored = settled(scored.where(F.col("ratio") >= LEAST_RATIO))
    words, starts = (
        [r["token"] for r in scored.where(F.col("kind") == kind).orderBy(F.desc("ratio"), "token").limit(MINED).collect()]
        for kind in ("word", "beginning"))
    return Voters(words, starts)


def _observed(voters: Voters):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with voters.keeping():
            for batch in batches:
                seen = [voters.observe(text) for text in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([votes for votes, _, _ in seen], pa.list_(pa.int32())),
                     pa.array([list(tokens) for _, tokens, _ in seen], pa.list_(pa.int32())),
                     pa.array([[SCALE * times / n for times in tokens.values()] for _, tokens, n in seen], pa.list_(pa.float64()))],
                    ["hash", "toxic", "votes", "tokens", "shares"])

    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = ROWS_PER_CLASS) -> Model:
    """Model from at most ``per_class`` labelled rows of each class, where ``learn`` holds on labels."""
    named = labels.where(learn).select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    label = named.groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    present = label.join(texts.select("id").where("id IS NOT NULL"), "id", "left_semi")
    chosen = settled(sampled(present.withColumnRenamed("toxic", "label"), per_class).withColumnRenamed("label", "toxic"))
    sizes = {r["toxic"]: r["count"] for r in present.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(None, None, 40.0 if toxic else -40.0)
    sample = settled(
        texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
        .select(F.xxhash64("id").alias("hash"), "toxic", "text"))
    drawn = {1: min(toxic, per_class), 0: min(clean, per_class)}
    voters = mine(sample, drawn[1], drawn[0])
    found = sample.mapInArrow(
        _observed(voters), "hash long, toxic int, votes array<int>, tokens array<int>, shares array<double>").toArrow()
    # By hash, so that the model doesn't depend on how rows were dealt out.
    found = found.sort_by([("hash", "ascending")])
    label = found.column("toxic").to_numpy()
    votes = np.array(found.column("votes").to_pylist(), np.int64).reshape(len(label), VOTES)
    x = np.zeros((len(label), voters.tokens + VOTES))
    for k, (at, share) in enumerate(zip(found.column("tokens").to_pylist(), found.column("shares").to_pylist())):
        x[k, at] = share
    x[:, voters.tokens:] = np.array(SIGN)[votes]
    judged = np.column_stack([votes, np.where(label == 1, TOXIC, CLEAN)])
    model = fit_label_model(judged, np.where(label == 1, 0.9, 0.1), drawn[1] / (drawn[0] + drawn[1]))
    posterior = model.posterior(judged)
    weight = np.where(label == 1, toxic / drawn[1], clean / drawn[0])
    held = np.arange(len(label)) % 4 == 0
    weights, bias = train(x[~held], posterior[~held])
    check = held if 0 < label[held].sum() < held.sum() else np.ones(len(label), bool)
    a, b = calibrated(x[check] @ weights + bias, label[check].astype(float), weight[check] * check.sum() / weight[check].sum())
    return Model(voters, a * weights, float(a * bias + b))


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row."""
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with shared.value.task():
            for batch in batches:
                scores = [shared.value.score(text.as_py()) for text in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, with their columns; nothing is exchanged."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with shared.value.task():
            for batch in batches:
                yield batch.filter(pa.array([shared.value.score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
