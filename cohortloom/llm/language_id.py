"""Language identification by averaged hashed subword embeddings.

A text is its letters in lower case, with everything else as single spaces. Its n-grams of one
to four characters hash to rows of an embedding table; their average goes through a linear
softmax. Table and softmax are trained together by stochastic gradient descent in numpy on a
bounded sample of labelled rows, whose n-grams are counted on the executors. A quarter of the
sample is kept back to set the softmax temperature and the score below which a prediction is
rejected. Since the model is linear in the averaged embeddings, table and softmax are
multiplied out to one weight per n-gram row and language before scoring.

Defined results: a text that is null or has no letter is ``und`` with score 0, not accepted; so
is every text when no row is labelled; equal scores give the label that sorts first; null ids
are scored but never learned from; repeated ids count once in the sample; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import sampled, text_of, worker_state

BUCKET_BITS = 14
NGRAMS = 4
DIMENSIONS = 16
EPOCHS = 12
RATE = 0.5
SEED = 7
#: Bound of the training sample: labelled rows per language, by hash of their id.
ROWS_PER_LABEL = 400
#: Accepted predictions of the rows kept back are wrong at most this often.
ACCEPTED_ERROR = 0.005
#: Characters hashed at a time.
CHUNK_CHARS = 1 << 19
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter or a mark."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), np.bool_, 0x110000)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Rows of the text's n-grams, a stretch of the text at a time."""
    letters = _letters()
    for at in range(0, len(text), CHUNK_CHARS):
        chars = text[at:at + CHUNK_CHARS].lower()
        codes = np.frombuffer(f" {chars} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(letters[codes], codes, np.uint32(32))
        space = codes == 32
        codes = codes[np.concatenate(([True], ~(space[1:] & space[:-1])))]
        grams = np.zeros(len(codes), np.uint32)
        for n in range(NGRAMS):
            if n >= len(codes):
                break
            grams = (grams[: len(codes) - n] ^ codes[n:]) * np.uint32(0x01000193) + np.uint32(n + 1)
            yield (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def counts_of(text: str) -> np.ndarray:
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for rows in buckets(text):
        counts += np.bincount(rows, minlength=len(counts))
    return counts


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # one row per n-gram row, one column per label
    bias: np.ndarray
    temperature: float
    accept: float  # lowest accepted score

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.labels or not text or not LETTER.search(text):
            return UNDETERMINED, 0.0, False
        logits, total = np.zeros(len(self.labels)), 0
        for rows in buckets(text):
            if 4 * len(rows) > self.weights.shape[0]:
                logits += np.bincount(rows, minlength=self.weights.shape[0]) @ self.weights
            else:
                logits += self.weights[rows].sum(axis=0)
            total += len(rows)
        share = softmax((logits / total + self.bias) / self.temperature)
        best = int(share.argmax())
        score = min(1.0, max(0.0, float(share[best])))
        return self.labels[best], score, score >= self.accept


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(sample: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Model from (label, n-gram rows, counts) of the sampled texts."""
    labels = sorted({label for label, _, _ in sample})
    size, k = 1 << BUCKET_BITS, len(labels)
    if not labels:
        return Model([], np.zeros((size, 0)), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 1 / DIMENSIONS, (size, DIMENSIONS))
    out, bias = np.zeros((DIMENSIONS, k)), np.zeros(k)
    order = rng.permutation(len(sample))
    held = order[: len(sample) // 4] if len(sample) >= 4 * k else order
    learned = order[len(sample) // 4:] if len(sample) >= 4 * k else order
    shares = [counts / counts.sum() for _, _, counts in sample]
    steps, step = EPOCHS * len(learned), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learned):
            label, rows, _ = sample[i]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = shares[i] @ table[rows]
            error = softmax(mean @ out + bias)
            error[labels.index(label)] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= 0.01 * rate * error
            # Rows are averaged, so a step is scaled to the number of rows it is shared by.
            table[rows] -= rate * np.outer(shares[i] * len(rows) ** 0.5, back)
    weights = table @ out
    logits = np.array([shares[i] @ weights[sample[i][1]] + bias for i in held])
    truth = np.array([labels.index(sample[i][0]) for i in held])

    def loss(temperature: float) -> float:
        p = softmax(logits / temperature)[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    temperature = min(np.geomspace(0.5, 20, 91), key=loss)
    share = softmax(logits / temperature)
    score, right = share.max(axis=1), share.argmax(axis=1) == truth
    falling = np.argsort(-score, kind="stable")
    wrong = np.cumsum(~right[falling]) / np.arange(1, len(falling) + 1)
    good = np.nonzero(wrong <= ACCEPTED_ERROR)[0]
    accept = float(score[falling[good[-1]]]) if len(good) else 1.0
    return Model(labels, weights, bias, float(temperature), accept)


# --- on Spark ----------------------------------------------------------------------------


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text and LETTER.search(text):
                counts = counts_of(text)
                rows = np.nonzero(counts)[0]
                kept.append((label, rows.astype(np.int32), counts[rows]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in kept], pa.string()), pa.array([k[1] for k in kept], pa.list_(pa.int32())),
             pa.array([k[2] for k in kept], pa.list_(pa.int64()))], ["label", "rows", "counts"])


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        per_label: int = ROWS_PER_LABEL) -> Model:
    """Model from at most ``per_label`` labelled rows of each label, where ``learn`` holds.

    Only ids and labels are ranked; then the texts of the chosen ids are read, and just n-gram
    counts, bounded by the table's rows per text, reach the driver.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"), learn.alias("learn"))
    able = named.where("learn AND label IS NOT NULL AND id IS NOT NULL")
    chosen = sampled(able.select("id", "label"), per_label).select("id").distinct()
    texts = able.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct("label", "text")).alias("row"))
    found = texts.select("row.label", "row.text").mapInArrow(_count, "label string, rows array<int>, counts array<long>").toArrow()
    sample = [
        (label.as_py(), rows.values.to_numpy(), counts.values.to_numpy())
        for label, rows, counts in zip(*(found.column(c) for c in ("label", "rows", "counts")))
    ]
    return train(sorted(sample, key=lambda s: (s[0], len(s[1]), s[1].tobytes(), s[2].tobytes())))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) per row."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed rows, a column per label

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language_id", dict)
        for batch in batches:
            rows = [shared.value.predict(text.as_py()) for text in batch.column(1)]
            langs, scores, accepted = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                ["id", "lang_pred", "score", "accepted"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(predict, f"id {kind}, lang_pred string, score double, accepted boolean").withColumnRenamed("id", id_col)
