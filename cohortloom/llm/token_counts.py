"""Token counts by a SentencePiece model: texts are encoded in batches, only lengths leave a task.

An Arrow function cuts the texts of a batch into pieces of about ``PIECE_CHARS`` characters at
safe boundaries, deals the pieces into batches of about ``BATCH_BYTES`` bytes, and adds the pieces'
counts up per text. A batch of many short texts and a part of one long text so cost the same, and
no list of ids is larger than a batch's.

A boundary is safe where the model cannot join what is left and right of it:

* before a space that follows another character, if no vocabulary piece holds the space mark behind
  a character. The model puts a space mark before each piece, so the space itself is left out.
* before a character that occurs in no piece of several characters. It is a token (or bytes) of its
  own wherever it stands, and so is the mark that the model puts before it, which is taken off.

Both hold for byte-pair models without normalisation that mark the start of a text; texts of other
models, and stretches without a safe boundary, are encoded whole.

Defined results: null text counts as empty and has no tokens; repeated rows are counted each; an
empty table gives an empty result; strings of special tokens are ordinary text, as the library's
default has it; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of, worker_state

#: Characters from which a piece is cut at the next safe boundary, and bytes of a batch of pieces.
PIECE_CHARS = 500
BATCH_BYTES = 1 << 20
LIMIT = 4096
#: The model's mark of a space.
MARK = "▁"


class Counter:
    """A model with its safe boundaries."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.boundary = safe_boundary(path, self.model)

    def pieces(self, text: str, size: int) -> Iterator[tuple[str, int]]:
        """(piece, tokens that the cut before it adds), in text order."""
        at, extra = 0, 0
        while self.boundary is not None and len(text) - at > size:
            found = self.boundary.search(text, at + size)
            if not found:
                break
            yield text[at:found.start()], extra
            lone = found.lastgroup == "lone"
            at, extra = (found.start(), 1) if lone else (found.start() + 1, 0)
        yield text[at:], extra

    def counts(self, texts: Iterable[str], piece_chars: int, batch_bytes: int) -> list[int]:
        """Tokens of each text."""
        out: list[int] = []
        batch: list[str] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            for owner, ids in zip(owners, self.model.encode(batch, num_threads=1)):
                out[owner] += len(ids)
            batch.clear()
            owners.clear()

        for row, text in enumerate(texts):
            out.append(0)
            for piece, extra in self.pieces(text, piece_chars):
                out[row] -= extra
                batch.append(piece)
                owners.append(row)
                size += len(piece.encode("utf-8", "replace"))
                if size >= batch_bytes:
                    flush()
                    size = 0
        flush()
        return out


def safe_boundary(path: str, model: sentencepiece.SentencePieceProcessor) -> re.Pattern | None:
    """Pattern of the places where a text may be cut; None if the model's rules allow none."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # without it the model's rules are unknown
        return None
    rules = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        rules.ParseFromString(file.read())
    trained, normal = rules.trainer_spec, rules.normalizer_spec
    plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    own = [p.piece for p in rules.pieces if p.type == kinds.USER_DEFINED]
    if trained.model_type != trained.BPE or not plain or normal.remove_extra_whitespaces or trained.treat_whitespace_as_suffix or own:
        return None
    several = {p.piece for p in rules.pieces if len(p.piece) > 1 and p.type in (kinds.NORMAL, kinds.UNUSED)}
    cuts = []
    if not any(MARK in piece.lstrip(MARK) for piece in several):
        cuts.append(rf"(?P<space>(?<=[^ {MARK}]) (?=[\s\S]))")
    if trained.byte_fallback and model.piece_to_id(MARK) != model.unk_id():
        joined = "".join(sorted(set("".join(several)) | {" ", MARK}))
        cuts.append(rf"(?P<lone>(?<=[\s\S])[^{re.escape(joined)}])")
    return re.compile("|".join(cuts)) if cuts else None


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text",
    piece_chars: int = PIECE_CHARS, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row, without begin and end tokens."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(("token_counts", path), lambda: Counter(path))
        for batch in batches:
            texts = batch.column(1)
            tokens = np.array(counter.counts((t.as_py() for t in texts), piece_chars, batch_bytes), np.int64)
            sizes = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = slim.schema["id"].dataType.simpleString()
    out = slim.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
