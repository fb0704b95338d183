"""Byte-level BPE encoding and decoding with DuckDB queries inside each partition.

A partition's texts are cut into words by the tokenizer's pattern, each distinct word is
encoded once, and words go back into their texts by look-up. Words start as one row per byte:
(word, position, token). A recursive query joins neighbouring tokens with the merge table,
contracts each word's leftmost pair of the smallest rank, and ends when no word has a pair
left. Long words are first cut where no vocabulary token that they contain crosses; pieces that
are still long contract all their pairs of that rank in one round, from the left, up to the first
one whose new token makes a pair of smaller rank. The ids are the same. A round passes over the
whole piece, so a piece of many thousand letters with thousands of different pairs is slow.

Decoding joins token rows with the vocabulary and concatenates bytes by an ordered aggregation.

Defined results: null text counts as empty and has no tokens; ids outside the vocabulary and
null ids in a sequence are errors; repeated rows are encoded each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of, worker_state

#: Characters of text, bytes of new words and tokens that are handled at a time.
TEXT_CHARS = 4_000_000
WORD_BYTES = 600_000
DECODE_TOKENS = 1_000_000
#: Encoded words that a worker keeps between texts and partitions, in two generations: words
#: met again move to the younger one, and a full one pushes the older one out.
KEPT_WORDS = 2_000_000
#: Words of more bytes are cut where no token can lie; what is still longer contracts all pairs of
#: its smallest rank at once, so many rounds to a query.
LONG_WORD = 64
LONG_ROUNDS = 40

# One contraction per word and round: the leftmost pair of the smallest rank. Each row holds
# its right neighbour and the rank of both joined. A contraction changes its own row and its
# left neighbour's, so just these two meet the merge table again. Positions fit a byte.
SHORT_WORDS = """
WITH RECURSIVE state(w, pos, tok, npos, ntok, merged, done) AS (
  SELECT w, pos, tok, npos, ntok, g.merged, false
  FROM (
    SELECT w, pos, tok, lead(pos) OVER near AS npos, lead(tok) OVER near AS ntok
    FROM start WINDOW near AS (PARTITION BY w ORDER BY pos))
  LEFT JOIN merges g ON g.pair = ((tok::BIGINT << 32) | ntok)
  UNION ALL (
    WITH best AS (SELECT w, min((merged::BIGINT << 16) | (pos << 8) | npos) AS b FROM state WHERE NOT done GROUP BY w),
    tagged AS MATERIALIZED (
      SELECT s.*, b IS NULL AS final, b >> 16 AS rank, (b >> 8) & 255 AS spot, b & 255 AS gone
      FROM state s JOIN best USING (w) WHERE NOT s.done),
    eaten AS (SELECT w, spot, npos, ntok FROM tagged WHERE pos = gone),
    made AS (
      SELECT t.w, t.pos, t.merged, t.final, e.w IS NOT NULL OR coalesce(t.npos = t.spot, false) AS fresh,
        CASE WHEN e.w IS NOT NULL THEN t.rank ELSE t.tok END AS tok,
        CASE WHEN e.w IS NOT NULL THEN e.npos ELSE t.npos END AS npos,
        CASE WHEN e.w IS NOT NULL THEN e.ntok WHEN t.npos = t.spot THEN t.rank ELSE t.ntok END AS ntok
      FROM tagged t LEFT JOIN eaten e ON e.w = t.w AND e.spot = t.pos WHERE t.final OR t.pos <> t.gone)
    SELECT w, pos, tok::INT, npos, ntok::INT, CASE WHEN fresh THEN g.merged ELSE m.merged END, final
    FROM made m LEFT JOIN merges g ON g.pair = CASE WHEN fresh THEN (m.tok::BIGINT << 32) | m.ntok END))
SELECT w, list(tok ORDER BY pos) AS ids FROM state WHERE done GROUP BY w ORDER BY w"""

# The same for long words, with many contractions to a round: occurrences of a word's smallest rank
# are contracted from the left up to the first one whose new token makes a pair of smaller rank with
# a neighbour or with itself; that one comes before all later occurrences. In a run of overlapping
# pairs every second one is contracted. A query ends after some rounds, and its last state starts the
# next one, so that states don't pile up.
LONG_WORDS = """
WITH RECURSIVE state(w, pos, tok, next, done, round) AS (
  SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos), false, 0 FROM start
  UNION ALL (
    WITH ranked AS (
      SELECT s.w, s.pos, s.tok, s.round, g.merged, lag(s.tok) OVER near AS before, lead(s.tok, 2) OVER near AS after
      FROM state s LEFT JOIN merges g ON g.pair = ((s.tok::BIGINT << 32) | s.next) WHERE NOT s.done AND s.round < {rounds}
      WINDOW near AS (PARTITION BY s.w ORDER BY s.pos)),
    best AS (SELECT w, min(merged) AS best FROM ranked GROUP BY w),
    met AS (SELECT r.*, best FROM ranked r JOIN best USING (w) WHERE merged = best),
    stops AS (
      SELECT m.w, min(m.pos) AS stop
      FROM met m LEFT JOIN merges a ON a.pair = ((m.before::BIGINT << 32) | m.merged)
      LEFT JOIN merges b ON b.pair = ((m.merged::BIGINT << 32) | m.after)
      LEFT JOIN merges c ON c.pair = ((m.merged::BIGINT << 32) | m.merged)
      WHERE least(a.merged, b.merged, c.merged) < m.best GROUP BY m.w),
    marked AS (
      SELECT r.w, r.pos, r.tok, r.round, r.merged, best IS NULL AS done, coalesce(merged = best AND (stop IS NULL OR pos <= stop), false) AS hit
      FROM ranked r JOIN best USING (w) LEFT JOIN stops USING (w)),
    runs AS (SELECT *, sum((NOT hit)::INT) OVER (PARTITION BY w ORDER BY pos) AS run FROM marked),
    cuts AS (SELECT *, hit AND row_number() OVER (PARTITION BY w, run, hit ORDER BY pos) % 2 = 1 AS cut FROM runs),
    made AS (
      SELECT w, pos, CASE WHEN cut THEN merged ELSE tok END AS tok, done, round + 1 AS round,
             coalesce(lag(cut) OVER (PARTITION BY w ORDER BY pos), false) AS eaten FROM cuts)
    SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos), done, round FROM made WHERE NOT eaten))
SELECT w, done, list(tok ORDER BY pos) AS ids FROM state WHERE done OR round = {rounds} GROUP BY w, done ORDER BY w"""

DECODE = """
SELECT row, array_to_string(list(chars ORDER BY pos), '') AS data
FROM tokens JOIN vocabulary USING (id) GROUP BY row ORDER BY row"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def ascii_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts of ASCII characters, if letters and numbers are all the properties it names."""
    in_sets = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9"), pattern)
    plain = in_sets.replace(r"\p{L}", "[a-zA-Z]").replace(r"\p{N}", "[0-9]")
    return None if r"\p" in plain.lower() else re.compile(plain, re.ASCII)


class Engine:
    """One DuckDB connection with the merge table and vocabulary of a rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.ascii = ascii_pattern(pattern)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tokens_inside: ahocorasick.Automaton | None = None
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.decimal = {rank: str(rank) for rank in self.ranks.values()}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        pairs = [
            (left, right, rank) for token, rank in self.ranks.items() for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None
        ]
        left, right, merged = (pa.array(x, pa.int32()) for x in zip(*pairs))
        pairs = pa.table({"l": left, "r": right, "merged": merged})
        self.db.sql("CREATE TABLE merges AS SELECT (l::BIGINT << 32) | r AS pair, merged FROM pairs")
        # Bytes as the characters of the same numbers: strings are what DuckDB concatenates.
        words = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "chars": [t.decode("latin-1") for t in self.ranks]})
        self.db.sql("CREATE TABLE vocabulary AS SELECT * FROM words")

    def contracted(self, words: list[bytes], query: str = SHORT_WORDS) -> list[bytes]:
        """Ids of each word, as bytes of 32-bit integers."""
        tokens = [self.byte[np.frombuffer(word, np.uint8)] for word in words] if query is LONG_WORDS else None
        if tokens is None:
            found = self.run(query, np.array([len(w) for w in words]), self.byte[np.frombuffer(b"".join(words), np.uint8)])
            return self.lists(found)
        out, open_words = [b""] * len(words), list(range(len(words)))
        while open_words:
            found = self.run(query.format(rounds=LONG_ROUNDS), np.array([len(t) for t in tokens]), np.concatenate(tokens))
            ids, still, tokens = self.lists(found), [], []
            for w, done, data in zip(found.column("w").to_pylist(), found.column("done").to_pylist(), ids):
                if done:
                    out[open_words[w]] = data
                else:
                    still.append(open_words[w])
                    tokens.append(np.frombuffer(data, "<i4"))
            open_words = still
        return out

    def run(self, query: str, sizes: np.ndarray, tokens: np.ndarray) -> pa.Table:
        """Result of a query over one row per token of words of the given sizes."""
        w = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        pos = np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.db.register("start", pa.table({"w": w, "pos": pos, "tok": tokens}))
        found = self.db.sql(query).to_arrow_table()
        self.db.unregister("start")
        return found

    @staticmethod
    def lists(found: pa.Table) -> list[bytes]:
        ids = found.column("ids").combine_chunks()
        flat, ends = ids.values.to_numpy().astype("<i4").tobytes(), (4 * ids.offsets.to_numpy()).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def pieces(self, word: bytes) -> list[bytes]:
        """The word cut wherever no token of the vocabulary that it contains crosses.

        Merges make vocabulary tokens only, so none crosses such a place, and the pieces'
        ids are the word's.
        """
        if self.tokens_inside is None:
            self.tokens_inside = ahocorasick.Automaton()
            for token in self.ranks:
                if len(token) > 1:
                    self.tokens_inside.add_word(token.decode("latin-1"), len(token))
            self.tokens_inside.make_automaton()
        steps = np.zeros(len(word) + 1, np.int64)
        for end, size in self.tokens_inside.iter(word.decode("latin-1")):
            steps[end - size + 2] += 1
            steps[end + 1] -= 1
        free = np.nonzero(np.cumsum(steps)[:-1] == 0)[0].tolist()  # 0, and the places that nothing crosses
        return [word[a:b] for a, b in zip(free, [*free[1:], len(word)])]

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not kept yet."""
        waiting: list[tuple[str, list[bytes]]] = []
        size = 0

        def flush() -> None:
            parts = [part for _, group in waiting for part in group]
            ids: dict[int, bytes] = {}
            for query, wanted in ((SHORT_WORDS, False), (LONG_WORDS, True)):
                some = [k for k, part in enumerate(parts) if (len(part) > LONG_WORD) == wanted]
                if some:
                    ids.update(zip(some, self.contracted([parts[k] for k in some], query)))
            at = 0
            for word, group in waiting:
                self.kept[word] = b"".join(ids[k] for k in range(at, at + len(group)))
                at += len(group)
            waiting.clear()

        for word in words:
            data = word.encode("utf-8", "replace")
            rank = self.ranks.get(data)
            if rank is not None:  # a word that is a token stays whole
                self.kept[word] = rank.to_bytes(4, "little")
                continue
            waiting.append((word, [data] if len(data) <= LONG_WORD else self.pieces(data)))
            size += len(data)
            if size >= WORD_BYTES:
                flush()
                size = 0
        flush()

    def words(self, text: str) -> list[str]:
        return (self.ascii if self.ascii and text.isascii() else self.pattern).findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of 32-bit integers."""
        words = [self.words(text) for text in texts]
        new = set().union(*words)
        if len(self.kept) + len(new) > KEPT_WORDS // 2:
            self.older, self.kept = self.kept, {}
        new.difference_update(self.kept)
        again = new.intersection(self.older)
        self.kept.update(zip(again, map(self.older.__getitem__, again)))
        self.learn(sorted(new.difference(again)))
        return [b"".join(map(self.kept.__getitem__, found)) for found in words]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of each of the sequences that end at ``ends``."""
        sizes = np.diff(ends, prepend=0)
        out = [b""] * len(ends)
        row = np.repeat(np.arange(len(ends), dtype=np.int32), sizes)
        tokens = pa.table({"row": row, "pos": np.arange(len(ids), dtype=np.int32), "id": ids})
        self.db.register("tokens", tokens)
        if self.db.sql("SELECT id FROM tokens ANTI JOIN vocabulary USING (id) LIMIT 1").fetchall():
            raise ValueError("an id is not in the vocabulary")
        found = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("tokens")
        for at, data in zip(found.column("row").to_pylist(), found.column("data").to_pylist()):
            out[at] = data.encode("latin-1")
        return out


def engine(path: str, pattern: str) -> Engine:
    """The worker's engine for a rank file; kept between partitions."""
    return worker_state(("byte_bpe", path, pattern), lambda: Engine(path, pattern))


def _groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Spans of rows of up to ``most`` in sum; a larger row is a span of its own."""
    at, total = 0, 0
    for k, size in enumerate(sizes):
        if k > at and total + size > most:
            yield at, k
            at, total = k, 0
        total += size
    if at < len(sizes):
        yield at, len(sizes)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, ids_sha256) per row; the digest is of the decimal ids joined by commas."""
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        for batch in batches:
            sizes = batch.column(1).to_pandas().str.len().tolist()
            for a, b in _groups(sizes, TEXT_CHARS):
                encoded = own.encode(batch.column(1).slice(a, b - a).to_pylist())
                ends = np.cumsum([0, *(len(e) // 4 for e in encoded)])
                ids = np.frombuffer(b"".join(encoded), "<i4")
                decimal = own.decimal.__getitem__
                digests = [
                    hashlib.sha256(",".join(map(decimal, ids[x:y].tolist())).encode()).hexdigest() for x, y in zip(ends, ends[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), pa.array(digests)],
                    ["id", "ids", "ids_sha256"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, ids array<int>, ids_sha256 string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: encoded, and the ids decoded, in one worker."""
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        decimal = own.decimal.__getitem__
        for batch in batches:
            sizes = batch.column(1).to_pandas().str.len().tolist()
            counts, of_ids, of_bytes = [], [], []
            for a, b in _groups(sizes, TEXT_CHARS):
                ids = [np.frombuffer(x, "<i4") for x in own.encode(batch.column(1).slice(a, b - a).to_pylist())]
                counts += map(len, ids)
                of_ids += (hashlib.sha256(",".join(map(decimal, x.tolist())).encode()).hexdigest() for x in ids)
                for x, y in _groups([len(i) for i in ids], DECODE_TOKENS):
                    part = ids[x:y]
                    data = own.decode(np.concatenate(part), np.cumsum([len(i) for i in part]))
                    of_bytes += (hashlib.sha256(d).hexdigest() for d in data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the ids' bytes in place of the ids."""
    rest = [c for c in encoded.columns if c != ids_col]
    slim = encoded.select(F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("_ids"), *[F.col(f"`{c}`") for c in rest])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_pylist()
            for a, b in _groups(sizes, DECODE_TOKENS):
                part = batch.slice(a, b - a)
                lists = part.column(0)
                data = own.decode(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes[a:b]))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(data, pa.binary())], [*rest, out_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[1:])
    return slim.mapInArrow(run, f"{fields}, `{out_col}` binary")
