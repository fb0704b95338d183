"""Token files: ids packed by an adaptive context-mixing range coder.

A segment is a run of whole documents: a directory of ids and lengths, then blocks of a fixed
number of token ids. Each block starts from an empty model and carries a checksum, so damage
stays in one block and blocks decode independently; a segment's blocks are coded side by side,
one numpy lane each.

For each id the model has three predictions: the id that last followed the two ids before it
(order 2), the id that last followed the one before it (order 1), each with a confidence, and
the frequencies of the block's ids so far (order 0). How often predictions of such confidences
held is learned as well; it mixes them into the probabilities of "order 2 is right", "order 1
is right" and "neither", and in the last case order 0 codes the id. All of it drives a range
coder with 48-bit state and 16-bit words, which takes one step per id. Predictions change with
each id; the probabilities are renewed after 8, 32, 128 and 384 ids of a block and each 256 from
there, so that within such an epoch an id's share is a look-up and most of the packing is done
for many ids at once.

Texts are encoded by their distinct pieces: words in lower case, the punctuation behind them, and
whatever else stands between white space. Arrow finds the pieces, and a worker keeps their ids.

On Spark, documents are range-partitioned by id, each task packs its documents in order, and
segments are rows of a Parquet table, so that any shared store can hold them. Only the number
of ids per partition reaches the driver.

Defined results: null text counts as empty and holds the end id alone; null ids come first;
equal ids are ordered by text; an empty table gives an empty table of segments and no rows;
other columns are ignored; a block whose checksum is wrong raises an error that names it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of, worker_state

MAGIC = b"TIDS2"
BLOCK_IDS = 2048
#: Ids after which a segment ends with its document.
SEGMENT_IDS = 2_000_000
#: Slots of a block's order-2 table.
PAIRS = 1024
#: What one occurrence adds to a frequency or outcome, the bound at which outcomes are halved,
#: and the steps after which a block's probabilities are renewed.
GAIN, LIMIT, RENEW = 32, 4096, 256
#: Bits of the outcomes' probabilities, and outcome rows of a block.
MIX_BITS, ROWS = 12, 32
FLOOR = float(1 << 32)
#: Steps that are packed together.
CHUNK = 64


def _epochs(steps: int) -> Iterator[tuple[int, int]]:
    """Steps between renewals of the model: up to 8, 32, 128 and 384, then RENEW each."""
    at, end = 0, 8
    while at < steps:
        yield at, min(end, steps)
        at, end = end, min(4 * end, end + RENEW)


def _bits(block_ids: int) -> int:
    """Bits of order 0: at least one unit for each of a block's ids."""
    bits = max(10, (block_ids - 1).bit_length())
    if bits + MIX_BITS > 30:
        raise ValueError(f"blocks of {block_ids} ids are too long")
    return bits


class Model:
    """Predictions and frequencies of all blocks of a segment, one lane each.

    Predictions change with each id, frequencies of ids and outcomes at the end of an epoch.
    """

    def __init__(self, sizes: np.ndarray, block_ids: int) -> None:
        self.lanes, self.width, self.bits = len(sizes), int(sizes.max()), _bits(block_ids)
        lane, sizes = np.arange(self.lanes), sizes[:, None].astype(np.int32)
        # A state is an id and two bits of confidence; order 1 of all lanes, then order 2 of all lanes.
        self.kind = np.int16 if self.width <= 1 << 13 else np.int32
        self.states, self.surer = np.zeros(self.lanes * (self.width + PAIRS), self.kind), np.array([1, 2, 3, 3, 0], self.kind)
        self.at_one, self.at_two = lane * self.width, self.lanes * self.width + lane * PAIRS
        self.last = self.pair = np.zeros(self.lanes, np.int64)
        # Outcomes by confidences: order 2 right, order 1 right, neither.
        start = np.array([[1 + 8 * c2, 1 + 4 * c1, 8] for c2 in range(4) for c1 in range(4)] * 2, np.int64)
        self.outcomes, self.at_row = np.tile(start.T, self.lanes), lane * ROWS
        # Each id of a block has one unit of order 0; the others are shared out by frequency.
        self.counts = (np.arange(self.width) < sizes).astype(np.float32)
        self.at_count, self.at_start = lane * self.width, lane * (self.width + 1)
        self.least = np.minimum(np.arange(self.width + 1, dtype=np.int32), sizes)
        self.sums, self.shared = np.zeros((2, self.lanes, self.width + 1), np.float32)
        self.starts, self.units = np.empty_like(self.least), ((1 << self.bits) - sizes + 0.5).astype(np.float32)

    def renew(self) -> None:
        """Bounds of the outcomes by row, and of the ids within order 0."""
        whole, units = self.outcomes.sum(axis=0), (1 << MIX_BITS) - 3
        first = self.outcomes[0] * units // whole + 1
        second = first + self.outcomes[1] * units // whole + 1
        self.bounds = (first << 32 | second) << self.bits
        np.cumsum(self.counts, axis=1, out=self.sums[:, 1:])
        np.multiply(self.sums, self.units / self.sums[:, -1:], out=self.shared)
        np.copyto(self.starts, self.shared, casting="unsafe")
        self.starts += self.least

    def mixed(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the outcomes "order 2" and "order 1", and the size of one unit of order 0 behind them."""
        bounds = self.bounds.take(rows)
        first, second = (bounds >> 32).astype(np.int32), bounds.astype(np.int32)
        return first, second, (1 << MIX_BITS) - (second >> self.bits)

    def write(self, place: np.ndarray, state: np.ndarray, plain: np.ndarray) -> None:
        """A right prediction gains confidence, a wrong one gives way to the id, here shifted to a state."""
        self.states[place] = plain + self.surer.take(np.minimum(state ^ plain, 4))

    def rows(self, state1: np.ndarray, state2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predictions of order 2 and 1, and the row of outcomes that their confidences name."""
        guess1, guess2 = state1 >> 2, state2 >> 2
        return guess2, guess1, self.at_row + ((state2 & 3) << 2 | state1 & 3 | (guess1 == guess2).view(np.int8) << 4)

    def learn(self, ids: np.ndarray, rows: np.ndarray, outcome: np.ndarray) -> None:
        """What an epoch showed."""
        np.add.at(self.counts.reshape(-1), (self.at_count + ids).reshape(-1), np.float32(GAIN))
        found = np.bincount((outcome * len(self.bounds) + rows).reshape(-1), minlength=self.outcomes.size)
        self.outcomes += GAIN * found.reshape(3, -1)
        old = self.outcomes.sum(axis=0) > LIMIT
        self.outcomes[:, old] = (self.outcomes[:, old] + 1) >> 1


def _pair(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (before * 769 + last * 31) & (PAIRS - 1)


class Encoder:
    """Range coder; all numbers are whole and below 2^53, so that floats hold them exactly."""

    def __init__(self, lanes: int, words: int, bits: int) -> None:
        self.low, self.range, self.unit = np.zeros(lanes), np.full(lanes, float((1 << 48) - 1)), 0.5 ** bits
        self.words, self.used = np.zeros((words + 4, lanes), np.int32), np.zeros(lanes, np.int64)

    def put(self, n: int, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow the first n lanes' ranges to size units from start; each emits at most two words."""
        low, width = self.low[:n], self.range[:n]
        np.floor(width * self.unit, out=width)
        low += width * start
        width *= size
        short = (width < FLOOR).nonzero()[0]
        while len(short):
            self.emit(short)
            wide = width[short] * 65536.0
            width[short] = wide
            short = short[wide < FLOOR]

    def emit(self, lanes: np.ndarray) -> None:
        low, at = self.low[lanes], self.used[lanes]
        word = (low * (1 / FLOOR)).astype(np.int32)
        self.words[at, lanes] = word
        self.used[lanes] = at + 1
        self.low[lanes] = (low - word * FLOOR) * 65536.0

    def done(self) -> list[bytes]:
        """The lanes' words, carries settled from the back."""
        for _ in range(3):
            self.emit(np.arange(len(self.low)))
        for k in range(int(self.used.max()) - 1, 0, -1):
            self.words[k - 1] += self.words[k] >> 16
        words = np.ascontiguousarray((self.words[: int(self.used.max())] & 0xFFFF).astype("<u2").T)
        return [words[k, :n].tobytes() for k, n in enumerate(self.used)]


class Decoder:
    def __init__(self, blocks: list[bytes], bits: int) -> None:
        width = max(len(b) for b in blocks) // 2 + 4
        words = np.zeros((len(blocks), width), np.uint16)
        for k, block in enumerate(blocks):
            words[k, : len(block) // 2] = np.frombuffer(block, "<u2")
        self.words, lane = words.reshape(-1), np.arange(len(blocks))
        self.next, self.last = lane * width + 3, lane * width + width - 1  # damaged blocks may run out
        self.code = words[:, :3] @ np.array([FLOOR, 65536.0, 1.0])
        self.range, self.unit, self.top = np.full(len(blocks), float((1 << 48) - 1)), 0.5 ** bits, float((1 << bits) - 1)

    def value(self) -> np.ndarray:
        np.floor(self.range * self.unit, out=self.range)
        return np.minimum(self.code / self.range, self.top).astype(np.int32)  # beyond the top in damaged blocks only

    def take(self, start: np.ndarray, size: np.ndarray) -> None:
        self.code -= self.range * start
        self.range *= size
        short = (self.range < FLOOR).nonzero()[0]
        while len(short):
            at = self.next[short]
            self.code[short] = self.code[short] * 65536.0 + self.words[at]
            self.next[short] = np.minimum(at + 1, self.last[short])
            wide = self.range[short] * 65536.0
            self.range[short] = wide
            short = short[wide < FLOOR]


def _cut(n: int, size: int) -> list[int]:
    return [min(size, n - at) for at in range(0, n, size)]


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ids, and the place of each id among them."""
    top = int(ids.max())
    if top >= 1 << 20:
        return np.unique(ids, return_inverse=True)
    there = np.zeros(top + 1, bool)
    there[ids] = True
    known, place = np.flatnonzero(there), np.zeros(top + 1, np.int32)
    place[known] = np.arange(len(known))
    return known, place[ids]


def pack_blocks(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> list[tuple[np.ndarray, bytes]]:
    """(sorted distinct ids, coded words) of each block of the ids."""
    lengths = _cut(len(ids), block_ids)
    if not lengths:
        return []
    lanes, steps, short = len(lengths), max(lengths), lengths[-1]
    every, ranks = _ranked(ids)
    known, table = [], np.zeros((lanes, steps), np.int32)
    for k, n in enumerate(lengths):
        some, table[k, :n] = _ranked(ranks[k * block_ids:k * block_ids + n])
        known.append(every[some].astype(np.uint32))
    table = np.ascontiguousarray(table.T)
    model = Model(np.array([len(x) for x in known]), block_ids)
    coder = Encoder(lanes, 2 * steps, model.bits + MIX_BITS)
    for at, end in _epochs(steps):
        model.renew()
        starts = model.starts.reshape(-1)
        all_rows, outcomes = np.empty((2, end - at, lanes), np.int64)
        for t in range(at, end, CHUNK):
            span, own = slice(t, min(t + CHUNK, end)), slice(t - at, min(t + CHUNK, end) - at)
            ids = table[span].astype(np.int64)
            lasts = np.vstack([model.last, ids[:-1]])
            pairs = np.vstack([model.pair, _pair(lasts, ids)])
            model.last, model.pair = ids[-1], pairs[-1]
            places = np.hstack([model.at_one + lasts, model.at_two + pairs[:-1]])
            states = np.empty(places.shape, model.kind)
            for place, state, plain in zip(places, states, np.tile((ids << 2).astype(model.kind), 2)):
                state[:] = model.states.take(place)
                model.write(place, state, plain)
            guess2, guess1, rows = model.rows(states[:, :lanes], states[:, lanes:])
            one, new = guess2 != ids, (guess2 != ids) & (guess1 != ids)
            first, second, rest = model.mixed(rows)
            low, high = starts.take(model.at_start + ids), starts.take(model.at_start + ids + 1)
            start = np.where(new, second + low * rest, first * one)
            size = np.where(new, (high - low) * rest, np.where(one, second - first, first))
            for k in range(len(ids)):  # only the last block is short
                n = lanes if t + k < short else lanes - 1
                coder.put(n, start[k, :n], size[k, :n])
            all_rows[own] = rows
            np.add(one, new, out=outcomes[own], dtype=np.int64)
        model.learn(table[at:end], all_rows, outcomes)
    return list(zip(known, coder.done()))


@np.errstate(over="ignore")  # damaged blocks only, which the checksums name
def unpack_blocks(blocks: list[tuple[np.ndarray, bytes]], n_ids: int, block_ids: int = BLOCK_IDS) -> np.ndarray:
    lengths = _cut(n_ids, block_ids)
    if not lengths:
        return np.zeros(0, np.uint32)
    known, coded = zip(*blocks)
    model = Model(np.array([len(x) for x in known]), block_ids)
    lanes, steps, bits = len(lengths), max(lengths), model.bits
    coder = Decoder(list(coded), bits + MIX_BITS)
    table, symbols = np.zeros((steps, lanes), model.kind), np.tile(np.arange(model.width, dtype=model.kind), lanes)
    at_symbol, place, plain = np.arange(lanes) << bits, np.empty(2 * lanes, np.int64), np.empty(2 * lanes, model.kind)
    for at, end in _epochs(steps):
        model.renew()
        starts = model.starts.reshape(-1)
        inverse = np.repeat(symbols, np.diff(model.starts, axis=1).reshape(-1))
        rows, outcomes = np.empty((2, end - at, lanes), np.int64)
        for t in range(at, end):
            np.add(model.at_one, model.last, out=place[:lanes])
            np.add(model.at_two, model.pair, out=place[lanes:])
            state = model.states.take(place)
            guess2, guess1, row = model.rows(state[:lanes], state[lanes:])
            first, second, rest = model.mixed(row)
            value = coder.value()
            one, new = value >= first, value >= second
            symbol = inverse.take(at_symbol + (np.maximum(value - second, 0) / rest).astype(np.int64))
            ids = np.where(new, symbol, np.where(one, guess1, guess2))
            found = model.at_start + symbol
            low, high = starts.take(found), starts.take(found + 1)
            coder.take(np.where(new, second + low * rest, first * one),
                       np.where(new, (high - low) * rest, np.where(one, second - first, first)))
            np.left_shift(ids, 2, out=plain[:lanes])
            plain[lanes:] = plain[:lanes]
            model.write(place, state, plain)
            table[t], rows[t - at] = ids, row
            np.add(one, new, out=outcomes[t - at], dtype=np.int64)
            before, model.last = model.last, ids.astype(np.int64)
            model.pair = _pair(before, model.last)
        model.learn(table[at:end], rows, outcomes)
    table = np.ascontiguousarray(table.T)
    return np.concatenate([known[k][table[k, :n]] for k, n in enumerate(lengths)])


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """One segment: directory, then blocks, each with its distinct ids, words and checksum."""
    ids = np.ascontiguousarray(ids, "<u4")
    blocks = pack_blocks(ids, block_ids)
    directory = (
        np.array([d is None for d in doc_ids], np.uint8).tobytes()
        + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<u4").tobytes()
    )
    directory = zlib.compress(directory, 1)
    out = [MAGIC, struct.pack("<IQIII", len(doc_ids), len(ids), block_ids, len(directory), zlib.crc32(directory)), directory]
    for k, (known, words) in enumerate(blocks):
        steps = known.astype(np.int64)
        steps[1:] -= known[:-1]
        kind = "<u2" if not len(steps) or steps.max() < 1 << 16 else "<u4"
        data = zlib.compress(steps.astype(kind).tobytes(), 1)
        sum_of_ids = zlib.crc32(ids[k * block_ids:(k + 1) * block_ids].tobytes())
        out += [struct.pack("<BIII", int(kind[2]), len(data), len(words), sum_of_ids), data, words]
    return b"".join(out)


def unpack_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of a segment; raises ValueError for damage."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a segment")
    head = struct.Struct("<IQIII")
    docs, n_ids, block_ids, size, check = head.unpack_from(data, len(MAGIC))
    at = len(MAGIC) + head.size
    directory = data[at:at + size]
    if zlib.crc32(directory) != check:
        raise ValueError("the directory's checksum is wrong")
    at, directory = at + size, zlib.decompress(directory)
    missing = np.frombuffer(directory, np.uint8, docs)
    names = np.frombuffer(directory, "<i8", docs, docs)
    lengths = np.frombuffer(directory, "<u4", docs, 9 * docs)
    part, blocks, checks = struct.Struct("<BIII"), [], []
    while at < len(data):
        width, known, words, check = part.unpack_from(data, at)
        at += part.size
        steps = np.frombuffer(zlib.decompress(data[at:at + known]), f"<u{width}")
        blocks.append((np.cumsum(steps.astype(np.int64)).astype(np.uint32), data[at + known:at + known + words]))
        checks.append(check)
        at += known + words
    ids = unpack_blocks(blocks, n_ids, block_ids).astype("<u4")
    for k, check in enumerate(checks):
        if zlib.crc32(ids[k * block_ids:(k + 1) * block_ids].tobytes()) != check:
            raise ValueError(f"block {k}: the checksum is wrong")
    return [None if m else int(d) for m, d in zip(missing, names)], lengths, ids


# --- tokenizer ---------------------------------------------------------------------------

#: Encoded pieces that a worker keeps; beyond that, only those of the last texts.
KEPT_PIECES = 1_000_000
#: White space to str.split, but not to the tokenizer, which drops white space between words.
SEPARATORS = "\x1c\x1d\x1e\x1f"
GAPS = re.compile(r"[ \t\n\r]+")
#: Punctuation that starts a word of its own after letters.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: Words that are joined for one call.
JOINED = 2000


def _letters(tokenizer) -> str:
    """Letters of which words can be made whose parts the tokenizer neither composes nor tells apart by case."""
    jamo = {*range(0x1100, 0x1200), *range(0xA960, 0xA980), *range(0xD7B0, 0xD800)}
    every = [c for k in range(1 << 16) if k not in jamo and (c := chr(k)).isalpha()]
    lower = pc.utf8_lower(pa.array(every)).to_pylist()
    normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
    every = [c for c, small in zip(every, lower) if len(small) == 1 and normal(c) == small == normal(small)]
    cut = tokenizer.pre_tokenizer.pre_tokenize_str if tokenizer.pre_tokenizer else lambda text: [text]
    return "".join(c for c in every if len(cut(f"a{c}a!")) == 2)


def _ranges(letters: str) -> str:
    """The letters, in ascending order, as ranges of a character class."""
    codes = np.array([ord(c) for c in letters])
    new = np.flatnonzero(np.diff(codes) > 1)
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(codes[[0, *(new + 1)]], codes[[*new, -1]]))


def gathered(ids: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces at ``places`` in turn and their lengths; ``ids`` holds each piece once."""
    starts, taken = np.cumsum(lengths) - lengths, lengths[places]
    out, at = np.empty(int(taken.sum()), ids.dtype), 0
    for k in range(0, len(places), 1 << 16):
        some, n = places[k:k + (1 << 16)], taken[k:k + (1 << 16)]
        index = np.repeat(starts[some] - np.cumsum(n) + n, n)
        index += np.arange(len(index))
        out[at:at + len(index)] = ids[index]
        at += len(index)
    return out, taken


class Words:
    """Ids of texts by a tokenizer file whose tokens never span white space."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of added tokens are found in the text as it is, and what is between them is encoded apart.
        added = self.tokenizer.get_added_tokens_decoder()
        if any(token.normalized or token.single_word or token.lstrip or token.rstrip for token in added.values()):
            raise ValueError(f"{path} has added tokens that look at their surroundings")
        self.added = {token.content for token in added.values()}
        self.marks = re.compile("|".join(f"({re.escape(x)})" for x in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.letters = _letters(self.tokenizer)
        self.word = f"^[{_ranges(self.letters)}]+" if self.letters else "^$"
        # Pieces with their ids, one after another.
        self.pieces, self.lengths, self.ids = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def stretches(self, text: str) -> list[str]:
        """Stretches without white space, and strings of added tokens, in order."""
        if self.marks.search(text):
            return [x for part in self.marks.split(text) if part for x in ([part] if part in self.added else self.stretches(part))]
        return GAPS.split(text) if any(c in text for c in SEPARATORS) else text.split()

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Little-endian ids of each text."""
        ids, lengths = self.encoded(pa.array(texts, pa.string()), end_id)
        raw, ends = ids.tobytes(), (4 * np.cumsum(lengths)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def encoded(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the lengths of each; each distinct stretch without white space is encoded once."""
        found = pc.ascii_split_whitespace(texts)
        coded = found.flatten().dictionary_encode()
        # A string of an added token that has white space is sought in the texts.
        if any(pc.any(pc.match_substring(texts if len(mark.split()) > 1 or mark.strip() != mark else coded.dictionary, mark)).as_py() for mark in self.added):
            found = pa.array([self.stretches(text) for text in texts.to_pylist()], pa.list_(pa.string()))
            coded = found.flatten().dictionary_encode()
        ids, lengths = self.ids_of(coded.dictionary)
        # After a text's last stretch one more that is the end id.
        ids, lengths = np.append(ids, np.uint32(end_id)), np.append(lengths, 1)
        ends = np.cumsum(pc.list_value_length(found).to_numpy(zero_copy_only=False), dtype=np.int64)
        ids, taken = gathered(ids, lengths, np.insert(coded.indices.to_numpy().astype(np.int64), ends, len(lengths) - 1))
        return ids, np.diff(np.cumsum(taken)[ends + np.arange(len(ends))], prepend=0)

    def ids_of(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches in turn and the lengths of each; a word and punctuation behind it are pieces of their own."""
        two = pc.match_substring_regex(stretches, f"{self.word}[{re.escape(MARKS)}]+$")
        some, whole = stretches.filter(two), stretches.filter(pc.invert(two))
        plain = pc.match_substring_regex(whole, f"{self.word}$")
        words = pc.if_else(plain, pc.utf8_lower(whole), whole)
        first = pa.concat_arrays([pc.utf8_lower(pc.ascii_rtrim(some, MARKS)), words])
        second = pa.concat_arrays([pc.utf8_ltrim(some, self.letters), pa.array([""])])
        pieces = pa.concat_arrays([first, second]).dictionary_encode()
        ids, lengths = self.known(pieces.dictionary)
        at, mask = pieces.indices.to_numpy().astype(np.int64), two.to_numpy(zero_copy_only=False)
        places = np.full((len(stretches), 2), at[-1])
        places[mask, 0], places[~mask, 0], places[mask, 1] = at[:len(some)], at[len(some):len(first)], at[len(first):-1]
        ids, taken = gathered(ids, lengths, places.reshape(-1))
        return ids, taken.reshape(-1, 2).sum(axis=1)

    def known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of distinct pieces; those that the worker hasn't are learned."""
        at = pc.index_in(pieces, value_set=self.pieces)
        is_new, before = pc.is_null(at).to_numpy(zero_copy_only=False), len(self.pieces)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        if is_new.any():
            new = pieces.filter(pa.array(is_new))
            self.learn(new)
            at[is_new] = before + pc.index_in(new, value_set=self.pieces.slice(before)).to_numpy()
        ids, lengths = gathered(self.ids, self.lengths, at)
        if len(self.pieces) > KEPT_PIECES:
            self.pieces, self.lengths, self.ids = pieces, lengths, ids
        return ids, lengths

    def learn(self, new: pa.Array) -> None:
        """Words of letters alone are encoded as one text and cut where words end; others one by one."""
        is_word = pc.match_substring_regex(new, f"{self.word}$")
        plain, others = new.filter(is_word).to_pylist(), new.filter(pc.invert(is_word)).to_pylist()
        names, lengths, ids = [], [self.lengths], [self.ids]
        for at in range(0, len(plain), JOINED):
            some = plain[at:at + JOINED]
            found = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[found]) + 1
            if len(ends) != len(some) or ends[-1] != len(found):
                others += some
                continue
            names += some
            lengths.append(np.diff(ends, prepend=0))
            ids.append(found)
        for at in range(0, len(others), JOINED):
            some = others[at:at + JOINED]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            names += some
            lengths.append(np.array([len(x) for x in found], np.int64))
            ids.append(np.array([i for x in found for i in x], np.uint32))
        self.pieces = pa.concat_arrays([self.pieces, pa.array(names, pa.string())])
        self.lengths, self.ids = np.concatenate(lengths), np.concatenate(ids)


def words(path: str) -> Words:
    """The worker's tokenizer; kept between partitions."""
    return worker_state(("token_files", path), lambda: Words(path))


# --- on Spark ----------------------------------------------------------------------------

#: Bytes of texts that are encoded together.
TEXTS_BYTES = 20_000_000


def _grouped(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(size):
        before = size[at - 1] if at else 0
        end = min(int(np.searchsorted(size, before + TEXTS_BYTES)) + 1, len(size))
        yield batch.slice(at, end - at)
        at = end


def _segments(path: str, end_id: int, segment_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, before, count = words(path), TaskContext.get().partitionId(), 0, 0
        names, sizes, packed, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            data = pack_segment(names, np.concatenate(sizes), np.concatenate(packed))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([count], pa.int32()),
                "before": pa.array([before], pa.int64()), "n_ids": pa.array([held], pa.int64()), "data": pa.array([data], pa.binary())})

        for batch in batches:
            for some in _grouped(batch):
                own_names = some.column(0).to_pylist()
                ids, lengths = own.encoded(some.column(1), end_id)
                ends, at, from_id = np.cumsum(lengths), 0, 0
                while at < len(ends):
                    # To the document that fills the segment, or to the last one.
                    full = int(np.searchsorted(ends, from_id + segment_ids - held))
                    end = min(full + 1, len(ends))
                    names += own_names[at:end]
                    sizes.append(lengths[at:end])
                    packed.append(ids[from_id:ends[end - 1]])
                    held += int(ends[end - 1]) - from_id
                    at, from_id = end, int(ends[end - 1])
                    if held >= segment_ids:
                        yield segment()
                        before, count = before + held, count + 1
                        names, sizes, packed, held = [], [], [], 0
        if names:
            yield segment()

    return run


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text, append ``end_id`` and write segments in ascending order of the ids."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    ordered = slim.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(
        _segments(tokenizer, end_id, segment_ids), "part int, segment int, before long, n_ids long, data binary",
    ).write.parquet(folder)


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            names, lengths, ids = unpack_segment(data.as_py())
            ends = np.cumsum(lengths, dtype=np.int64)
            starts, raw = ends - lengths, ids.tobytes()
            for at in range(0, len(names), 2000):
                span = slice(at, at + 2000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[span], pa.int64()), pa.array(base + starts[span]),
                     pa.array([raw[4 * a:4 * b] for a, b in zip(starts[span], ends[span])], pa.binary())], ["id", "start", "ids"])


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids) per document: ids of all documents before it, and its own as little-endian bytes."""
    segments = spark.read.schema("part int, segment int, before long, n_ids long, data binary").parquet(folder)
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row per task that wrote
    bases, total = [], 0
    for row in sizes:
        bases.append((row["part"], total))
        total += row["n"]
    base = spark.createDataFrame(bases, "part int, base long")
    placed = segments.join(F.broadcast(base), "part").select((F.col("base") + F.col("before")).alias("base"), "data")
    return placed.mapInArrow(_documents, "id long, start long, ids binary").withColumnRenamed("id", id_col)
