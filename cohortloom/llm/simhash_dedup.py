"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are 64 majority bits over the XXH64 values of a text's word shingles. Distinct
fingerprints within the radius are linked: fingerprints that differ in r bits agree in at
least bands - r of any division into bands, so each is dealt into one bucket per choice of
that many bands, and every link shares a bucket. Within a task, the fingerprints are stored
as bit planes, 64 rows to a machine word; a row's differing bits to 64 others are added up at
once by carry-save counters, and words in which all rows exceed the radius are abandoned.
Buckets beyond a size are compared block by block in several tasks, without loss.

A task reports links as a spanning forest of what it compared, so output grows with the rows
and not with a group's square; components are the same.

Defined results: null or white text has fingerprint zero and is linked like any other; a text
of fewer words than a shingle is one shingle; null ids never name a component unless it has
no other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import rows_of_keepers, settled, text_of, worker_state

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
#: Fingerprints compared with each other in one task at most, per bucket.
BLOCK_ROWS = 2048
#: Rows handled at a time in a task; buckets are never cut by it.
CHUNK_ROWS = 1 << 17
#: (row, word) comparisons updated at a time.
LANE_PAIRS = 1 << 15
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64 majority bits over the XXH64 values of the text's word shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white space bytes only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(tokens) - words + 1], ends[words - 1:]
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 14):
        low, high = starts[at:at + (1 << 14)].tolist(), ends[at:at + (1 << 14)].tolist()
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(low, high)), np.uint64, len(low))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_state("simhash_dedup", dict)
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(2)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["id", "digest", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, print) per row: the text's SHA-256, and its fingerprint as a signed long."""
    slim = docs.select(F.col(id_col).alias("id"), text_digest(text_col), text_of(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(_fingerprints, f"id {kind}, digest binary, print long")


def text_digest(column: str = "text"):
    return F.unhex(F.sha2(text_of(column), 256)).alias("digest")


# --- links -------------------------------------------------------------------------------


def band_choices(n: int, radius: int = RADIUS) -> list[list[tuple[int, int]]]:
    """Bucket keys as lists of (first bit, bits); more bands for more fingerprints.

    Any choice finds every link; the number of bands only decides how full buckets get.
    """
    for bands in range(radius + 1, radius + 5):
        edges = [64 * k // bands for k in range(bands + 1)]
        spans = [(a, b - a) for a, b in zip(edges, edges[1:])]
        choices = [list(c) for c in combinations(spans, bands - radius)]
        if n >> min(sum(bits for _, bits in c) for c in choices) <= BLOCK_ROWS:
            break
    return choices


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes: [64, words]; bit k of word w of plane p is bit p of row 64 w + k."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _beyond(c0, c1, c2, over, radius: int):
    """Lanes whose counters exceed the radius (0 to 7)."""
    out = over.copy()
    equal = np.full_like(over, ONES)
    for counter, bit in ((c2, radius >> 2 & 1), (c1, radius >> 1 & 1), (c0, radius & 1)):
        if bit:
            equal &= counter
        else:
            out |= equal & counter
            equal &= ~counter
    return out


def close_lanes(planes: np.ndarray, prints: np.ndarray, row: np.ndarray, word: np.ndarray, lanes: np.ndarray,
                radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (row, word) comparisons, those with rows within the radius, and these rows' lanes."""
    c0, c1, c2 = (np.zeros(len(row), np.uint64) for _ in range(3))
    over = ~lanes
    for p in range(0, 64, 2):
        own = prints[row]
        a = planes[p][word] ^ (np.uint64(0) - ((own >> np.uint64(p)) & np.uint64(1)))
        b = planes[p + 1][word] ^ (np.uint64(0) - ((own >> np.uint64(p + 1)) & np.uint64(1)))
        half = a ^ b
        carry = (a & b) | (c0 & half)
        c0 ^= half
        carry, c1 = c1 & carry, c1 ^ carry
        carry, c2 = c2 & carry, c2 ^ carry
        over |= carry
        if p % 8 == 6:
            over |= _beyond(c0, c1, c2, over, radius)
            alive = over != ONES
            if not alive.all():
                row, word, c0, c1, c2, over = (x[alive] for x in (row, word, c0, c1, c2, over))
                if not len(row):
                    break
    return row, word, ~over


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining rows a and b: the smallest row of each component so far."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
    return labels


def linked(keys: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows sorted by bucket key: the first row of each row's component within its bucket."""
    n = len(prints)
    labels = np.arange(n)
    ends = np.searchsorted(keys, keys, side="right")
    planes = planes_of(prints)
    rows = np.nonzero(ends > labels + 1)[0]
    first, last = (rows + 1) // 64, (ends[rows] - 1) // 64
    spans = np.cumsum(last - first + 1)
    at = 0
    while at < len(rows):
        done = spans[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(spans, done + LANE_PAIRS, side="right")))
        width = last[at:to] - first[at:to] + 1
        row = np.repeat(rows[at:to], width)
        word = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first[at:to], width)
        low = np.maximum(row + 1 - 64 * word, 0).astype(np.uint64)
        high = np.minimum(ends[row] - 64 * word, 64).astype(np.uint64)
        lanes = (ONES << low) & (ONES >> (np.uint64(64) - high))
        row, word, hits = close_lanes(planes, prints, row, word, lanes, radius)
        for part in range(0, len(row), 1 << 13):
            bits = np.unpackbits(hits[part:part + (1 << 13)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k, lane = np.nonzero(bits)
            labels = _join(labels, row[part + k], 64 * word[part + k] + lane)
        at = to
    return labels


def _bucket_links(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys, prints):
            labels = linked(keys, prints.view(np.uint64), radius)
            moved = np.nonzero(labels != np.arange(len(labels)))[0]
            a, b = prints[moved], prints[labels[moved]]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

        held_keys, held_prints, held = [], [], 0
        for batch in batches:
            held_keys.append(batch.column(0).to_numpy())
            held_prints.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held >= CHUNK_ROWS:
                keys, prints = np.concatenate(held_keys), np.concatenate(held_prints)
                cut = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
                if cut:
                    yield links(keys[:cut], prints[:cut])
                held_keys, held_prints, held = [keys[cut:]], [prints[cut:]], len(keys) - cut
        if held:
            yield links(np.concatenate(held_keys), np.concatenate(held_prints))

    return run


def near_links(prints: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b), a > b: links that join exactly what the links within the radius join.

    ``prints`` has one row per distinct fingerprint, in column print. A bucket of more than
    ``block_rows`` is cut in blocks by hash; each pair of blocks is a bucket of its own.
    """
    choices = band_choices(prints.count(), radius)
    keys = [
        F.xxhash64(F.lit(t), *[
            F.shiftrightunsigned("print", first).bitwiseAND(F.lit((1 << bits) - 1)) for first, bits in choice
        ])
        for t, choice in enumerate(choices)
    ]
    dealt = prints.select("print", F.explode(F.array(*keys)).alias("bucket"))
    large = (
        dealt.groupBy("bucket").agg(F.count("*").alias("rows")).where(F.col("rows") > block_rows)
        .select("bucket", F.ceil(2 * F.col("rows") / block_rows).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("print", F.lit("block")), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != block)
    pairs = F.when(
        F.col("blocks").isNotNull(),
        F.transform(others, lambda x: F.xxhash64("bucket", F.least(x, block), F.greatest(x, block))),
    ).otherwise(F.array("bucket"))
    return (
        dealt.join(large, "bucket", "left").select(F.explode(pairs).alias("bucket"), "print")
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_bucket_links(radius), "a long, b long")
    )


# --- components --------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node but the roots: large-star and small-star rounds.

    ``links`` has columns a > b. Each round ends in a table in the shared folder.
    """
    edges = settled(links.distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = settled(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b"))).distinct()
        )
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _with_roots(docs: DataFrame, radius: int, id_col: str, text_col: str, block_rows: int) -> DataFrame:
    """(id, digest, print, root) per row; root is the smallest fingerprint of the component."""
    rows = settled(fingerprints(docs, id_col, text_col))
    prints = settled(rows.select("print").distinct())
    roots = components(near_links(prints, radius, block_rows))
    of_print = prints.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("root", "print").alias("root"))
    return rows.join(of_print, "print")


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, print, component) per row; component is the smallest id reachable by links."""
    rows = settled(_with_roots(docs, radius, id_col, text_col, block_rows))
    least = rows.groupBy("root").agg(F.min("id").alias("component"))
    return rows.join(least, "root").select(F.col("id").alias(id_col), "print", "component")


def hex_print(column: str = "print"):
    """A signed long as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
                         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row of ``docs`` per component, with its columns: the smallest id, null ids last."""
    rows = _with_roots(docs, radius, id_col, text_col, block_rows)
    alike = rows.groupBy("root", "id", "digest").agg(F.count("*").alias("rows"))
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest", "rows")
    keepers = settled(alike.groupBy("root").agg(F.min(first).alias("k")).select("k.id", "k.digest", "k.rows"))
    return rows_of_keepers(docs, keepers, id_col, text_digest(text_col))
