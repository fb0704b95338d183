import numpy as np
import pytest
import xxhash

from cohortloom.llm import simhash_dedup as s
from tests.llm.conftest import ODD


def slow_fingerprint(text):
    words = text.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    grams = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, radius=4):
    n = len(prints)
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if bin(prints[i] ^ prints[j]).count("1") <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def near_prints(rng, groups, size, bits=3):
    out = []
    for base in rng.integers(0, 1 << 63, groups, dtype=np.uint64):
        for _ in range(size):
            x = int(base)
            for b in rng.choice(64, rng.integers(0, bits + 1), replace=False):
                x ^= 1 << int(b)
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("text", ["", "  ", "One", "a b c", "a b c d", "A b  c\nd e f g", "x " * 3000, "é ü ß ö a"])
def test_fingerprint(text):
    assert s.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", range(8))
def test_counters_against_popcount(radius):
    rng = np.random.default_rng(radius)
    prints = np.array(near_prints(rng, 3, 60, 9), np.uint64)
    labels = s.linked(np.zeros(len(prints), np.int64), prints, radius)
    assert labels.tolist() == slow_components([int(p) for p in prints], radius)


def test_buckets_are_kept_apart():
    prints = np.array([1, 2, 1, 3], np.uint64)
    assert s.linked(np.array([5, 5, 7, 7]), prints, 4).tolist() == [0, 0, 2, 2]


@pytest.mark.parametrize("n", [10, 10**8, 10**11])
def test_band_choices_miss_no_link(n):
    rng = np.random.default_rng(1)
    choices = s.band_choices(n)
    for _ in range(300):
        differing = set(rng.choice(64, 4, replace=False).tolist())
        assert any(all(not differing & set(range(a, a + bits)) for a, bits in choice) for choice in choices)


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_links_and_components(spark, block_rows):
    prints = near_prints(np.random.default_rng(3), 6, 50)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = s.near_links(spark.createDataFrame([(p,) for p in signed], "print long"), block_rows=block_rows)
    assert links.count() < 20 * len(prints)  # a forest per bucket, not all pairs
    root = {r["node"]: r["root"] for r in s.components(links).collect()}
    label = slow_components(prints)
    classes = {}
    for k, p in enumerate(signed):
        classes.setdefault(label[k], set()).add(root.get(p, p))
    assert all(len(c) == 1 for c in classes.values()) and len(set.union(*classes.values())) == len(classes)


def test_near_duplicates_against_brute_force(docs_of):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 500, 400)]
    pairs = list(ODD)
    for k in range(20):
        words = list(base)
        words[int(rng.integers(0, 400))] = f"edit{k}"
        pairs.append((100 + k, " ".join(words)))
    pairs += [(200 + k, " ".join(f"v{j}" for j in rng.integers(0, 900, 50))) for k in range(20)]
    rows = s.near_duplicates(docs_of(pairs)).select("doc_id", s.hex_print().alias("p"), "component").collect()
    prints = [slow_fingerprint(t or "") for _, t in pairs]
    label = slow_components(prints)
    least = {}
    for (i, _), c in zip(pairs, label):
        least[c] = min((x for x in (i, least.get(c)) if x is not None), default=None)
    assert sorted(map(repr, ((r[0], r[1], r[2]) for r in rows))) == sorted(
        repr((i, f"{p:016x}", least[c])) for (i, _), p, c in zip(pairs, prints, label))
    docs = docs_of(pairs)
    kept = s.drop_near_duplicates(docs)
    assert kept.schema == docs.schema and kept.count() == len(set(label))


def test_empty_table(docs_of):
    assert s.near_duplicates(docs_of([])).count() == 0
    assert s.drop_near_duplicates(docs_of([])).count() == 0


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(300)], "a long, b long")
    assert {r["root"] for r in s.components(links).collect()} == {0}
