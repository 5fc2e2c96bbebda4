"""SimHash near duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldgap.llm import simhash
from fieldgap.llm.queries import QUERIES


def slow_fingerprint(text, size=4):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\r\x0b\x0c":
            if word:
                words.append(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(marks, radius):
    """Smallest id reachable, for a list of (id, fingerprint)."""
    parent = list(range(len(marks)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i][1] ^ marks[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(marks):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(marks))]


TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs",
    "the QUICK brown\tfox  jumps over the lazy dog and runs",
    "Straße Ünï çode wörds İ here are some more",
    "three words only",
    "one",
    "",
    None,
    " \n\t ",
    "a b c d\x0be f\x0cg",
    "x " * 5000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.text_fingerprint(text, 4) % 2**64 == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 6])
def test_bit_sliced_comparison(radius):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(30)]
    members = set()
    for b in base:
        for _ in range(8):
            for p in draw.sample(range(64), draw.randint(0, 5)):
                b ^= 1 << p
            members.add(b)
    own = np.array(sorted(members), np.uint64)
    for head in (0, 100):
        u, v = simhash.linked([(own, head)], 0, radius)
        pairs = [(i, j) for i in range(len(own)) for j in range(i) if not head or (j < head <= i)]
        expected = components(len(own), [(i, j) for i, j in pairs if (int(own[i]) ^ int(own[j])).bit_count() <= radius])
        at = {int(x): i for i, x in enumerate(own)}
        found = components(len(own), [(at[int(a) % 2**64], at[int(b) % 2**64]) for a, b in zip(u, v, strict=True)])
        assert found == expected


def components(n, edges):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


@pytest.mark.parametrize("count", [10, 10**6, 10**9, 10**12])
def test_close_fingerprints_share_a_table(count):
    masks = simhash.bit_ranges(count, 4)
    draw = random.Random(1)
    for _ in range(500):
        difference = sum(1 << p for p in draw.sample(range(64), 4))
        assert any(difference & m == 0 for m in masks)


@pytest.mark.parametrize("block", [4, 4096])
def test_components_of_fingerprints(spark, block):
    """Chains, hot buckets split into chunks, and lonely ones."""
    draw = random.Random(3)
    marks = []
    for _ in range(15):
        b = draw.getrandbits(64)
        for _ in range(draw.randint(1, 25)):
            marks.append(b)
            for p in draw.sample(range(64), draw.randint(0, 6)):
                b ^= 1 << p
    frame = spark.createDataFrame([(m - 2**64 if m >> 63 else m,) for m in sorted(set(marks))], "fp long")
    edges = simhash.near_edges(frame, 4, block)
    roots = {r["node"]: r["root"] for r in simhash.smallest_reachable(edges).collect()}
    values = [r["fp"] for r in frame.collect()]
    own = [(i, v % 2**64) for i, v in enumerate(values)]
    expected = slow_components(own, 4)
    groups, got = {}, {}
    for i, v in enumerate(values):
        groups.setdefault(expected[i], set()).add(v)
        got.setdefault(roots.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def some_texts():
    draw = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(0, 200))]
        rows.append((i * 10, " ".join(words)))
        for j in range(draw.randint(0, 3)):
            other = list(words)
            if other and j:
                other[draw.randrange(len(other))] = "changed"
            rows.append((i * 10 + j + 1, " ".join(other)))
    return rows


def test_query_against_brute_force(spark, docs_of, tables):
    rows = some_texts() + [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b"), (1003, "A  b")]
    folder = tables(documents=docs_of(rows))
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in QUERIES["op2_simhash_near_dedup"](spark, folder).collect())
    marks = [(i, slow_fingerprint(t)) for i, t in rows]
    expected = sorted((i, f"{f:016x}", c) for (i, f), c in zip(marks, slow_components(marks, 4), strict=True))
    assert got == expected


def test_query_on_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    marks = [(i, slow_fingerprint(t)) for i, t in rows]
    expected = sorted((i, f"{f:016x}", c) for (i, f), c in zip(marks, slow_components(marks, 4), strict=True))
    got = QUERIES["op2_simhash_near_dedup"](spark, folder)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_one_document_per_group(docs_of):
    docs = docs_of([(5, "a b c d e"), (3, "A b c d e"), (9, "z y x w v u"), (None, "a b c d e"), (9, "z y x w v u"), (None, None), (None, "")])
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"]) == [(3, "A b c d e"), (9, "z y x w v u")]
    assert kept.where("doc_id is null").count() == 1


def test_missing_ids_and_empty_table(docs_of):
    found = simhash.near_duplicates(docs_of([(None, "q w e r t"), (4, "Q w e r t"), (None, "lonely text stands here alone")]))
    assert sorted(((r["id"], r["component"]) for r in found.collect()), key=str) == [(4, 4), (None, 4), (None, None)]
    assert simhash.near_duplicates(docs_of([(1, "x")]).where(F.lit(False))).count() == 0
    assert simhash.one_per_group(docs_of([(1, "x")]).where(F.lit(False))).count() == 0
