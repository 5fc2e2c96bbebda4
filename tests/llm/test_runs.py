"""Periodic runs against every period at every place."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldgap.llm import queries, runs


def brute(words, min_length=24, times=3):
    """Every maximal stretch of every period; those with a smaller period of their own go."""
    n, found = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(min_length, times * q):
                part = words[start : start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.add((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@st.composite
def texts(draw):
    words = []
    for _ in range(draw(st.integers(0, 5))):
        block = draw(st.lists(st.integers(0, draw(st.sampled_from([1, 2, 30]))), min_size=1, max_size=9))
        words += block * draw(st.integers(1, 12)) + block[: draw(st.integers(0, len(block)))]
    return words[:200]


@settings(max_examples=600, deadline=None)
@given(st.lists(texts(), max_size=4), st.sampled_from([1, 6, 24]))
def test_runs_equal_brute_force(many, min_length):
    codes = [np.array(t, np.int64) for t in many]
    window = 1 << (runs.least_depth(min_length, 3).bit_length() - 1)
    expected = [brute(t, min_length) for t in many]
    assert runs.runs_of(codes, min_length, 3) == expected
    if codes:
        assert all(flag or not e for flag, e in zip(runs.repeats_windows(codes, window), expected, strict=True))


def test_long_and_hard_texts():
    """One word, a long period, a Fibonacci word, and a line among ever other neighbours."""
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    line = [x for i in range(2000) for x in (1000 + i, *range(30), 9000 + i)]
    got = runs.runs_of([np.zeros(50_000, np.int64), np.arange(60_000) % 777, np.array(b), np.array(line)], 24, 3)
    assert got[0] == [(0, 50_000, 1)] and got[1] == [(0, 60_000, 777)] and got[3] == []
    assert got[2] == brute(b)


def test_exponents_below_three_are_refused():
    with pytest.raises(ValueError):
        runs.least_depth(24, 2)


def test_odd_rows(docs_of):
    cycle = " ".join(["a", "b"] * 20)
    rows = [(1, None), (2, ""), (3, cycle), (3, cycle), (None, "\t x y \n"), (5, "w " * 30_000), (6, "once " + cycle)]
    found = runs.periodic_runs(docs_of(rows)).collect()
    assert len(found) == len(rows)
    got = {r["id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found}
    assert got[1] == got[2] == (0, [], "")
    assert got[3] == (40, [(0, 40, 2)], "a b") and sum(r["id"] == 3 for r in found) == 2
    assert got[None] == (1, [], "x y")
    assert got[5] == (30_000, [(0, 30_000, 1)], "w")
    assert got[6] == (41, [(1, 40, 2)], "once a b")
    assert runs.periodic_runs(docs_of([])).count() == 0


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (
        len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_query_on_a_small_table(spark, docs_of, tables):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3 + i % 9, rng.integers(0, 200)))) for i in range(400)]
    rows += [(500, None), (501, "  "), (502, "x\t" * 33)]
    found = queries.op12_periodic_runs(spark, tables(documents=docs_of(rows))).collect()
    texts = dict(rows)
    assert len(found) == len(rows) and sum(r["n_runs"] for r in found) > 10
    for r in found:
        got = (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"])
        assert got == expected_row(r["doc_id"], texts[r["doc_id"]])
