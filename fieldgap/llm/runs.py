"""Stretches of words that repeat with a period, found as maximal pairs in the tree of LCP intervals.

A maximal pair is two places i < j of a text whose next `depth` words are equal, whose words after these
differ and whose words before i and j differ. With q = j - i and depth >= 2 q the words from i to
j + depth have period q, and since the pair is maximal on both sides no neighbouring word extends them:
pairs whose distance meets the length constraints are exactly the runs. Of pairs with the same stretch
the smallest distance is the period.

The suffixes of a text are sorted by doubling; intervals of the sorted suffixes that share `depth` words
are the nodes of the tree, visited bottom-up. A node keeps its places in lists by the word before them
(left-word classes). Where children meet, a place is paired only if its class differs, and only with
the nearest place on either side: two places one period apart have none between them, since that
would make the period smaller. Places of the smaller child are looked up and moved, so a text of n
words takes n log n steps however often it repeats.

Two places of a run share at least `least_depth` words. Texts without two equal windows of that many
words, told by a rolling hash that misses none, are not sorted at all.

Defined cases: words are runs of bytes other than space and \\t to \\r; null and empty texts have no
words and collapse to the empty text; rows of one id are separate rows; a null id stays null; an
empty table gives none. Memory is an Arrow batch's or one text's.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import bounded_batches

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Words whose suffixes are sorted together; a longer text is sorted alone.
STACK = 1 << 19
#: Places are bits of blocks.
BLOCK = 10
WITHIN = (1 << BLOCK) - 1

Run = tuple[int, int, int]


def least_depth(min_length: int, min_exponent: int) -> int:
    """The fewest words that two places of a run, one period apart, share."""
    if min_exponent < 3:
        raise ValueError("runs are found from three periods on")
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


class Places:
    """The places of a node in text order, and in lists by the word before them."""

    __slots__ = ("blocks", "lists", "size", "top")

    def __init__(self, place: int, left: int):
        self.blocks = {place >> BLOCK: 1 << (place & WITHIN)}
        self.top = 1 << (place >> BLOCK)
        self.lists = {left: [place]}
        self.size = 1

    def after(self, place: int) -> int:
        """The nearest place behind; -1 if none."""
        b = place >> BLOCK
        rest = self.blocks.get(b, 0) >> ((place & WITHIN) + 1)
        if rest:
            return place + (rest & -rest).bit_length()
        rest = self.top >> (b + 1)
        if not rest:
            return -1
        b += (rest & -rest).bit_length()
        first = self.blocks[b]
        return (b << BLOCK) + (first & -first).bit_length() - 1

    def before(self, place: int) -> int:
        """The nearest place in front; -1 if none."""
        b = place >> BLOCK
        rest = self.blocks.get(b, 0) & ((1 << (place & WITHIN)) - 1)
        if not rest:
            b = (self.top & ((1 << b) - 1)).bit_length() - 1
            if b < 0:
                return -1
            rest = self.blocks[b]
        return (b << BLOCK) + rest.bit_length() - 1

    def take(self, other: Places) -> None:
        """Move all places of another node here."""
        for left, places in other.lists.items():
            own = self.lists.get(left)
            if own is None:
                self.lists[left] = places
            elif len(own) < len(places):
                places.extend(own)
                self.lists[left] = places
            else:
                own.extend(places)
        for b, bits in other.blocks.items():
            self.blocks[b] = self.blocks.get(b, 0) | bits
        self.top |= other.top
        self.size += other.size


class PairFinder:
    """Maximal pairs of nodes that meet; `period` holds the smallest distance of each (start, length)."""

    def __init__(self, left: list[int], min_length: int, min_exponent: int):
        self.left, self.min_length, self.times = left, min_length, min_exponent - 1
        self.period: dict[tuple[int, int], int] = {}

    def pair(self, i: int, j: int, depth: int) -> None:
        q = j - i
        if depth >= self.times * q and depth + q >= self.min_length and self.left[i] != self.left[j]:
            stretch = (i, depth + q)
            self.period[stretch] = min(q, self.period.get(stretch, q))

    def meet(self, a: Places, b: Places, depth: int) -> Places:
        """One node of two children that share `depth` words."""
        if a.size < b.size:
            a, b = b, a
        only = next(iter(a.lists)) if len(a.lists) == 1 else None
        reach = depth // self.times
        for left, places in b.lists.items():
            if left == only:  # the other child has no other class
                continue
            for p in places:
                q = a.after(p)
                if 0 <= q <= p + reach:
                    self.pair(p, q, depth)
                q = a.before(p)
                if 0 <= q and p <= q + reach:
                    self.pair(q, p, depth)
        a.take(b)
        return a

    def tree(self, places: list[int], shared: list[int]) -> None:
        """Visit the nodes over sorted suffixes, of which k - 1 and k share `shared[k]` words."""
        open_nodes: list[tuple[int, Places]] = []
        node = Places(places[0], self.left[places[0]])
        for place, depth in zip(places[1:], shared[1:], strict=True):
            while open_nodes and open_nodes[-1][0] > depth:
                at, begun = open_nodes.pop()
                node = self.meet(begun, node, at)
            if open_nodes and open_nodes[-1][0] == depth:
                node = self.meet(open_nodes.pop()[1], node, depth)
            open_nodes.append((depth, node))
            node = Places(place, self.left[place])
        while open_nodes:
            at, begun = open_nodes.pop()
            node = self.meet(begun, node, at)


def sorted_suffixes(code: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, and how many words each shares with the one before; below `least` 0.

    A place's rank is where its group begins in that order. Each round sorts the groups that still have
    several members by the rank of what follows, and keeps the ranks for the shared lengths.
    """
    n = len(code)
    order = np.argsort(code, kind="stable")
    rank, old = np.zeros(n, np.int64), np.zeros(n, np.int64)
    active, follows, step, rounds = order, code[order], 1, []
    while True:
        group = old[active]
        begins = np.ones(len(active), bool)
        begins[1:] = (group[1:] != group[:-1]) | (follows[1:] != follows[:-1])
        outer = np.ones(len(active), bool)
        outer[1:] = group[1:] != group[:-1]
        at = np.arange(len(active))
        shift = np.maximum.accumulate(np.where(begins, at, 0)) - np.maximum.accumulate(np.where(outer, at, 0))
        rank[active] = group + shift
        rounds.append(rank.astype(np.int32))
        alone = begins & np.append(begins[1:], True)
        active = active[~alone]
        if not len(active):
            break
        old = rank.copy()
        behind = active + step
        follows = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        order = np.lexsort((follows, rank[active]))
        active, follows, step = active[order], follows[order], 2 * step
    places = np.empty(n, np.int64)
    places[rank] = np.arange(n)
    shared = np.zeros(n, np.int64)
    near = rounds[min(len(rounds), least.bit_length()) - 1]
    k = np.flatnonzero(near[places[1:]] == near[places[:-1]]) + 1
    one, two, length = places[k - 1], places[k], np.zeros(len(k), np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        i, j = one + length, two + length
        inside = (i < n) & (j < n)
        ranks = rounds[level]
        equal = inside & (ranks[np.where(inside, i, 0)] == ranks[np.where(inside, j, 0)])
        length += equal.astype(np.int64) << level
    shared[k] = np.where(length >= least, length, 0)
    return places, shared


def runs_of(texts: list[np.ndarray], min_length: int, min_exponent: int) -> list[list[Run]]:
    """Runs (start, length, period) of texts of word codes, by start and period. Places of different texts share nothing."""
    least = least_depth(min_length, min_exponent)
    starts = np.cumsum([0, *map(len, texts)])
    found: list[list[Run]] = [[] for _ in texts]
    code = np.concatenate([np.zeros(0, np.int64), *texts])
    if not len(code):
        return found
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    places, shared = sorted_suffixes(owner * (int(code.max()) + 1) + code, least)
    left = np.append(-1, code[:-1])
    left[starts[:-1][np.diff(starts) > 0]] = -1
    finder = PairFinder(left.tolist(), min_length, min_exponent)
    # Suffixes that share enough words stand in stretches; each is a tree of its own.
    bound = np.flatnonzero(np.diff(np.concatenate([[0], shared > 0, [0]])))
    for first, end in zip(bound[::2] - 1, bound[1::2], strict=True):
        finder.tree(places[first:end].tolist(), shared[first:end].tolist())
    for (start, length), period in sorted(finder.period.items(), key=lambda x: (x[0][0], x[1])):
        n = int(owner[start])
        found[n].append((start - int(starts[n]), length, period))
    return found


def repeats_windows(texts: list[np.ndarray], size: int) -> np.ndarray:
    """Which texts may hold an equal window of `size` words twice: none is missed. `size` is a power of two."""
    lengths = np.array([len(t) for t in texts], np.int64)
    code = np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    odd, other = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(29))) * odd
        return x ^ (x >> np.uint64(32))

    value, step = mixed(code + np.uint64(1)), 1
    while step < size:
        value = mixed(value[: max(0, len(value) - step)] * other + value[step:])
        step *= 2
    inside = np.arange(len(value)) + size <= np.cumsum(lengths)[owner[: len(value)]]
    owner = owner[: len(value)][inside]
    value = value[inside] ^ mixed(owner.astype(np.uint64) + odd)
    order = np.argsort(value)
    same = value[order[1:]] == value[order[:-1]]
    flags = np.zeros(len(texts), bool)
    flags[owner[order[1:][same]]] = True
    return flags


class Codes(dict):
    """Numbers of words, in the order they come."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k])


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """(id, n_words, runs, collapsed), one row per row; runs are structs (start, length, period) by start, then period."""
    least = least_depth(min_length, min_exponent)
    window = 1 << (least.bit_length() - 1)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            known, codes, plain = Codes(), [], []
            for text in batch.column(1).to_pylist():
                words = text.encode().split() if text else []
                codes.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                plain.append(b" ".join(words))
            runs: dict[int, list[Run]] = defaultdict(list)
            several = np.flatnonzero(repeats_windows(codes, window))
            part = np.cumsum([len(codes[n]) for n in several]) // STACK
            for k in np.unique(part):
                stack = several[part == k].tolist()
                runs.update(zip(stack, runs_of([codes[n] for n in stack], min_length, min_exponent), strict=True))
            out = [collapsed(t.split(), runs[n]) if n in runs and runs[n] else t for n, t in enumerate(plain)]
            ends = np.cumsum([0, *(len(runs[n]) if n in runs else 0 for n in range(len(plain)))], dtype=np.int32)
            flat = [r for n in range(len(plain)) if n in runs for r in runs[n]]
            columns = list(zip(*flat, strict=True)) or [(), (), ()]
            struct = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, codes), pa.int64()),
                    pa.ListArray.from_arrays(ends, struct),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return bounded_batches(narrow).mapInArrow(
        batches, "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
