"""Near duplicates by SimHash, compared bit-sliced.

Fingerprints are 64 votes over word shingles. Two of them within `radius` bits agree on at least
`m - radius` of m bit ranges, so every choice of that many ranges is a table and equal bits there a
bucket; with m taken from the number of distinct fingerprints a bucket holds about 64 by chance.
Inside a bucket fingerprints lie vertically, 64 to a word: plane p holds bit p of 64 members. One
member is compared with a whole word by XOR with its own bit; carry-save adders count the differing
planes of all 64 lanes at once, and words whose lanes are all beyond the radius are given up.

A bucket beyond `BLOCK` members is dealt into chunks by hash, and chunk pairs are compared in tasks
of their own, so a group of many thousand near copies is neither one task nor a list of all its
pairs: a task emits one edge per member to the smallest member it is connected to.

Defined cases: no words or a null text give fingerprint zero, which is linked like any other; rows
with a null id come last and take part; equal rows share a component; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgap.llm.common import LAST_ID, bounded_batches, ordered_id, text_key, written

BITS = 64
SHINGLE_SEED = 42
#: Members of a bucket that one task compares with each other.
BLOCK = 4096
#: Members per bucket to aim at when choosing the number of bit ranges.
PER_BUCKET = 64
#: (member, word) pairs that are counted together.
PAIRS_AT_ONCE = 1 << 15
VOTES_AT_ONCE = 1 << 16


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Words are maximal runs without ASCII white space; A-Z is lowered, other letters are kept."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    width = min(shingle, len(words))
    digest = partial(xxhash.xxh64_intdigest, seed=SHINGLE_SEED)
    n = len(words) - width + 1
    votes = np.zeros(BITS, np.int64)
    for first in range(0, n, VOTES_AT_ONCE):
        last = min(n, first + VOTES_AT_ONCE)
        spans = zip(starts[first:last], ends[first + width - 1 : last + width - 1], strict=True)
        hashes = np.fromiter((digest(joined[a:b]) for a, b in spans), np.uint64, last - first)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    ones = np.packbits((2 * votes > n).astype(np.uint8), bitorder="little")
    return int(ones.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4) -> DataFrame:
    """One row per row: (id, key of the text, fingerprint)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            marks = [text_fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(marks, pa.int64())], ["id", "tid", "fp"]
            )

    narrow = docs.select(
        F.col(id_column).cast("long").alias("id"), text_key(text_column).alias("tid"), F.col(text_column).alias("text")
    )
    return bounded_batches(narrow).mapInArrow(batches, "id long, tid long, fp long")


def bit_ranges(count: int, radius: int) -> list[int]:
    """Masks of the tables: any two fingerprints within the radius agree under at least one."""
    ranges = radius + 1
    while count > PER_BUCKET << (BITS * (ranges - radius) // ranges) and ranges < 2 * radius + 2:
        ranges += 1
    borders = [BITS * i // ranges for i in range(ranges + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, ranges - radius)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def vertical(members: np.ndarray) -> np.ndarray:
    """Bit planes: row p, word w holds bit p of members 64w to 64w+63."""
    planes = np.empty((BITS, len(members) // BITS), np.uint64)
    for p in range(BITS):
        bits = ((members >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        planes[p] = np.packbits(bits.reshape(-1, BITS), axis=1, bitorder="little").view(np.uint64)[:, 0]
    return planes


def beyond(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose vertical counter is larger than the radius."""
    more, equal = over.copy(), ~over
    for i in reversed(range(len(counter))):
        if radius >> i & 1:
            equal &= counter[i]
        else:
            more |= equal & counter[i]
            equal &= ~counter[i]
    return more


def close_lanes(
    planes: np.ndarray, member: np.ndarray, word: np.ndarray, lanes: np.ndarray, bits: list[int], radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the (member, word) pairs with lanes within the radius, and those lanes.

    Three planes go through a full adder; its sum and carry are added to the counters, whose
    overflow sticks. Pairs with no lane left are dropped every few planes.
    """
    kept = np.arange(len(member))
    counter = [np.zeros(len(member), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(member), np.uint64)
    lanes = lanes.copy()

    def add(value: np.ndarray, weight: int) -> None:
        for i in range(weight, len(counter)):
            counter[i], value = counter[i] ^ value, counter[i] & value
        over[:] |= value

    for step in range(0, len(bits), 3):
        differ = []
        for p in bits[step : step + 3]:
            own = np.negative((member >> np.uint64(p)) & np.uint64(1))
            differ.append(planes[p, word] ^ own)
        if len(differ) == 3:
            a, b, c = differ
            either = a ^ b
            add(either ^ c, 0)
            add((a & b) | (c & either), 1)
        else:
            for value in differ:
                add(value, 0)
        if step % 9 == 6 or step + 3 >= len(bits):
            lanes &= ~beyond(counter, over, radius)
            alive = np.flatnonzero(lanes)
            if len(alive) < 0.9 * len(lanes):
                kept, member, word, lanes, over = kept[alive], member[alive], word[alive], lanes[alive], over[alive]
                counter = [c[alive] for c in counter]
            if not len(kept):
                break
    return kept, lanes


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i]; labels become the smallest index of a class."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label[:] = jumped


def pair_plan(sizes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which member meets which word.

    sizes: members per group; left: how many of them are the first chunk of a chunk pair, 0 where the
    group is compared with itself. Returns member positions, words and the first lane that counts.
    Every group starts at a new word, and so does the second chunk of a pair.
    """
    members, words, firsts = [], [], []
    base = 0
    for size, head in zip(sizes.tolist(), left.tolist(), strict=True):
        if head:
            start = base + -(-head // BITS)
            own = np.arange(head)
            there = np.arange(start, start + -(-(size - head) // BITS))
            members.append(np.repeat(base * BITS + own, len(there)))
            words.append(np.tile(there, head))
            firsts.append(np.zeros(head * len(there), np.int64))
            base = there[-1] + 1 if len(there) else start
        else:
            own, count = np.arange(size), -(-size // BITS)
            reach = count - own // BITS
            total = np.repeat(np.cumsum(reach) - reach, reach)
            step = np.arange(reach.sum()) - total
            who = np.repeat(own, reach)
            members.append(base * BITS + who)
            words.append(base + who // BITS + step)
            firsts.append(np.where(step == 0, who % BITS + 1, 0))
            base += count
    return np.concatenate(members), np.concatenate(words), np.concatenate(firsts)


def linked(groups: list[tuple[np.ndarray, int]], mask: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, smaller linked one) of groups of one table."""
    spots, at = [], 0
    for fps, head in groups:
        for part in (fps[:head], fps[head:]) if head else (fps,):
            spots.append((at, part))
            at += -(-len(part) // BITS) * BITS
    lane = np.zeros(at, np.uint64)
    valid = np.zeros(at, bool)
    for start, part in spots:
        lane[start : start + len(part)] = part
        valid[start : start + len(part)] = True
    planes = vertical(lane)
    filled = np.packbits(valid.reshape(-1, BITS), axis=1, bitorder="little").view(np.uint64)[:, 0]
    member, word, first = pair_plan(np.array([len(f) for f, _ in groups]), np.array([h for _, h in groups]))
    bits = [p for p in range(BITS) if not mask >> p & 1]
    label = np.arange(at)
    every = np.uint64(2**64 - 1)
    for s in range(0, len(member), PAIRS_AT_ONCE):
        m, w, f = (x[s : s + PAIRS_AT_ONCE] for x in (member, word, first))
        lanes = filled[w] & np.where(f >= BITS, np.uint64(0), every << np.minimum(f, BITS - 1).astype(np.uint64))
        some = np.flatnonzero(lanes)
        kept, close = close_lanes(planes, lane[m[some]], w[some], lanes[some], bits, radius)
        for t in range(0, len(kept), 4096):  # at most 64 links each
            k, c = kept[t : t + 4096], close[t : t + 4096]
            pair, offset = np.nonzero(np.unpackbits(c.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            connect(label, m[some][k][pair], w[some][k][pair] * BITS + offset)
    moved = np.flatnonzero(label != np.arange(at))
    return lane[moved].view(np.int64), lane[label[moved]].view(np.int64)


def bucket_edges(masks: list[int], radius: int):
    """Read buckets in order, hold as many as fit a block, and compare them."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def compared(columns: list[np.ndarray], borders: np.ndarray) -> Iterator[pa.RecordBatch]:
            waiting: dict[int, tuple[int, list]] = {}

            def flush(t: int) -> pa.RecordBatch:
                a, b = linked(waiting.pop(t)[1], masks[t], radius)
                return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

            for a, b in zip(borders, borders[1:], strict=False):
                t, i, j = int(columns[0][a]), columns[2][a], columns[3][a]
                head = int((columns[4][a:b] == i).sum()) if i != j else 0
                if b - a < 2 or i != j and head in (0, b - a):
                    continue
                size, groups = waiting.get(t, (0, []))
                groups.append((columns[5][a:b].view(np.uint64), head))
                waiting[t] = (size + b - a, groups)
                if size + b - a >= BLOCK:
                    yield flush(t)
            for t in list(waiting):
                yield flush(t)

        for batch in rows:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            change = np.zeros(len(columns[0]) - 1, bool)
            for c in columns[:4]:
                change |= c[1:] != c[:-1]
            borders = np.concatenate([[0], np.flatnonzero(change) + 1])
            yield from compared(columns, borders)
            held = [c[borders[-1] :].copy() for c in columns]
        if held is not None:
            yield from compared(held, np.array([0, len(held[0])]))

    return batches


def near_edges(marks: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) between distinct fingerprints; their components are those of all links."""
    masks = bit_ranges(marks.count(), radius)
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(masks)]))
    members = marks.select("fp", tables.alias("x")).select("x.t", "x.key", "fp")
    large = (
        members.groupBy("t", "key").count().where(F.col("count") > block)
        .select("t", "key", F.ceil(F.col("count") / block).cast("int").alias("chunks"))
    )
    dealt = (
        members.join(large, ["t", "key"], "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("t", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", "fp")
    )
    return (
        dealt.repartition("t", "key", "i", "j")
        .sortWithinPartitions("t", "key", "i", "j", "c", "fp")
        .mapInArrow(bucket_edges(masks, radius), "u long, v long")
        .distinct()
    )


def smallest_reachable(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node with an edge, by alternating large and small stars.

    Each round hangs neighbours on the smallest one known, written to the shared folder. Minima
    are taken with map-side combining and joined back, so a node with very many neighbours is no
    single task.
    """

    def star(directed: DataFrame) -> DataFrame:
        least = directed.groupBy("u").agg(F.min("v").alias("m"))
        return directed.join(least, "u")

    now, seen = written(edges.where("u <> v"), label), None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        hung = star(down)
        small = (
            hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(hung.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = written(small, label)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, radius: int = 4,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row: (id, tid, fp, root, component).

    The component is the smallest id reachable over links, null where no member has an id; `root`
    names the component by a fingerprint; `tid` tells rows of one id with different texts apart.
    """
    rows = written(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    marks = rows.groupBy("fp").agg(F.min(ordered_id("id")).alias("least"))
    roots = smallest_reachable(near_edges(marks.select("fp"), radius, block))
    members = roots.select(F.col("node").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct()
    )
    first = members.join(marks, "fp").groupBy("root").agg(F.min("least").alias("component"))
    linked_marks = members.join(first, "root").select("fp", "root", "component")
    of_mark = marks.join(linked_marks, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "least").alias("component")
    )
    # Written, so that a fingerprint of very many rows can be split in the join.
    return rows.join(written(of_mark, "labels"), "fp").select(
        "id", "tid", "fp", "root", F.when(F.col("component") < LAST_ID, F.col("component")).alias("component")
    )


def one_per_group(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """Keep, with all columns, one row per component: that of the smallest id (then of the smallest text key)."""
    found = near_duplicates(docs, id_column, text_column, shingle, radius)
    first = found.groupBy("root").agg(F.min(F.struct(ordered_id("id").alias("rid"), "tid")).alias("first"))
    kept = first.select("first.rid", "first.tid")
    keyed = docs.select(
        F.struct("*").alias("row"), ordered_id(id_column).alias("rid"), text_key(text_column).alias("tid")
    )
    again = F.row_number().over(Window.partitionBy("rid", "tid").orderBy(F.xxhash64("row")))
    return keyed.join(kept, ["rid", "tid"], "left_semi").withColumn("n", again).where("n = 1").select("row.*")
