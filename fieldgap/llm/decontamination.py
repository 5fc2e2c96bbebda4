"""Benchmark words in documents, found by Wu-Manber search over words.

Windows of equal length form a search: the shift table says for the last block of two words how far
the window may move without missing an occurrence, blocks at a window's end choose a bucket by hash,
and the bucket's windows are compared word by word. Windows shorter than the usual length (whole
short items) are searched by length, so they do not spoil the shifts of the others.

Items are split into blocks of at most `BLOCK_BYTES` text by a hash of the row; each block is
broadcast on its own and every task searches its documents block by block, so neither the driver nor
a worker holds more than one block whatever the size of the benchmark. Documents are not shuffled.

Defined cases: null or empty texts have no words; a text without words is never contaminated; items
of one id count once; items without an id hit words but are not listed; an empty benchmark hits
nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import bounded_batches

WINDOW = 13
BLOCK_BYTES = 32 << 20
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


class Search:
    """Windows of one length: shift table over blocks of words, buckets by the block at the end."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.windows: dict[tuple[int, ...], set] = {}
        self.shift: dict = {}
        self.bucket: dict[object, list[tuple[int, ...]]] = {}

    def add(self, window: tuple[int, ...], item: object) -> None:
        known = self.windows.get(window)
        if known is not None:
            known.add(item)
            return
        self.windows[window] = {item}
        for end in range(self.block, self.length + 1):
            key = window[end - self.block : end]
            self.shift[key] = min(self.shift.get(key, self.length), self.length - end)
        self.bucket.setdefault(window[-self.block :], []).append(window)

    def run(self, ids: list[int], found: Callable[[int, set], None]) -> None:
        """Call found(first word, items) for every occurrence, from left to right."""
        length, n = self.length, len(ids)
        far = length - self.block + 1
        shift, bucket, windows = self.shift, self.bucket, self.windows
        if self.block == 1:
            for at, word in enumerate(ids):
                if (word,) in windows:
                    found(at, windows[(word,)])
            return
        end = length
        while end <= n:
            key = (ids[end - 2], ids[end - 1])
            step = shift.get(key, far)
            if step:
                end += step
                continue
            text = tuple(ids[end - length : end])
            for window in bucket[key]:
                if window == text:
                    found(end - length, windows[window])
            end += 1


class Matcher:
    """All windows of one block of items."""

    def __init__(self, items: list[tuple], length: int):
        self.number: dict[str, int] = {}
        self.search: dict[int, Search] = {}
        for item, text in items:
            words = words_of(text)
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            size = min(length, len(ids))
            if size:
                search = self.search.setdefault(size, Search(size))
                for i in range(len(ids) - size + 1):
                    search.add(tuple(ids[i : i + size]), item)

    def hits(self, words: list[str], hit: bytearray, items: set) -> None:
        """Mark the words inside occurrences; add the items that have any."""
        number = self.number
        ids = [number.get(w, 0) for w in words]
        for size, search in self.search.items():

            def found(at: int, owners: set, size: int = size) -> None:
                hit[at : at + size] = b"\x01" * size
                items.update(owners)

            search.run(ids, found)


def item_blocks(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int) -> list[Broadcast]:
    """The items in broadcasts of about `block_bytes` text each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_column).alias("item"), F.col(text_column).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    held = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        held.append(spark.sparkContext.broadcast([(r["item"], r["text"]) for r in rows]))
    return held


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row: (id, n_words, n_hit, items), items sorted as strings."""
    blocks = item_blocks(benchmark, item_column, item_text, block_bytes)
    schema = "id long, n_words long, n_hit long, items array<string>"

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counted in searched(rows, blocks, window, 1):
            n, hit, items = zip(*counted, strict=True) if counted else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string()))],
                ["id", "n_words", "n_hit", "items"],
            )

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return bounded_batches(narrow).mapInArrow(batches, schema)


def searched(
    rows: Iterator[pa.RecordBatch], blocks: list[Broadcast], window: int, column: int
) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, list[str]]]]]:
    """Each batch with (words, hit words, items) of its texts."""
    only = Matcher(blocks[0].value, window) if len(blocks) == 1 else None
    for batch in rows:
        texts = [words_of(t) for t in batch.column(column).to_pylist()]
        marks = [bytearray(len(w)) for w in texts]
        owners: list[set] = [set() for _ in texts]
        for block in blocks:
            matcher = only or Matcher(block.load_from_path(block._path) if block._path else block.value, window)
            for words, hit, items in zip(texts, marks, owners, strict=True):
                matcher.hits(words, hit, items)
        yield batch, [
            (len(w), sum(h), sorted(str(i) for i in o if i is not None))
            for w, h, o in zip(texts, marks, owners, strict=True)
        ]


def contaminated(n_words: int, n_hit: int) -> bool:
    """At least one word in twenty lies inside a benchmark window."""
    return n_hit > 0 and 20 * n_hit >= n_words


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows, with all columns, whose text is not contaminated."""
    blocks = item_blocks(benchmark, item_column, item_text, block_bytes)
    column = docs.columns.index(text_column)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counted in searched(rows, blocks, window, column):
            yield batch.filter(pa.array([not contaminated(n, hit) for n, hit, _ in counted], pa.bool_()))

    return bounded_batches(docs).mapInArrow(batches, docs.schema)
