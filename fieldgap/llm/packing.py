"""Packing of token sequences with a fixed number of open windows.

Each task keeps `open_windows` windows. A document's full windows leave at once; its rest goes to
the fullest window that takes it whole (best fit). When none does, the fullest window is topped up
with the head of the rest and emitted, so it carries no padding. At its end a task merges its open
windows, topping up in the same way, and hands on at most one part-filled window. Those are merged
in groups of `MERGE`, round by round, until one is left, which is cut at powers of two and so needs
no padding. Nothing is gathered in one task but fewer than `MERGE` windows.

Defined cases: a null or empty text is the end token alone; rows of one id are separate documents
whose pieces share the id; a null id stays null; an empty table gives no pieces.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import bounded_batches, written

TOKENIZER = "word_bpe_49k.json"
LENGTH = 4096
END_ID = 2
OPEN_WINDOWS = 32
MERGE = 64
ID_BYTES = 4
#: Distinct words whose ids a task remembers.
REMEMBERED = 1 << 19
#: A sequence id is the round of merging, the task and the count in the task, which has so many bits.
TASK_BITS = 24

PIECE = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, open boolean"


@dataclass
class Piece:
    id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.id, self.start, self.ids[: at * ID_BYTES], self.doc_tokens),
            Piece(self.id, self.start + at, self.ids[at * ID_BYTES :], self.doc_tokens),
        )


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)
    used: int = 0

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.used += len(piece)


class Packer:
    """Open windows of one task; `full` collects what is ready to leave."""

    def __init__(self, length: int, open_windows: int):
        self.length, self.limit = length, open_windows
        self.open: list[Window] = []
        self.full: list[Window] = []

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.length:
            head, piece = piece.cut(self.length)
            self.full.append(Window([head], self.length))
        while len(piece):
            room = self.length - len(piece)
            best = max((w for w in self.open if w.used <= room), key=lambda w: w.used, default=None)
            if best is None and len(self.open) < self.limit:
                best = Window()
                self.open.append(best)
            if best is None:  # top up the fullest, emit it, and go on with the rest
                best = max(self.open, key=lambda w: w.used)
                head, piece = piece.cut(self.length - best.used)
                best.put(head)
            else:
                best.put(piece)
                piece = Piece(piece.id, 0, b"", 0)
            if best.used == self.length:
                self.open.remove(best)
                self.full.append(best)

    def merge(self) -> Window | None:
        """Empty the open windows into full ones; return the one that is left."""
        rest = sorted(self.open, key=lambda w: -w.used)
        self.open, last = [], Window()
        for window in rest:
            for piece in window.pieces:
                while len(piece):
                    head, piece = piece.cut(min(len(piece), self.length - last.used))
                    last.put(head)
                    if last.used == self.length:
                        self.full.append(last)
                        last = Window()
        return last if last.used else None


def byte_characters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def word_ids(path: str) -> Callable[[str], bytes]:
    """A text's ids as little-endian 32-bit numbers, equal to the tokenizer's.

    The tokenizer drops white space, never looks across it, lowers letters and splits what remains by a
    pattern before its model sees a word. For characters that need no normalisation but lowering, the
    same split is made here and the model's ids of frequent words are remembered; parts with any
    other character go through the whole tokenizer.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, alphabet = tokenizer.model, byte_characters()
    # The tokenizer's own pattern for the characters of PLAIN, lowered.
    letters = "a-zà-öø-ÿß"
    word = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^\\s0-9{letters}]+")
    plain = re.compile("[\t\n\r\x20-\x7e\u00c0-\u00ff]*")
    spaces = re.compile("[ \t\r\n]+")
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def packed(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes() if len(ids) > 8 else b"".join([i.to_bytes(ID_BYTES, "little") for i in ids])

    class Known(dict):
        def __missing__(self, w: str) -> bytes:
            coded = w if w.isascii() else "".join([alphabet[b] for b in w.encode()])
            found = self[w] = packed([t.id for t in model.tokenize(coded)])
            return found

    known = Known()

    def of_words(text: str) -> bytes:
        return b"".join(map(known.__getitem__, word.findall(text.lower())))

    def is_plain(text: str) -> bool:
        return plain.fullmatch(text) is not None and not any(t in text for t in special)

    def encode(text: str) -> bytes:
        if len(known) > REMEMBERED:
            known.clear()
        if is_plain(text):
            return of_words(text)
        parts = spaces.split(text)
        return b"".join(
            of_words(p) if is_plain(p) else packed(tokenizer.encode(p, add_special_tokens=False).ids) for p in parts
        )

    return encode


def piece_rows(windows: Iterable[tuple[Window, bool]], first: int) -> pa.RecordBatch:
    """Rows of windows in PIECE's order; a window that is handed on keeps its ids."""
    rows: list[tuple] = []
    for n, (window, is_open) in enumerate(windows):
        offset = 0
        for p in window.pieces:
            rows.append((p.id, p.start, len(p), p.ids, p.doc_tokens, first + n, offset, is_open))
            offset += len(p)
    names = [c.split()[0] for c in PIECE.split(", ")]
    types = [{"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[c.split()[1]] for c in PIECE.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 8, types, strict=True)], names
    )


def packed_pieces(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    length: int = LENGTH, end_id: int = END_ID, open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """One row per piece: (id, start, length, ids, doc_tokens, sequence_id, offset).

    `ids` holds the piece's ids as little-endian unsigned 32-bit numbers. Sequence ids are unique:
    round, task, count.
    """
    end = end_id.to_bytes(ID_BYTES, "little")

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, sent, base = word_ids(tokenizer), Packer(length, open_windows), 0, 0

        def leave(more: list[tuple[Window, bool]]) -> pa.RecordBatch:
            nonlocal sent
            ready = [(w, False) for w in packer.full] + more
            packer.full.clear()
            sent += len(ready)
            return piece_rows(ready, base + sent - len(ready))

        for batch in rows:
            if batch.num_rows:
                base = batch.column(0)[0].as_py() << TASK_BITS
            for i, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ids = encode(text or "") + end
                packer.add(Piece(i, 0, ids, len(ids) // ID_BYTES))
            yield leave([])
        last = packer.merge()
        yield leave([(last, True)] if last else [])

    def merge_level(level: int):
        def merged(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows come in order of (group, sequence, offset); a group is MERGE windows at most."""
            packer, group, sent = Packer(length, open_windows), None, 0

            def leave() -> pa.RecordBatch:
                nonlocal sent
                last = packer.merge()
                ready = [(w, False) for w in packer.full] + ([(last, True)] if last else [])
                packer.full.clear()
                first = (group << TASK_BITS) + sent + (level << 56)
                sent = 0
                return piece_rows(ready, first)

            for batch in rows:
                for r in batch.to_pylist():
                    if group is not None and r["g"] != group:
                        yield leave()
                    group = r["g"]
                    packer.add(Piece(r["id"], r["start"], r["ids"], r["doc_tokens"]))
            if group is not None:
                yield leave()

        return merged

    narrow = docs.select(
        F.spark_partition_id().cast("long").alias("task"),
        F.col(id_column).cast("long").alias("id"),
        F.col(text_column).alias("text"),
    )
    rows = written(bounded_batches(narrow).mapInArrow(pack, PIECE), "packed", "zstd")
    done, level = [], 0
    while True:
        left = rows.where("open")
        number = left.select("sequence_id").distinct().count()
        done.append(rows.where("not open"))
        if number <= 1:
            break
        level += 1
        task = F.col("sequence_id").bitwiseAND(F.lit((1 << 56) - 1))
        grouped = left.withColumn("g", F.floor(F.shiftright(task, TASK_BITS) / MERGE).cast("long"))
        rows = written(
            grouped.repartition("g").sortWithinPartitions("g", "sequence_id", "offset").mapInArrow(merge_level(level), PIECE),
            "packed",
            "zstd",
        )

    def powers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cut the one window that is left into lengths that are powers of two."""
        rest = [Piece(r["id"], r["start"], r["ids"], r["doc_tokens"]) for b in batches for r in b.to_pylist()]
        total, ready = sum(map(len, rest)), []
        while total:
            size, window = 1 << (total.bit_length() - 1), Window()
            while window.used < size:
                head, tail = rest[0].cut(min(len(rest[0]), size - window.used))
                window.put(head)
                rest[:1] = [tail] if len(tail) else []
            ready.append((window, False))
            total -= size
        yield piece_rows(ready, (level + 1) << 56)

    out = rows.where("open").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(powers, PIECE)
    for part in done:
        out = out.unionByName(part)
    return out.drop("open")


