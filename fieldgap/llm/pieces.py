"""Encoding and decoding with SentencePiece vocabularies of the merge type.

A text's symbols are its characters. An agenda holds the pairs of neighbours that form a piece, the
one with the highest score first and of equal scores the leftmost; taking a pair makes it one symbol
and puts its two new pairs on the agenda. What is no piece in the end is spelled in byte pieces.
A merge never joins two characters that stand side by side in no piece. Texts are therefore cut at all such
places; the parts are encoded on their own, and short parts are remembered in a bounded table. Parts of several
texts are numbered together, so that a part is looked up once for all its occurrences and their ids are gathered
as one array. A vocabulary whose pieces hold all such pairs gets whole texts.

In each Arrow batch the library encodes and decodes the same texts. `agrees` says whether ids and
decoded text are equal; where they are not, the library's are returned.

Defined cases: null and empty texts have no ids and decode to the empty text; rows of one id are
separate rows; a null id stays null; an empty table gives none. Memory is a batch's.
"""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import bounded_batches

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: What the library writes for the unknown piece.
UNKNOWN = " ⁇ "
#: Parts a task remembers, and their longest.
REMEMBERED, LONGEST = 1 << 19, 64
#: Characters of texts that are encoded together.
TOGETHER = 2 << 20
#: Characters whose neighbours are looked at together.
BLOCK = 1 << 18
IDS = np.dtype("<i4")
#: The rank of what is no pair.
NEVER = np.iinfo(np.int32).max
#: Slots that tell most pairs that are not in a set from those that may be, and what spreads pairs over them.
SLOT_BITS, SPREAD = 20, np.uint64(0x9E3779B97F4A7C15)


def slots(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64, copy=False) * SPREAD) >> np.uint64(64 - SLOT_BITS)


def neighbours(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Slots of pairs of code points."""
    return slots((left.astype(np.uint64) << np.uint64(21)) | right)


class Vocabulary:
    """Pieces, scores and kinds of a model file, and its library object."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=model)
        kinds = range(lib.get_piece_size())
        plain = [i for i in kinds if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        if any(lib.is_unused(i) for i in kinds):
            raise ValueError("unused pieces are not supported")
        self.number = {lib.id_to_piece(i): i for i in plain}
        #: The smallest is merged first.
        self.rank = {lib.id_to_piece(i): -lib.get_score(i) for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(map(lib.is_byte, kinds)) else None
        self.unknown = lib.unk_id()
        self.surface = [lib.id_to_piece(i).replace(SPACE, " ") for i in kinds]
        self.byte_of = {i: b for b, i in enumerate(self.bytes or [])}
        self.silent = {i for i in kinds if lib.is_control(i)}
        for i in self.silent:
            self.surface[i] = ""
        self.surface[self.unknown] = UNKNOWN
        self.opening = {i for i in plain if self.surface[i].startswith(" ")}
        # Rules of normalisation show in what the library makes of a probe; others than the usual ones are left to it.
        probe = " a  ﬁéé\x00\t\n "
        self.own_rules = lib.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        beside = np.array([(ord(a), ord(b)) for p in self.number for a, b in zip(p, p[1:], strict=False)], "<u4")
        #: True in the slots of characters that stand side by side in a piece.
        self.parts: np.ndarray | None = np.zeros(1 << SLOT_BITS, bool)
        self.parts[neighbours(*beside.reshape(-1, 2).T)] = True

    def normal(self, text: str) -> str:
        if not text:
            return ""
        return SPACE + text.replace(" ", SPACE) if self.own_rules else self.library.normalize(text)


class Agendas:
    """The agendas of many short parts at once: places of pairs with what they stand at, part after part.

    In each round every part takes its best pair, of equal ones the leftmost. Symbols are numbers: of pieces their
    own, of other characters their code point behind the last piece.
    """

    def __init__(self, number: dict[str, int], rank: dict[str, float], size: int):
        self.size, self.wide = size, size + sys.maxunicode + 1
        self.of_char = np.arange(size, self.wide, dtype=np.int32)
        for piece, i in number.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        known = {}
        for whole, i in number.items():
            for k in range(1, len(whole)):
                left, right = number.get(whole[:k]), number.get(whole[k:])
                if left is not None and right is not None:
                    known[left * self.wide + right] = (i, rank[whole])
        keys = np.array(sorted(known), np.int64)
        #: Pairs by key, with a last one that no pair has.
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.whole = np.array([known[k][0] for k in keys.tolist()] + [0], np.int32)
        #: Places in the order of scores; equal scores share one.
        order = np.unique([known[k][1] for k in keys.tolist()], return_inverse=True)[1]
        self.rank = np.append(order, NEVER).astype(np.int32)
        self.may_be = np.zeros(1 << SLOT_BITS, bool)
        self.may_be[slots(keys)] = True

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * np.int64(self.wide) + right
        some = np.flatnonzero(self.may_be[slots(key)])
        key = key[some]
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = len(self.keys) - 1
        rank, whole = np.full(len(left), NEVER, np.int32), np.zeros(len(left), np.int32)
        rank[some], whole[some] = self.rank[at], self.whole[at]
        return rank, whole

    def merged(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all parts when their agendas are empty, and where each part's end."""
        symbol = self.of_char[np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")]
        part = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
        done: list[np.ndarray] = []
        rank, whole = np.full(len(symbol), NEVER, np.int32), np.zeros(len(symbol), np.int32)
        inner = np.flatnonzero(part[1:] == part[:-1])
        rank[inner], whole[inner] = self.ranked(symbol[inner], symbol[inner + 1])
        while len(symbol):
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            best = np.minimum.reduceat(rank, begins)
            lengths = np.diff(begins, append=len(part))
            over = np.repeat(best == NEVER, lengths)
            if over.any():
                done.append(np.stack([part[over], symbol[over]]))
                stay = ~over
                symbol, part, rank, whole = symbol[stay], part[stay], rank[stay], whole[stay]
                lengths, best = lengths[best != NEVER], best[best != NEVER]
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            at = at[np.diff(part[at], prepend=-1) > 0]
            symbol[at] = whole[at]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            symbol, part, rank, whole = symbol[stay], part[stay], rank[stay], whole[stay]
            at -= np.arange(len(at))
            # The taken symbol's pairs on either side stand anew.
            rank[at] = NEVER
            for left in (at, at[at > 0] - 1):
                left = left[left + 1 < len(part)]
                left = left[part[left] == part[left + 1]]
                rank[left], whole[left] = self.ranked(symbol[left], symbol[left + 1])
        owner, symbols = np.concatenate([np.zeros((2, 0), np.int32), *done], axis=1)
        return symbols[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner, minlength=len(parts)))


def merged_long(part: str, rank: dict[str, float]) -> list[str]:
    """The symbols of one part of any length: the agenda is a heap, the symbols are linked."""
    symbol: list[str | None] = list(part)
    before, after = list(range(-1, len(symbol) - 1)), list(range(1, len(symbol) + 1))
    end = len(symbol)
    agenda = [
        (rank[x + y], i, x, y) for i, (x, y) in enumerate(zip(part, part[1:], strict=False)) if x + y in rank
    ]
    heapify(agenda)
    while agenda:
        _, i, x, y = heappop(agenda)
        j = after[i]
        # A pair is stale once either side has been merged into another symbol.
        if symbol[i] != x or j == end or symbol[j] != y:
            continue
        whole = symbol[i] = x + y
        symbol[j] = None
        k = after[i] = after[j]
        if k != end:
            before[k] = i
            right = rank.get(whole + symbol[k])
            if right is not None:
                heappush(agenda, (right, i, whole, symbol[k]))
        h = before[i]
        if h >= 0:
            left = rank.get(symbol[h] + whole)
            if left is not None:
                heappush(agenda, (left, h, symbol[h], whole))
    return [s for s in symbol if s is not None]


def encoder(vocabulary: Vocabulary) -> Callable[[list[str]], list[bytes]]:
    """The ids of each of some texts as little-endian 32-bit numbers."""
    rank, spelled, beside, number = vocabulary.rank, vocabulary.bytes, vocabulary.parts, vocabulary.number
    size = vocabulary.library.get_piece_size()
    agendas = Agendas(number, rank, size)

    def spell(character: str) -> list[int]:
        return [spelled[b] for b in character.encode()] if spelled else [vocabulary.unknown]

    def packed(ids: list[int]) -> bytes:
        return np.array(ids, IDS).tobytes()

    def of_long(part: str) -> bytes:
        return packed([i for x in merged_long(part, rank) for i in ([number[x]] if x in number else spell(x))])

    class Known(dict):
        """Ids of short parts; long ones are not remembered."""

        def __missing__(self, part: str) -> bytes:
            return of_long(part)

    known = Known()

    def learn(parts: list[str]) -> None:
        """Add the ids of short parts."""
        symbols, ends = agendas.merged(parts)
        ids, low = symbols.astype(IDS).tobytes(), 0
        strange = np.add.reduceat(symbols >= size, np.append(0, ends[:-1])).tolist() if len(ends) else []
        for part, end, odd in zip(parts, ends.tolist(), strange, strict=True):
            if odd:
                own = symbols[low:end].tolist()
                known[part] = packed([i for x in own for i in ([x] if x < size else spell(chr(x - size)))])
            else:
                known[part] = ids[IDS.itemsize * low : IDS.itemsize * end]
            low = end

    def cut(whole: str, firsts: np.ndarray) -> tuple[np.ndarray, pa.LargeStringArray]:
        """Where parts of the joined texts begin, and the parts; `firsts` are the texts' own beginnings."""
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        first = np.zeros(len(codes), bool)
        first[firsts] = True
        if beside is not None:
            for low in range(1, len(codes), BLOCK):
                right = codes[low : low + BLOCK]
                first[low : low + BLOCK] |= ~beside[neighbours(codes[low - 1 : low - 1 + len(right)], right)]
        begins = np.flatnonzero(first)
        width = np.ones(len(codes), np.uint8)
        for least in (0x80, 0x800, 0x10000):
            width += codes >= least
        offsets = np.append(0, np.cumsum(np.add.reduceat(width, begins, dtype=np.int64)))
        buffers = pa.py_buffer(offsets), pa.py_buffer(whole.encode())
        return begins, pa.LargeStringArray.from_buffers(len(begins), *buffers)

    def encode(texts: list[str]) -> list[bytes]:
        normal = [vocabulary.normal(text) for text in texts]
        text_ends = np.cumsum([0, *map(len, normal)])
        if not text_ends[-1]:
            return [b""] * len(texts)
        begins, parts = cut("".join(normal), text_ends[:-1][np.diff(text_ends) > 0])
        numbered = parts.dictionary_encode()
        different, which = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        if len(known) >= REMEMBERED:
            known.clear()
        found = list(map(known.get, different))
        new = [i for i, own in enumerate(found) if own is None]
        learn([p for i in new if len(p := different[i]) < LONGEST])
        for i in new:
            found[i] = known[different[i]]
        ids = np.frombuffer(b"".join(found), IDS)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // IDS.itemsize
        lengths = sizes[which]
        ends = np.append(0, np.cumsum(lengths))
        out = ids[np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        bounds = ends[np.searchsorted(begins, text_ends)].tolist()
        return [out[low:high].tobytes() for low, high in zip(bounds, bounds[1:], strict=False)]

    return encode


def spelled_text(raw: bytes) -> str:
    """Text of byte pieces; each byte that begins no character becomes one replacement sign."""
    out = ""
    while raw:
        try:
            return out + raw.decode()
        except UnicodeDecodeError as bad:
            out += raw[: bad.start].decode() + "�"
            raw = raw[bad.start + 1 :]
    return out


def decoder(vocabulary: Vocabulary) -> Callable[[list[int]], str]:
    """Text of ids; the space sign before the first piece that shows goes."""
    surface, byte_of, silent = vocabulary.surface, vocabulary.byte_of, vocabulary.silent
    spelled = set(byte_of)

    def decode(ids: list[int]) -> str:
        if spelled.isdisjoint(ids):
            text = "".join(map(surface.__getitem__, ids))
        else:
            out, run = [], bytearray()
            for i in ids:
                if i in spelled:
                    run.append(byte_of[i])
                    continue
                if run:
                    out.append(spelled_text(bytes(run)))
                    run.clear()
                out.append(surface[i])
            text = "".join(out) + spelled_text(bytes(run))
        first = next((i for i in ids if i not in silent), vocabulary.unknown)
        return text[1:] if first in vocabulary.opening else text

    return decode


def decoder_of_many(vocabulary: Vocabulary) -> Callable[[list[np.ndarray]], list[str]]:
    """Texts of several lists of ids. Lists with silent pieces or bytes that make no text are decoded one by one."""
    decode, byte_of = decoder(vocabulary), vocabulary.byte_of
    spelled = [bytes([byte_of[i]]) if i in byte_of else s.encode() for i, s in enumerate(vocabulary.surface)]
    surface, longest = pa.array(spelled, pa.binary()), max(map(len, spelled))
    silent, opening = np.zeros(len(spelled), bool), np.zeros(len(spelled), bool)
    silent[list(vocabulary.silent)], opening[list(vocabulary.opening)] = True, True

    def decode_many(lists: list[np.ndarray]) -> list[str]:
        ids = np.concatenate([*lists, np.zeros(0, IDS)])
        if not len(ids) or len(ids) * longest >= 1 << 31:  # beyond the offsets of one Arrow array
            return [decode(own.tolist()) for own in lists]
        ends = np.cumsum([0, *map(len, lists)])
        _, offsets, data = surface.take(pa.array(ids)).buffers()
        at = np.frombuffer(offsets, np.int32, len(ids) + 1)[ends].tolist()
        quiet = np.append(0, np.cumsum(silent[ids], dtype=np.int32))[ends].tolist()
        text, out = memoryview(data or b""), []
        for i, own in enumerate(lists):
            one = None
            if len(own) and quiet[i] == quiet[i + 1]:
                # Whole text, so bytes between pieces are whole characters too.
                with contextlib.suppress(UnicodeDecodeError):
                    one = str(text[at[i] + int(opening[own[0]]) : at[i + 1]], "utf-8")
            out.append(decode(own.tolist()) if one is None else one)
        return out

    return decode_many


def encoded(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids, decoded, agrees), one row per row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        encode, decode_many, library = encoder(vocabulary), decoder_of_many(vocabulary), vocabulary.library
        for batch in rows:
            ids, texts, agrees, some, size = [], [], [], [], 0
            column = batch.column(1).to_pylist()
            for n, text in enumerate(column, 1):
                some.append(text or "")
                size += len(some[-1])
                if size < TOGETHER and n < len(column):
                    continue
                listed = []
                for one, own in zip(some, encode(some), strict=True):
                    # One text at a time, so that the library's ids of a batch do not stand beside the own ones.
                    checked = library.encode_as_numpy(one).astype(IDS, copy=False)
                    same = own == checked.tobytes()
                    ids.append(checked)
                    listed.append(checked if same else np.frombuffer(own, IDS))
                    agrees.append(same)
                    texts.append(library.decode(checked) if len(checked) else "")
                for i, back in enumerate(decode_many(listed), len(texts) - len(listed)):
                    agrees[i] = agrees[i] and back == texts[i]
                some, size = [], 0
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(ends, np.concatenate([*ids, np.zeros(0, IDS)])),
                    pa.array(texts, pa.string()),
                    pa.array(agrees, pa.bool_()),
                ],
                ["id", "ids", "decoded", "agrees"],
            )

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return bounded_batches(narrow).mapInArrow(batches, "id long, ids array<int>, decoded string, agrees boolean")
