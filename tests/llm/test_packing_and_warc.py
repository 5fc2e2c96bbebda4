"""Round trips: packed sequences hold every id once, archives give back every page."""

import base64
import gzip
import hashlib
import zlib

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldgap.llm import packing, warc
from fieldgap.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(path(packing.TOKENIZER))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


ODD = [
    "Plain words, and it's 42!",
    "  spaces \t\r\n and other spaces here ",
    "<|startoftext|> specials <|endoftext|>x",
    "é composed ẛ̣ İstanbul ǅ ﬁ 漢字 \U0001f600",
    "control \x1c\x1d between \x0b\x0c parts \x00",
    "",
    " \n ",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_are_the_tokenizers(text):
    coded = packing.word_ids(path(packing.TOKENIZER))(text)
    assert [int.from_bytes(coded[i : i + 4], "little") for i in range(0, len(coded), 4)] == ids_of(text)[:-1]


def check_packed(rows, pieces, length=4096):
    wanted, got, sequences = {}, {}, {}
    for i, t in rows:
        wanted.setdefault(i, []).append(ids_of(t))
    for p in pieces:
        got.setdefault(p["id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], len(p["ids"]) // 4))
    assert set(got) == set(wanted)
    for i, own in got.items():
        if len(wanted[i]) > 1:
            continue
        at, ids = 0, b""
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] * 4 == len(p["ids"]) > 0
            at, ids = at + p["length"], ids + p["ids"]
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == wanted[i][0]
        assert all(p["doc_tokens"] == len(wanted[i][0]) for p in own)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert sum(n for parts in sequences.values() for _, n in parts) == sum(len(x) for own in wanted.values() for x in own)
    return padding


@pytest.mark.parametrize("partitions", [1, 3, 150])
def test_every_id_once_and_no_padding(docs_of, partitions):
    rows = [(i, " ".join(f"word{i} {j}" for j in range(i * 7 % 900))) for i in range(200)] + [(900, "long " * 30_000), (901, None), (902, "")]
    docs = docs_of(rows).repartition(partitions, "doc_id")
    pieces = packing.packed_pieces(docs, path(packing.TOKENIZER), open_windows=4).collect()
    assert check_packed(rows, pieces) == 0


def test_odd_rows(docs_of):
    rows = [(None, "no id"), (3, "same"), (3, "same"), (4, None)]
    pieces = packing.packed_pieces(docs_of(rows), path(packing.TOKENIZER)).collect()
    check_packed(rows, pieces)
    assert sorted(str(p["id"]) for p in pieces if p["start"] == 0) == ["3", "3", "4", "None"]
    assert packing.packed_pieces(docs_of(rows).where(F.lit(False)), path(packing.TOKENIZER)).count() == 0


def test_best_fit():
    packer = packing.Packer(10, 3)
    for i, n in enumerate((6, 7, 4, 3)):
        packer.add(packing.Piece(i, 0, b"\0" * 4 * n, n))
    assert sorted(sorted(p.id for p in w.pieces) for w in packer.full) == [[0, 2], [1, 3]]


def test_packing_query_columns(spark, docs_of, tables):
    folder = tables(documents=docs_of([(1, "some words"), (2, None)]))
    got = {r["doc_id"]: r for r in QUERIES["op10_packing"](spark, folder).collect()}
    ids = b"".join(i.to_bytes(4, "little") for i in ids_of("some words"))
    assert got[2]["ids_crc32"] == zlib.crc32((2).to_bytes(4, "little"))
    assert {r["doc_id"] for r in got.values()} == {1, 2} and got[1]["doc_tokens"] == len(ids) // 4


@pytest.fixture
def pages_of(spark):
    def make(rows):
        return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, id string")

    return make


PAGES = [
    (1, "http://a.org/1", "<p>one</p>"),
    (2, "http://a.org/2", "<p>two</p>\r\n\r\nWARC/1.1\r\n\r\n"),
    (3, None, "<p>one</p>"),
    (4, "http://a.org/4\r\nX: y", None),
    (5, "http://a.org/5", ""),
    (6, "http://ä.org/ß", "äöü 漢字 \x00"),
    (7, "http://a.org/7", "<p>one</p>"),
    (7, "http://a.org/7", "<p>one</p>"),
    (None, "http://a.org/none", "no id"),
    (9, "http://a.org/9", "long" * 500_000),
]


def test_archives_give_back_every_page(spark, pages_of, tables):
    folder = tables(pages=pages_of(PAGES))
    got = QUERIES["op9_warc"](spark, folder)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    holder = {}
    for i, _, h in PAGES:
        holder[h or ""] = max(holder.get(h or "", -1), -1 if i is None else i)
    expected = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = holder[h or ""] not in (i, -1)
        expected.append((i, len(raw), digest, "revisit" if again else "response", holder[h or ""] if again else None))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected))


def test_members_stand_alone(spark, pages_of, tmp_path):
    index = warc.archive(pages_of(PAGES), str(tmp_path / "warc")).collect()
    payloads = {}
    for r in index:
        with open(r["file"].removeprefix("file:"), "rb") as f:
            f.seek(r["offset"])
            record = gzip.decompress(f.read(r["length"]))
        head, _, rest = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1") and rest.endswith(b"\r\n\r\n")
        payloads[r["record_id"]] = rest[:-4].decode()
    assert payloads["<urn:record:2>"] == PAGES[1][2] and payloads["<urn:record:1>"] == "" and payloads["<urn:record:9>"] == PAGES[-1][2]
    by_file = {}
    for r in index:
        by_file.setdefault(r["file"], []).append((r["offset"], r["length"]))
    for spans in by_file.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length


def test_other_archives(spark, tmp_path):
    """Several members in one file, records of other writers."""
    record = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:record:{}>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    parts = [record.format("response", i, len(b), b).encode() for i, b in enumerate(("abc", "", "x" * 3_000_000))]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(parts[0] + parts[1]) + gzip.compress(parts[2]))
    index = warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted((r["record_id"], r["payload_bytes"]) for r in warc.read_records(index).collect()) == [
        ("<urn:record:0>", 3), ("<urn:record:1>", 0), ("<urn:record:2>", 3_000_000),
    ]


def test_broken_archive_fails(spark, tmp_path):
    whole = gzip.compress(b"WARC/1.0\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(whole[:-12])
    with pytest.raises(Exception, match="ends early"):
        warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_empty_table(spark, pages_of, tables):
    folder = tables(pages=pages_of(PAGES).where(F.lit(False)))
    assert QUERIES["op9_warc"](spark, folder).count() == 0


def test_small_payloads_are_all_responses(pages_of, tmp_path):
    index = warc.archive(pages_of(PAGES), str(tmp_path / "warc"), least_bytes=11)
    assert {r["record_type"] for r in warc.read_records(index).collect()} == {"response"}
