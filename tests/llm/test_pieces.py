"""SentencePiece encoding and decoding against the library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F

from fieldgap.llm import pieces, queries

SIGNS = [" ", "  ", "\n", "\t", "\r", "\0", "▁", "<s>", "</s>", "<unk>", "<0x41>", "é", "é", "ﬁ", "😀", "‍", "梦",
         "ゼ", "the", "ing", "a", "b", ".", ",", "_.", "e", "0", "12", "﻿", "\xa0", "\U0010ffff", "\x85", "ß"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(path(pieces.MODEL))


@pytest.fixture(scope="module")
def own(vocabulary):
    encode = pieces.encoder(vocabulary)
    return lambda text: memoryview(encode([text])[0]).cast("i").tolist()


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(SIGNS) | st.characters(exclude_categories=["Cs"]), max_size=14))
def test_ids_and_text_equal_the_librarys(vocabulary, own, signs):
    text = "".join(signs)
    ids = vocabulary.library.encode(text)
    assert own(text) == ids
    assert pieces.decoder(vocabulary)(ids) == (vocabulary.library.decode(ids) if ids else "")


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 3, 50, 200, 227, 130, 131, 155, 243]) | st.integers(0, 31999), min_size=1, max_size=9))
def test_any_ids_decode_as_in_the_library(vocabulary, ids):
    assert pieces.decoder(vocabulary)(ids) == vocabulary.library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 50_000, "梦ゼ" * 20_000, "ab c" * 20_000, "word. " * 30_000])
def test_long_parts(vocabulary, own, text):
    assert own(text) == vocabulary.library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("▁thein .saoé梦", min_size=1, max_size=40), max_size=5))
def test_both_agendas_are_the_same(vocabulary, many):
    agendas = pieces.Agendas(vocabulary.number, vocabulary.rank, vocabulary.library.get_piece_size())
    symbols, ends = agendas.merged(many)
    for part, own in zip(many, np.split(symbols, ends[:-1]) if many else [], strict=True):
        long = pieces.merged_long(part, vocabulary.rank)
        assert own.tolist() == [vocabulary.number.get(x, 32_000 + ord(x[0])) for x in long]


def test_whole_texts_where_pieces_cross_spaces(vocabulary):
    """Without places to cut, the whole text is one part and gives the same."""
    whole = pieces.Vocabulary(path(pieces.MODEL))
    whole.parts = None
    text = "The thing,  in a\nhouse \t was<s> red. "
    assert memoryview(pieces.encoder(whole)([text])[0]).cast("i").tolist() == vocabulary.library.encode(text)


def test_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (5, " "), (6, "x\n" * 40_000), (7, "▁ ▁")]
    found = pieces.encoded(docs_of(rows), path(pieces.MODEL)).collect()
    assert len(found) == len(rows) and all(r["agrees"] for r in found)
    by_id = {r["id"]: r for r in found}
    assert by_id[1]["ids"] == [] == by_id[2]["ids"] and by_id[1]["decoded"] == "" == by_id[2]["decoded"]
    assert by_id[3]["decoded"] == "same" and by_id[None]["decoded"] == "no id" and by_id[7]["decoded"] == "     "[:3]
    assert pieces.encoded(docs_of([]), path(pieces.MODEL)).count() == 0


def test_query(spark, vocabulary, docs_of, tables):
    texts = {1: "One and  two.", 2: None, 3: "", 4: "été\n梦", 5: " a"}
    found = queries.op13_sentencepiece(spark, tables(documents=docs_of(texts.items()))).collect()
    for r in found:
        ids = vocabulary.library.encode(texts[r["doc_id"]] or "")
        back = vocabulary.library.decode(ids) if ids else ""
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_whole_table_agrees(spark):
    found = queries.op13_sentencepiece(spark, "/root/testdata/sf0.001")
    assert found.where(~F.col("agrees")).count() == 0 and found.count() > 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 3, 13, 50, 227, 130, 131, 155, 243]) | st.integers(0, 31999), max_size=9), max_size=6))
def test_many_lists_decode_as_one_by_one(vocabulary, lists):
    many = pieces.decoder_of_many(vocabulary)([np.array(ids, pieces.IDS) for ids in lists])
    assert many == [vocabulary.library.decode(ids) if ids else "" for ids in lists]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("▁the in.,!\n$ saoé梦😀", max_size=60), max_size=6))
def test_texts_encoded_together_as_alone(vocabulary, texts):
    own = pieces.encoder(vocabulary)(texts)
    assert [memoryview(ids).cast("i").tolist() for ids in own] == [vocabulary.library.encode(t) for t in texts]


def test_a_word_is_merged_once_whatever_stands_beside_it(vocabulary, monkeypatch):
    """Marks that no piece joins with letters are parts of their own."""
    merged, whole = [], pieces.Agendas.merged
    monkeypatch.setattr(pieces.Agendas, "merged", lambda self, parts: merged.extend(parts) or whole(self, parts))
    encode = pieces.encoder(vocabulary)
    text = "geberie geberie, geberie\ngeberie geberie!!! geberie$$$"
    assert memoryview(encode([text])[0]).cast("i").tolist() == vocabulary.library.encode(text)
    assert merged.count("▁geberie") == 1 and sum("geberie" in part for part in merged) == 2
    encode(["geberie? geberie###"])
    assert sum("geberie" in part for part in merged) == 2


def test_parts_across_blocks_of_neighbours(vocabulary, own, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 3)
    text = "The thing, in a house.\nAnd 梦ゼ 😀 more"
    assert own(text) == vocabulary.library.encode(text)
