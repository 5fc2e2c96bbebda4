"""Line dedup and benchmark decontamination, by their SQL and by hand."""

import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldgap.llm import decontamination, line_dedup
from fieldgap.llm.queries import ORACLE, QUERIES

PLAIN = "/root/testdata/sf0.001"
TABLES = pytest.mark.skipif(not os.path.isdir(PLAIN), reason="test tables are not here")


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(str(r[i]) for i in order) for r in rows))


@TABLES
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{PLAIN}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, PLAIN)
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.columns, got.collect()) == [tuple(x.replace("true", "True") if x in ("true", "false") else x for x in r) for r in canonical(columns, result.fetchall())]


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


def texts(df):
    return sorted((tuple(r) for r in df.select("row.doc_id", "text", "n_removed").collect()), key=str)


def test_long_passage_goes_from_later_documents(docs_of):
    passage = words(60)
    docs = docs_of([(2, f"own line two\n{passage}\nlast two"), (1, f"first\n{passage}"), (3, passage), (4, f"clean\n{words(60, 500)}")])
    assert texts(line_dedup.dedup_lines(docs)) == [
        (1, f"first\n{passage}", 0),
        (2, "own line two\nlast two", 1),
        (3, "", 1),
        (4, f"clean\n{words(60, 500)}", 0),
    ]


def test_repeat_within_a_document_keeps_the_first(docs_of):
    passage = words(55)
    docs = docs_of([(1, f"{passage}\nmiddle\n{passage}\n{passage}"), (2, passage)])
    assert texts(line_dedup.dedup_lines(docs)) == [(1, f"{passage}\nmiddle", 2), (2, "", 1)]


def test_runs_of_short_lines_and_shifted_lines(docs_of):
    run = [f"short line number {i}" for i in range(40)]
    docs = docs_of([(1, "\n".join(run)), (2, "\n".join(["something", "else", *run])), (3, "one line only"), (4, "one line only")])
    found = {r[0]: r for r in texts(line_dedup.dedup_lines(docs))}
    assert found[1][2] == 0
    assert found[2][2] > 25, "boundaries follow the content, not the position"
    assert found[3][1:] == found[4][1:] == ("one line only", 0), "a short line alone is no chunk of several lines"


def test_odd_rows(docs_of):
    passage = words(51)
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, passage), (7, passage), (7, passage), (8, "b1c1\nc1b1\n"), (9, "x\r\ny"), (10, words(200_000))]
    docs = docs_of(rows)
    got = line_dedup.dedup_lines(docs)
    assert sorted(got.select("row.*").columns) == sorted(docs.columns)
    found = sorted(((r["row"]["doc_id"], r["text"]) for r in got.collect()), key=str)
    kept = {7: passage}
    assert found == sorted([(i, "" if i is None else kept.get(i, t)) for i, t in rows], key=str)
    assert line_dedup.dedup_lines(docs.where(F.lit(False))).count() == 0


def test_words_are_runs_without_white_space(docs_of):
    tabs, mixed = words(50).replace(" ", "\t"), words(50, 100).replace(" ", " \x0b\r\t\f ")
    brace, row, blank, short = " " * 60 + "}", "a" + " " * 50 + "b", " " * 80, words(49, 200) + " " * 9
    docs = docs_of([(1, "\n".join([tabs, brace, mixed, row, short])), (2, tabs), (3, mixed), (4, brace), (5, row), (6, blank), (7, blank), (8, short)])
    assert texts(line_dedup.dedup_lines(docs)) == [
        (1, "\n".join([tabs, brace, mixed, row, short]), 0), (2, "", 1), (3, "", 1), (4, brace, 0), (5, row, 0), (6, blank, 0), (7, blank, 0), (8, short, 0)
    ]


def slow_hits(text, items, size=13):
    own = decontamination.words_of(text)
    hit, found = set(), set()
    for item, body in items:
        other = decontamination.words_of(body)
        length = min(size, len(other))
        for i in range(len(other) - length + 1 if length else 0):
            for j in range(len(own) - length + 1):
                if own[j : j + length] == other[i : i + length]:
                    hit.update(range(j, j + length))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [10**6, 60])
def test_hits_against_brute_force(spark, docs_of, block_bytes):
    items = [
        (1, words(20)), (2, words(13, 5)), (3, "Alpha beta"), (4, "gamma"), (5, ""), (6, None), (7, words(30, 100)),
        (7, "second text of an item with two rows of it"), (10, "a a a a a a a a a a a a a a"),
    ]
    docs = [
        (1, f"before {words(20)} after"), (2, words(40)), (3, "ALPHA,Beta! and gamma; alpha beta"), (4, "nothing of it"), (5, None), (6, ""),
        (7, words(12, 100)), (8, words(14, 99) + " " + words(14, 99)), (9, "a " * 40), (10, "Straße alpha-beta " * 3), (11, "gamma " + words(300, 900)),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.benchmark_hits(docs_of(docs), bench, block_bytes=block_bytes)
    found = {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got.collect()}
    assert found == {i: slow_hits(t, items) for i, t in docs}
    kept = decontamination.without_contaminated(docs_of(docs), bench, block_bytes=block_bytes)
    expected = sorted(i for i, (n, h, _) in found.items() if not (h > 0 and 20 * h >= n))
    assert sorted(r["doc_id"] for r in kept.collect()) == expected and 11 in expected
    assert kept.columns == docs_of(docs).columns


def test_empty_benchmark(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.without_contaminated(docs_of([(1, "a b"), (2, None)]), bench).count() == 2


def test_items_digest(spark, docs_of, tables):
    bench = spark.createDataFrame([(9, "alpha beta"), (10, "gamma"), (None, "delta")], "item_id long, text string")
    folder = tables(documents=docs_of([(1, "alpha beta gamma"), (2, "delta"), (3, "none")]), benchmark=bench)
    got = {r["doc_id"]: r for r in QUERIES["op5_benchmark_decontamination"](spark, folder).collect()}
    assert got[1]["items_sha256"] == hashlib.sha256(b"10,9").hexdigest() and got[1]["n_items"] == 2
    assert got[2]["n_items"] == 0 and got[2]["n_hit"] == 1 and got[2]["contaminated"]
    assert got[3]["items_sha256"] == hashlib.sha256(b"").hexdigest()
