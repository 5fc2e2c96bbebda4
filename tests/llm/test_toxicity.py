"""Toxicity: windows against brute force, copies, languages, and passages inside long ordinary texts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from fieldgap.llm import toxicity
from fieldgap.llm.common import table

TABLES_OF = "/root/testdata/check_s"
TABLES = pytest.mark.skipif(not os.path.isdir(TABLES_OF), reason="test tables are not here")


def test_strongest_windows_against_brute_force():
    draw = random.Random(3)
    step = toxicity.SPAN // 2
    for n in (0, 1, 15, 16, 17, 32, 33, 48, 49, 500):
        weights = [draw.choice([0.0, 0.0, 0.0, 1.5, 4.0]) for _ in range(n)]
        starts = range(0, max(1, n - step), step)
        slow = sorted((sum(weights[k : k + toxicity.SPAN]) for k in starts), reverse=True)[: toxicity.STRONGEST]
        assert toxicity.strongest(weights) == pytest.approx(sum(slow))


def test_copies_of_one_toxic_text_do_not_make_its_words_telling(spark, docs_of):
    draw = random.Random(5)
    plain = [f"{a}plain{b}" for a in "abcdefgh" for b in range(40)]
    rare = ("".join(draw.choices("aeiourstn", k=8)) for _ in range(1 << 20))
    rows = [
        (i, " ".join([*draw.choices(plain, k=60), *(next(rare) for _ in range(5)), *["vileword"] * (i % 2 * 2)]))
        for i in range(400)
    ]
    copied = " ".join(f"quiet{a}{b}" for a in "klmnop" for b in range(10)) + " vileword"
    rows += [(1000 + i, copied) for i in range(200)]
    docs = docs_of(rows)
    labels = docs.select("doc_id", ((F.col("doc_id") % 2 == 1) | (F.col("doc_id") >= 1000)).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, F.lit(True))
    assert all(b"vileword" in pair.toxic and b"quietk" not in pair.toxic for pair in model.pairs)
    probe = docs_of([(1, rows[0][1]), (2, "vileword " + rows[0][1] + " vileword"), (3, None), (4, "")])
    found = {r["id"]: r["score"] >= toxicity.LIMIT for r in toxicity.scores(probe, model).collect()}
    assert found == {1: False, 2: True, 3: False, 4: False}


@TABLES
def test_languages_and_passages_inside_long_texts(spark):
    docs, labels = table(spark, TABLES_OF, "documents"), table(spark, TABLES_OF, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = toxicity.fit(docs, labels, ~held)
    docs = docs.select("doc_id", "lang", "text")
    rows = docs.join(labels, "doc_id").where(held).select("lang", "toxic", F.coalesce("text", F.lit("")).alias("text")).collect()
    evidence = toxicity.evidence_of(model.pairs)

    def toxic(text):
        return model.score(evidence(text)) >= toxicity.LIMIT

    rate = {}
    for lang in ("en", "de", "es", "fr"):
        own = [(toxic(r["text"]), r["toxic"]) for r in rows if r["lang"] == lang]
        hit = sum(a and b == 1 for a, b in own)
        rate[lang] = hit / sum(a for a, _ in own), hit / sum(b for _, b in own)
    assert all(precision >= 0.9 for precision, _ in rate.values()), rate
    assert all(recall >= 0.9 for _, recall in rate.values()), rate

    draw = random.Random(1)
    pool = [w for r in rows if r["lang"] == "en" and not r["toxic"] for w in r["text"].split()]
    alone = [r["text"] for r in rows if r["toxic"] and len(r["text"].split()) < 400 and toxic(r["text"])]
    for size in (1000, 5000, 20_000):
        at = [draw.randrange(len(pool) - size) for _ in alone]
        beside = [" ".join(pool[k : k + size]) for k in at]
        assert sum(toxic(f"{b} {t}") for b, t in zip(beside, alone, strict=True)) >= 0.95 * len(alone)
        assert sum(map(toxic, beside)) <= 0.1 * len(beside)
