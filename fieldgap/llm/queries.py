"""Registered queries: each operator over its whole table, and the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fieldgap.llm import (
    alignment,
    decontamination,
    line_dedup,
    oracle,
    packing,
    pieces,
    quality,
    runs,
    simhash,
    topk,
    toxicity,
    url_rules,
    warc,
    wrappers,
)
from fieldgap.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def fold(divisor: int) -> Column:
    """The remainder that decides whether a document is held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(divisor))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


#: (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), url_rules.rule_table(spark, URL_RULES))
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = quality.featured(docs)
    model = quality.fit(rows, labels, fold(5) != 0)
    return quality.scores(rows, model).select(
        F.col("id").alias("doc_id"),
        (F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.LIMIT).cast("int").alias("predicted"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, fold(3) != 1)
    return toxicity.scores(docs, model).select(
        F.col("id").alias("doc_id"),
        (F.pmod(F.crc32(F.col("id").cast("string")), F.lit(3)) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.LIMIT).cast("int").alias("predicted"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read_records(warc.archive(table(spark, sf_dir, "pages"), least_bytes=0))
    return found.select(
        warc.record_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.record_number(F.col("refers_to")).alias("refers_to"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed_pieces(table(spark, sf_dir, "documents"), tokenizer_path(packing.TOKENIZER))
    return corpus_pipeline.piece_digests(pieces)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.aligned(
        table(spark, sf_dir, "documents"),
        tokenizer_path(alignment.BYTE_TOKENIZER),
        tokenizer_path(alignment.PIECE_MODEL),
        digest=True,
    )
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return found.select(F.col("id").alias("doc_id"), *numbers, F.col("groups").alias("groups_sha256"))


BLANKS = " \t\n\x0b\f\r"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the ids go on from some word with a period of their own; the others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    stripped = F.trim("text", F.lit(BLANKS))

    def planted(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        # Ten periods at most, so the last of them covers what is left of the text.
        again = F.flatten(F.array_repeat(F.slice(w, a.cast("int") + 1, p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, 1, a.cast("int")), F.slice(again, 1, (n - a).cast("int"))), " ")

    words = F.split(stripped, f"[{BLANKS}]+")
    changed = F.element_at(F.transform(F.array(words), planted), 1)
    return docs.select("doc_id", F.when((h % 10 == 0) & (stripped != ""), changed).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))

    def order(x: Column, y: Column) -> Column:
        """Greatest length by period first, then the smallest start and period."""
        one, two = x["length"] * y["period"], y["length"] * x["period"]
        later = (one < two) | ((one == two) & ((x["start"] > y["start"]) | ((x["start"] == y["start"]) & (x["period"] > y["period"]))))
        return F.when(later, 1).otherwise(-1)

    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))

    best = F.get(F.array_sort("runs", order), F.lit(0))
    return found.select("*", best.alias("best")).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encoded(table(spark, sf_dir, "documents"), tokenizer_path(pieces.MODEL))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_packing": op10_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_sentencepiece": op13_sentencepiece,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = oracle.STATEMENTS
