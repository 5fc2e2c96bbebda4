"""Training data from documents: five stages, each written as Parquet and read again by the next.

toxic documents go; repeated runs of lines go; one document of each near-duplicate group stays;
contaminated documents go; what remains is packed into sequences.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.llm import decontamination, line_dedup, packing, simhash, toxicity
from fieldgap.llm.common import table, written

#: Near-duplicate ids, tokenization and model fitting are not SQL.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that score as toxic; the model is learned as in the operator's own query."""
    usable = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), usable)
    return toxicity.without_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines removed; `n_chars` follows the text where it changed."""
    found = line_dedup.dedup_lines(docs)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(F.col("row.n_chars"))
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_per_group(docs, shingle=4, radius=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return piece_digests(packing.packed_pieces(docs, tokenizer_path(packing.TOKENIZER)))


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
