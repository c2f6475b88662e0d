"""A training corpus from raw documents: quality, line dedup, near-dup removal, personal data, packing.

Each stage takes (spark, documents, folder of the tables) and works on all that the stage before kept; its result is written as Parquet
and read again. All stages but the last return the columns of documents; `n_chars` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetgauge.llm import lines, packing, pii, quality, simhash
from fleetgauge.llm.common import staged, table
from fleetgauge.llm.queries import MAX_BITS, SHINGLE, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.judge_quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go."""
    return _documents(lines.drop_boilerplate(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.one_of_each(docs.select(*COLUMNS), SHINGLE, MAX_BITS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return _documents(pii.redact_pii(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, neighbours on the curve together: one row for each piece of a document."""
    packed = packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("pack", pack),
]

# Fingerprints, the learned patterns and the tokenizer are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of a folder on."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
