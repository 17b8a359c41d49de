"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, personal data, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before kept. All but
the last return the columns of ``documents``; the last returns one row of token counts and digests per
document. Rows are told apart by ``doc_id`` and ``text``, so rows without an id, or that share one, are
each judged by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featmart.llm import bpe, decontaminate, neardup, pii, quality
from featmart.llm.common import row_key, stored, tokenizer_file
from featmart.sources.tables import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and reach the threshold of the n-gram model."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("__row"), F.col("doc_id").alias("__id"),
                       F.col("text").alias("__body"))
    judged = quality.judge(rows, model, "__id", "__body", keep=("__row", "__body"))
    return judged.where("kept").select(*((F.col("__body") if c == "text" else F.col("__row").getField(c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near copies (and one of those without an id)."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no notable share is benchmark text."""
    rows = docs.withColumn("__row_key", row_key())
    found = decontaminate.contamination(rows, read_table(spark, sf_dir, "benchmark"), id_col="__row_key")
    out = stored(found.where("contaminated").select(F.col("doc_id").alias("__out")).distinct(), "contaminated")
    return rows.join(out, rows["__row_key"] == out["__out"], "left_anti").drop("__row_key")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; ``n_chars`` follows."""
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens``, ``ids`` and digests of the ids and of the decoded text."""
    both = bpe.encode(docs, tokenizer_file(VOCABULARY), round_trip=True)
    return both.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("tokens", tokens),
]

#: SQL cannot state the trained models of the stages; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
