"""Corpus pipeline: five stages over ``documents``, each written and read again.

quality   documents that the classifier rejects (score below 0.3) go
dedup     of each component of near copies one row stays, the one of least doc_id
pii       personal data is replaced by its kind
mix       sources are brought to their target weights (documents repeat or go)
tokens    token ids, their number and the decoded text of every document left

All but the last return the columns of their input.  ``dedup`` chooses by class
and row, not by doc_id alone: rows that share a doc_id, or have none, are kept
or dropped for their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe, mixing, ngram_join, pii, quality
from salesmart.llm.common import stage
from salesmart.llm.entry import tokenizer_path


def _columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: fitted to the labelled documents of the whole table."""

    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, out="_score").filter("_score >= 0.3").select(*_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one row of each component stays, the one of least doc_id."""

    return ngram_join.representatives(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10."""

    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7."""

    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3."""

    coded = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), tokenizer_path(), keep=["doc_id", "source"])
    return coded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", redact_pii),
    ("mixing sources", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

# the classifier's fit and the tokenizer are no SQL; tests/llm/test_pipeline.py holds the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written and read again."""

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, "pipeline")
    return docs
