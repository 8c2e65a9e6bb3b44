"""Documents to packed training sequences, in five stages.

Each stage reads what the stage before kept, as Parquet in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from navloom.llm import decontaminate, packing, pii, quality, simhash
from navloom.llm.common import bundled, id_text, staged, table, unbundled


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; labels are those of the stage's own rows."""
    weights = quality.train(id_text(docs), table(spark, sf_dir, "labels"))
    return unbundled(quality.score(bundled(docs), weights).where("score >= 0.5"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest id."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which less than a twentieth of the words lie in test windows, or none."""
    marked = decontaminate.decontaminate(bundled(docs), table(spark, sf_dir, "benchmark"))
    return unbundled(marked.where(~decontaminate.contaminated()), docs.columns)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every span of personal data replaced by its kind."""
    return unbundled(pii.find_pii(bundled(docs), redact=True), docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their place in sequences of 1024."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("pii", pii_redaction),
    ("best-fit packing", sequences),
]

# The classifier and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs)
    return docs
