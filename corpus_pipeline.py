"""Documents to a training mixture: language, near duplicates, benchmark passages, personal data, mixing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a frame with the
columns of ``documents``; the last one adds topic, n_tokens, weight and copies. Between stages the rows are
written as Parquet to the shared checkpoint folder and read again. Nulls, empty and long texts, repeated
rows and extra columns are handled as each operator's docstring says; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import decontaminate, language, minhash, mixing, pii
from stockweave.llm.common import read_table
from stockweave.session import materialize, use_utc


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; a text without letters has none."""
    found = language.identify_documents(docs, language.fit(docs), read_table(spark, sf_dir, "pages"))
    return found.filter("accepted").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id."""
    return minhash.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text."""
    clean = pii.redact_text(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn documents with their number of copies."""
    return mixing.mix(docs).filter("copies > 0")


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("pii", personal_data_stage),
    ("mixing", mixing_stage),
]

# The language, personal-data and alignment stages are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(use_utc(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
