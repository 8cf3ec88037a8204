"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet
to the shared folder and reads again as the next stage's ``docs``. All but the last return the
columns of documents; the last returns the pieces and the sequences they are packed into.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunesmith.llm import jaccard, langid, line_dedup, mixing, packing
from tunesmith.llm.common import read_table, stored
from tunesmith.llm.tokens import tokenizer_path
from tunesmith.session import ship_package


def _ready(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, "documents") if docs is None else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known well enough; the model learns from these same documents."""
    return langid.identified_documents(_ready(spark, docs, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds."""
    return line_dedup.deduplicated_documents(_ready(spark, docs, sf_dir))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.representative_documents(_ready(spark, docs, sf_dir))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words that the mix takes of them."""
    return mixing.mixed_documents(_ready(spark, docs, sf_dir))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1,024 tokens."""
    return packing.pack(_ready(spark, docs, sf_dir), tokenizer_path(), end_id=0)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
