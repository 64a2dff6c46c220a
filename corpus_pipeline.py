"""Documents to packed training sequences in five stages, each over what the last one kept.

A stage takes and returns the columns of documents, others among them, but for the last. Null and
empty texts have no words, so the quality rules reject them; an empty table stays empty through
all stages; columns named like those an operator makes are kept as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from undercut.llm import decontamination, near_duplicates, packing, personal_data, quality
from undercut.shared import delete_tables, materialise, noted_tables

#: Tokenizers, and so packed sequences, are beyond SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules reject go."""
    return quality.drop_rejected(docs)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, by the shingles of the registered query."""
    return near_duplicates.drop_duplicates(docs, width=2, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that disclose it are replaced in the texts; all documents stay."""
    return personal_data.sanitise(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicate_groups),
    ("benchmark decontamination", benchmark_passages),
    ("personal data", personal_data_removed),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents.

    Each stage's result is written to the shared folder; then the tables it was read from,
    the result of the stage before among them, are deleted. Those that the last stage's result
    is read from stay. Whoever calls stages alone has theirs in the folder until it is cleared.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    *stages, (_, last) = STAGES
    for name, step in stages:
        with noted_tables() as tables:
            docs = materialise(step(spark, docs, sf_dir), name.replace(" ", "-"))
        *done, written = tables
        delete_tables(spark, [*before, *done])
        before = [written]
    return last(spark, docs, sf_dir)
