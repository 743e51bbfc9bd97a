"""A corpus in five stages: toxic documents go, then exact copies, near copies and documents with benchmark passages; the rest is encoded.

Each stage takes what its predecessor kept, is written as Parquet and read again, and filters whole rows, so all but the
last return the columns of ``documents``. Labels are learned from the rows that aren't held out. What a stage's operator writes on the way goes
when the stage's result is stored.

Defined cases: empty tables give an empty result; null and empty texts are clean, equal each other, and have no near copies, so the least id of them
stays; of repeated rows one stays; a null id counts as an id like any other, and in near duplicates links with nothing; columns that ``documents`` has
besides go through, whatever their names, and the ids take the name ``_ids`` where it has ``ids``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from tidewater.llm.queries import tokenizer_path, toxic_labels
from tidewater.llm.scratch import Scratch, dropped_after


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that score 0.5 or more go; the model learns from the labelled rows among ``docs``."""
    return toxicity.drop_toxic(docs, docs, toxic_labels(spark, sf_dir))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of texts equal but for white space one stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, on shingles of five words at a similarity of 0.8: the least id of each component stays."""
    return near_dedup.drop_near_duplicates(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: doc_id, lang, source, n_chars and the ids of each text."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact), ("near_dedup", drop_near), ("decontaminate", drop_contaminated), ("bpe", encode)]

#: A learned score can't be written as SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        with dropped_after():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
