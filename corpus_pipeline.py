"""A training corpus from ``documents``: language, near-duplicates, repeated passages, test items, mixture.

Every stage takes what its predecessor kept, written as Parquet, and returns the same
columns; the last one adds the copies' numbers and the key of their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitlake.llm import decontaminate, language, mixing, simhash, substring
from hitlake.llm.common import held_out, new_name
from hitlake.scratch import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of no known language."""
    found = new_name(docs, "language")
    known = language.identify(docs, labelled=~held_out(F.col("doc_id"), 4), name=found)
    return language.keep_known(known, found)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return simhash.deduplicate(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each passage of several sentences once."""
    return substring.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of which a twentieth or more stands in benchmark items."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by the square root of their size, as copies in random order."""
    return mixing.mix(docs, temperature=0.5, total=1.0, seed=6)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
]

#: The stages' results need models and fingerprints that SQL can't say; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
