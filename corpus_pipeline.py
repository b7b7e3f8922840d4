"""A training corpus from raw documents: reject, deduplicate, decontaminate, mix, and write token records.

Each stage reads what the one before kept, and works on all of it. ``run`` writes every stage to the shared folder and
reads it back, so that a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carestrata.llm.common import stage, table

#: the rows of ``run`` depend on a trained model and a tokenizer, which SQL cannot express
ORACLE_SQL = None


def reject_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from carestrata.llm.toxicity import reject_toxic

    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from carestrata.llm.simhash import keep_one

    return keep_one(docs, shingle=3, max_bits=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from carestrata.llm.decontam import decontaminate

    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from carestrata.llm.mixing import poisson_mix

    return poisson_mix(docs).drop("copy", "shuffle_key")


def write_token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the records and returns one row for each, read back from the files."""
    from carestrata.llm.queries import tokenizer_path
    from carestrata.llm.records import document_digests, read_records, write_records

    return document_digests(read_records(spark, write_records(docs, tokenizer_path()), with_ids=False))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic_documents),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
    ("token_records", write_token_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
