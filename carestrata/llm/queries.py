"""One query for each corpus operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carestrata.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.quality import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_bootstrapped_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.pii import find_personal_data, span_digests

    return span_digests(find_personal_data(table(spark, sf_dir, "documents")))


def op3_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.mixing import poisson_mix

    return poisson_mix(table(spark, sf_dir, "documents"))


def op4_byte_recurrent_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op5_deletion_variant_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op6_lyndon_group_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.suffix import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_framed_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.records import document_digests, read_records, write_records

    folder = write_records(table(spark, sf_dir, "documents"), tokenizer_path())
    return document_digests(read_records(spark, folder, with_ids=False))


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.arc import archive_digests, convert_archives, read_warc, write_arc

    folder = convert_archives(spark, write_arc(table(spark, sf_dir, "pages")))
    return archive_digests(read_warc(spark, folder))


def op9_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.toxicity import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.decontam import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_subvector_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.centroids import cluster

    return cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, seed=3)


def op12_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.chat import chat_digests, conversation_log, format_conversations

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat_digests(format_conversations(conversation_log(rows.union(added))))


def op13_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carestrata.llm.repair import damage, repair_conversations, repair_digests

    rows, dropped = damage(table(spark, sf_dir, "conversations"))
    return repair_digests(repair_conversations(rows, dropped))


def llm_queries():
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
