"""The registered queries of this package: ``opN_<name>``, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from hitlake.operators import number_rows
from hitlake.scratch import scratch_path

from . import bpe, chat, decontaminate, language, lattice, mixing, quality, repair, simhash, sql, substring, toxicity, variants, warc
from .common import held_out

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_digest(items: F.Column) -> F.Column:
    return F.sha2(F.array_join(items, ","), 256)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is a reply tree of one branch: each turn answers the one before."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], said.schema)
    rows = said.unionByName(extra)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    numbered = number_rows(rows, order, name="node")
    messages = chat.link_turns(numbered, "node", "conv_id")
    paths = chat.best_paths(messages, tree="conv_id", node="node", parent="parent", unique=True)
    parts = chat.format_paths(paths, messages, node="node", role="role", text="text", unique=True)
    return chat.read_back(parts).drop("rank").withColumnRenamed("tree", "conv_id")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, name="r").select(
        "doc_id", "r.n_removed", "r.removed_chars", (F.col("r.n_removed") > 0).alias("changed"), F.col("r.text").alias("text")
    )


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = ~held_out(F.col("doc_id"), 4)
    found = language.identify(docs, labelled=learned, name="found")
    return found.select("doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "found.lang_pred", "found.score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 4)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~out)
    scored = toxicity.add_scores(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, temperature=0.5, total=1.0, seed=6)


#: An existing vocabulary of pieces with scores, read where it lies.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op7_lm_score(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7)
    model = lattice.learn(docs, ~out, vocabulary=vocabulary)
    scored = lattice.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_windows(docs, table(spark, sf_dir, "benchmark"), name="hits")
    hits = F.col("hits")
    return found.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("bigint").alias("n_items"),
        joined_digest(hits["items"]).alias("items_sha256"),
        decontaminate.contaminated(hits).alias("contaminated"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    read = warc.read_archive(spark, path)
    header = F.col("header")
    return read.select(
        warc.urn_id(warc.header_field(header, "WARC-Record-ID")).alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        warc.header_field(header, "WARC-Type").alias("record_type"),
        warc.urn_id(warc.header_field(header, "WARC-Refers-To")).alias("refers_to"),
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report = repair.repair_report(conversations.select(F.col("conv_id").alias("conv")), repair.damage(conversations))
    return report.withColumnRenamed("conv", "conv_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.count_words(table(spark, sf_dir, "documents"), one_in=199))


def op13_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.token_report(table(spark, sf_dir, "documents"), bpe.load(vocabulary))


QUERIES: dict[str, Query] = {
    "op1_chat_format": (op1_chat_format, sql.CHAT_FORMAT),
    "op2_substring_dedup": (op2_substring_dedup, None),
    "op3_simhash_dedup": (op3_simhash_dedup, None),
    "op4_language_id": (op4_language_id, None),
    "op5_toxicity": (op5_toxicity, None),
    "op6_mix_sources": (op6_mix_sources, sql.MIX_SOURCES),
    "op7_lm_score": (op7_lm_score, None),
    "op8_decontaminate": (op8_decontaminate, sql.DECONTAMINATE),
    "op9_quality_rules": (op9_quality_rules, sql.QUALITY_RULES),
    "op10_warc": (op10_warc, sql.WARC),
    "op11_repair": (op11_repair, sql.REPAIR),
    "op12_spelling_variants": (op12_spelling_variants, sql.VARIANTS),
    "op13_bpe": (op13_bpe, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
