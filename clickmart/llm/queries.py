"""One query per operator, over whole tables, and SQL text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import decontaminate, jaccard, language, mixing, oracle, packing, quality, spelling, suffixes, surrogates, token_planes, toxicity, trie, windows
from clickmart.llm.common import crc, read, stage

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.remove_repeats(read(spark, sf_dir, "documents"), 400, ["doc_id"])
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc("doc_id") % 3 == 1, F.lit(False))
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out)
    texts = language.sample(docs.filter(~F.col("held_out")))
    return language.identify(docs.select("doc_id", "held_out", "text"), texts).drop("text")


def op4_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = windows.remove_windows(read(spark, sf_dir, "documents"), 13, ["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), 4, 85)


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace_entities(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return replaced.select("doc_id", "n_entities", "entity_types", "text")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    return token_planes.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(read(spark, sf_dir, "documents"))
    judged = judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return stage(judged, "quality-judged")  # a written table of eight narrow columns, so filters and joins on it stay cheap


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc("doc_id") % 5 == 0, F.lit(False))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    labels = read(spark, sf_dir, "labels").filter(crc("doc_id") % 5 != 0)
    scored = toxicity.toxicity(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    examples = packing.as_examples(read(spark, sf_dir, "documents"))
    packed = packing.pack(examples, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_radix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_decontaminate, op2_suffix_dedup, op3_language_id, op4_window_dedup, op5_jaccard_join, op6_surrogates, op7_mix_sources,
                                    op8_token_planes, op9_quality_rules, op10_toxicity, op11_vector_packing, op12_radix_trie, op13_spelling_variants)}


def oracle_sql() -> dict[str, Callable[[], str]]:
    """A function for each text, so that one that cannot be built costs no other."""
    return oracle.texts()
