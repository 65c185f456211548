"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, conversation_trie, decontaminate, hard_negatives, license_scan, ngram_join, pii, quality_classifier, quality_rules, sharding, substring_dedup, token_file, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.measure(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "n_stop_words", "n_lines", "n_upper", "base_failed", "kept")


def vocabulary() -> str:
    """Default vocabulary file of the BPE queries; the operators take a path; op2's refuses files of other rules."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.report(docs, pii.train(docs))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(_table(spark, sf_dir, "documents"), vocabulary())


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"), license_scan.CATALOGUE, license_scan.IDENTIFIERS)


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.round_trip(_table(spark, sf_dir, "documents"), vocabulary())


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.forked_trie(_table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_bpe": op2_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontaminate": op5_decontaminate,
    "op6_warc": op6_warc,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_sharding": op9_sharding,
    "op10_license_scan": op10_license_scan,
    "op11_token_ids": op11_token_ids,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_hard_negatives": op13_hard_negatives,
}
