"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import context_tree, cover_tree, divergence, language_id, mixing, packing, phrases, pii, quality_model, quality_rules, secrets, simhash, vector_search
from riskweave.llm.common import table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"), carry=["doc_id"]).drop("found")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = quality_rules.trusted_sample(table(spark, sf_dir, "labels"))
    return quality_rules.judge_documents(docs, trusted).drop("text")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_documents(table(spark, sf_dir, "documents"), carry=["doc_id"]).drop("first")


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_documents(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_model.score_documents(docs, labels, carry=["doc_id"])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cover_tree.link_vectors(vectors).drop("embedding")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op1_mix": op1_mix, "op2_pii": op2_pii, "op3_quality": op3_quality,
           "op4_simhash": op4_simhash, "op5_context_tree": op5_context_tree, "op6_quality_model": op6_quality_model,
           "op7_secrets": op7_secrets, "op8_language": op8_language,
           "op9_cover_tree": op9_cover_tree, "op10_pack": op10_pack, "op11_phrases": op11_phrases, "op12_divergence": op12_divergence, "op13_top_vectors": op13_top_vectors}
ORACLES = {"op1_mix": mixing.ORACLE, "op11_phrases": phrases.ORACLE, "op12_divergence": divergence.ORACLE, "op13_top_vectors": vector_search.ORACLE}
