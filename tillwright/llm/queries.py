"""The registered queries of this package: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillwright.llm import (
    chat_format,
    clustering,
    exact_dedup,
    html_text,
    mixing,
    near_dedup,
    packing,
    phrases,
    pii,
    quality_model,
    quality_rules,
    secrets_scan,
    url_filter,
)
from tillwright.llm.common import table
from tillwright.llm.oracle import SQL

URL_RULES = (
    url_filter.Rule(url_filter.ALLOW, "com", "/"),
    url_filter.Rule(url_filter.BLOCK, "example.com", "/en/"),
    url_filter.Rule(url_filter.ALLOW, "www.example.com", "/en/"),
    url_filter.Rule(url_filter.BLOCK, "net", "/es/"),
    url_filter.Rule(url_filter.BLOCK, "net", "/fr/"),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    base = quality_rules.Policy("base", quality_rules.BASE_RULES)
    failed = F.col("failed_bits").bitwiseAND(F.lit(base.mask).cast("long")) != 0
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *names, failed.alias("base_failed"), "kept", "failed_bits")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), str(path), with_ids=False)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clustering.integer_vectors(table(spark, sf_dir, "embeddings"))
    return clustering.digest(clustering.cluster(vectors))


# A conversation that says what other templates use as control strings.
ODD_CHAT = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_CHAT, "conv_id long, turn long, role string, text string")
    return chat_format.digest(chat_format.format_chats(turns.union(odd)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_url_filters, op2_pii, op3_minhash, op4_quality_model, op5_mix,
        op6_quality_rules, op7_packing, op8_secrets, op9_exact_dedup, op10_html,
        op11_phrases, op12_clustering, op13_chat_format,
    )
    return {query.__name__: query for query in operators} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    extra = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return SQL | extra
