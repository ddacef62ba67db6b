"""The registered queries: each applies its operator to whole tables and digests the result."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (decontaminate, language_id, line_dedup, near_dup, ngram_join, packing, prefix_trie,
                           quality_crf, quality_rules, secrets, substring_dedup, url_filter, vector_codes)
from tidewatch.llm.common import crc_mod, table, tuned
from tidewatch.session import stage

# The rules of the URL query.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(tuned(spark), sf_dir, "documents").select("doc_id", "text"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("found.items", lambda i: i.cast("string")))
    return out.select("doc_id", F.col("found.n_words").alias("n_words"), "n_hit",
                      F.size("found.items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(tuned(spark), sf_dir, "pages").select("page_id", "url")
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.judge_urls(pages, rules).drop("url")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "source", "text")
    measured = stage(quality_rules.measure(docs).drop("text"), "measures")
    return quality_rules.judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)

    def written(kinds):
        some = F.filter("spans", lambda s: s.kind.isin(*kinds))
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
                        F.sha2(written(secrets.KINDS[:3]), 256).alias("base_sha256"),
                        written(secrets.KINDS).alias("spans"))


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    out = quality_crf.score(docs, quality_crf.train(docs, labels))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    out = language_id.identify(docs, language_id.train(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(tuned(spark), sf_dir, "documents").select("doc_id", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(tuned(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(tuned(spark), sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    text = F.lit(hashlib.sha256(vector_codes.codebook_text(books).encode()).hexdigest())
    return coded.select("vec_id", "code", "error", "label_error", text.alias("codebooks_sha256"))


QUERIES = {
    "op1_near_dup": op1_near_dup,
    "op2_line_dedup": op2_line_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_crf": op5_quality_crf,
    "op6_packing": op6_packing,
    "op7_decontamination": op7_decontamination,
    "op8_secrets": op8_secrets,
    "op9_url_filter": op9_url_filter,
    "op10_language_id": op10_language_id,
    "op11_ngram_join": op11_ngram_join,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_vector_codes": op13_vector_codes,
}
