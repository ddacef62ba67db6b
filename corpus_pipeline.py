"""The corpus pipeline: stages over ``documents``, each written and read again before the next.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``; the last returns packed pieces.
Other columns of the input are left behind.  Empty tables pass through all stages; nulls are treated as the
operators describe: a null text fails the quality rules, a row without doc_id is never a duplicate.  Very long texts pass all
stages whole; of repeated rows one stays, and ties between near-duplicates go to the smallest doc_id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, line_dedup, near_dup, packing, quality_rules
from tidewatch.llm.common import table, tuned
from tidewatch.session import job_folder, stage, work_dir, write_once

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "word_bpe_49k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules, or whose host does, go."""
    measured = stage(quality_rules.measure(docs.select(*COLUMNS)), "measures")
    return quality_rules.judge(measured).where("kept").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay only in the last one."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; of repeated rows, one."""
    docs = docs.select(*COLUMNS)
    gone = near_dup.judged_rows(docs).where("NOT kept").select("doc_id", "row").distinct()
    out = docs.withColumn("row", near_dup.row_hash()).join(gone, ["doc_id", "row"], "left_anti")
    return out.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat benchmark passages go."""
    out = decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return out.where("NOT contaminated").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of tokens."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Tokenisation and packing have no SQL counterpart; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per packed piece."""
    docs = table(tuned(spark), sf_dir, "documents")
    for name, step in STAGES:
        place = work_dir(spark, name)
        with job_folder(spark, f"{name}-work"):  # what a stage wrote on its way goes when its rows are written
            docs = write_once(step(tuned(spark), docs, sf_dir), place)
    return docs
