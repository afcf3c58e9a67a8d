"""Registered queries of the subpackage (thin: each derives its digest columns
from the operator's output) and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.llm import (
    alignment,
    bestfit,
    bradley_terry,
    collocation,
    decontam,
    html_template,
    packing,
    ppm,
    preference,
    quality_rules,
    sql,
    superminhash,
    toxicity,
    warc,
)
from qualis.llm.session import read


def op1_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(read(spark, sf_dir, "documents")).drop("word_distance", "class_distance")


def op2_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.link(read(spark, sf_dir, "documents"))


def op3_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bradley_terry.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.links(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False)


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.identify(read(spark, sf_dir, "documents"))


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preference.format_arrays(preference.rivals(read(spark, sf_dir, "conversations")))
    return rows.select(
        F.col("pair_id").alias("conv_id"), "prompt_turns", "prompt", "chosen", "rejected",
        preference.mask_text(F.col("chosen_segments")).alias("chosen_mask"),
        preference.mask_text(F.col("rejected_segments")).alias("rejected_mask"), "usable")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(read(spark, sf_dir, "pages"))


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def op12_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(read(spark, sf_dir, "documents"), with_ids=False)


def op13_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.mine(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_divergence": op1_divergence,
    "op2_superminhash": op2_superminhash,
    "op3_bradley_terry": op3_bradley_terry,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_ppm_language": op7_ppm_language,
    "op8_preference": op8_preference,
    "op9_main_text": op9_main_text,
    "op10_warc_index": op10_warc_index,
    "op11_alignment": op11_alignment,
    "op12_bestfit": op12_bestfit,
    "op13_collocation": op13_collocation,
}

ORACLE_SQL = {k: v for k, v in sql.ORACLES.items() if k in QUERIES}
