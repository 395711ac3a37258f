"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import collocations, compression, hamming, licenses, mixing, packing, pitman_yor, projection, quality_gam, secret_scan, spelling, token_blocks, toxicity
from ordermill.llm.common import documents, labels


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_gam": lambda spark, sf_dir: quality_gam.op1(documents(spark, sf_dir), labels(spark, sf_dir)),
        "op2_token_blocks": lambda spark, sf_dir: token_blocks.op2(documents(spark, sf_dir)),
        "op3_packing": lambda spark, sf_dir: packing.op3(documents(spark, sf_dir)),
        "op4_hamming_dedup": lambda spark, sf_dir: hamming.op4(documents(spark, sf_dir)),
        "op5_toxicity": lambda spark, sf_dir: toxicity.op5(documents(spark, sf_dir), labels(spark, sf_dir)),
        "op6_pitman_yor": lambda spark, sf_dir: pitman_yor.op6(documents(spark, sf_dir)),
        "op7_compression_rules": lambda spark, sf_dir: compression.op7(documents(spark, sf_dir)),
        "op8_secret_scan": lambda spark, sf_dir: secret_scan.op8(documents(spark, sf_dir)),
        "op9_mixing": lambda spark, sf_dir: mixing.op9(documents(spark, sf_dir)),
        "op10_projection_dedup": lambda spark, sf_dir: projection.op10(spark.read.parquet(f"{sf_dir}/embeddings.parquet")),
        "op11_collocations": lambda spark, sf_dir: collocations.op11(documents(spark, sf_dir)),
        "op12_spelling": lambda spark, sf_dir: spelling.op12(documents(spark, sf_dir)),
        "op13_licenses": lambda spark, sf_dir: licenses.op13(documents(spark, sf_dir)),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_hamming_dedup": hamming.ORACLE,
        "op9_mixing": mixing.ORACLE,
        "op10_projection_dedup": projection.ORACLE,
        "op11_collocations": collocations.ORACLE,
    }
