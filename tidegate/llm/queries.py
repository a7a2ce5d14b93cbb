"""The registered queries of this package and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import (
    contamination,
    infill,
    licenses,
    lines,
    merkle,
    minhash,
    mixing,
    neighbours,
    pii,
    secrets,
    sentencepiece,
    toxicity,
    whitening,
)
from tidegate.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


QUERIES["op1_license_scan"] = op1_license_scan
SQL["op1_license_scan"] = licenses.scan_sql()


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op4_sentencepiece"] = op4_sentencepiece


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allot(table(spark, sf_dir, "documents"))


QUERIES["op7_mixing"] = op7_mixing
SQL["op7_mixing"] = mixing.allot_sql()


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(documents).select("doc_id", "n_lines", "n_deleted", "text")


QUERIES["op2_line_dedup"] = op2_line_dedup
SQL["op2_line_dedup"] = lines.dedup_sql()


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


QUERIES["op5_secret_scan"] = op5_secret_scan
SQL["op5_secret_scan"] = secrets.scan_sql()


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op6_minhash"] = op6_minhash
SQL["op6_minhash"] = minhash.near_duplicates_sql()


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_edited(table(spark, sf_dir, "documents"))


QUERIES["op9_merkle"] = op9_merkle
SQL["op9_merkle"] = merkle.compare_edited_sql()


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op8_toxicity"] = op8_toxicity


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


QUERIES["op10_neighbours"] = op10_neighbours


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


QUERIES["op3_pii"] = op3_pii


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op11_contamination"] = op11_contamination
SQL["op11_contamination"] = contamination.decontaminate_sql()


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


QUERIES["op12_infill"] = op12_infill
SQL["op12_infill"] = infill.digests_sql()


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


QUERIES["op13_whitening"] = op13_whitening

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
