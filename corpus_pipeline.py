"""From raw documents to token counts: the corpus pipeline.

Each stage takes the documents that the one before has kept, as they were written, and ``sf_dir`` for further
tables. All but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import lines, minhash, mixing, sentencepiece, toxicity
from tidegate.workspace import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. The model learns from the labelled rows of ``docs``.

    An id that occurs several times is judged by each of its texts and goes if any is rejected.
    """
    scored = toxicity.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rejected = scored.where("predicted = 1").select("doc_id").distinct()
    return docs.join(rejected.hint("shuffle_merge"), "doc_id", "left_anti").select(*docs.columns)


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier runs; those that lose all their lines go."""
    found = lines.dedup(docs).where("n_deleted = 0 OR n_deleted < n_lines")
    return _measured(found.select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id.

    Rows with a NULL id stay. Of rows that share an id one stays, that with the least text.
    """
    found = minhash.near_duplicates(docs, width=5)
    kept = found.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    rows = docs.join(kept.hint("shuffle_merge"), "doc_id", "left_semi").select(*docs.columns)
    one = rows.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("r"))
    one = one.select(*[F.col("doc_id") if c == "doc_id" else F.col("r").getField(c).alias(c) for c in docs.columns])
    return one.unionByName(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; one that it takes in part comes with its first words."""
    return _measured(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row."""
    return sentencepiece.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", delete_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# Nearest-example votes and pieces are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for label, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{label}").df
    return STAGES[-1][1](spark, docs, sf_dir)
