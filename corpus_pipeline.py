"""Documents to training data: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.line_dedup import dedup_lines
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.near_dedup import dedup_documents
from shelfwise.llm.own_columns import keeping
from shelfwise.llm.quality import fit_ranker, held_out, score_quality
from shelfwise.workspace import write_down


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker, learnt from the labels, places below its threshold go.

    A null text is judged as an empty one, repeated rows alike; without documents nothing
    stays. All columns are kept as they are, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    ranker = fit_ranker(docs, labels)
    return keeping(docs, ("score", "predicted"), lambda d: score_quality(d, ranker).where(F.col("predicted") == 1))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more hold are taken out; ``n_chars`` follows the text.

    A null text becomes an empty one; blank lines stay; other columns are kept as they are.
    """
    kept = keeping(docs, ("n_lines", "n_dropped"), dedup_lines)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8 alike) stays.

    Documents without words are like no other and stay; of equal ids all rows stay or go.
    """
    return dedup_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words of a benchmark item in a row go; those without words stay, and all own columns."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the mix of sources, a null source being one; no row goes."""
    return mix_sources(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
#: Learnt scores and the interleaving have no SQL form; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_down(stage(spark, docs, sf_dir), f"pipeline-{name}").table
    return docs
