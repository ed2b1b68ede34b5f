"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.byte_bpe import Vocabulary, decode, encode
from shelfwise.llm.collocations import best_phrases, mine_phrases
from shelfwise.llm.conversation_repair import damage, digests, repair
from shelfwise.llm.decontaminate import find_contamination
from shelfwise.llm.html_text import extract_text
from shelfwise.llm.language_model import score_documents
from shelfwise.llm.line_dedup import dedup_lines
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.near_dedup import near_duplicates
from shelfwise.llm.neighbours import nearest_neighbours
from shelfwise.llm.quality import fit_ranker, held_out, score_quality
from shelfwise.llm.reputation import judge_urls
from shelfwise.llm.substring_dedup import mark_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of its number, where there is one."""
    outcomes = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("outcome"))
    return judge_urls(_table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, per_cent=85)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ranker = fit_ranker(docs, _table(spark, sf_dir, "labels").where(~held_out()))
    return score_quality(docs, ranker).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, ~held_out(fold=1))
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "longest_words",
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    decimal = F.array_join(F.col("tokens").cast("array<string>"), " ")
    told = encoded.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), "tokens")
    return decode(told, vocabulary).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = mine_phrases(_table(spark, sf_dir, "documents").select("lang", "text"))
    return best_phrases(phrases).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = repair(damage(turns))
    found = turns.select(F.col("conv_id").alias("id")).distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    hashes = digests(repaired.rows).withColumnRenamed("conv_id", "hashed")
    return (
        found.join(repaired.conversations, F.col("id").eqNullSafe(F.col("conv_id")), "left")
        .join(hashes, F.col("id").eqNullSafe(F.col("hashed")), "left")
        .select(
            F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_neighbours": op2_neighbours,
    "op3_mixing": op3_mixing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_near_dedup": op6_near_dedup,
    "op7_quality": op7_quality,
    "op8_language_model": op8_language_model,
    "op9_decontamination": op9_decontamination,
    "op10_html_extraction": op10_html_extraction,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}
