"""The registered queries of the subpackage; each reads its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm import (brown, decontamination, exact_dedup, langid, multi_index, ngram_join, oracle, packing, quality,
                         ranked_search, spelling, suffix_dedup, tokenfile, toxicity)
from airlens.llm.common import fold, read_table, stage
from airlens.session import scratch_dir

TOXIC_CHAIN = ["low_quality", "toxic"]


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a document is held out; one without an id is not."""
    return F.coalesce(fold(F.col("doc_id"), modulus) == remainder, F.lit(False))


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 5) == 1
    model, words = brown.fit(docs.where(~held))
    return brown.score(docs, model, words, held)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = held_out(4, 2)
    model = langid.fit(docs.where(~held))
    return langid.predict(docs, model, keep={"held_out": held})


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(read_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    tokenfile.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return tokenfile.read_tokens(spark, path)


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model | None:
    train = labels.where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    return quality.fit(docs, train)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    out = quality.score(docs, model, keep={"held_out": held_out(5, 0)})
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labels of documents whose crc32 mod 5 is not 0."""
    docs = read_table(spark, sf_dir, "documents")
    labels = (read_table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
              .select("doc_id", (F.lit(1) - F.col("quality")).alias("low_quality"), "toxic"))
    chain = toxicity.fit(docs, labels, TOXIC_CHAIN)
    out = toxicity.score(docs, chain, TOXIC_CHAIN, keep={"held_out": held_out(5, 0)})
    threshold = chain.thresholds[TOXIC_CHAIN.index("toxic")] if chain else 0.5
    return (out.withColumn("score", F.col("p_toxic"))
            .withColumn("predicted", (F.col("p_toxic") >= threshold).cast("int")))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of even ids stand for what earlier runs have kept digests of."""
    docs = read_table(spark, sf_dir, "documents")
    return exact_dedup.deduplicate(docs, history=F.col("doc_id") % 2 == 0)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(read_table(spark, sf_dir, "documents"))
    return ranked_search.search(index, read_table(spark, sf_dir, "benchmark"), k=10)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(read_table(spark, sf_dir, "documents"), min_length=6, min_count=5, damage=199)
    return spelling.variants(words, ratio=5)


QUERIES = {
    "op1_brown_lm": op1_brown_lm,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_decontamination": op6_decontamination,
    "op7_token_files": op7_token_files,
    "op8_quality": op8_quality,
    "op9_near_vectors": op9_near_vectors,
    "op10_toxicity": op10_toxicity,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE_SQL: dict[str, str] = {
    "op5_ngram_join": oracle.OP5,
    "op6_decontamination": oracle.OP6,
    "op11_exact_dedup": oracle.OP11,
    "op12_ranked_search": oracle.OP12,
    "op13_spelling_variants": oracle.OP13,
}
