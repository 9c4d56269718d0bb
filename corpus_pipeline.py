"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark
passages, packing. Each stage takes (spark, docs, sf_dir) and returns a frame
that is written and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm import decontamination, ngram_join, packing, quality, suffix_dedup
from airlens.llm.common import read_table, ship, stage
from airlens.llm.queries import quality_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
QUALITY_THRESHOLD = 0.3


def _carried(docs: DataFrame, *names: str) -> dict[str, Column]:
    return {f"own_{c}": F.col(c) for c in names}


def _back(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "text", *[F.col(f"own_{c}").alias(c) for c in COLUMNS[2:]])


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=_carried(docs, *COLUMNS[2:]), with_text=True)
    return _back(scored.where(F.col("score") >= QUALITY_THRESHOLD))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: its smallest id.

    Rows without words link with nothing, so each stays. The others are found
    again by hashes of all their columns, so only hashes pass through the join
    operator; a group keeps one row, so rows equal in every column are one."""
    docs = docs.select(*COLUMNS)
    # The join's words lie between ASCII white space.
    worded = F.coalesce(F.col("text").rlike(r"[^\x09-\x0D ]"), F.lit(False))
    every = [F.col(c) for c in COLUMNS] + [F.col(c).isNull() for c in COLUMNS]
    prints = {"h1": F.xxhash64(*every), "h2": F.xxhash64(F.lit(1), *every)}
    found = ngram_join.classes(docs.where(worded), keep=prints).where("kept")
    stay = stage(found.select("h1", "h2").distinct(), "kept-rows")
    keyed = docs.where(worded).select(*COLUMNS, *[c.alias(n) for n, c in prints.items()])
    kept = keyed.join(stay, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    return kept.select(*COLUMNS).unionByName(docs.where(~worded))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that repeat are cut out of the texts."""
    own = {**_carried(docs, "lang", "source"), "own_null": F.col("text").isNull()}
    out = suffix_dedup.remove_repeats(docs, keep=own, with_text=True)
    # An unchanged null stays null.
    text = F.when(F.col("own_null"), F.lit(None).cast("string")).otherwise(F.col("text"))
    return out.select("doc_id", text.alias("text"), F.col("own_lang").alias("lang"), F.col("own_source").alias("source"),
                      F.length(text).cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    out = decontamination.hits(docs, read_table(spark, sf_dir, "benchmark"), keep=_carried(docs, *COLUMNS[2:]), with_text=True)
    return _back(out.where("n_hit = 0"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("benchmark_passages", drop_contaminated),
    ("packing", pack),
]
# Learned scores and suffix arrays are not SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
