"""Corpus pipeline: toxicity, near duplicates, repeated passages, source mixing, tokenising.

Each stage is written as Parquet and read again as the next one's documents; all but the last return the columns of
the documents they were given (text is what is left of it). A stage works on everything its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import load, materialize, order_key
from tidewater.llm.mixing import mix_sources, with_quality, word_count
from tidewater.llm.queries import SENTENCEPIECE_MODEL, _fold
from tidewater.llm.sentencepiece_codec import sentencepiece_codec
from tidewater.llm.simhash_vp import simhash_groups
from tidewater.llm.suffix_dedup import suffix_dedup
from tidewater.llm.zstd_toxicity import fit_toxicity, score_toxicity

ROW = "__row"  # carries a document's columns as one struct, so that none clashes with an operator's


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5. Equal rows share a fate; null and empty texts stay."""
    model = fit_toxicity(docs, load(spark, sf_dir, "labels"), _fold("doc_id", 5) != 0)
    rows = docs.select(F.struct(*docs.columns).alias(ROW), "text")
    return score_toxicity(rows, model, [ROW]).where("score < 0.5").select(f"{ROW}.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id (rows without an id come last), and one of rows equal to it."""
    groups = simhash_groups(docs, shingle=3, distance=2).where("key = component_key")
    firsts = groups.groupBy("component_fp").agg(F.min("key").alias("__key"), F.min("text_hash").alias("__hash")).drop("component_fp")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct(*docs.columns).alias(ROW), order_key(F.col("doc_id"), text).alias("__key"), F.xxhash64(text).alias("__hash"))
    return keyed.join(firsts, ["__key", "__hash"], "left_semi").dropDuplicates(["__key", "__hash"]).select(f"{ROW}.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that suffix-array dedup removes; what is left of a character that was cut in two goes with them.
    Every document stays, a null text stays null; n_chars follows the text."""
    rows = docs.select(F.struct(*docs.columns).alias(ROW), "doc_id", "text")
    out = suffix_dedup(rows, length=100, keep=[ROW])
    text = F.when(F.col(f"{ROW}.text").isNotNull(), F.col("kept_text"))
    row = F.col(ROW).withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.withColumn(ROW, row).select(f"{ROW}.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole copies, so documents that a source has to spare are left out. Sizes are counted anew.
    Texts without words take no part in word targets; each stays once."""
    rows = docs.select(F.struct(*docs.columns).alias(ROW), "doc_id", "source", word_count(F.col("text")).alias("size"))
    rows, quality = with_quality(rows, load(spark, sf_dir, "labels"))
    mixed = mix_sources(rows, [ROW], quality=quality, size=F.col("size"))
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies")).cast("int")
    return mixed.select(F.col(f"row.{ROW}").alias(ROW), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select(f"{ROW}.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the check that they decode to its text."""
    rows = docs.select("doc_id", "text")
    out = sentencepiece_codec(rows, SENTENCEPIECE_MODEL, ["doc_id"])
    return out.select("doc_id", "n_tokens", "ids", "round_trip", "parity")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("mixing", mix),
    ("tokens", tokenise),
]
ORACLE_SQL = None  # SQL expresses neither compression distances nor shingle hashes; tests/llm compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
