"""One registered query per operator: applied to its whole table with production parameters, columns as agreed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.brown_lm import brown_scores
from tidewater.llm.common import load
from tidewater.llm.fill_middle import fill_middle
from tidewater.llm.filter_audit import audit_documents
from tidewater.llm.imatch import imatch_edits
from tidewater.llm.mixing import mix_sources, with_quality, word_count
from tidewater.llm.multi_index import embedding_groups
from tidewater.llm.sentencepiece_codec import sentencepiece_codec
from tidewater.llm.simhash_vp import simhash_groups
from tidewater.llm.substring_dedup import substring_dedup
from tidewater.llm.suffix_dedup import suffix_dedup
from tidewater.llm.text_density import extract_pages
from tidewater.llm.token_files import read_token_files, write_token_files
from tidewater.llm.zstd_toxicity import fit_toxicity, score_toxicity
from tidewater.session import scratch_dir


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(load(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    docs, quality = with_quality(docs, load(spark, sf_dir, "labels"))
    out = mix_sources(docs, ["doc_id"], quality=quality, size=F.col("size"))
    return out.select("row.doc_id", "size", "source_size", "target", "taken")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(load(spark, sf_dir, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op4_sentencepiece_codec(spark: SparkSession, sf_dir: str, model_file: str = SENTENCEPIECE_MODEL) -> DataFrame:
    out = sentencepiece_codec(load(spark, sf_dir, "documents"), model_file, ["doc_id"])
    digest = F.lower(F.lpad(F.hex(F.xxhash64("ids")), 16, "0")).alias("ids_xxhash64")
    return out.select("doc_id", "n_tokens", digest, F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip", "parity")


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch_edits(load(spark, sf_dir, "documents"), ["doc_id"])


def op6_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(load(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(load(spark, sf_dir, "documents"), shingle=3, distance=2).select("doc_id", "fingerprint", "component_id")


def _fold(ident: str, folds: int) -> Column:
    """Remainder of the crc32 of the id as text; a row without an id counts as one with an empty text (remainder 0)."""
    return F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit(""))) % folds


def op8_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = brown_scores(load(spark, sf_dir, "documents"), _fold("doc_id", 7) != 2, ["doc_id"])
    return out.withColumn("held_out", _fold("doc_id", 7) == 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = fit_toxicity(docs, load(spark, sf_dir, "labels"), _fold("doc_id", 5) != 0)
    out = score_toxicity(docs, model, ["doc_id"])
    return out.select("doc_id", (_fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_pages(load(spark, sf_dir, "pages"), ["page_id", "url"])
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_token_files(spark: SparkSession, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark, "token-files")
    write_token_files(load(spark, sf_dir, "documents"), path, tokenizer_file or public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path, digest=True)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), "lang")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle(load(spark, sf_dir, "documents"), ["doc_id"])
    digests = [F.sha2(c, 256).alias(n) for c, n in (("output", "output_sha256"), ("restored", "restored_sha256"))]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_source_mixing, op3_suffix_array_dedup, op4_sentencepiece_codec, op5_imatch, op6_inverted_multi_index, op7_simhash_near_dedup, op8_brown_lm,
              op9_compression_toxicity, op10_text_density, op11_token_files, op12_filter_audit, op13_fill_middle)
}
