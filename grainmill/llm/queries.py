"""The opN_<name> queries: each applies one operator to its whole table and shapes the contract's columns."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm import lm_score as _lm
from grainmill.llm import mixing as _mixing
from grainmill.llm import pieces as _pieces
from grainmill.llm import simhash as _simhash
from grainmill.llm import pii as _pii
from grainmill.llm import pu_quality as _pu
from grainmill.llm import quality_rules as _rules
from grainmill.llm import sharding as _sharding
from grainmill.llm import token_files as _files
from grainmill.llm import vector_dedup as _vectors
from grainmill.llm.common import load, scratch_root
from grainmill.llm.oracles import ORACLES  # noqa: F401


def op1_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors.vector_dedup(load(spark, sf_dir, "embeddings"), cosine=0.98).withColumnRenamed("id", "vec_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _sharding.shard_rows(load(spark, sf_dir, "documents"), shards=8, seed=20)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_no"
    )


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the trusted ones among them; figures are rounded to six places."""
    docs = load(spark, sf_dir, "documents")
    found = _lm.cross_entropy_difference(docs, _lm.labelled_target(load(spark, sf_dir, "labels")))
    figures = [F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")]
    return found.select(F.col("id").alias("doc_id"), "n_tokens", *figures, "kept")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _simhash.simhash_dedup(load(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _pii.detect(load(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{_pii.KINDS[k]}")
    return found.select(
        F.col("id").alias("doc_id"), *map(count, range(4)), F.sha2(_pii.join_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"), _pii.join_spans(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == 4)).cast("long").alias("n_secret"),
    )


def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _pu.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids again and report both."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    back = _pieces.decode_documents(_pieces.encode_documents(load(spark, sf_dir, "documents"), model), model)
    decoded = F.crc32(F.encode("decoded", "UTF-8"))
    return back.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), "text_crc32", decoded.alias("decoded_crc32"), (decoded == F.col("text_crc32")).alias("exact")
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = _rules.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    _files.write_token_files(load(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return _files.read_documents(spark, path).withColumnRenamed("id", "doc_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = _mixing.mix(load(spark, sf_dir, "documents"), temper=0.7, share=0.6, seed=7)
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")


QUERIES = {
    "op1_vector_dedup": op1_vector_dedup,
    "op2_sharding": op2_sharding,
    "op3_lm_score": op3_lm_score,
    "op4_pieces": op4_pieces,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_files": op6_token_files,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_pii": op9_pii,
    "op10_pu_quality": op10_pu_quality,
}
