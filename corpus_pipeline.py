"""From raw documents to token ids: five stages, each written as Parquet and read again.

The stages are tempered for a corpus that has already been paid for: the classifier drops
only what it scores below its threshold, one document of each near-duplicate group stays,
personal data is masked in place, mixing keeps most of the tokens while it raises small
sources and languages, and the last stage returns ids instead of texts.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm import mixing, near_copies, pieces, pii, pu_quality
from grainmill.llm.common import load, scratch_root

#: Share of the tokens that mixing keeps, and how far it evens sources and languages out.
MIX_SHARE, MIX_TEMPER = 0.8, 0.85


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects.

    Every row is judged by its own text, null as empty; repeated rows and rows without an id
    are judged like any other, without labels the class prior decides, an empty table stays
    empty, and all columns are carried through.
    """
    return pu_quality.keep_predicted(docs, load(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: of the least id, and of its texts one if the id repeats.

    Groups are linked by a similarity of 0.8 or more of five-word shingles; a repeated id
    with another text is a row of its own. Rows without an id link with nothing and stay.
    Texts without words are copies of each other; an empty table stays empty; all columns
    are carried through.
    """
    kept = near_copies.near_copies(docs).where("kept").select(F.col("id").alias("_kept"), F.col("class").alias("_of"))
    classed = near_copies.with_class(docs, "_class")
    one = classed.join(kept, (classed["doc_id"] == kept["_kept"]) & (classed["_class"] == kept["_of"]), "left_semi")
    return one.dropDuplicates(["doc_id", "_class"]).drop("_class").unionByName(docs.where("doc_id is null"))


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and secrets in the texts; no document goes.

    Null texts stay null; ``n_chars`` follows the new text; all columns and rows are carried
    through, and an empty table stays empty.
    """
    return pii.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that tokens approach the target weights.

    Null sources and languages are values of their own, rows without an id share one draw,
    rows of one id draw alike; an empty table stays empty; all columns are carried through.
    """
    return mixing.mix(docs, share=MIX_SHARE, temper=MIX_TEMPER).where("kept").select("row.*")


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left: one row for each, none for a null or empty text's ids."""
    ids = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return ids.select(F.col("id").alias("doc_id"), "ids", F.size("ids").alias("n_tokens"), "text_crc32")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("PII", pii_masking),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", sentencepiece_ids),
]

#: The classifier and the hashes have no SQL form; tests/llm/test_pipeline.py holds run() against stages in memory.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    root = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        path = f"{root}/{k}"
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
