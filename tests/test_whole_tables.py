"""Queries of the catalogue keep all that their operators keep."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from grainmill.plans import catalogue


def twin(path, table, sql):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/{table}.parquet/*.parquet')")
        return Counter(db.execute(sql).fetchall())


def test_masked_rows_are_cut_at_2048_tokens(spark, tmp_path):
    talks = {0: (10, 5), 1: (100, 7), 2: (2000, 300), 3: (2100, 5)}
    rows = [(c, t, ("user", "assistant")[t], " ".join(f"w{k % 91}" for k in range(n))) for c, sizes in talks.items() for t, n in enumerate(sizes)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r["conv_id"]: r for r in catalogue.mask_labels(spark, str(tmp_path)).collect()}
    assert sorted(found) == [0, 1, 2]
    assert len(found[2]["input_ids"].split()) == 2048 and len(found[1]["input_ids"].split()) > 100
    for name in ("mask_labels", "pad_batch"):
        got = Counter(map(tuple, catalogue.QUERIES[name](spark, str(tmp_path)).collect()))
        assert got == twin(tmp_path, "conversations", catalogue.ORACLES[name])


@pytest.fixture(scope="module")
def one_language(spark, tmp_path_factory):
    """Driver texts as one language with more good rows than the cap of the first round."""
    path = tmp_path_factory.mktemp("one")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("lang", F.lit("en"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def test_the_build_has_no_cap(spark, one_language):
    want = twin(one_language, "documents", catalogue.ORACLES["shuffle_split"])
    got = Counter(map(tuple, catalogue.shuffle_split(spark, str(one_language)).collect()))
    assert got == want and sum(got.values()) > catalogue.CAP


def test_adapters_have_no_limit_that_their_sql_lacks(spark, tmp_path):
    """More dialogues than 10,000, and positions from 10 million on."""
    first = 9_990_000
    talk = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)) + " the end that ends."
    turns = spark.range(first, first + 10_050).select(F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("turn"))
    turns.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit(talk), F.col("conv_id").cast("string")).alias("text")).write.parquet(f"{tmp_path}/conversations.parquet")
    got = Counter(map(tuple, catalogue.adapter_dialogue(spark, str(tmp_path)).collect()))
    assert got == twin(tmp_path, "conversations", catalogue.ORACLES["adapter_dialogue"]) and sum(got.values()) == 10_050
    book = "\n".join("the that and " + " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + line)}ord" for k in range(60)) for line in range(12))
    docs = spark.range(10_000_000, 10_000_003).select(F.col("id").alias("doc_id"), F.lit("src1").alias("source"), F.lit(book).alias("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("adapter_continuation", "adapter_prompt_story", "adapter_chunks"):
        got = Counter(map(tuple, catalogue.QUERIES[name](spark, str(tmp_path)).collect()))
        assert got == twin(tmp_path, "documents", catalogue.ORACLES[name]) and sum(got.values()) >= 3


def test_case_is_changed_letter_by_letter_as_in_sql(spark, tmp_path):
    """Sharp s, ligatures, title case, final sigma, the dotted I and letters whose other case is new."""
    odd = "ßŉǰǆıİΣςﬁﬓᾀᾳᾼẞᲊᲉƛꟋ\U00010d70\U00010d50\U00010400"
    texts = [*odd, *(c + "ΑΣ AΣ" + c + "İX" for c in odd), "", " ß", "dIldo", "dİldo", "AΣ aσ aς " * 30]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("capitalize", "norm_key", "type_token_ratio", "sfw_flag"):
        assert Counter(map(tuple, catalogue.QUERIES[name](spark, str(tmp_path)).collect())) == twin(tmp_path, "documents", catalogue.ORACLES[name]), name
