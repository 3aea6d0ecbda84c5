"""Gates work a value out once, move no text that is not asked for, and give the results of their SQL on odd texts."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from grainmill.functions import arrays, text
from grainmill.plans import catalogue
from grainmill.plans import twins as q
from grainmill.sources import scratch
from test_whole_tables import twin

ODD = [
    "", " ", "　\x1c a  ", "a \t\n\n\n\n b\t\n", "x" * 3 + " " * 50 + "y", " \n" * 20, "a\r\r\nb \r\n c", "one porn", "COCKtail", "doc\nument cums", "Hunter xx x", "nsf w", "İ dİldo", "fuc\nk", "pu ssy",
    "word " * 300, " ".join(f"w{i}é" for i in range(60)), "A" * 499 + "  b", "A" * 499 + " " * 3000 + "b", " " * 2500 + "tail", "naïve " * 40 + "Straße", "k" * 2100,
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_gate_and_a_packing_split_a_text_once(spark, tmp_path):
    spark.createDataFrame([(0, "x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    # The other splits are those into letters, for texts with letters whose case is new.
    assert _plan(docs.where(text.quality_ok("text"))).count("(?U)[\\s\\x{1C}-\\x{1F}]+, -1)") == 1
    assert _plan(docs.select(arrays.pack(arrays.paragraphs("text")).alias("x"))).count("split(") == 1


def test_odd_texts_pass_the_gates_as_in_sql(spark, tmp_path):
    spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = docs.select("doc_id", text.clean("text"), text.strip("text"), F.coalesce(text.reject_reason("text"), F.lit("ok")), text.is_sfw("text"), text.norm_key("text"), text.detokenize("text"))
    sql = f"SELECT doc_id, {q.clean('text')}, {q.strip('text')}, coalesce({q.reason('text')}, 'ok'), {q.is_sfw('text')}, {q.key('text')}, {q.detokenize('text')} FROM documents"
    assert Counter(map(tuple, got.collect())) == twin(tmp_path, "documents", sql)


def test_a_story_that_shrinks_is_not_left_out_early(spark):
    fits, too_long = "[WP] " + "<newline> " * 900 + "a, " * 200, "a" * 8004
    rows = spark.createDataFrame([(0, fits), (1, too_long), (2, "[ABC]" + "a" * 8000), (3, None), (4, "``''" * 5000)], "i int, t string")
    kept = {r["i"]: r["k"] for r in rows.select("i", text.detokenized_may_fit("t", 8000).alias("k")).collect()}
    assert kept == {0: True, 1: False, 2: True, 3: True, 4: True}
    short = rows.where(F.length(text.detokenize("t")) <= 8000).select("i").collect()
    assert {r["i"] for r in short} <= {i for i, k in kept.items() if k}


def test_the_build_moves_no_text_that_is_not_asked_for(spark, small, monkeypatch):
    kept, keep = [], scratch.keep
    monkeypatch.setattr(scratch, "keep", lambda df, *a: kept.append(df.columns) or keep(df, *a))
    for name in ("card_by_slice", "card_by_license", "card_totals", "card_row", "first_match", "shuffle_split", "stride_sample"):
        catalogue.QUERIES[name](spark, small)
    assert len(kept) == 7 and not any({"text", "assistant", "messages"} & set(c) for c in kept)
    catalogue.chat_splits(spark, small)
    # Both splits are written from one table, so places are found once.
    assert len(kept) == 9 and set(kept[8]) == {"messages", "meta", "split"}
