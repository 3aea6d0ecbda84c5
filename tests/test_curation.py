"""Curation operators: literal cases, invariants and whole builds."""

from __future__ import annotations

import json
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from grainmill.functions import arrays, text
from grainmill.operators import card, cast, chat, selection, synth
from grainmill.plans import build as plans
from grainmill.sources import readers, sinks
from grainmill.streaming import ingest


def apply(spark, make, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").select("i", make(F.col("t")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


CASES = {
    "detokenize": (text.detokenize, {
        "[ WP ] You are a king .": "You are a king.", "[wp] hi": "[wp] hi", "`` do n't '' he said": "\" don't \"he said", "a <newline> b<NEWLINE>c": "a\nb\nc", "a\n\n\n\nb": "a\n\nb", "wait\n, what": "wait, what",
        "it 's the 'dog I 'd": "it's the 'dog I'd", "can 't": "can 't", "( x )": "(x)", 'line one\n"Hi" she': 'line one "Hi" she', 'he " hi " then': 'he "hi "then', "50 % [ ok ] ; fine": "50% [ok]; fine", None: "", "": "",
    }),
    "clean": (text.clean, {"a \t\r\nb": "a\nb", "a\r\r\rb\n\n\n\nc": "a\n\nb\n\nc", "  x  y ": "x  y", "a\n \n \nb": "a\n\nb", None: ""}),
    "hits": (text.keyword_hits, {"The lie and the lied.": 2, "believe families estates lovers": 0, "Secretly, her husband's wife": 3, "SCHEMES fiancée heirloom": 3, "lies lie lied lying": 3, None: 0}),
    "sfw": (text.is_sfw, {"The analysis": False, "a document": False, "peacock": False, "Analyst": False, "": True, None: True, "plain": True}),
    "think": (text.strip_think, {"<think>a</think>b</think>c": "b</think>c", "<think>a</think>\n b": "b", "none": "none", None: ""}),
    "trim": (lambda c: text.smart_trim(c, 10), {"short": "short", "one two, three": "one two...", "abcdefghijklmno": "abcdefghij...", "exactly 10": "exactly 10"}),
    "capitalize": (text.capitalize, {"hELLO wORLD": "Hello world", "": ""}),
    "surrogates": (text.drop_lone_surrogates, {r'"😀"': r'"😀"', r'"a\ud800b"': '"ab"', r'"\udc00"': '""', r'"\\ud800"': r'"\\ud800"'}),
    "list": (lambda c: F.size(arrays.as_list(c)), {'[{"from": "A"}]': 1, '{"from": "A"}': 1, "oops": 0, "[]": 0, "7": 1, None: 0}),
}


@pytest.mark.parametrize("name", CASES)
def test_literal_cases(spark, name):
    make, cases = CASES[name]
    assert apply(spark, make, list(cases)) == list(cases.values())


def test_quality_bounds(spark):
    words = " ".join(f"word{i:02d}" for i in range(20))
    prose = "".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}cdefgh " for i in range(1500))
    ok = {
        prose[:119]: False, prose[:120]: False, (prose[:180]): True, prose[:11999] + "x": True, prose[:12000] + "x": False, None: False, "": False,
        " ".join(["abcdefghij"] * 7 + [f"abcdefg{chr(97 + i)}" for i in range(6)] + ["abcdefghij"] * 12): True, words: True, words[:-7]: False,
    }
    got = apply(spark, text.quality_ok, list(ok))
    assert got == list(ok.values())


def test_norm_key(spark):
    a, b, c, d, n, e = apply(spark, text.norm_key, ["Hello  World\n", "hello world", "x" * 500 + "a", "x" * 500 + "b", None, ""])
    assert a == b and c == d and n == e and a != c


def test_packing(spark):
    paragraphs = ["a" * 700, "b" * 600, "c" * 300, "d" * 1000, "e" * 50]
    assert apply(spark, lambda c: arrays.pack(arrays.paragraphs(c)), ["\n\n".join(paragraphs), "f" * 5000, "", None]) == [["\n\n".join(paragraphs[:2]), "\n\n".join(paragraphs[2:4])], ["f" * 5000], [], []]
    rng = random.Random(5)
    texts = ["\n\n".join("x" * rng.randrange(1, 900) for _ in range(rng.randrange(0, 30))) for _ in range(40)]

    def sequential(t):
        out, held, size = [], [], 0
        for p in filter(None, t.split("\n\n")):
            held.append(p)
            size += len(p)
            if size >= 1200:
                out.append("\n\n".join(held))
                held, size = [], 0
        return out

    assert apply(spark, lambda c: arrays.pack(arrays.paragraphs(c)), texts) == [sequential(t) for t in texts]


def test_dialogue_and_roles(spark):
    raw = '[{"from":"A","message":"hi"},"plain",{"speaker":"B","value":"yo"},{"from":"C","message":""}]'
    assert apply(spark, lambda c: arrays.render_dialogue(F.transform(arrays.as_list(c), arrays.turn_of)), [raw]) == ["A: hi\nplain\nB: yo"]
    turns = "array<struct<from:string,value:string>>"
    got = apply(spark, lambda c: arrays.exchange(F.from_json(c, turns)), ['[{"from":"GPT","value":"a"},{"from":"Human","value":"u"},{"from":"user","value":"v"}]', '[{"from":"user","value":""},{"from":"user","value":"later"}]', None])
    assert [tuple(x) for x in got] == [("u", "a"), ("", None), (None, None)]
    nine = json.dumps({f"k{i}": 1 for i in range(9)})
    assert apply(spark, lambda c: arrays.first_keys(arrays.as_map(c)), [nine, "junk"]) == [", ".join(f"k{i}" for i in range(8)), ""]


def sequential(rows, limit):
    """The loop that caps and keys are defined by: synthetic rows first, then the others."""
    seen, out, n = set(), [], 0
    for i, k in rows[0]:
        if n < limit and k not in seen:
            seen.add(k)
            out.append(i)
            n += 1
    for i, k in rows[1]:
        if k not in seen:
            seen.add(k)
            out.append(i)
    return sorted(out)


def test_dedup_then_cap_equals_the_loop(spark):
    rng = random.Random(1)
    for limit in (1, 2, 5, 50):
        first = [(i, f"k{rng.randrange(12)}") for i in range(20)]
        others = [(100 + i, f"k{rng.randrange(20)}") for i in range(20)]
        frame = lambda rows, o: spark.createDataFrame([(o, i, k) for i, k in rows], "ord int, pos int, key string")
        got = selection.dedup_then_cap(frame(first, 0), frame(others, 1), limit, "key", ["ord", "pos"]).collect()
        assert sorted(r["pos"] for r in got) == sequential((first, others), limit)


@pytest.mark.parametrize("limit", [1000, 1001, 30_000])
def test_caps_of_any_size_keep_the_first_rows(spark, limit):
    rows = spark.range(0, 120_000, 1, 6).select(F.pmod(F.col("id") * 7919, F.lit(400_009)).alias("pos"), F.when(F.col("id") % 4 > 0, "hot").when(F.col("id") % 8 == 0, "cool").alias("slice"))
    got = selection.cap(rows, limit, ["slice"], ["pos"]).collect()
    by = {}
    for r in rows.collect():
        by.setdefault(r["slice"], []).append(r["pos"])
    assert sorted((r["slice"] or "", r["pos"]) for r in got) == sorted((s or "", p) for s, ps in by.items() for p in sorted(ps)[:limit])


def test_no_window_of_a_large_cap_ranks_a_whole_slice(spark):
    rows = spark.range(100).select(F.col("id").alias("pos"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("slice"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for limit in (1001, 30_000):
        ranks = [x for x in plan(selection.cap(rows, limit, ["slice"], ["pos"])).splitlines() if "Window" in x and "row_number" in x]
        assert ranks and all("_run0" in x for x in ranks)
    column = F.when(F.col("slice") == "a", 7).otherwise(3)
    assert "WindowGroupLimit" in plan(selection.cap(rows, column, ["slice"], ["pos"], 7))
    assert selection.cap(rows, column, ["slice"], ["pos"], 7).count() == selection.cap(rows, column, ["slice"], ["pos"], 7000).count() == 10


def test_lines_of_several_files_keep_their_places(spark, tmp_path):
    texts = [json.dumps({"setting": f"s{i}"}) if i % 7 else ("" if i % 2 else "{oops") for i in range(500)]
    texts[3] = '{"setting": "x\\ud800y"}'
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, value string").repartitionByRange(7, "i").sortWithinPartitions("i").select("value").write.text(str(tmp_path / "lines"))
    for schema, field in (("setting string", F.col("setting")), (None, F.try_variant_get("row", "$.setting", "string"))):
        rows = readers.json_lines(spark, str(tmp_path / "lines"), schema, position="pos").select("pos", field.alias("s")).collect()
        assert {r["pos"]: r["s"] for r in rows} == {i: "xy" if i == 3 else f"s{i}" for i in range(500) if i % 7}


def test_the_entry_works_without_the_optional_folders(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "grainmill", tmp_path / "grainmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    check = "import __spark_entry__ as e; q = e.queries(); assert 'card_row' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    for extra in ([], ["corpus_pipeline.py"]):
        for name in extra:
            (tmp_path / name).write_text("from grainmill.llm import mixing\n")
        subprocess.run([sys.executable, "-c", check], cwd=tmp_path, check=True)


def test_scaling():
    assert selection.scaled(7500, 0.01) == 75 and selection.scaled(30, 0.01) == 1 and selection.scaled_scan(800, 0.01) == 50 and selection.scaled_scan(None, 1.0) == 10_000


@pytest.mark.parametrize(("n", "guard", "val"), [(20, True, 0), (21, True, 1), (0, True, 0), (5, False, 1), (2000, True, 40)])
def test_split_sizes(spark, n, guard, val):
    rows = selection.split(spark.range(n), "id", 13, guard=guard).collect()
    assert sorted(r["place"] for r in rows) == list(range(n)) and sum(r["split"] == "val" for r in rows) == val
    assert all((r["split"] == "val") == (r["place"] < val) for r in rows)


def test_the_validation_share_of_a_large_build(spark):
    assert spark.range(1).select(selection.validation_rows(F.lit(44585)).alias("v")).first()["v"] == 891


@pytest.mark.parametrize(("n", "places"), [(29, range(29)), (95, range(0, 88, 3)), (0, range(0))])
def test_stride_sample(spark, n, places):
    rows = selection.stride_sample(selection.shuffled(spark.range(n), "id", 13)).collect()
    assert sorted(r["place"] for r in rows) == list(places)


def test_positions_of_several_files(spark, tmp_path):
    spark.range(0, 50, 1, 1).write.parquet(str(tmp_path / "a"))
    spark.range(50, 70, 1, 3).write.parquet(str(tmp_path / "b"))
    rows = selection.with_position(spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "b"))).collect()
    assert sorted(r["pos"] for r in rows) == list(range(70))


def test_masks_and_padding(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6],)], "f array<int>")
    assert df.select(chat.mask(F.col("f"), F.lit(4)).alias("l")).first()["l"] == [-100] * 4 + [5, 6]
    assert df.select(chat.mask(F.col("f"), F.lit(9)).alias("l")).first()["l"] == [-100] * 6
    rows = spark.createDataFrame([(0, [1, 2, 3], [-100, 2, 3], [1, 1, 1]), (0, [1] * 5, [1] * 5, [1] * 5)], "b int, input_ids array<int>, labels array<int>, attention_mask array<int>")
    out = sorted(tuple(map(tuple, (r["input_ids"], r["labels"], r["attention_mask"]))) for r in chat.pad_batches(rows, "b", 9).collect())
    assert out == [((1, 1, 1, 1, 1), (1,) * 5, (1,) * 5), ((1, 2, 3, 9, 9), (-100, 2, 3, -100, -100), (1, 1, 1, 0, 0))]
    talk = spark.createDataFrame([([("user", "a b"), ("assistant", "c d")],)], "messages array<struct<role:string,content:string>>")
    assert chat.training_rows(talk, max_len=3).count() == 0
    kept = chat.training_rows(talk).first()
    assert len(kept["input_ids"]) == len(kept["labels"]) and kept["labels"][-1] == kept["input_ids"][-1] and kept["labels"][0] == -100


def test_a_library_tokenizer(spark):
    lengths = chat.library_tokens(lambda texts: [[len(w) for w in t.split()] for t in texts])
    talk = spark.createDataFrame([([("user", "a bb"), ("assistant", "ccc")],)], "messages array<struct<role:string,content:string>>")
    # The answer's last word carries the end mark of its turn.
    assert chat.training_rows(talk, tokens=lengths).first()["labels"][-1] == len("ccc<|end|>")


def test_an_empty_cast(spark):
    bible = spark.createDataFrame([], "pos int, " + ", ".join(f"{c} string" for c in cast.COLUMNS))
    chosen = spark.createDataFrame([], "pos int, name string")
    row = cast.assemble(chosen, bible, "s").first()
    assert row["text"] == cast.EMPTY and row["json"] is None
    assert tuple(cast.count_label(spark.createDataFrame([(0, "x"), (1, "y")], "pos int, name string")).first()) == ("2 selected", "· 2 characters")


def test_episodes_follow_from_their_numbers(spark):
    a, b = synth.candidates(spark, 30, 1), synth.candidates(spark, 30, 1)
    rows = a.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, b.collect()))
    for r in rows:
        lines = r["assistant"].split("\n")
        assert lines[0].startswith("EPISODE ") and sum(x.startswith("Scene — ") for x in lines) == 6
        assert all(len(x) <= len("NARRATION: ") + 118 for x in lines if x.startswith("NARRATION: ")) and all(len(x) <= len("VISUAL: ") + 243 for x in lines if x.startswith("VISUAL: "))


PROMPTS = {"fruit": "System one.", "voice": "System two."}


def story(i):
    return f'She said "{i}" of her secret marriage. ' + " ".join(f"{w}{i}" for w in ("betrayal", "garden", "window", "silence", "evening", "letter", "stranger", "morning", "promise", "winter") for _ in range(1)) + " and the family kept a secret about the wedding and the wife while " + " ".join(f"tale{chr(97 + k % 26)}{chr(97 + (i * 7 + k) % 26)}" for k in range(60))


def test_a_build_and_its_extension(spark, tmp_path):
    stories = spark.createDataFrame([("[ WP ] A secret affair .", story(i % 8), i) for i in range(12)], "prompt string, story string, pos long")
    plays = spark.createDataFrame([([("human", "go"), ("gpt", f"<think>x</think>{story(50 + i)}")], "monologue" if i % 2 else "Act_Break", "Drama", i) for i in range(6)], "conversations array<struct<from:string,value:string>>, category string, genre string, pos long")
    config = plans.Config()
    config.slices["fruit_synth"].cap = 6
    built = plans.new(spark, config, {"writingprompts_twist": stories, "screenplay": plays}, PROMPTS).persist()
    by = {r["slice"]: r["n_rows"] for r in card.by_slice(built).collect()}
    assert by == {"fruit_synth": 6, "writingprompts_twist": 8, "screenplay_voice": 3, "screenplay_structure": 3}
    assert built.select("key").distinct().count() == built.count() == 20
    assert {r["s"] for r in built.select(F.col("messages")[0]["content"].alias("s")).collect()} == set(PROMPTS.values())
    out = str(tmp_path / "set")
    sinks.build(built, out, scale=1.0)
    base = readers.chat_splits(spark, f"{out}.train.jsonl", f"{out}.val.jsonl")
    assert base.count() == 20 and '"genre":null' not in spark.read.text(f"{out}.train.jsonl").first()["value"]
    written = json.loads(spark.read.text(f"{out}.card.json").first()["value"])
    assert written["total_rows"] == 20 and written["by_slice"] == by and written["by_license"] == {"ours": 6, "mit": 14} and written["scale"] == 1.0
    more = spark.createDataFrame([([("human", "go"), ("gpt", story(50 + i))], "monologue", "drama", i) for i in range(4, 10)], "conversations array<struct<from:string,value:string>>, category string, genre string, pos long")
    grown = plans.augment(spark, base.drop("split"), config, {"screenplay": more}, PROMPTS)
    assert grown.count() == 24 and grown.where("split = 'val'").count() == 1
    config.slices["screenplay_voice"].cap = 5
    assert plans.augment(spark, base.drop("split"), config, {"screenplay": more}, PROMPTS, count_base=True).count() == 22


def test_readers(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"a": 1}\n\n{"a": \noops\n{"a": 2}\n')
    assert sorted(r["a"] for r in readers.json_lines(spark, str(tmp_path / "a.jsonl.gz"), "a int").where("a is not null").collect()) == [1, 2]
    assert readers.json_lines(spark, str(tmp_path / "a.jsonl.gz")).count() == 2
    assert readers.chat_rows(spark, str(tmp_path / "missing")).count() == 0
    (tmp_path / "bad.jsonl").write_text("{oops\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.chat_rows(spark, str(tmp_path / "bad.jsonl")).collect()
    spark.range(3).withColumn("x", F.lit("x")).write.parquet(str(tmp_path / "p1"))
    spark.range(2).write.parquet(str(tmp_path / "p2"))
    both = readers.parquet_by_intersection(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")], ["id", "x", "gone"])
    assert both.count() == 5 and both.where("x is null").count() == 2
    assert readers.parquet(spark, str(tmp_path / "p1"), ["x"]).columns == ["x"]
    assert readers.pages(spark.range(500), ["id"], 250).groupBy("page").count().count() == 3
    assert readers.first_match(spark.range(10), F.col("id") > 3, ["id"])["id"] == 4
    with pytest.raises(LookupError):
        readers.first_match(spark.range(3), F.col("id") > 3, ["id"])


def test_streaming_ingest_adds_each_key_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = lambda ids: spark.createDataFrame([(i, story(i % 5)) for i in ids], "doc_id long, text string")
    rows(range(6)).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema("doc_id long, text string").parquet(source)
        query = ingest.gated(stream).writeStream.foreachBatch(ingest.append_new(out)).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        rows(range(3, 12)).write.mode("append").parquet(source)
    found = spark.read.parquet(out)
    assert found.count() == found.select("key").distinct().count() == 5


def test_the_entry(spark, small):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
