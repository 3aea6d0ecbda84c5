"""The registered queries of the curation operators and their DuckDB twins.

Each entry applies an operator to a whole driver table; where the table has nothing for it
to do (no stray blanks, no reasoning blocks), both sides put the same noise in first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions import arrays, fixed, text
from grainmill.operators import adapters, card, cast, chat, selection, synth
from grainmill.plans import twins as q
from grainmill.sources import readers, scratch, sinks

#: Keywords that occur in the driver's invented prose.
PROSE = ("the", "that", "and", r"un\w*", "les?", "der", r"lo[s]?", r"qu\w*")
PROMPTS = {"en": "Write in English.", "fr": "Write in French.", "de": "Write in German.", "es": "Write in Spanish."}
CAP, SEED = 300, 13


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def _talks(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as arrays of turns in order."""
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    turns = F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("from"), F.col("text").alias("value"))))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def _of(make: Callable[[Column], dict[str, Column]]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that puts expressions of the text beside the id."""
    return lambda spark, sf: _docs(spark, sf).select("doc_id", *[c.alias(k) for k, c in make(F.col("text")).items()])


def _sql(**expressions: str) -> str:
    return "SELECT doc_id, " + ", ".join(f"{e} AS {k}" for k, e in expressions.items()) + " FROM documents"


def _noisy(t: Column) -> Column:
    for old, new in q.NOISE:
        t = F.replace(t, F.lit(old), F.lit(new))
    return F.concat(F.lit(q.NOISE_HEAD), t)


def _reports(t: Column) -> dict[str, Column]:
    return {"reason": F.coalesce(text.reject_reason(t), F.lit("ok")), "ok": text.quality_ok(t)}


# ------------------------------------------------------------------ selection
def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", "lang", "source", text.norm_key("text").alias("key"))


def scan_limit(spark: SparkSession, sf: str) -> DataFrame:
    return selection.scan_limit(selection.with_position(_docs(spark, sf)), CAP).select("doc_id", "pos")


def cap_per_slice(spark: SparkSession, sf: str) -> DataFrame:
    return selection.cap(_docs(spark, sf).select("doc_id", "lang"), 40, ["lang"], ["doc_id"])


def dedup_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return selection.first_wins(_keyed(spark, sf), "key", ["lang", "doc_id"]).select("doc_id", "lang", "key")


def dup_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _keyed(spark, sf).groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_id")).where("n_rows > 1")


def dedup_then_cap(spark: SparkSession, sf: str) -> DataFrame:
    rows = _keyed(spark, sf).withColumn("ord", (F.col("lang") != "en").cast("int"))
    return selection.dedup_then_cap(rows.where("ord = 0"), rows.where("ord = 1"), 200, "key", ["ord", "doc_id"]).select("doc_id", "lang", "key")


def fold_slices(spark: SparkSession, sf: str) -> DataFrame:
    rows = _keyed(spark, sf)
    return selection.fold([(rows.where(F.col("lang") == x), 150) for x in ("en", "fr", "de", "es")], "key", ["doc_id"]).select("doc_id", "lang", "key")


def augment_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """English rows are the base; others come in if their answer is new."""
    rows = _keyed(spark, sf)
    return selection.first_wins(selection.new_rows(rows.where("lang <> 'en'"), rows.where("lang = 'en'"), "key"), "key", ["doc_id"]).select("doc_id", "lang", "key")


# ------------------------------------------------------------------ the build
def build(spark: SparkSession, sf: str, *columns: str | Column) -> DataFrame:
    """Clean, gate, wrap as chat, keep the first of each key, split.

    With ``columns`` these are taken of each row before it is moved, so its texts stay where they are.
    """
    rows = scratch.once(_docs(spark, sf).select("doc_id", "lang", "source", text.clean("text").alias("assistant")))
    good = rows.where(text.quality_ok("assistant")).where(text.is_sfw("assistant")).withColumn("key", text.norm_key("assistant"))
    license = F.when(F.col("source") != "src3", F.col("source"))
    shaped = good.select("doc_id", "lang", "key", F.concat(F.lit("Continue: "), text.head("assistant", 40)).alias("user"), "assistant", adapters.meta(source=F.col("source"), slice=F.col("lang"), license=license).alias("meta"))
    wrapped = chat.wrap(shaped, PROMPTS, "lang").select("doc_id", "lang", "key", *(columns or ("messages", "meta")))
    return selection.split(selection.first_wins(wrapped, "key", ["lang", "doc_id"]).drop("key"), "doc_id", SEED)


def _sized(spark: SparkSession, sf: str) -> DataFrame:
    """The build with the characters of a row instead of its texts: what cards ask for."""
    return build(spark, sf, "meta", arrays.message_chars("messages").alias("n_chars"))


def card_by_slice(spark: SparkSession, sf: str) -> DataFrame:
    return _sized(spark, sf).groupBy(F.col("meta.slice").alias("slice"), "split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars"))


def chat_json(spark: SparkSession, sf: str) -> DataFrame:
    return build(spark, sf).select("doc_id", chat.as_json("messages").alias("json"), arrays.message_chars("messages").alias("n_chars"), chat.answer("messages").alias("answer"))


def shuffle_split(spark: SparkSession, sf: str) -> DataFrame:
    return build(spark, sf, "meta").select("doc_id", "place", "total", "split")


def stride_sample(spark: SparkSession, sf: str) -> DataFrame:
    return selection.stride_sample(build(spark, sf, "meta")).select("doc_id", "place")


def card_row(spark: SparkSession, sf: str) -> DataFrame:
    """The data card with its maps as JSON."""
    row = card.card(_sized(spark, sf), scale=1.0, chars=F.col("n_chars"))
    return row.select("total_rows", "train_rows", "val_rows", "approx_tokens", *[F.to_json(c).alias(c) for c in ("by_slice", "by_license", "sources")], "format", "policy", "scale")


def chat_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The build written as JSON lines and read back, both splits."""
    built = scratch.keep(build(spark, sf).select("messages", "meta", "split"), "built")
    out = f"{scratch.root(spark)}/grainmill-chat-{uuid.uuid4().hex}"
    for part in ("train", "val"):
        sinks.json_lines(built.where(F.col("split") == part).select("messages", "meta"), f"{out}.{part}.jsonl")
    rows = readers.chat_splits(spark, f"{out}.train.jsonl", f"{out}.val.jsonl")
    return rows.select("split", F.col("meta.slice").alias("slice"), "meta.license", chat.as_json("messages").alias("json"))


def first_match(spark: SparkSession, sf: str) -> DataFrame:
    """The first row of a slice in shuffled order."""
    found = readers.first_match(build(spark, sf, "meta").select("doc_id", "place", F.col("meta.slice").alias("slice")), F.col("slice") == "fr", ["place"])
    return spark.createDataFrame([found], "doc_id long, place long, slice string")


def shards_of_two_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables as shards of one source, each with the wanted columns that it has."""
    rows = readers.parquet_by_intersection(spark, [f"{sf}/documents.parquet", f"{sf}/benchmark.parquet"], ["doc_id", "item_id", "text", "missing"])
    return rows.select("doc_id", "item_id", F.length("text").alias("n_chars"))


def json_lines_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON lines in several files, every tenth line cut short: places count all lines."""
    out = f"{scratch.root(spark)}/grainmill-lines-{uuid.uuid4().hex}"
    line = F.to_json(F.struct("doc_id", F.left("text", F.lit(40)).alias("text")))
    broken = _docs(spark, sf).select("doc_id", F.when(F.col("doc_id") % 10 == 3, F.left(line, F.lit(12))).otherwise(line).alias("value"))
    broken.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").select("value").write.text(out)
    return readers.json_lines(spark, out, "doc_id long, text string", position="pos")


def bible_array(spark: SparkSession, sf: str) -> DataFrame:
    """The character table as one JSON array in a file, and how many of each gender it holds."""
    out = f"{scratch.root(spark)}/grainmill-bible-{uuid.uuid4().hex}"
    whole = F.to_json(F.array_sort(F.collect_list(F.struct("pos", *cast.COLUMNS))))
    _bible(spark).agg(whole.alias("value")).write.text(out)
    return cast.genders(readers.json_array(spark, out))


def threshold_counts(spark: SparkSession, sf: str) -> DataFrame:
    return card.threshold_counts(_docs(spark, sf), "text", 2, 30, patterns=PROSE)


def yield_unique(spark: SparkSession, sf: str) -> DataFrame:
    return card.yields(_docs(spark, sf), "lang", "text")


def scan_report(spark: SparkSession, sf: str) -> DataFrame:
    return card.scan_report(_docs(spark, sf), text.quality_ok("text") & text.is_sfw("text"), F.col("source"), "source")


def top_slices(spark: SparkSession, sf: str) -> DataFrame:
    return card.most_common(_docs(spark, sf), F.col("source"), "source", 5, F.col("doc_id"))


def gate_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """The gate against the quality labels (an extension)."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = _docs(spark, sf).select("doc_id", text.quality_ok("text").alias("passed")).join(labels, "doc_id")
    return judged.groupBy("quality", "passed").agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------- dialogues and books
def first_exchange(spark: SparkSession, sf: str) -> DataFrame:
    rows = _talks(spark, sf).withColumn("x", arrays.exchange("turns"))
    return rows.where("x.user <> '' and x.assistant <> ''").select("conv_id", "x.user", "x.assistant")


def render_dialogue(spark: SparkSession, sf: str) -> DataFrame:
    turns = F.transform("turns", lambda t: F.struct(t["from"].alias("who"), t["value"].alias("message")))
    return _talks(spark, sf).where(F.size("turns") >= 3).select("conv_id", arrays.render_dialogue(turns).alias("dialogue"))


def first_keys(spark: SparkSession, sf: str) -> DataFrame:
    props = spark.read.parquet(f"{sf}/events.parquet").select("event_id", arrays.as_map("props").alias("m"))
    return props.select("event_id", arrays.first_keys("m").alias("keys"), F.size("m").alias("n_keys"))


def pack_chunks(spark: SparkSession, sf: str) -> DataFrame:
    packed = arrays.pack(arrays.paragraphs("text", "\n"), 1200, "\n\n")
    return _docs(spark, sf).select("doc_id", F.posexplode(packed).alias("i", "chunk"))


def adapter_screenplay(spark: SparkSession, sf: str) -> DataFrame:
    """Talks that open with a system turn count as monologues, others as pilots."""
    talks = _talks(spark, sf)
    rows = talks.select(
        F.col("turns").alias("conversations"), F.when(F.element_at("turns", 1)["from"] == "system", "Monologue").otherwise("tv_pilot").alias("category"), F.lit("Drama").alias("genre"), F.col("conv_id").alias("pos"),
    )
    return adapters.screenplay(rows, 50, 100, None).select("pos", "slice", "user", "assistant", F.col("meta.category").alias("category"))


def adapter_dialogue(spark: SparkSession, sf: str) -> DataFrame:
    rows = _talks(spark, sf).select(F.concat(F.lit(" Room "), F.col("conv_id").cast("string")).alias("setting"), F.to_json("turns").alias("conversation"), F.lit('{"user": "asks", "assistant": "answers"}').alias("characters"), F.col("conv_id").alias("pos"))
    return adapters.multichar(rows, None, None).select("pos", "user", "assistant")


def adapter_continuation(spark: SparkSession, sf: str) -> DataFrame:
    rows = _docs(spark, sf).select(F.col("source").alias("title"), F.col("text").alias("description"), F.col("text").alias("context"), F.col("text").alias("continuation"), F.col("doc_id").alias("pos"))
    return adapters.dramabench(rows, 500, None).select("pos", F.md5(F.col("user").cast("binary")).alias("user_md5"), F.md5(F.col("assistant").cast("binary")).alias("assistant_md5"))


def adapter_prompt_story(spark: SparkSession, sf: str) -> DataFrame:
    rows = _docs(spark, sf).select(F.left("text", F.lit(60)).alias("prompt"), _noisy(F.col("text")).alias("story"), F.col("doc_id").alias("pos"))
    return adapters.writingprompts(rows, 400, None, 2, PROSE).select("pos", "user", F.md5(F.col("assistant").cast("binary")).alias("assistant_md5"))


def adapter_chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _docs(spark, sf).select(F.col("doc_id").alias("id"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"), F.col("doc_id").alias("pos"))
    return adapters.gutenberg(rows, 500, None, patterns=PROSE, quoted=False).select("pos", F.col("meta.book_id").alias("book_id"), "assistant")


# ------------------------------------------------------------------ synthesis
def synth_episode(spark: SparkSession, sf: str) -> DataFrame:
    return synth.candidates(spark, 500, SEED)


def synth_kept(spark: SparkSession, sf: str) -> DataFrame:
    made = synth.generate(spark, 100, SEED, 2)
    return made.select("pos", "slice", F.col("meta.plot").alias("plot"), F.md5(F.col("assistant").cast("binary")).alias("assistant_md5"))


# ---------------------------------------------------------------------- casts
def _bible(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {q.BIBLE} AS t(pos, {', '.join(cast.COLUMNS)})")


def _selection(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {q.SELECTION} AS t(pos, name, gender, stage, role, disp, char, note)")


def bible_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return cast.stages(_bible(spark))


def bible_genders(spark: SparkSession, sf: str) -> DataFrame:
    rows = cast.search(cast.table(_bible(spark)), "A")
    return rows.select("n", "name", text.escape_attribute("example").alias("example"), cast.default_gender("gender").alias("gender"))


def cast_join(spark: SparkSession, sf: str) -> DataFrame:
    return cast.chosen(_selection(spark), cast.table(_bible(spark)).drop("pos", "n")).select("pos", "name", "gender", "stage", "role", "persona", "trait")


def prompt_assembly(spark: SparkSession, sf: str) -> DataFrame:
    return cast.assemble(_selection(spark), cast.table(_bible(spark)).drop("pos", "n"), "Be brief.", 3, "dark").select("n_cast", "user", "json")


def zip_longest(spark: SparkSession, sf: str) -> DataFrame:
    return cast.lookups(spark)


# -------------------------------------------------------------- training rows
def _trained(spark: SparkSession, sf: str) -> DataFrame:
    rows = _talks(spark, sf).select("conv_id", F.transform("turns", lambda t: F.struct(t["from"].alias("role"), t["value"].alias("content"))).alias("messages"))
    return chat.training_rows(rows, max_len=q.MAX_LEN)


def render_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = _talks(spark, sf).select("conv_id", F.transform("turns", lambda t: F.struct(t["from"].alias("role"), t["value"].alias("content"))).alias("m"))
    return rows.select("conv_id", chat.render(F.col("m")).alias("whole"), F.length(chat.render(F.slice("m", 1, F.size("m") - 1), True)).alias("prompt_chars"))


def mask_labels(spark: SparkSession, sf: str) -> DataFrame:
    shown = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), " ").alias(c)
    return _trained(spark, sf).select("conv_id", *map(shown, ("input_ids", "labels", "attention_mask")))


def pad_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = chat.pad_batches(_trained(spark, sf).withColumn("batch", F.expr("conv_id div 8")), "batch")
    joined = lambda c: F.md5(F.array_join(F.transform(c, lambda x: x.cast("string")), " ").cast("binary")).alias(c)
    return rows.select("conv_id", F.size("input_ids").alias("n"), *map(joined, ("input_ids", "labels", "attention_mask")))


def steps_per_epoch(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).groupBy("lang").agg(chat.steps_per_epoch(F.count(F.lit(1)), 1, 16).alias("steps"))


# ----------------------------------------------------------------------- JSON
def malformed_json_drop(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql(f"SELECT * FROM VALUES {q.JSON_LINES} AS t(i, raw)")
    parsed = rows.select("i", F.try_parse_json("raw").alias("v")).where("v is not null")
    return parsed.select("i", F.try_variant_get("v", "$.a", "string").alias("a"))


def tolerant_coercion(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql(f"SELECT * FROM VALUES {q.JSON_LISTS} AS t(i, raw)")
    return rows.select("i", F.size(arrays.as_list("raw")).alias("n"), F.size(arrays.as_map("raw")).alias("n_keys"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_text": _of(lambda t: {"cleaned": text.clean(F.replace(t, F.lit(". "), F.lit(" \t\r\n\r\n\n.")))}),
    "detokenize_noisy": _of(lambda t: {"plain": text.detokenize(_noisy(t))}),
    "strip_think": _of(lambda t: {"answer": text.strip_think(F.replace(t, F.lit(". "), F.lit(".</think> ")))}),
    "premise_head_tail": _of(lambda t: {"premise": text.head(t, 400), "context": text.tail(t, 4000), "body": F.md5(text.after_marker(t, ", ").cast("binary"))}),
    "smart_trim": _of(lambda t: {"narration": text.smart_trim(t), "visual": text.smart_trim(t, 240)}),
    "capitalize": _of(lambda t: {"first": text.capitalize(t)}),
    "sfw_flag": _of(lambda t: {"sfw": text.is_sfw(t), "sfw_words": text.is_sfw(t, terms=("cum", "tion", "the"), word_boundary=True)}),
    "ascii_alpha_ratio": _of(lambda t: {"ascii": text.ascii_ratio(t), "alpha": text.alpha_ratio(t)}),
    "type_token_ratio": _of(lambda t: {"n_words": text.word_count(t), "ttr": text.type_token_ratio(t)}),
    "quality_gate": _of(_reports),
    "keyword_hits": _of(lambda t: {"hits": text.keyword_hits(t, PROSE), "dramatic": text.is_dramatic(t, 30, PROSE)}),
    "norm_key": _of(lambda t: {"key": text.norm_key(t)}),
    "scan_limit": scan_limit,
    "cap_per_slice": cap_per_slice,
    "dedup_first_wins": dedup_first_wins,
    "dup_groups": dup_groups,
    "dedup_then_cap": dedup_then_cap,
    "fold_slices": fold_slices,
    "augment_anti_join": augment_anti_join,
    "card_by_slice": card_by_slice,
    "card_by_license": lambda spark, sf: card.by_license(build(spark, sf, "meta")),
    "card_totals": lambda spark, sf: card.totals(_sized(spark, sf), F.col("n_chars")),
    "chat_json": chat_json,
    "card_row": card_row,
    "chat_splits": chat_splits,
    "first_match": first_match,
    "shards_of_two_schemas": shards_of_two_schemas,
    "json_lines_positions": json_lines_positions,
    "bible_array": bible_array,
    "shuffle_split": shuffle_split,
    "stride_sample": stride_sample,
    "threshold_counts": threshold_counts,
    "yield_unique": yield_unique,
    "scan_report": scan_report,
    "top_slices": top_slices,
    "gate_by_label": gate_by_label,
    "first_exchange": first_exchange,
    "render_dialogue": render_dialogue,
    "first_keys": first_keys,
    "pack_chunks": pack_chunks,
    "adapter_screenplay": adapter_screenplay,
    "adapter_dialogue": adapter_dialogue,
    "adapter_continuation": adapter_continuation,
    "adapter_prompt_story": adapter_prompt_story,
    "adapter_chunks": adapter_chunks,
    "synth_episode": synth_episode,
    "synth_kept": synth_kept,
    "bible_unpivot": bible_unpivot,
    "bible_genders": bible_genders,
    "cast_join": cast_join,
    "prompt_assembly": prompt_assembly,
    "zip_longest": zip_longest,
    "render_chat": render_chat,
    "mask_labels": mask_labels,
    "pad_batch": pad_batch,
    "steps_per_epoch": steps_per_epoch,
    "malformed_json_drop": malformed_json_drop,
    "tolerant_coercion": tolerant_coercion,
}

ORACLES: dict[str, str] = {
    "clean_text": _sql(cleaned=q.clean("replace(text, '. ', ' ' || chr(9) || chr(13) || chr(10) || chr(13) || chr(10) || chr(10) || '.')")),
    "detokenize_noisy": _sql(plain=q.detokenize(q.noisy("text"))),
    "strip_think": _sql(answer=q.strip_think("replace(text, '. ', '.</think> ')")),
    "premise_head_tail": _sql(premise="left(text, 400)", context="right(text, 4000)", body="md5(CASE WHEN contains(text, ', ') THEN substring(text, instr(text, ', ') + 2) ELSE text END)"),
    "smart_trim": _sql(narration=synth._Sql.trim("text"), visual=synth._Sql.trim("text", 240)),
    "capitalize": _sql(first="upper(left(text, 1)) || lower(substring(text, 2))"),
    "sfw_flag": _sql(sfw=q.is_sfw("text"), sfw_words=r"NOT regexp_matches(lower(text), '(^|[^\p{L}\p{M}\p{N}_])(cum|tion|the)($|[^\p{L}\p{M}\p{N}_])')"),
    "ascii_alpha_ratio": _sql(ascii=q.ascii_ratio("text"), alpha=q.alpha_ratio("text")),
    "type_token_ratio": _sql(n_words=f"len({q.words('text')})", ttr=q.ttr("text")),
    "quality_gate": _sql(reason=f"coalesce({q.reason('text')}, 'ok')", ok=f"{q.reason('text')} IS NULL"),
    "keyword_hits": _sql(hits=q.hits("text", PROSE), dramatic=f"{q.hits('text', PROSE)} >= 30"),
    "norm_key": _sql(key=q.key("text")),
    "scan_limit": f"SELECT doc_id, pos FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) WHERE pos < {CAP}",
    "cap_per_slice": "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 40",
    "dedup_first_wins": f"{q.KEYED} SELECT doc_id, lang, key FROM keyed QUALIFY row_number() OVER (PARTITION BY key ORDER BY lang, doc_id) = 1",
    "dup_groups": f"{q.KEYED} SELECT key, count(*) AS n_rows, min(doc_id) AS first_id FROM keyed GROUP BY key HAVING count(*) > 1",
    "dedup_then_cap": f"""{q.KEYED},
        firsts AS (SELECT * FROM keyed WHERE lang = 'en' QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1),
        capped AS (SELECT * FROM firsts QUALIFY row_number() OVER (ORDER BY doc_id) <= 200),
        both_sides AS (SELECT *, 0 AS o FROM capped UNION ALL SELECT *, 1 AS o FROM keyed WHERE lang <> 'en')
        SELECT doc_id, lang, key FROM both_sides QUALIFY row_number() OVER (PARTITION BY key ORDER BY o, doc_id) = 1""",
    "fold_slices": q.fold(["en", "fr", "de", "es"], 150),
    "augment_anti_join": f"""{q.KEYED} SELECT doc_id, lang, key FROM keyed
        WHERE lang <> 'en' AND NOT EXISTS (SELECT 1 FROM keyed b WHERE b.lang = 'en' AND b.key = keyed.key) QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1""",
    "card_by_slice": f"{q.build(PROMPTS, SEED)} SELECT lang AS slice, split, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars FROM built GROUP BY ALL",
    "card_by_license": f"{q.build(PROMPTS, SEED)} SELECT coalesce(license, '?') AS license, count(*) AS n_rows FROM built GROUP BY ALL",
    "card_totals": f"{q.build(PROMPTS, SEED)} SELECT count(*) AS total_rows, count_if(split = 'train') AS train_rows, count_if(split = 'val') AS val_rows, (coalesce(sum(n_chars), 0) // 4)::BIGINT AS approx_tokens FROM built",
    "chat_json": f"""{q.build(PROMPTS, SEED)} SELECT doc_id, to_json({{'messages': [{{'role': 'system', 'content': system}}, {{'role': 'user', 'content': question}}, {{'role': 'assistant', 'content': assistant}}]}})::VARCHAR AS json,
        n_chars, assistant AS answer FROM built""",
    "card_row": f"""{q.build(PROMPTS, SEED)}, pairs AS (SELECT lang AS s, coalesce(license, '?') AS l FROM built),
        maps AS (SELECT (SELECT '{{' || string_agg('"' || s || '":' || n, ',' ORDER BY s) || '}}' FROM (SELECT s, count(*) AS n FROM pairs GROUP BY s)) AS by_slice,
            (SELECT '{{' || string_agg('"' || l || '":' || n, ',' ORDER BY l) || '}}' FROM (SELECT l, count(*) AS n FROM pairs GROUP BY l)) AS by_license,
            (SELECT '{{' || string_agg('"' || s || '":"' || l || '"', ',' ORDER BY s) || '}}' FROM (SELECT s, min(l) AS l FROM pairs GROUP BY s)) AS sources)
        SELECT count(*) AS total_rows, count_if(split = 'train') AS train_rows, count_if(split = 'val') AS val_rows, (coalesce(sum(n_chars), 0) // 4)::BIGINT AS approx_tokens,
            any_value(by_slice) AS by_slice, any_value(by_license) AS by_license, any_value(sources) AS sources, '{card.FORMAT}' AS format, '{card.POLICY}' AS policy, 1.0::DOUBLE AS scale FROM built, maps""",
    "chat_splits": f"""{q.build(PROMPTS, SEED)} SELECT split, lang AS slice, license,
        to_json({{'messages': [{{'role': 'system', 'content': system}}, {{'role': 'user', 'content': question}}, {{'role': 'assistant', 'content': assistant}}]}})::VARCHAR AS json FROM built""",
    "first_match": f"{q.build(PROMPTS, SEED)} SELECT doc_id, place, lang AS slice FROM built WHERE lang = 'fr' ORDER BY place LIMIT 1",
    "shards_of_two_schemas": "SELECT doc_id, NULL::BIGINT AS item_id, length(text)::INTEGER AS n_chars FROM documents UNION ALL SELECT NULL, item_id, length(text)::INTEGER FROM benchmark",
    "json_lines_positions": "SELECT doc_id, left(text, 40) AS text, pos FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) WHERE doc_id % 10 <> 3",
    "bible_array": f"SELECT gender, count(*) AS n_rows FROM (VALUES {q.BIBLE}) AS t(pos, {', '.join(cast.COLUMNS)}) GROUP BY gender",
    "shuffle_split": f"{q.build(PROMPTS, SEED)} SELECT doc_id, place, total, split FROM built",
    "stride_sample": f"{q.build(PROMPTS, SEED)} SELECT doc_id, place FROM built WHERE place % greatest(1, total // 30) = 0 AND place // greatest(1, total // 30) < 30",
    "threshold_counts": f"""WITH h AS (SELECT text, {q.hits('text', PROSE)} AS h FROM documents)
        SELECT count(*) AS scanned, count_if(h >= 2) AS at_low, count_if(h >= 30) AS at_high, count(DISTINCT CASE WHEN h >= 2 THEN text END) AS unique_at_low FROM h""",
    "yield_unique": "SELECT lang, count(*) AS n_rows, count(DISTINCT text) AS n_unique FROM documents GROUP BY lang",
    "scan_report": f"SELECT source, count(*) AS scanned, count_if({q.reason('text')} IS NULL AND {q.is_sfw('text')}) AS kept FROM documents GROUP BY source",
    "top_slices": "SELECT source, n_rows FROM (SELECT source, count(*) AS n_rows, min(doc_id) AS f FROM documents GROUP BY source ORDER BY n_rows DESC, f LIMIT 5)",
    "gate_by_label": f"SELECT quality, {q.reason('text')} IS NULL AS passed, count(*) AS n_rows FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
    "first_exchange": f"{q.EXCHANGE} SELECT conv_id, u AS \"user\", a AS assistant FROM pairs WHERE u <> '' AND a <> ''",
    "render_dialogue": f"{q.DIALOGUE} SELECT conv_id, dialogue FROM talks WHERE n >= 3",
    "first_keys": "SELECT event_id, array_to_string(json_keys(props)[1:8], ', ') AS keys, len(json_keys(props)) AS n_keys FROM events",
    "pack_chunks": f"{q.packed('text')} SELECT doc_id, i, chunk FROM chunks",
    "adapter_screenplay": q.SCREENPLAY,
    "adapter_dialogue": q.MULTICHAR,
    "adapter_continuation": f"""WITH c AS (SELECT doc_id AS pos, source, {q.clean('text')} AS t FROM documents),
        shaped AS (SELECT pos, t, '{fixed.CONTINUE_PROMPT}' || chr(10) || 'Title: ' || source || chr(10) || 'Premise: ' || left(t, 400) || chr(10) || chr(10) || '---' || chr(10) || right(t, 4000) AS u FROM c WHERE t <> '')
        SELECT pos, md5(u) AS user_md5, md5(t) AS assistant_md5 FROM shaped WHERE {q.reason('t', max_len=9000)} IS NULL AND {q.is_sfw('u', 't')}
        QUALIFY row_number() OVER (ORDER BY pos) <= 500""",
    "adapter_prompt_story": f"""WITH d AS (SELECT doc_id AS pos, {q.detokenize('left(text, 60)')} AS p, {q.detokenize(q.noisy('text'))} AS s FROM documents)
        SELECT pos, {q.quote(fixed.TWIST_PROMPT)} || p AS "user", md5(s) AS assistant_md5 FROM d
        WHERE p <> '' AND s <> '' AND {q.hits("(p || ' ' || left(s, 1500))", PROSE)} >= 2 AND {q.reason('s', min_len=400, max_len=8000)} IS NULL AND {q.is_sfw('p', 's')}
        QUALIFY row_number() OVER (ORDER BY pos) <= 400""",
    "adapter_chunks": q.gutenberg(PROSE),
    "synth_episode": synth.sql_rows(500, SEED),
    "synth_kept": f"""WITH c AS ({synth.sql_rows(200, SEED)}), k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY left(assistant, 400) ORDER BY pos) = 1)
        SELECT pos, 'fruit_synth' AS slice, plot, md5(assistant) AS assistant_md5 FROM k QUALIFY row_number() OVER (ORDER BY pos) <= 100""",
    "bible_unpivot": f"SELECT name, stage, persona FROM (SELECT * FROM (VALUES {q.BIBLE}) AS t(pos, {', '.join(cast.COLUMNS)})) UNPIVOT (persona FOR stage IN (growth, prime, ripening, senescence))",
    "bible_genders": f"""SELECT pos + 1 AS n, name, replace(example, '"', '&quot;') AS example, CASE WHEN gender = 'Male-dominant' THEN 'Male' ELSE 'Female' END AS gender
        FROM (VALUES {q.BIBLE}) AS t(pos, {', '.join(cast.COLUMNS)}) WHERE contains(lower(name), 'a') OR contains(lower(archetype), 'a')""",
    "cast_join": f"{q.CAST} SELECT pos, name, gender, stage, role, persona, trait FROM picked",
    "prompt_assembly": q.ASSEMBLY,
    "zip_longest": q.zip_longest({"role": fixed.ROLES, "disposition": fixed.DISPOSITIONS, "character": fixed.CHARACTERS}),
    "render_chat": f"{q.RENDERED} SELECT conv_id, whole, length(prompt) AS prompt_chars FROM rendered",
    "mask_labels": f"{q.MASKED} SELECT conv_id, array_to_string(ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels, array_to_string(ones, ' ') AS attention_mask FROM masked",
    "pad_batch": f"""{q.MASKED}, longest AS (SELECT *, max(len(ids)) OVER (PARTITION BY conv_id // 8) AS n FROM masked)
        SELECT conv_id, n::INTEGER AS n, md5(array_to_string(list_concat(ids, {q.padding('0')}), ' ')) AS input_ids, md5(array_to_string(list_concat(labels, {q.padding('-100')}), ' ')) AS labels,
        md5(array_to_string(list_concat(ones, {q.padding('0')}), ' ')) AS attention_mask FROM longest""",
    "steps_per_epoch": "SELECT lang, greatest(1, count(*) // 16) AS steps FROM documents GROUP BY lang",
    "malformed_json_drop": f"SELECT i, raw::JSON ->> '$.a' AS a FROM (SELECT * FROM (VALUES {q.JSON_LINES}) AS t(i, raw) WHERE json_valid(raw))",
    "tolerant_coercion": f"""SELECT i, CASE WHEN NOT json_valid(raw) OR json_type(raw) = 'NULL' THEN 0 WHEN json_type(raw) = 'ARRAY' THEN json_array_length(raw) ELSE 1 END AS n,
        CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN len(json_keys(raw)) ELSE 0 END AS n_keys FROM (VALUES {q.JSON_LISTS}) AS t(i, raw)""",
}
