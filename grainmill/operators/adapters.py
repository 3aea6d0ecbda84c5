"""Source adapters: from the rows of one corpus to (user, assistant, meta, slice, pos).

Each takes a DataFrame with a position column (`selection.with_position`) and is lazy. Scan
limits cut raw rows; caps count accepted rows in source order. None is no scan limit, and no cap of
dialogues.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions import arrays, fixed, text
from grainmill.operators import selection
from grainmill.sources.scratch import once

META = ("source", "slice", "license", "genre", "category", "book_id", "plot")


def meta(**known: Column | str) -> Column:
    """The struct of all meta fields; those that a source lacks are null and vanish in JSON."""
    lit = lambda v: F.lit(v) if isinstance(v, str) else v.cast("string")
    return F.struct(*[(lit(known[k]) if k in known else F.lit(None).cast("string")).alias(k) for k in META])


def _turns(df: DataFrame, column: str) -> Column:
    """array<struct<from,value>> of a column that holds it or its JSON text."""
    if df.schema[column].dataType.typeName() != "string":
        return F.col(column)
    part = lambda v, k: F.try_variant_get(v, f"$.{k}", "string")
    return F.transform(arrays.as_list(column), lambda v: F.struct(part(v, "from").alias("from"), part(v, "value").alias("value")))


def _accept(df: DataFrame, **limits: float) -> DataFrame:
    """Quality of the answer first, being the cheaper test; then safety of both sides."""
    return once(df).where(text.quality_ok("assistant", **limits)).where(text.is_sfw("user", "assistant"))


def _emit(df: DataFrame, *order: str) -> DataFrame:
    return df.select("user", "assistant", "meta", F.col("meta.slice").alias("slice"), "pos", *[F.col(o) for o in order])


def screenplay(
    df: DataFrame, voice_cap: int, structure_cap: int, max_scan: int | None, genres: tuple[str, ...] = fixed.GENRES, voice: tuple[str, ...] = fixed.VOICE_CATEGORIES, structure: tuple[str, ...] = fixed.STRUCTURE_CATEGORIES,
    source: str = "Atum09/screenplay-dataset", license: str = "mit",
) -> DataFrame:
    """Two slices from one scan: a category goes to voice or to structure."""
    category = F.lower(F.coalesce("category", F.lit("")))
    routed = selection.scan_limit(df, max_scan).where(F.lower(F.coalesce("genre", F.lit(""))).isin(*genres))
    # A cap of zero switches a slice off, and its categories with it.
    target = F.when(category.isin(*voice) & F.lit(voice_cap > 0), "screenplay_voice").when(category.isin(*structure) & F.lit(structure_cap > 0), "screenplay_structure")
    routed = routed.withColumn("_slice", target).where(F.col("_slice").isNotNull())
    pair = routed.withColumn("_x", arrays.exchange(_turns(df, "conversations"))).where((F.coalesce("_x.user", F.lit("")) != "") & (F.coalesce("_x.assistant", F.lit("")) != ""))
    shaped = pair.select(
        text.clean("_x.user").alias("user"), text.clean(text.strip_think("_x.assistant")).alias("assistant"), meta(source=source, slice=F.col("_slice"), license=license, genre=F.col("genre"), category=category).alias("meta"), "pos",
    )
    good = _emit(_accept(shaped, max_len=9000))
    limit = F.when(F.col("slice") == "screenplay_voice", voice_cap).otherwise(structure_cap)
    return selection.cap(good, limit, ["slice"], ["pos"], max(voice_cap, structure_cap)).where(limit > 0)


def multichar(df: DataFrame, cap: int | None, max_scan: int | None, source: str = "agentlans/multi-character-dialogue", license: str = "cc-by-4.0") -> DataFrame:
    """Dialogues from JSON texts: ``setting``, ``conversation`` and ``characters``."""
    rows = once(selection.scan_limit(df, max_scan).select(text.clean("setting").alias("setting"), arrays.as_list("conversation").alias("turns"), arrays.as_map("characters").alias("cast"), "pos"))
    rows = rows.where((F.col("setting") != "") & (F.size("turns") >= 3))
    names = arrays.first_keys("cast")
    user = F.concat(F.lit(f"{fixed.SCENE_PROMPT}\nSetting: "), F.col("setting"), F.when(names != "", F.concat(F.lit("\nCharacters: "), names)).otherwise(""))
    shaped = rows.select(user.alias("user"), arrays.render_dialogue(F.transform("turns", arrays.turn_of)).alias("assistant"), meta(source=source, slice="multichar", license=license).alias("meta"), "pos")
    good = _emit(_accept(shaped, max_len=9000))
    return good if cap is None else selection.cap(good, cap, ["slice"], ["pos"])


def dramabench(df: DataFrame, cap: int, max_scan: int | None, source: str = "FutureMa/DramaBench", license: str = "mit") -> DataFrame:
    """Scripts to be continued: ``title``, ``description``, ``context``, ``continuation``."""
    rows = once(selection.scan_limit(df, max_scan).select(*[text.clean(c).alias(c) for c in ("title", "description", "context", "continuation")], "pos"))
    rows = rows.where((F.col("context") != "") & (F.col("continuation") != ""))
    line = lambda label, c, shown: F.when(F.col(c) != "", F.concat(F.lit(f"\n{label}: "), shown)).otherwise("")
    user = F.concat(F.lit(fixed.CONTINUE_PROMPT), line("Title", "title", F.col("title")), line("Premise", "description", text.head("description", 400)), F.lit("\n\n---\n"), text.tail("context", 4000))
    shaped = rows.select(user.alias("user"), F.col("continuation").alias("assistant"), meta(source=source, slice="dramabench", license=license).alias("meta"), "pos")
    return selection.cap(_emit(_accept(shaped, max_len=9000)), cap, ["slice"], ["pos"])


def accepted_chunks(book: Column, per_book: int = 4, least: int = 1200, separator: str = "\n\n", min_hits: int = 2, patterns: tuple[str, ...] = fixed.DRAMA_PATTERNS, quoted: bool = True, **limits: float) -> Column:
    """The first accepted chunks of a book, as an array of (i, chunk)."""
    packed = F.transform(arrays.pack(arrays.paragraphs(text.after_marker(book), separator), least), text.clean)
    limits = {"max_len": 4000} | limits

    def good(x: Column) -> Column:
        c = x["chunk"]
        speech = (c.contains('"') | c.contains("'")) if quoted else F.lit(True)
        return speech & text.quality_ok(c, **limits) & text.is_dramatic(c, min_hits, patterns) & text.is_sfw(c)

    numbered = F.transform(packed, lambda c, i: F.struct(i.alias("i"), c.alias("chunk")))
    return F.slice(F.filter(numbered, good), 1, per_book)


def gutenberg(df: DataFrame, cap: int, max_books: int | None, per_book: int = 4, normalize_first: bool = False, source: str = "manu/project_gutenberg", license: str = "public-domain", **chunking) -> DataFrame:
    """Dialogue-rich chunks of books (``id``, ``text``); a book that is too short still counts as scanned."""
    body = text.clean("text") if normalize_first else F.coalesce(F.col("text"), F.lit(""))
    books = selection.scan_limit(df, max_books).where(F.length(F.coalesce("text", F.lit(""))) >= 4000)
    chunks = books.select(F.col("id").alias("_book"), "pos", F.explode(accepted_chunks(body, per_book, **chunking)).alias("_c"))
    shaped = chunks.select(F.lit(fixed.MELODRAMA_PROMPT).alias("user"), F.col("_c.chunk").alias("assistant"), meta(source=source, slice="gutenberg_melodrama", license=license, book_id=F.col("_book")).alias("meta"), "pos", F.col("_c.i").alias("part"))
    return selection.cap(_emit(shaped, "part"), cap, ["slice"], ["pos", "part"]).drop("part")


def writingprompts(df: DataFrame, cap: int, max_scan: int | None, min_hits: int = 2, patterns: tuple[str, ...] = fixed.DRAMA_PATTERNS, source: str = "euclaise/writingprompts", license: str = "mit") -> DataFrame:
    """Stories by ``prompt``: tokenized texts, of which the opening must be dramatic."""
    raw = once(selection.scan_limit(df, max_scan).select("prompt", "story", "pos")).where(text.detokenized_may_fit("story", 8000))
    rows = once(raw.select(text.detokenize("prompt").alias("prompt"), text.detokenize("story").alias("story"), "pos")).where((F.col("prompt") != "") & (F.col("story") != ""))
    rows = rows.where(text.is_dramatic(F.concat(F.col("prompt"), F.lit(" "), text.head("story", 1500)), min_hits, patterns)).where(text.quality_ok("story", min_len=400, max_len=8000)).where(text.is_sfw("prompt", "story"))
    shaped = rows.select(F.concat(F.lit(fixed.TWIST_PROMPT), F.col("prompt")).alias("user"), F.col("story").alias("assistant"), meta(source=source, slice="writingprompts_twist", license=license).alias("meta"), "pos")
    return selection.cap(_emit(shaped), cap, ["slice"], ["pos"])
