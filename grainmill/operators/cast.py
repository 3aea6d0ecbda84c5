"""Character tables and prompts for a chosen cast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions import fixed, text

COLUMNS = ("name", "emoji", "gender", "example", "archetype", "personality", "character", "cheating", "properties", *(k for k, _ in fixed.STAGES))
CHOICE = "(you choose)"


def table(bible: DataFrame) -> DataFrame:
    """All columns of a character table, numbered; missing values and columns are empty texts."""
    known = set(bible.columns)
    return bible.select("pos", (F.col("pos") + 1).alias("n"), *[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in known else F.lit("")).alias(c) for c in COLUMNS])


def stages(bible: DataFrame) -> DataFrame:
    """One row for each character and life stage."""
    return bible.unpivot(["name"], [k for k, _ in fixed.STAGES], "stage", "persona")


def default_gender(gender: Column | str) -> Column:
    return F.when(F.col(gender) == "Male-dominant" if isinstance(gender, str) else gender == "Male-dominant", "Male").otherwise("Female")


def stage_label(stage: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, label in fixed.STAGES:
        out = F.when(stage == k, F.lit(label)).otherwise(out)
    return out


def lookups(spark: SparkSession) -> DataFrame:
    """Roles, dispositions and characters side by side, as long as the longest of them."""
    from grainmill.functions.arrays import zip_longest

    lists = {"role": fixed.ROLES, "disposition": fixed.DISPOSITIONS, "character": fixed.CHARACTERS}
    rows = zip_longest("", **{k: F.array(*map(F.lit, v)) for k, v in lists.items()})
    return spark.range(1).select(F.posexplode(rows).alias("i", "r")).select((F.col("i") + 1).alias("n"), "r.*")


def search(bible: DataFrame, query: str) -> DataFrame:
    return bible.where(text.matches_any(query, "name", "archetype"))


def chosen(selection: DataFrame, bible: DataFrame) -> DataFrame:
    """Selected characters with what is known of them; choices that were not made take their defaults."""
    known = {c for c in selection.columns}
    given = lambda c, default="": (F.coalesce(F.col(f"s.{c}"), F.lit(default)) if c in known else F.lit(default))
    joined = selection.alias("s").join(bible.alias("b"), F.col("s.name") == F.col("b.name"))
    rows = joined.select(
        F.col("s.pos").alias("pos"), *[F.col(f"b.{c}").alias(c) for c in COLUMNS if c != "gender"], F.coalesce(F.col("s.gender") if "gender" in known else F.lit(None), default_gender(F.col("b.gender"))).alias("gender"),
        given("stage", "prime").alias("stage"), given("role").alias("role"), given("disp").alias("disp"), given("char").alias("char"), given("note").alias("note"),
    )
    persona = F.coalesce(*[F.when(F.col("stage") == k, F.col(k)) for k, _ in fixed.STAGES])
    return rows.withColumn("persona", persona).withColumn("trait", F.concat(stage_label(F.col("stage")), F.lit(": "), F.col("persona"), F.lit(" · Cheats: "), F.col("cheating")))


def _entry() -> Column:
    either = lambda c, default: F.when(F.col(c) != "", F.col(c)).otherwise(default)
    t = F.lit
    return F.concat(
        F.col("i").cast("string"), t(". "), F.col("emoji"), t(" "), F.col("name"), t(' ("'), F.col("example"), t('") — '), F.col("gender"), t(", "), stage_label(F.col("stage")), t(".\n   Stage persona: "), F.col("persona"),
        t("\n   Personality: "), F.col("personality"), t(" Character: "), F.col("character"), t("\n   Cheating/betrayal pattern: "), F.col("cheating"), t("\n   Role: "), either("role", t(CHOICE)), t(" · Disposition: "), either("disp", t(CHOICE)),
        t(" · Dramatic function: "), either("char", F.col("archetype")), F.when(F.col("note") != "", F.concat(t("\n   Note: "), F.col("note"))).otherwise(""),
    )


# The wording of a request for an episode with a cast.
OPENING = "Write ONE 6-scene AI fruit-drama episode (Episode {episode}) that intertwines the cast below into a single, mind-blowing storyline with a shocking final twist. Tone: {tone}.\n\nCAST:\n"
NO_CONTEXT = "(no context given — invent a juicy one)"
CLOSING = "Connect these characters through secrets, betrayals, affairs and rivalries drawn from their cheating patterns and current life-stages. Escalate every scene and end on a jaw-dropping cliffhanger. Follow the exact 6-scene format with a NARRATION line and a VISUAL line for each scene."
EMPTY = "Select at least one fruit first."


def assemble(selection: DataFrame, bible: DataFrame, system: str, episode: int = 1, tone: str = "", context: str = "") -> DataFrame:
    """(n_cast, user, text, json) for one story: its cast, a handful of rows, in order of selection."""
    from grainmill.operators.card import numbered

    cast = numbered(chosen(selection, bible), ["pos"], "i").select("i", _entry().alias("entry"))
    rows = cast.agg(F.count(F.lit(1)).alias("n_cast"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "entry"))), lambda x: x["entry"]), "\n").alias("cast"))
    opening = OPENING.replace("{episode}", str(episode)).replace("{tone}", tone)
    user = F.concat(F.lit(opening), F.col("cast"), F.lit(f"\n\nCONTEXT / LOCATION / SETTING:\n{context.strip() or NO_CONTEXT}\n\n{CLOSING}"))
    some = F.col("n_cast") > 0
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return rows.select(
        "n_cast", F.when(some, user).alias("user"), F.when(some, F.concat(F.lit(f"=== SYSTEM ===\n{system}\n\n=== USER ===\n"), user)).otherwise(EMPTY).alias("text"),
        F.when(some, F.to_json(F.struct(F.array(message("system", F.lit(system)), message("user", user)).alias("messages")))).alias("json"),
    )


def count_label(selection: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return selection.agg(F.concat(n.cast("string"), F.lit(" selected")).alias("label"), F.when(n > 0, F.concat(F.lit("· "), n.cast("string"), F.lit(" character"), F.when(n > 1, "s").otherwise(""))).otherwise("").alias("hint"))


def genders(bible: DataFrame) -> DataFrame:
    return bible.groupBy("gender").agg(F.count(F.lit(1)).alias("n_rows"))
