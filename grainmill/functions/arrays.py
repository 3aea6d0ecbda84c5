"""Column functions over arrays, maps and loosely typed JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainmill.functions import fixed, text


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def as_list(raw: Column | str) -> Column:
    """array<variant> of a JSON text: a list as it is, another value as the only element, nothing for junk."""
    v = F.try_parse_json(text.drop_lone_surrogates(_c(raw)))
    empty = F.expr("cast(array() as array<variant>)")
    return F.when(v.isNull() | F.is_variant_null(v), empty).otherwise(F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)))


def as_map(raw: Column | str) -> Column:
    """map<string,string> of a JSON object text; empty for anything else."""
    return F.coalesce(F.from_json(text.drop_lone_surrogates(_c(raw)), "map<string,string>"), F.expr("cast(map() as map<string,string>)"))


def first_non_empty(*columns: Column) -> Column:
    """The first that is neither null nor empty, else an empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def first_by_role(turns: Column | str, roles: tuple[str, ...], role: str = "from", value: str = "value") -> Column:
    """The text of the first turn of a role, even an empty one; null without such a turn."""
    hits = F.filter(_c(turns), lambda t: F.lower(_or_empty(t[role])).isin(*roles))
    return F.when(F.size(hits) > 0, _or_empty(F.get(hits, 0)[value]))


def turn_of(v: Column) -> Column:
    """(who, message) of one turn: an object with either set of keys, or a bare text."""
    part = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    who = F.when(is_object, first_non_empty(part("from"), part("speaker"))).otherwise(F.lit(""))
    message = F.when(is_object, first_non_empty(part("message"), part("value"))).otherwise(_or_empty(F.try_variant_get(v, "$", "string")))
    return F.struct(who.alias("who"), message.alias("message"))


def render_dialogue(turns: Column | str) -> Column:
    """Lines ``who: message`` of structs (who, message); empty messages are left out."""
    cleaned = F.transform(_c(turns), lambda t: F.struct(t["who"].alias("who"), text.clean(t["message"]).alias("m")))
    shown = F.filter(cleaned, lambda t: t["m"] != "")
    return F.array_join(F.transform(shown, lambda t: F.when(_or_empty(t["who"]) != "", F.concat(t["who"], F.lit(": "), t["m"])).otherwise(t["m"])), "\n")


def first_keys(m: Column | str, n: int = 8) -> Column:
    return F.array_join(F.slice(F.map_keys(_c(m)), 1, n), ", ")


def paragraphs(c: Column | str, separator: str = "\n\n") -> Column:
    import re

    parts = F.transform(F.split(_or_empty(_c(c)), re.escape(separator)), text.strip)
    return F.filter(parts, lambda p: p != "")


def pack(parts: Column | str, least: int = 1200, joint: str = "\n\n") -> Column:
    """Greedy chunks: parts are added until their lengths reach ``least``; a rest that does not is left out.

    The places of the cuts are found first, over lengths alone, and each chunk is then cut
    out once, and parts are worked out once for all chunks, so a long text costs its length and
    not the square of it.
    """
    state = F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum"), F.expr("cast(array() as array<int>)").alias("cuts"))

    def step(s: Column, p: Column) -> Column:
        total = s["sum"] + F.length(p)
        full = total >= least
        return F.struct((s["i"] + 1).alias("i"), F.when(full, 0).otherwise(total).alias("sum"), F.when(full, F.array_append(s["cuts"], s["i"] + 1)).otherwise(s["cuts"]).alias("cuts"))

    def cut(parts: Column, cuts: Column) -> Column:
        bounds = F.zip_with(F.concat(F.array(F.lit(0)), F.slice(cuts, 1, F.greatest(F.size(cuts) - 1, F.lit(0)))), cuts, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        chunks = F.transform(bounds, lambda x: F.array_join(F.slice(parts, x["a"] + 1, x["b"] - x["a"]), joint))
        return F.when(F.size(cuts) > 0, chunks).otherwise(F.expr("cast(array() as array<string>)"))

    return text.let(_c(parts), lambda parts: text.let(F.aggregate(parts, state, step, lambda s: s["cuts"]), lambda cuts: cut(parts, cuts)))


def messages(system: Column, user: Column, assistant: Column) -> Column:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("system", system), turn("user", user), turn("assistant", assistant))


def message_chars(m: Column | str) -> Column:
    """Characters of all contents."""
    return F.aggregate(_c(m), F.lit(0).cast("long"), lambda a, x: a + F.length(_or_empty(x["content"])))


def zip_longest(fill: str, **arrays: Column) -> Column:
    """Rows of several arrays by position; ``fill`` where one is shorter."""
    zipped = F.arrays_zip(*[c.alias(k) for k, c in arrays.items()])
    return F.transform(zipped, lambda x: F.struct(*[F.coalesce(x[k], F.lit(fill)).alias(k) for k in arrays]))


def exchange(turns: Column | str) -> Column:
    """(user, assistant) of the first turn on each side."""
    return F.struct(first_by_role(turns, fixed.USER_ROLES).alias("user"), first_by_role(turns, fixed.ASSISTANT_ROLES).alias("assistant"))
