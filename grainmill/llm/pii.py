"""Personal data by weak supervision, in DataFrame functions only.

Base spans come from one regular expression and one validity test per kind. Beside them,
wider expressions propose candidates (obfuscated addresses, phone numbers without a plus,
grouped digits that fail the checksum, IPv6 and out-of-range addresses, and, as a kind of
their own without base spans, long runs of letters and digits that may be secrets). Labelers
vote -1, 0 or 1 on every base span and candidate:

- shape: a strict regular expression for the kind;
- check: checksum, digit count, range or number of different characters;
- gazetteer: known top-level domains, card prefixes, calling codes, reserved networks, names of keys;
- cue: words such as "call", "e-mail" or "version", or an assignment, just before the span;
- border: what touches the span on either side.

Votes are counted by pattern over all documents; expectation-maximisation (two classes,
labelers independent given the class, abstentions carry no weight) estimates each
labeler's reliability and the class share of each kind from these at most 5 * 3^5 counts.
The posteriors then weigh a final classifier over span features (kind, length, digits,
separators, letters before and after, vote sum): smoothed log odds per feature value,
summed by a column expression. Candidates it accepts are added; base spans always stay.

Positions follow from the pieces between matches, and a span takes its context from the piece
and the match next to it, so a match costs its own length. Folds run over chunks of `CHUNK`
matches, so that their cost grows with the number of matches up to tens of thousands in a text
and by its square, divided by the size of a chunk, beyond. Expressions are written without nested greedy repeats and start only at run borders,
so long runs cost linear time.

Defined cases: null text counts as empty and has no spans; repeated rows and ids are rows
of their own and nothing is joined on ids; an empty table gives an empty result, and without
any span the model adds nothing; base spans of different kinds may overlap and are all
reported, and a candidate that overlaps a base span is not proposed; input columns are
kept by `redact` and may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize

KINDS = ("email", "ip", "card", "phone", "secret")
#: Kinds with base spans come first.
BASES = KINDS[:4]
VOTERS = ("shape", "check", "gazetteer", "cue", "border")
_E = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_E})){_E}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Something that every match of the expression above holds, to skip most texts cheaply.
NEEDS = {"email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){13}", "phone": r"\+[0-9]"}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]{1,63}+(?:(?:\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?|\.)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z-])[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,}+(?![.@][A-Za-z0-9])",
}
WIDE_NEEDS = {"email": r"[\[(]\x20?(?:at|AT)\x20?[\])]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:", "card": r"[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}", "phone": r"[0-9]{3}[.-][0-9]{4}", "secret": "[A-Za-z0-9_-]{20}"}
TLDS = "com|org|net|edu|gov|io|info|biz|co|uk|de|fr|es|eu|us|ca|it|nl|ch|at"
GOOD_CUES = r"(?i)(?:e-?mails?|mail|contact|reach|phone|tel|telephone|call|mobile|cell|fax|card|visa|mastercard|amex|credit|ip|host|address|server|login)\W{0,4}\z"
BAD_CUES = r"(?i)(?:version|ver|release|isbn|issn|order|invoice|serial|part|section|chapter|figure|fig|table|sku|v)\W{0,4}\z"
KEY_NAMES = r"(?i)(?:token|secret|passw(?:or)?d|pwd|credential|bearer|auth|api[_-]?key|access[_-]?key|private[_-]?key)"
#: Characters kept before a span for cue labelers, matches of a fold, and characters of a piece of text.
WINDOW, CHUNK, PIECE = 24, 1024, 512


def _luhn(digits: F.Column) -> F.Column:
    chars = F.reverse(F.split(digits, ""))
    chars = F.filter(chars, lambda c: c != "")
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, match: F.Column) -> F.Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, r"\A0+(?=[0-9])", "").rlike(r"\A(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\z"))
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


_SPAN = "array<struct<kind:int,start:int,end:int,hit:string,before:string,after:string>>"
_NONE = f"cast(array() as {_SPAN})"


def _let(value: F.Column, use: Callable[[F.Column], F.Column]) -> F.Column:
    """``use(value)`` with the value computed once, however often it is used inside of lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def _chunks(items: F.Column, size: int = CHUNK) -> F.Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")), lambda k: F.slice(items, k * size + 1, F.lit(size)))


def _fold(items: F.Column, start: F.Column, empty: str, step: Callable, value: str) -> F.Column:
    """All items that ``step`` appends to the field ``value`` beside the field ``at``, folded chunk by chunk."""

    def chunk(s: F.Column, some: F.Column) -> F.Column:
        done = F.aggregate(some, F.struct(s["at"].alias("at"), F.expr(f"cast(array() as {empty})").alias(value)), step)
        return _let(done, lambda d: F.struct(d["at"].alias("at"), F.array_append(s["all"], d[value]).alias("all")))

    none = F.struct(start.alias("at"), F.expr(f"cast(array() as array<{empty}>)").alias("all"))
    whole = _let(items, lambda x: F.aggregate(_chunks(x), none, chunk, lambda s: F.flatten(s["all"])))
    return whole


def _spans(text: F.Column, kind: str, pattern: str, needs: str, check: bool) -> F.Column:
    """Spans of the matches of one expression that pass, in order, with what stands around them."""
    code = KINDS.index(kind)

    def step(s: F.Column, x: F.Column) -> F.Column:
        begin = s["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        around = F.right(F.concat(F.coalesce(x["last"], F.lit("")), x["gap"]), F.lit(WINDOW)), F.left(F.concat(x["tail"], F.coalesce(x["next"], F.lit(""))), F.lit(1))
        span = F.struct(F.lit(code).alias("kind"), begin.alias("start"), end.alias("end"), x["hit"].alias("hit"), around[0].alias("before"), around[1].alias("after"))
        keep = _passes(kind, x["hit"]) if check else F.lit(True)
        return F.struct(end.alias("at"), F.when(keep, F.array_append(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    def cut(both: F.Column) -> F.Column:
        gaps, hits = both["gaps"], both["hits"]
        n = F.size(hits)
        named = F.arrays_zip(F.slice(gaps, F.lit(1), n).alias("gap"), hits.alias("hit"), F.slice(gaps, F.lit(2), n).alias("tail"), F.slice(F.concat(F.array(F.lit("")), hits), F.lit(1), n).alias("last"), F.slice(F.concat(hits, F.array(F.lit(""))), F.lit(2), n).alias("next"))
        return F.when(n > 0, _fold(named, F.lit(0), _SPAN, step, "spans")).otherwise(F.expr(_NONE))

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(text.rlike(needs), _let(both, cut)).otherwise(F.expr(_NONE))


def _sorted(spans: F.Column) -> F.Column:
    keyed = F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "kind", "end", "hit", "before", "after")]))
    return F.array_sort(keyed)


def base_spans(text: F.Column) -> F.Column:
    """array<struct<start, kind, end, hit, before, after>> of the base spans, by start, then kind."""
    return _sorted(F.concat(*[_spans(text, k, BASE[k], NEEDS[k], True) for k in BASES]))


def wide_spans(text: F.Column, base: F.Column) -> F.Column:
    """Candidates that overlap no base span (nor, in order of kinds, each other's start)."""
    wide = _sorted(F.concat(*[_spans(text, k, WIDE[k], WIDE_NEEDS[k], False) for k in KINDS]))
    meets = lambda b, w: (b["start"] < w["end"]) & (w["start"] < b["end"])
    # Base spans by chunks, so that a candidate is held against few of them.
    chunks = F.transform(_chunks(base), lambda c: F.struct(c[0]["start"].alias("start"), F.array_max(F.transform(c, lambda b: b["end"])).alias("end"), c.alias("spans")))
    apart = lambda w: _let(chunks, lambda held: F.filter(w, lambda x: ~F.exists(held, lambda c: meets(c, x) & F.exists(c["spans"], lambda b: meets(b, x)))))
    return F.when(F.size(base) == 0, wide).otherwise(_let(wide, lambda w: F.when(F.size(w) == 0, w).otherwise(apart(w))))


def join_spans(spans: F.Column) -> F.Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _facts(span: F.Column, is_base: bool) -> F.Column:
    """Votes and features of one span."""
    hit, before, after = span["hit"], span["before"], span["after"]
    digits = F.regexp_replace(hit, "[^0-9]", "")
    kind = span["kind"]
    by_kind = lambda e, i, c, p, k: F.when(kind == 0, e).when(kind == 1, i).when(kind == 2, c).when(kind == 3, p).otherwise(k)
    vote = lambda yes, no=None: F.when(yes, 1).when(no if no is not None else ~yes, -1).otherwise(0)
    n = F.length(digits)
    shape = by_kind(
        vote(hit.rlike(rf"\A{_E}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}\z"), F.lit(False)),
        vote(hit.rlike(r"\A(?:[0-9]{1,3}\.){3}[0-9]{1,3}\z") | hit.contains(":")),
        vote(hit.rlike(r"\A[0-9]{14,16}\z|\A[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}\z")),
        vote(hit.rlike(r"\A\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}\z")),
        vote(hit.rlike(r"\A(?:[0-9a-f]{24,}|[0-9A-F]{24,})\z") | (hit.rlike("[a-z]") & hit.rlike("[A-Z]") & ~hit.contains("_"))),
    )
    check = by_kind(F.lit(0), vote(hit.contains(":") | _passes("ip", hit)), vote(n.between(14, 19) & _luhn(digits)), vote(n.between(10, 15)), vote(F.size(F.array_distinct(F.split(F.lower(hit), ""))) > 9))
    gazetteer = by_kind(
        vote(hit.rlike(rf"(?i)(?:\.|[\[( ]dot[\]) ]+)(?:{TLDS})\z")),
        vote(~hit.rlike(r"\A(?:0|127|22[4-9]|2[3-5][0-9])\.")),
        vote(digits.rlike(r"\A(?:4|5[1-5]|2[2-7]|3[47]|6011|65)")),
        vote(hit.rlike(r"\A\+(?:1|33|34|49|44|39|31|41|43)(?:[^0-9]|[0-9])"), hit.rlike(r"\A\+0")),
        vote(before.rlike(KEY_NAMES), F.lit(False)),
    )
    said = F.when(before.rlike(BAD_CUES), -1).when(before.rlike(GOOD_CUES), 1).otherwise(0)
    cue = F.when(kind == 4, vote(before.rlike(r"[=:]\s{0,2}[\"']?\z"))).otherwise(said)
    open_left, open_right = (F.length(before) == 0) | before.rlike(r"[\s(\[\"',;:<]\z"), (F.length(after) == 0) | after.rlike(r"[\s)\]\"',;:.!?>]")
    border = F.when(open_left & open_right, 1).otherwise(-1)
    return F.struct(
        kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"), F.lit(is_base).alias("base"),
        shape.cast("int").alias("shape"), check.cast("int").alias("check"), gazetteer.cast("int").alias("gazetteer"), cue.cast("int").alias("cue"), border.cast("int").alias("border"),
        F.least(F.floor(F.length(hit) / 4), F.lit(12)).cast("int").alias("f_length"), F.least(n, F.lit(20)).cast("int").alias("f_digits"),
        F.least(F.length(F.regexp_replace(hit, "[A-Za-z0-9]", "")), F.lit(8)).cast("int").alias("f_marks"),
        F.when(F.length(before) == 0, 0).when(before.rlike(r"[A-Za-z]\W{0,2}\z"), 1).when(before.rlike(r"[0-9]\W{0,2}\z"), 2).otherwise(3).alias("f_left"),
        F.when(F.length(after) == 0, 0).when(after.rlike(r"\s"), 1).when(after.rlike("[A-Za-z0-9]"), 2).otherwise(3).alias("f_right"),
        (shape + check + gazetteer + cue + border).cast("int").alias("f_votes"),
    )


FEATURES = ("f_length", "f_digits", "f_marks", "f_left", "f_right", "f_votes")


def scan(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``base`` spans and ``seen``: the facts of base spans and candidates."""
    staged = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    staged = staged.withColumn("_base", base_spans(F.col("_text"))).withColumn("_wide", wide_spans(F.col("_text"), F.col("_base")))
    seen = F.concat(F.transform("_base", lambda s: _facts(s, True)), F.transform("_wide", lambda s: _facts(s, False)))
    slim = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return staged.withColumn("_seen", F.when(F.size("_base") + F.size("_wide") > 0, seen)).withColumn("_base", slim)


@dataclass
class Model:
    """odds: log odds by kind and by (kind, feature, value); reliability: of each labeler as EM sees it."""

    prior: dict[int, float]
    odds: dict[tuple[int, str, int], float]
    reliability: dict[str, tuple[float, float]]
    threshold: float = 0.9


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 60) -> tuple[dict[int, float], dict[str, tuple[float, float]]]:
    """EM over counted vote patterns (kind, votes, count): class shares and (sensitivity, specificity)."""
    share = dict.fromkeys(range(len(KINDS)), 0.7)
    rel = dict.fromkeys(VOTERS, (0.8, 0.8))
    for _ in range(rounds):
        up, total = dict.fromkeys(share, 1.4), dict.fromkeys(share, 2.0)
        stats = {v: [1.6, 2.0, 1.6, 2.0] for v in VOTERS}
        for kind, votes, n in patterns:
            p = posterior(kind, votes, share, rel)
            up[kind] += p * n
            total[kind] += n
            for v, x in zip(VOTERS, votes, strict=True):
                if x:
                    s = stats[v]
                    s[0] += p * n * (x > 0)
                    s[1] += p * n
                    s[2] += (1 - p) * n * (x < 0)
                    s[3] += (1 - p) * n
        share = {k: min(0.99, max(0.01, up[k] / total[k])) for k in share}
        # A labeler is taken to be better than chance, which fixes which class is which.
        rel = {v: (min(0.99, max(0.5, s[0] / s[1])), min(0.99, max(0.5, s[2] / s[3]))) for v, s in stats.items()}
    return share, rel


def posterior(kind: int, votes: tuple[int, ...], share: dict[int, float], rel: dict[str, tuple[float, float]]) -> float:
    z = math.log(share[kind] / (1 - share[kind]))
    for v, x in zip(VOTERS, votes, strict=True):
        sens, spec = rel[v]
        z += math.log(sens / (1 - spec)) if x > 0 else math.log((1 - sens) / spec) if x < 0 else 0.0
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def fit(seen: DataFrame) -> Model:
    """Estimate the model from a table of span facts (one row per span)."""
    counted = seen.groupBy("kind", *VOTERS).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 5 * 3^5 rows
    patterns = [(r["kind"], tuple(r[v] for v in VOTERS), r["n"]) for r in counted]
    share, rel = reliabilities(patterns)
    if not patterns:
        return Model({}, {}, rel)
    logit = F.element_at(F.array(*[F.lit(math.log(share[k] / (1 - share[k]))) for k in range(len(KINDS))]), F.col("kind") + 1)
    for v in VOTERS:
        sens, spec = rel[v]
        logit = logit + F.when(F.col(v) > 0, math.log(sens / (1 - spec))).when(F.col(v) < 0, math.log((1 - sens) / spec)).otherwise(0.0)
    soft = seen.withColumn("p", 1 / (1 + F.exp(-logit)))
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FEATURES])
    # At most 5 kinds * 6 features * 21 values.
    rows = soft.select("kind", "p", F.explode(pairs).alias("x")).groupBy("kind", "x.f", "x.v").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    sums = {k: [0.0, 0.0] for k in range(len(KINDS))}
    for r in rows:
        if r["f"] == FEATURES[0]:
            sums[r["kind"]][0] += r["yes"]
            sums[r["kind"]][1] += r["no"]
    prior = {k: math.log((y + 1) / (n + 1)) for k, (y, n) in sums.items()}
    odds = {(r["kind"], r["f"], r["v"]): math.log((r["yes"] + 1) / (sums[r["kind"]][0] + 20)) - math.log((r["no"] + 1) / (sums[r["kind"]][1] + 20)) for r in rows}
    return Model(prior, odds, rel)


def accepted(span: F.Column, model: Model) -> F.Column:
    """The final classifier's verdict on a candidate, as a column."""
    z = F.lit(0.0)
    for k, p in model.prior.items():
        z = z + F.when(span["kind"] == k, p).otherwise(0.0)
    for f in FEATURES:
        table = [x for (k, name, v), w in sorted(model.odds.items()) if name == f for x in (F.lit(k * 100 + v + 20), F.lit(round(w, 6)))]
        if table:
            z = z + F.coalesce(F.create_map(*table)[span["kind"] * 100 + span[f] + 20], F.lit(0.0))
    return z > math.log(model.threshold / (1 - model.threshold)) if model.odds else F.lit(False)


def _all_spans(model: Model) -> F.Column:
    added = F.transform(
        F.filter(F.coalesce(F.col("_seen"), F.expr("array()").cast(_SEEN)), lambda s: ~s["base"] & accepted(s, model)),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    return F.array_sort(F.concat(F.col("_base"), added))


_SEEN = "array<struct<kind:int,start:int,end:int,base:boolean,shape:int,check:int,gazetteer:int,cue:int,border:int,f_length:int,f_digits:int,f_marks:int,f_left:int,f_right:int,f_votes:int>>"


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) with one row per input row; spans are structs of start, kind code, end."""
    scanned = scan(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_doc")), "_doc", ["_id"]).drop("_text", "_wide")
    scanned = materialize(scanned, "pii-spans")
    model = fit(scanned.where("_seen is not null").select(F.explode("_seen").alias("s")).select("s.*"))
    return scanned.select(F.col("_id").alias("id"), F.col("_base").alias("base"), _all_spans(model).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the same columns; every span is replaced by its kind in angle brackets.

    Overlapping spans are merged under the kind of the first. Null texts stay null.
    ``length_col``, if the table has it, follows the new text.
    """
    columns = docs.columns
    base = scan(docs.select(F.col(f"`{text_col}`").alias("_doc")), "_doc", []).select(F.explode("_seen").alias("s")).select("s.*")
    model = fit(materialize(base, "pii-facts"))
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(f"`{text_col}`").alias("_doc"))
    scanned = scan(wrapped, "_doc", ["_row"]).withColumn("_spans", _all_spans(model))
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text = F.col("_text")

    def step(s: F.Column, x: F.Column) -> F.Column:
        hole = F.struct(s["at"].alias("start"), x["start"].alias("end"), x["kind"].alias("kind"))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] >= s["at"], F.array_append(s["kept"], hole)).otherwise(s["kept"]).alias("kept"))

    kept = _fold(F.col("_spans"), F.lit(0), "array<struct<start:int,end:int,kind:int>>", step, "kept")
    # What stays before each mark is joined from pieces of the text, so it costs its own length.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def between(held: F.Column, start: F.Column, end: F.Column) -> F.Column:
        first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
        return F.substring(F.array_join(F.slice(held, first + 1, last - first + 1), ""), start % PIECE + 1, end - start)

    ends = F.array_max(F.transform("_spans", lambda x: x["end"]))
    shown = _let(pieces, lambda held: F.concat(F.array_join(F.transform(kept, lambda h: F.concat(between(held, h["start"], h["end"]), F.element_at(marks, h["kind"] + 1))), ""), between(held, ends, F.length(text))))
    new = F.when(F.size("_spans") > 0, shown).otherwise(F.col(f"_row.`{text_col}`"))
    scanned = scanned.withColumn("_new", new)
    out = []
    for c in columns:
        if c == text_col:
            out.append(F.col("_new").alias(c))
        elif c == length_col:
            out.append(F.when(F.size("_spans") > 0, F.length("_new").cast(docs.schema[c].dataType)).otherwise(F.col(f"_row.`{c}`")).alias(c))
        else:
            out.append(F.col(f"_row.`{c}`").alias(c))
    return scanned.select(*out)
