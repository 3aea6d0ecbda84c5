"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells (source, language, topic) that hold sums of tokens, aggregated
with map-side combine. Raking scales the cells until the sums by source, by language and
by topic meet their targets, each in turn, from the corpus's own distribution. A document
is then kept with the calibrated probability p = min(1, k * weight of its cell), where k is
solved so that the expected number of kept tokens is the asked share of all tokens. The
draw is a hash of the seed and the id, so any rerun or any split of the data keeps the same
rows.

Targets default to the tempered shares of the corpus (share ** temper, renormalised): small
sources and languages are raised, the topic marginal is kept. Every value of a dimension
keeps its own marginal. If no dimension has more than ``max_values`` values, raking runs on
the driver over the collected cells; else the same rounds run over a table of cells, with
sums by axis and joins, written to the shared folder after each round.

Topics come from a column expression; the default tells tabular, shouted, marked-up,
brief and running text apart by their marks. DataFrame functions only.

Defined cases: null source, language or topic is a value of its own; null text has no
tokens, and cells without tokens get weight 1; null ids share one draw and equal ids draw
alike; an empty table gives an empty result; zero targets drop their cells' rows; input
columns are carried through in a struct, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.common import materialize

DIMENSIONS = ("source", "lang", "topic")
NULL = "\x00null"


SPACE = "[\\x20\\x09-\\x0D]"


def token_count(text: F.Column) -> F.Column:
    """Number of words separated by ASCII white space."""
    pieces = F.size(F.split(text, f"{SPACE}+", -1))
    ends = text.rlike(f"\\A{SPACE}").cast("int") + F.substring(text, -1, 1).rlike(SPACE).cast("int")
    return F.when(F.octet_length(F.trim(text)) == 0, 0).when(pieces == ends, 0).otherwise(pieces - ends).cast("long")


def surface_topic(text: F.Column) -> F.Column:
    """tabular, shouted, marked, brief or running: how a text is written."""
    n = F.greatest(F.octet_length(text), F.lit(1))

    def count(chars: str) -> F.Column:
        bare = text
        for c in chars:
            bare = F.replace(bare, F.lit(c), F.lit(""))
        return F.octet_length(text) - F.octet_length(bare)

    return (
        F.when(count("|") * 40 > n, "tabular")
        .when(count("!") * 20 > n, "shouted")
        .when(count("#*$%&<>") * 30 > n, "marked")
        .when(n < 600, "brief")
        .otherwise("running")
    )


def rake(cells: dict[tuple, float], targets: list[dict], rounds: int = 200, tolerance: float = 1e-10) -> dict[tuple, float]:
    """Scale positive cells until their sums along each axis meet ``targets`` (shares of one whole)."""
    total = sum(cells.values())
    now = {c: v / total for c, v in cells.items() if v > 0} if total else {}
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(targets):
            sums: dict = {}
            for c, v in now.items():
                sums[c[axis]] = sums.get(c[axis], 0.0) + v
            whole = sum(target.get(g, 0.0) for g in sums) or 1.0
            factor = {g: (target.get(g, 0.0) / whole) / s if s else 0.0 for g, s in sums.items()}
            worst = max([worst, *(abs(f - 1) for f in factor.values() if f)])
            now = {c: v * factor[c[axis]] for c, v in now.items()}
        if worst < tolerance:
            break
    return {c: v * total for c, v in now.items()}


def tempered(sums: dict, temper: float) -> dict:
    whole = sum(sums.values()) or 1.0
    raised = {g: (s / whole) ** temper if s > 0 else 0.0 for g, s in sums.items()}
    again = sum(raised.values()) or 1.0
    return {g: r / again for g, r in raised.items()}


def calibrate(tokens: dict[tuple, float], weights: dict[tuple, float], share: float) -> dict[tuple, float]:
    """Probabilities min(1, k * weight) whose expected tokens are ``share`` of all tokens.

    Cells of weight zero stay at zero; the share is met as far as the other cells reach.
    """
    want = share * sum(tokens.values())
    order = sorted((c for c in tokens if weights[c] > 0), key=lambda c: -weights[c])
    full, rest = 0.0, sum(tokens[c] * weights[c] for c in order)
    k = float("inf")
    for c in order:
        k = (want - full) / rest if rest > 0 else float("inf")
        if k * weights[c] <= 1:
            break
        full += tokens[c]
        rest -= tokens[c] * weights[c]
        k = float("inf")
    return {c: 0.0 if weights[c] <= 0 else min(1.0, k * weights[c]) for c in tokens}


def _raked_on_driver(cells: DataFrame, targets: dict[str, dict[str, float]], temper: float, share: float) -> DataFrame:
    """(source, lang, topic, weight, probability) of every cell, by `rake` and `calibrate`."""
    sums = {tuple(r[d] for d in DIMENSIONS): float(r["n"]) for r in cells.collect()}
    goals = []
    for axis, d in enumerate(DIMENSIONS):
        along: dict = {}
        for c, v in sums.items():
            along[c[axis]] = along.get(c[axis], 0.0) + v
        goals.append(targets.get(d) or tempered(along, 1.0 if d == "topic" else temper))
    raked = rake(sums, goals)
    weights = {c: raked.get(c, 0.0) / v if v else 1.0 for c, v in sums.items()}
    chance = calibrate(sums, weights, share)
    schema = T.StructType([*[T.StructField(d, T.StringType()) for d in DIMENSIONS], T.StructField("weight", T.DoubleType()), T.StructField("probability", T.DoubleType())])
    return F.broadcast(cells.sparkSession.createDataFrame([(*c, float(weights[c]), float(chance[c])) for c in sums], schema))


def _raked_in_tables(cells: DataFrame, targets: dict[str, dict[str, float]], temper: float, share: float, rounds: int = 200, tolerance: float = 1e-10) -> DataFrame:
    """The same as `_raked_on_driver`, with no table of cells or values on the driver."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("n")).first()[0] or 0)
    now = materialize(cells.where("n > 0").select(*DIMENSIONS, (F.col("n") / F.lit(total or 1.0)).alias("v")), "raked")
    goals = {}
    for d in DIMENSIONS:
        along = now.groupBy(d).agg(F.sum("v").alias("s"))
        if targets.get(d):
            given = spark.createDataFrame([(g, float(t)) for g, t in targets[d].items()], f"{d} string, goal double")
            along = along.join(given, d, "left").select(d, F.coalesce("goal", F.lit(0.0)).alias("goal"))
        else:
            along = along.select(d, F.pow("s", F.lit(1.0 if d == "topic" else temper)).alias("goal"))
        along = materialize(along, "goals")
        whole = along.agg(F.sum("goal")).first()[0] or 1.0
        goals[d] = along.select(d, (F.col("goal") / F.lit(whole)).alias("goal"))
    for _ in range(rounds):
        step = now.select(*DIMENSIONS, "v", F.lit(0.0).alias("worst"))
        for d in DIMENSIONS:
            factor = step.groupBy(d).agg(F.sum("v").alias("s")).join(goals[d], d).select(d, F.when(F.col("s") > 0, F.col("goal") / F.col("s")).otherwise(0.0).alias("f"))
            far = F.when(F.col("f") != 0, F.abs(F.col("f") - 1)).otherwise(0.0)
            step = step.join(factor, d).select(*DIMENSIONS, (F.col("v") * F.col("f")).alias("v"), F.greatest("worst", far).alias("worst"))
        now = materialize(step, "raked")
        if (now.agg(F.max("worst")).first()[0] or 0.0) < tolerance:
            break
    weight = F.when(F.col("n") > 0, F.coalesce("v", F.lit(0.0)) * F.lit(total) / F.col("n")).otherwise(1.0)
    weighed = materialize(cells.join(now, list(DIMENSIONS), "left").select(*DIMENSIONS, "n", weight.alias("weight")), "weighed")
    k, full = 0.0, -1.0
    while True:  # the cells of probability one only grow in number
        over = F.col("weight") * F.lit(k) > 1
        row = weighed.agg(F.coalesce(F.sum(F.when(over, F.col("n"))), F.lit(0)).alias("full"), F.coalesce(F.sum(F.when(~over, F.col("n") * F.col("weight"))), F.lit(0.0)).alias("rest")).first()
        if row["full"] == full:
            break
        full = row["full"]
        k = (share * total - full) / row["rest"] if row["rest"] > 0 else float("inf")
        if k == float("inf"):
            break
    chance = F.when(F.col("weight") <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.lit(k) * F.col("weight")))
    return weighed.select(*DIMENSIONS, "weight", chance.alias("probability"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source: F.Column | None = None,
    lang: F.Column | None = None,
    topic: F.Column | None = None,
    targets: dict[str, dict[str, float]] | None = None,
    temper: float = 0.7,
    share: float = 0.6,
    max_values: int = 256,
    seed: int = 7,
) -> DataFrame:
    """(row, source, lang, topic, n_tokens, weight, probability, kept) for every row of ``docs``.

    ``row`` is the input row as a struct. ``targets`` maps a dimension to shares by value;
    dimensions without targets use tempered shares (the topic keeps its own).
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    source = F.col("`source`") if source is None else source
    lang = F.col("`lang`") if lang is None else lang
    topic = surface_topic(text) if topic is None else topic
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("string").alias("key"),
        F.coalesce(source.cast("string"), F.lit(NULL)).alias("source"), F.coalesce(lang.cast("string"), F.lit(NULL)).alias("lang"), F.coalesce(topic.cast("string"), F.lit(NULL)).alias("topic"),
        token_count(text).alias("n_tokens"),
    )
    cells = materialize(named.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n")), "cells")
    many = max(cells.agg(*[F.count_distinct(d) for d in DIMENSIONS]).first())
    plan = (_raked_on_driver if many <= max_values else _raked_in_tables)(cells, targets or {}, temper, share)
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("key", F.lit("null")))), 1, 13), 16, 10).cast("double") / float(1 << 52)
    restore = lambda d: F.when(F.col(d) != NULL, F.col(d)).alias(d)
    return named.join(plan, list(DIMENSIONS)).select("row", *[restore(d) for d in DIMENSIONS], "n_tokens", "weight", "probability", (draw < F.col("probability")).alias("kept"))
