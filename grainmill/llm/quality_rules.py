"""Quality rules: a learned decision list over text statistics, in DataFrame functions only.

Base statistics of every whole text decide the fixed rule (too few words, or too much of
the text repeated). What passes meets an ordered list of rejecting rules, each a conjunction
of thresholds on ratios. The list is learnt by sequential covering:

- every ratio is cut halfway between quantiles of the labelled rows, taken for good and bad
  apart;
- a rule grows by the threshold with the best information gain on the growing rows, from
  counts of good and bad by (ratio, bin), so one aggregation serves all thresholds;
- it is pruned to the prefix that does best on the pruning rows, which growing has not seen;
- it joins the list if its precision there is at least ``precision``; its rows are removed
  and the next rule is grown, until one fails.

The list becomes one CASE expression. Learning aggregates over all labelled rows with
map-side combine; the driver sees counts by bin only. Growing and pruning rows are told
apart by a hash of the id, and rows of the held-out fold are not used.

Repeated windows are compared by 64-bit hashes of their three words.

Defined cases: null text has no words and fails the base rule; null ids, null qualities and
ids whose labels disagree teach nothing; repeated ids are judged row by row; without bad
labelled rows there are no rules, and the base rule decides alone; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize

SPACE = "[\\x20\\x09-\\x0D]+"
RATIOS = ("symbol_ratio", "upper_ratio", "bang_ratio", "bar_ratio", "distinct_ratio", "repeat_ratio", "dup_line_ratio", "word_length", "line_ratio")
QUANTILES = (0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99, 1.0)


def _repeat_words(words: F.Column, n: F.Column) -> F.Column:
    """Words inside three-word windows that occur at least twice."""
    windows = F.transform(words, lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(n >= 3, F.array_sort(F.slice(windows, 1, F.greatest(n - 2, F.lit(1)))))


def _covered(ranked: F.Column) -> F.Column:
    same = lambda x, j: F.coalesce(F.get(ranked, j)["h"] == x["h"], F.lit(False))
    marked = F.transform(ranked, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
    return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the base statistics, ``base_failed`` and the ratios that rules test."""

    def count(chars: str) -> F.Column:
        """Occurrences of ASCII characters, each a byte that is searched for as such."""
        bare = F.col("t")
        for c in chars:
            bare = F.replace(bare, F.lit(c), F.lit(""))
        return (F.octet_length("t") - F.octet_length(bare)).cast("long")

    share = lambda top, low: (top / F.greatest(low, F.lit(1))).cast("double")
    df = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    df = df.withColumn("words", F.filter(F.split("t", SPACE), lambda w: w != "")).withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    df = df.withColumn("ranked", _repeat_words(F.col("words"), F.col("n_words").cast("int")))
    df = df.withColumn("again", _covered(F.col("ranked")))
    again = F.col("again")
    cover = F.aggregate(F.transform(again, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(again, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    df = df.select(
        "id", "n_words", (F.length("t").cast("long") - count(" \t\n\x0b\x0c\r")).alias("word_chars"), count("#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.coalesce(cover, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"), F.size("lines").alias("n_lines"), F.length(F.regexp_replace("t", "[^A-ZÀ-ÖØ-Þ]+", "")).cast("long").alias("n_upper"), count("!").alias("n_bang"), count("|").alias("n_bar"),
    )
    return df.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        share(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"), share(F.col("n_upper"), F.col("word_chars")).alias("upper_ratio"),
        share(F.col("n_bang"), F.col("n_words")).alias("bang_ratio"), share(F.col("n_bar"), F.col("n_words")).alias("bar_ratio"),
        share(F.col("n_distinct"), F.col("n_words")).alias("distinct_ratio"), share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_ratio"),
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"), share(F.col("word_chars"), F.col("n_words")).alias("word_length"),
        share(F.col("n_lines"), F.col("n_words")).alias("line_ratio"),
    )


@dataclass(frozen=True)
class Test:
    ratio: str
    above: bool
    limit: float

    def column(self) -> F.Column:
        return F.col(self.ratio) > self.limit if self.above else F.col(self.ratio) <= self.limit

    def __str__(self) -> str:
        return f"{self.ratio} {'>' if self.above else '<='} {self.limit:.6g}"


@dataclass
class Rules:
    """An ordered list of rejecting conjunctions."""

    rules: list[list[Test]] = field(default_factory=list)

    def column(self) -> F.Column:
        """True for rows that no rule rejects."""
        verdict = F.lit(True)
        for rule in reversed(self.rules):
            verdict = F.when(_all(rule), F.lit(False)).otherwise(verdict)
        return verdict

    def __str__(self) -> str:
        return "\n".join([*(f"reject if {' and '.join(map(str, r))}" for r in self.rules), "keep"])


def _all(tests: list[Test]) -> F.Column:
    out = F.lit(True)
    for t in tests:
        out = out & t.column()
    return out


def _edges(rows: DataFrame) -> dict[str, list[float]]:
    wanted = F.array(*map(F.lit, QUANTILES))
    cuts = rows.groupBy("bad").agg(*[F.percentile_approx(r, wanted, F.lit(10_000)).alias(r) for r in RATIOS]).collect()
    seen = {r: sorted({x for c in cuts for x in c[r] or []}) for r in RATIOS}
    return {r: [(x + y) / 2 for x, y in zip(v, v[1:])] for r, v in seen.items()}  # noqa: B905


def _best(rows: DataFrame, edges: dict[str, list[float]], taken: list[Test], least: int) -> tuple[Test | None, int, int]:
    """The test with the most information gain among ``rows``, and the bad and good rows it leaves."""
    place = lambda r: F.lit(0) if not edges[r] else sum((F.col(r) > x).cast("int") for x in edges[r])
    bins = F.array(*[F.struct(F.lit(k).alias("k"), place(r).alias("b")) for k, r in enumerate(RATIOS)])
    counted = rows.select("bad", F.explode(bins).alias("x")).groupBy("x.k", "x.b").agg(F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")).collect()
    table = {(r["k"], r["b"]): (r["p"], r["n"]) for r in counted}
    p0 = sum(p for (k, _), (p, _) in table.items() if k == 0)
    n0 = sum(n for (k, _), (_, n) in table.items() if k == 0)
    best, gain, left = None, 1e-9, (p0, n0)
    if not p0 or not n0:
        return None, p0, n0
    for k, r in enumerate(RATIOS):
        p = n = 0
        for b, limit in enumerate(edges[r]):
            dp, dn = table.get((k, b), (0, 0))
            p, n = p + dp, n + dn
            for above, (x, y) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                if x < least or Test(r, above, limit) in taken:
                    continue
                g = x * (math.log2(x / (x + y)) - math.log2(p0 / (p0 + n0)))
                if g > gain:
                    best, gain, left = Test(r, above, limit), g, (x, y)
    return best, *left


def learn(facts: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_rules: int = 8, max_tests: int = 3, precision: float = 0.9, least: int = 3) -> Rules:
    """Sequential covering over the labelled rows of a statistics table."""
    marks = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("id is not null and y is not null")
    marks = marks.groupBy("id").agg(F.min("y").alias("lo"), F.max("y").alias("hi")).where("lo = hi")
    rows = facts.where("not base_failed").join(marks, "id").where(F.crc32(F.col("id").cast("string")) % 5 != 0)
    rows = materialize(rows.select(*RATIOS, (F.col("lo") == 0).alias("bad"), (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("prune")), "rules")
    edges = _edges(rows)
    found, rest = Rules(), rows
    while len(found.rules) < max_rules:
        rule: list[Test] = []
        grow = rest.where("not prune")
        while len(rule) < max_tests:
            test, _, good = _best(grow.where(_all(rule)), edges, rule, least)
            if test is None:
                break
            rule.append(test)
            if not good:
                break
        if not rule:
            break
        heads = [rule[: k + 1] for k in range(len(rule))]
        stats = rest.where("prune").agg(*[F.count_if(_all(h) & (F.col("bad") == b)).alias(f"{'p' if b else 'n'}{k}") for k, h in enumerate(heads) for b in (True, False)]).first()
        worth = [(stats[f"p{k}"] - stats[f"n{k}"]) / (stats[f"p{k}"] + stats[f"n{k}"] + 1) for k in range(len(heads))]
        k = max(range(len(heads)), key=lambda i: (worth[i], -i))
        p, n = stats[f"p{k}"], stats[f"n{k}"]
        if (p + 1) / (p + n + 1) < precision or p < 1:
            break
        found.rules.append(heads[k])
        rest = rest.where(~_all(heads[k]))
    return found


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **learning) -> tuple[DataFrame, Rules]:
    """(statistics with ``kept`` for every row of ``docs``, the learnt rules)."""
    facts = materialize(statistics(docs, id_col, text_col), "statistics")
    rules = learn(facts, labels, id_col, label_col, **learning)
    return facts.withColumn("kept", ~F.col("base_failed") & rules.column()), rules
