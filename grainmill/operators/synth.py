"""Episodes from templates, as rows of a range.

Every draw is the MD5 of seed, row and slot, so a row depends on nothing but its number:
rows can be made anywhere, in any order, again. Templates are compiled to expressions, once
for Spark and once, by `sql_rows`, for a database that the results are held against.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions import episodes, text
from grainmill.operators import adapters, selection

_NAME = re.compile(r"\{(\w+)(\^?)\}")


class _Spark:
    """Expressions as columns."""

    lit = staticmethod(F.lit)
    join = staticmethod(lambda parts: F.concat(*parts))

    @staticmethod
    def scenes(narrations: list[Column], visuals: list[Column]) -> Column:
        """The scenes; each line is built once and then trimmed as an element."""
        heads = F.array(*[F.lit(f"\nScene — {x}\nNARRATION: ") for x in episodes.LABELS])
        said = F.zip_with(heads, F.array(*narrations), lambda h, n: F.concat(h, text.smart_trim(n)))
        return F.array_join(F.zip_with(said, F.array(*visuals), lambda s, v: F.concat(s, F.lit("\nVISUAL: "), text.smart_trim(v, 240))), "\n")

    @staticmethod
    def draw(seed: int, row: Column, slot: str, n: int) -> Column:
        digest = F.md5(F.concat(F.lit(f"{seed}:"), row.cast("string"), F.lit(f":{slot}")).cast("binary"))
        return F.pmod(F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long"), F.lit(n))

    @staticmethod
    def pick(values: list, at: Column) -> Column:
        return F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (at + 1).cast("int"))


class _Sql:
    """The same expressions as SQL."""

    lit = staticmethod(lambda s: "'" + s.replace("'", "''") + "'")
    join = staticmethod(lambda parts: "(" + " || ".join(parts) + ")")

    @classmethod
    def scenes(cls, narrations: list[str], visuals: list[str]) -> str:
        lines = [f"{cls.lit(f'{chr(10)}Scene — {x}{chr(10)}NARRATION: ')} || {cls.trim(n)} || {cls.lit(chr(10) + 'VISUAL: ')} || {cls.trim(v, 240)}" for x, n, v in zip(episodes.LABELS, narrations, visuals, strict=True)]
        return cls.join([f" || {cls.lit(chr(10))} || ".join(lines)])

    @staticmethod
    def trim(e: str, limit: int = 115) -> str:
        return f"(CASE WHEN length({e}) > {limit} THEN regexp_replace(regexp_replace(left({e}, {limit}), ' [^ ]*\\z', '', 's'), '[,;:]+\\z', '') || '...' ELSE {e} END)"

    @staticmethod
    def draw(seed: int, row: str, slot: str, n: int) -> str:
        return f"(('0x' || left(md5('{seed}:' || {row} || ':{slot}'), 8))::BIGINT % {n})"

    @classmethod
    def pick(cls, values: list, at: str) -> str:
        listed = ", ".join(v if v.startswith(("(", "'")) else cls.lit(v) for v in values)
        return f"([{listed}])[{at} + 1]"


class _Plot:
    """One plot's expressions over a row number, in either language."""

    def __init__(self, name: str, lang, seed: int, row):
        self.lang, self.seed, self.row, self.plot = lang, seed, row, episodes.PLOTS[name]
        pools = {s: [c for a in kinds for c in episodes.CAST[a]] for s, kinds in self.plot["slots"].items()}
        self.who = {s: self._pick([lang.lit(c[0]) for c in pool], s) for s, pool in pools.items()}
        self.capital = {s: self._pick([lang.lit(c[0].capitalize()) for c in pool], s) for s, pool in pools.items()}
        self.full = {s: self._pick([lang.lit(f"{c[0]} in {c[1]}") for c in pool], s) for s, pool in pools.items()}
        self.twist = self._pick([self.fill(t) for t in self.plot["twists"]], "twist")

    def _pick(self, values: list, slot: str):
        return self.lang.pick(values, self.lang.draw(self.seed, self.row, slot, len(values)))

    def fill(self, template: str):
        parts, at = [], 0
        for m in _NAME.finditer(template):
            if m.start() > at:
                parts.append(self.lang.lit(template[at : m.start()]))
            value = self.twist if m[1] == "twist" else self.who[m[1]]
            parts.append(self.capital[m[1]] if m[2] else value)
            at = m.end()
        if at < len(template):
            parts.append(self.lang.lit(template[at:]))
        return self.lang.join(parts)

    def visual(self, k: int, seen: tuple, where: object, doing: str):
        places = episodes.SETTINGS
        get = lambda i: self.lang.lit(places[where][i]) if isinstance(where, int) else self._pick([self.lang.lit(p[i]) for p in places], "s" if where == "s" else f"s{k}")
        cast = [x for j, s in enumerate(seen) for x in ([self.lang.lit(" and ")] if j else []) + [self.full[s]]]
        t = self.lang.lit
        return self.lang.join([t("Dramatic 9:16 vertical scene in "), get(0), t(" "), get(1), t(". "), *cast, t(f". {doing} "), get(2), t(", "), self._pick([t(m) for m in episodes.MOODS], f"m{k}"), t(" atmosphere.")])

    def episode(self):
        number = self.lang.pick([self.lang.lit(str(i)) for i in range(1, 10)], self.lang.draw(self.seed, self.row, "n", 9))
        t = self.lang.lit
        beats = self.plot["beats"]
        scenes = self.lang.scenes([self.fill(b[0]) for b in beats], [self.visual(k, *b[1:]) for k, b in enumerate(beats)])
        return self.lang.join([t("EPISODE "), number, t(f": {self.plot['title']}\n"), scenes])

    def request(self):
        t, logline = self.lang.lit, self.fill(self.plot["logline"])
        number = self.lang.pick([t(str(i)) for i in range(1, 10)], self.lang.draw(self.seed, self.row, "n", 9))
        made = []
        for r in episodes.REQUESTS:
            parts = [number if x == "{n}" else logline if x == "{logline}" else t(x) for x in re.split(r"(\{n\}|\{logline\})", r) if x]
            made.append(self.lang.join(parts))
        return self._pick(made, "request")


def candidates(spark: SparkSession, n: int, seed: int = 13) -> DataFrame:
    """(pos, plot, user, assistant) for rows 0..n-1, repeats included."""
    rows = spark.range(n).withColumn("plot", _Spark.pick(list(episodes.PLOTS), _Spark.draw(seed, F.col("id"), "plot", len(episodes.PLOTS))))

    def choose(make) -> Column:
        made = [(name, make(_Plot(name, _Spark, seed, F.col("id")))) for name in episodes.PLOTS]
        return reduce(lambda out, x: F.when(F.col("plot") == x[0], x[1]).otherwise(out), reversed(made), F.lit(None).cast("string"))

    return rows.select(F.col("id").alias("pos"), "plot", choose(_Plot.request).alias("user"), choose(_Plot.episode).alias("assistant"))


def sql_rows(n: int, seed: int = 13) -> str:
    """The SQL twin of `candidates`."""
    choose = lambda make: "CASE plot " + " ".join(f"WHEN '{p}' THEN {make(_Plot(p, _Sql, seed, 'id'))}" for p in episodes.PLOTS) + " END"
    plot = _Sql.pick([f"'{p}'" for p in episodes.PLOTS], _Sql.draw(seed, "id", "plot", len(episodes.PLOTS)))
    return f"SELECT id AS pos, plot, {choose(_Plot.request)} AS \"user\", {choose(_Plot.episode)} AS assistant FROM (SELECT range AS id, {plot} AS plot FROM range({n}))"


def generate(spark: SparkSession, n_rows: int, seed: int = 13, attempts_per_row: int = 40, source: str = "synthetic-fruit", license: str = "ours") -> DataFrame:
    """Up to ``n_rows`` episodes that differ in their first 400 characters, in the shape of an adapter.

    The first ``n_rows`` * ``attempts_per_row`` candidates are all that may be drawn.
    """
    drawn = candidates(spark, n_rows * attempts_per_row, seed).withColumn("_key", F.left("assistant", F.lit(400)))
    distinct = selection.first_wins(drawn, "_key", ["pos"]).drop("_key").withColumn("_one", F.lit(1))
    kept = selection.cap(distinct, n_rows, ["_one"], ["pos"])
    return kept.select("user", "assistant", adapters.meta(source=source, slice="fruit_synth", license=license, plot=F.col("plot")).alias("meta"), F.lit("fruit_synth").alias("slice"), "pos")
