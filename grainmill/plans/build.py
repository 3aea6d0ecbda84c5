"""Whole builds from a configuration: a new dataset, and the extension of an earlier one.

    python -m grainmill.plans.build --config mix.json --sources DIR --prompts DIR --out DIR/name [--scale X] [--skip-external] [--augment]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions import fixed, text
from grainmill.operators import adapters, chat, selection, synth
from grainmill.sources import readers, scratch, sinks

ORDER = tuple(s[0] for s in fixed.SLICES)


@dataclass
class Slice:
    cap: int
    max_scan: int | None = None
    system: str = "voice"
    enabled: bool = True


@dataclass
class Config:
    slices: dict[str, Slice] = field(default_factory=lambda: {name: Slice(cap, scan, system) for name, cap, scan, system, _ in fixed.SLICES})
    seed: int = 13
    share: float = 0.98
    genres: tuple[str, ...] = fixed.GENRES
    voice: tuple[str, ...] = fixed.VOICE_CATEGORIES
    structure: tuple[str, ...] = fixed.STRUCTURE_CATEGORIES

    @classmethod
    def of(cls, raw: dict) -> Config:
        """From the parsed JSON of a configuration; slices are on unless they say otherwise."""
        slices = {k: Slice(v["cap"], v.get("max_scan"), v.get("system", "voice"), v.get("enabled", True)) for k, v in raw["slices"].items()}
        return cls(slices, raw.get("seed", 13), raw.get("train_val_split", 0.98), tuple(raw["screenplay_genres_allow"]), tuple(raw["screenplay_voice_categories"]), tuple(raw["screenplay_structure_categories"]))

    def on(self, name: str) -> bool:
        return name in self.slices and self.slices[name].enabled

    def cap(self, name: str, scale: float) -> int:
        return selection.scaled(self.slices[name].cap, scale) if self.on(name) else 0

    def scan(self, name: str, scale: float) -> int:
        return selection.scaled_scan(self.slices[name].max_scan, scale)


#: The sources that an earlier build is extended by, unless others are named.
EXTENDING = ("screenplay", "gutenberg_melodrama")


def external(config: Config, sources: dict[str, DataFrame], scale: float = 1.0, isolate: bool = False, only: tuple[str, ...] | None = None) -> DataFrame | None:
    """All adapters over the sources that are given (by name, with ``pos``), in build order.

    ``isolate``: the rows of each source are written out on their own, and a source that
    cannot be read or adapted is left out, with a line that says so.
    """
    cap, scan = lambda s: config.cap(s, scale), lambda s: config.scan(s, scale)
    plans: dict[str, Callable[[DataFrame], DataFrame]] = {}
    if config.on("screenplay_voice") or config.on("screenplay_structure"):
        plans["screenplay"] = lambda df: adapters.screenplay(df, cap("screenplay_voice"), cap("screenplay_structure"), scan("screenplay_voice"), config.genres, config.voice, config.structure)
    simple = {"multichar": adapters.multichar, "dramabench": adapters.dramabench, "gutenberg_melodrama": adapters.gutenberg, "writingprompts_twist": adapters.writingprompts}
    for name, adapt in simple.items():
        if config.on(name):
            plans[name] = lambda df, n=name, a=adapt: a(df, cap(n), scan(n))
    out = None
    for name, plan in plans.items():
        if name not in sources or (only is not None and name not in only):
            continue
        try:
            rows = plan(sources[name])
            if isolate:
                rows = scratch.keep(rows, "adapted")
        except Exception as error:
            if not isolate:
                raise
            print(f"[{name}] left out: {type(error).__name__}: {error}")
            continue
        out = rows if out is None else out.unionByName(rows)
    return out


def _ordered(rows: DataFrame) -> DataFrame:
    order = F.lit(len(ORDER))
    for k, name in enumerate(ORDER):
        order = F.when(F.col("slice") == name, k).otherwise(order)
    return rows.withColumn("ord", order).withColumn("key", text.norm_key("assistant"))


def new(spark: SparkSession, config: Config, sources: dict[str, DataFrame], prompts: dict[str, str], scale: float = 1.0, skip_external: bool = False) -> DataFrame:
    """Chat rows with ``split``, ``place`` and ``total``: twice the synthetic rows are drawn, and all keys are unique."""
    rows = None if skip_external else external(config, sources, scale)
    if config.on("fruit_synth"):
        limit = config.cap("fruit_synth", scale)
        made = _ordered(synth.generate(spark, 2 * limit, config.seed))
        others = _ordered(rows) if rows is not None else made.limit(0)
        rows = selection.dedup_then_cap(made, others, limit, "key", ["ord", "pos"])
    elif rows is not None:
        rows = selection.first_wins(_ordered(rows), "key", ["ord", "pos"])
    else:
        raise ValueError("no slice is on")
    wrapped = chat.wrap(rows, {k: prompts[v.system] for k, v in config.slices.items()})
    return selection.split(wrapped.select("messages", "meta", "key"), "key", config.seed, config.share)


def augment(spark: SparkSession, base: DataFrame, config: Config, sources: dict[str, DataFrame], prompts: dict[str, str], count_base: bool = False, only: tuple[str, ...] | None = EXTENDING) -> DataFrame:
    """An earlier build and what sources add to it, shuffled and split anew.

    Sources beyond ``only`` add nothing; None lets all of them add.

    Keys of the base are taken. Caps count the new rows alone, or with ``count_base`` all rows.
    """
    kept = base.select("messages", "meta", text.norm_key(chat.answer("messages")).alias("key"))
    rows = external(config, sources, isolate=True, only=only)
    if rows is not None:
        fresh = selection.first_wins(selection.new_rows(_ordered(rows), kept, "key"), "key", ["ord", "pos"])
        limit = F.lit(None).cast("int")
        for name in config.slices:
            limit = F.when(F.col("slice") == name, config.cap(name, 1.0)).otherwise(limit)
        if count_base:
            # One row for each slice of the configuration.
            had = kept.groupBy(F.col("meta.slice").alias("slice")).agg(F.count(F.lit(1)).alias("had")).where(F.col("slice").isin(*config.slices))
            fresh = fresh.join(F.broadcast(had), "slice", "left")
            limit = limit - F.coalesce("had", F.lit(0))
        fresh = selection.cap(fresh, limit, ["slice"], ["pos"], max((config.cap(name, 1.0) for name in config.slices), default=0))
        kept = kept.unionByName(chat.wrap(fresh, {k: prompts[v.system] for k, v in config.slices.items()}).select("messages", "meta", "key"))
    return selection.split(kept, "key", config.seed, config.share, guard=False)


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The sources that a folder holds: NAME (Parquet) by adapter, multichar as JSON lines."""
    found = {}
    for name in ("screenplay", "dramabench", "gutenberg_melodrama", "writingprompts_twist"):
        if readers.exists(spark, f"{folder}/{name}"):
            found[name] = selection.with_position(spark.read.parquet(f"{folder}/{name}"))
    if readers.exists(spark, f"{folder}/multichar"):
        schema = "setting string, conversation string, characters string"
        found["multichar"] = readers.json_lines(spark, f"{folder}/multichar", schema, position="pos")
    return found


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    for name in ("--config", "--sources", "--prompts", "--out"):
        parser.add_argument(name, required=name != "--config")
    parser.add_argument("--scale", type=float, default=1.0)
    parser.add_argument("--skip-external", action="store_true")
    parser.add_argument("--augment", action="store_true")
    given = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    config = Config.of(readers.config(spark, given.config)) if given.config else Config()
    prompts = {s: readers.text_file(spark, f"{given.prompts}/system_{s}.txt") for s in {v.system for v in config.slices.values()}}
    sources = {} if given.skip_external else read_sources(spark, given.sources)
    if given.augment:
        base = readers.chat_splits(spark, f"{given.out}.train.jsonl", f"{given.out}.val.jsonl").drop("split")
        # The new build replaces what it was made from, so it is written out first.
        staged = f"{given.out}.staged"
        augment(spark, base, config, sources, prompts).write.mode("overwrite").parquet(staged)
        sinks.build(spark.read.parquet(staged), given.out, note="augmented")
    else:
        sinks.build(new(spark, config, sources, prompts, given.scale, given.skip_external), given.out, scale=given.scale)


if __name__ == "__main__":
    main()
