"""Chat rows and rows of tokens for training."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions import arrays, fixed


def wrap(df: DataFrame, prompts: dict[str, str], by: str = "slice") -> DataFrame:
    """``messages`` of system, user and assistant; the system prompt follows from the slice.

    ``prompts`` has one entry per slice, a handful; they become one CASE expression.
    """
    system = F.lit(None).cast("string")
    for k, v in prompts.items():
        system = F.when(F.col(by) == k, F.lit(v)).otherwise(system)
    return df.withColumn("messages", arrays.messages(system, F.col("user"), F.col("assistant")))


def answer(messages: Column | str) -> Column:
    """The content of the third message."""
    return F.element_at(F.col(messages) if isinstance(messages, str) else messages, 3)["content"]


def as_json(*columns: Column | str) -> Column:
    """One JSON object; fields without a value are left out and no character is escaped to ASCII."""
    return F.to_json(F.struct(*columns))


def render(messages: Column, add_generation: bool = False, turn: str = "<|{role}|>\n", end: str = "<|end|>\n", opening: str = "<|assistant|>\n") -> Column:
    """The messages as one text; ``add_generation`` opens the answer."""
    before, after = turn.split("{role}")
    shown = F.transform(messages, lambda m: F.concat(F.lit(before), m["role"], F.lit(after), m["content"], F.lit(end)))
    return F.concat(F.array_join(shown, ""), F.lit(opening if add_generation else ""))


def whitespace_tokens(text: Column) -> Column:
    """Ids of words by a hash: a tokenizer without a vocabulary."""
    return F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), lambda w: F.pmod(F.conv(F.left(F.md5(w.cast("binary")), F.lit(7)), 16, 10).cast("int"), F.lit(50_000)))


def library_tokens(encode: Callable[[list[str]], list[list[int]]]) -> Callable[[Column], Column]:
    """A tokenizer of a library, in Arrow batches; ``encode`` must be picklable."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(encode(texts.fillna("").tolist()))

    return run


def mask(full: Column, prompt_size: Column) -> Column:
    """Labels: the ids, with those at the places of the prompt ignored."""
    rest = F.slice(full, prompt_size + 1, F.greatest(F.size(full) - prompt_size, F.lit(0)))
    return F.concat(F.array_repeat(F.lit(fixed.IGNORED), F.least(prompt_size, F.size(full))), rest)


def training_rows(df: DataFrame, messages: str = "messages", tokens: Callable[[Column], Column] = whitespace_tokens, max_len: int = 2048, **template: str) -> DataFrame:
    """``input_ids``, ``labels`` and ``attention_mask``, cut after masking; rows with nothing to learn go."""
    m = F.col(messages)
    both = df.withColumns({"_full": tokens(render(m, **template)), "_prompt": F.size(tokens(render(F.slice(m, 1, F.greatest(F.size(m) - 1, F.lit(0))), True, **template)))})
    cut = both.withColumns({"input_ids": F.slice("_full", 1, max_len), "labels": F.slice(mask(F.col("_full"), F.col("_prompt")), 1, max_len)})
    cut = cut.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1))).drop("_full", "_prompt")
    return cut.where(F.exists("labels", lambda x: x != fixed.IGNORED))


def pad_batches(df: DataFrame, batch: str, pad: int = 0) -> DataFrame:
    """Rows of a batch padded on the right to its longest."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    out = df.withColumn("_n", longest)
    fill = lambda c, v: F.concat(F.col(c), F.array_repeat(F.lit(v), (F.col("_n") - F.size(c)).cast("int")))
    return out.withColumns({"input_ids": fill("input_ids", pad), "labels": fill("labels", fixed.IGNORED), "attention_mask": fill("attention_mask", 0)}).drop("_n")


def steps_per_epoch(rows: Column, batch: int, accumulate: int) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.floor(rows / (batch * accumulate)))
