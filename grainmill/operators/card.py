"""Reports: data cards, yields and threshold counts, each from one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions import arrays, text

FORMAT = "chat messages (system/user/assistant) JSONL"
POLICY = "permissive-license + platform-safe (SFW) only"


def counts_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))


def by_slice(df: DataFrame) -> DataFrame:
    return counts_by(df, F.col("meta.slice"), "slice")


def by_license(df: DataFrame) -> DataFrame:
    """Rows by license; ``?`` where it is missing."""
    return counts_by(df, F.coalesce("meta.license", F.lit("?")), "license")


def totals(df: DataFrame, chars: Column | None = None) -> DataFrame:
    """Rows by split, and tokens at four characters each, system prompts included; ``chars`` if they are counted already."""
    chars = F.coalesce(F.sum(arrays.message_chars("messages") if chars is None else chars), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("split") == "train").alias("train_rows"), F.count_if(F.col("split") == "val").alias("val_rows"), F.floor(chars / 4).cast("long").alias("approx_tokens"),
    )


def _as_map(pairs: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(pairs)))


def card(df: DataFrame, scale: float | None = None, note: str | None = None, chars: Column | None = None) -> DataFrame:
    """The data card as one row; maps hold one entry per slice or license."""
    slices = by_slice(df).agg(_as_map(F.struct("slice", "n_rows")).alias("by_slice"))
    licenses = by_license(df).agg(_as_map(F.struct("license", "n_rows")).alias("by_license"))
    sources = df.select(F.col("meta.slice").alias("s"), F.coalesce("meta.license", F.lit("?")).alias("l")).groupBy("s").agg(F.min("l").alias("l")).agg(_as_map(F.struct("s", "l")).alias("sources"))
    # Each side is one row.
    one = totals(df, chars).crossJoin(slices).crossJoin(licenses).crossJoin(sources)
    extra = {"scale": F.lit(scale)} if scale is not None else {}
    extra |= {"note": F.lit(note)} if note is not None else {}
    return one.select("total_rows", "train_rows", "val_rows", "approx_tokens", "by_slice", "by_license", "sources", F.lit(FORMAT).alias("format"), F.lit(POLICY).alias("policy"), *[c.alias(k) for k, c in extra.items()])


def stamped(df: DataFrame) -> DataFrame:
    """With the time of the build as text; not comparable between runs."""
    return df.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("built_at"), "*")


def most_common(df: DataFrame, key: Column, name: str, k: int, tie: Column | None = None) -> DataFrame:
    """The k largest groups; ties go by ``tie`` (of the group's first row) or by name."""
    counted = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"), *([F.min(tie).alias("_tie")] if tie is not None else []))
    order = [F.desc("n_rows"), *(["_tie"] if tie is not None else []), name]
    return counted.orderBy(*order).limit(k).select(name, "n_rows")


def yields(df: DataFrame, by: str = "slice", column: str = "assistant") -> DataFrame:
    """Rows and distinct answers, told apart by MD5 so that no text is shuffled."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.md5(F.col(column).cast("binary"))).alias("n_unique"))


def threshold_counts(df: DataFrame, column: str = "assistant", low: int = 2, high: int = 3, **keywords) -> DataFrame:
    """How many rows reach either number of keyword hits, and how many distinct ones the lower."""
    hits = df.select(F.col(column).alias("t"), text.keyword_hits(column, **keywords).alias("h"))
    return hits.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("h") >= low).alias("at_low"), F.count_if(F.col("h") >= high).alias("at_high"), F.countDistinct(F.when(F.col("h") >= low, F.md5(F.col("t").cast("binary")))).alias("unique_at_low"),
    )


def scan_report(df: DataFrame, kept: Column, by: Column, name: str) -> DataFrame:
    """Rows read and rows kept of each source."""
    return df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("scanned"), F.count_if(kept).alias("kept"))


def numbered(df: DataFrame, order: list[str], name: str = "n", by: list[str] | None = None) -> DataFrame:
    """1-based numbers in order, within groups; without groups one task numbers all, so it is for short lists."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*(by or [F.lit(1)])).orderBy(*order)))
