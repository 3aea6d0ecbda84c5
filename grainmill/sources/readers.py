"""Readers of the formats that corpora come in."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from grainmill.functions import text
from grainmill.sources import scratch

MESSAGES = "messages array<struct<role:string,content:string>>, meta struct<source:string,slice:string,license:string,genre:string,category:string,book_id:string,plot:string>"


def parquet(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, split: str | None = None, config: str | None = None) -> DataFrame:
    """Shards under one or more paths; ``split`` and ``config`` prune folders split=... and config=..., ``columns`` prunes columns."""
    df = spark.read.option("recursiveFileLookup", split is None and config is None).option("pathGlobFilter", "*.parquet").parquet(*([paths] if isinstance(paths, str) else paths))
    for name, value in (("split", split), ("config", config)):
        df = df if value is None else df.where(F.col(name) == value)
    return df if columns is None else df.select(*columns)


def parquet_by_intersection(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """Shards whose columns differ: each gives those it has of ``columns``, the rest is null."""
    out = None
    for p in paths:
        df = spark.read.parquet(p)
        df = df.select(*[c for c in columns if c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def json_lines(spark: SparkSession, path: str, schema: str | StructType | None = None, malformed: str = "drop", position: str | None = None) -> DataFrame:
    """JSON lines, plain or gzipped. ``malformed``: "drop" or "fail". Without a schema: one variant column ``row``.

    Escapes of lone surrogates are taken out before a line is parsed. ``position`` names a
    gapless place in (file, line) order, blank and malformed lines included; lines are then
    written out once, in the order in which they were read.
    """
    lines = spark.read.text(path)
    if position is not None:
        lines = _numbered(lines, position)
    kept = [position] if position is not None else []
    lines = lines.where(F.length(F.trim("value")) > 0).select(text.drop_lone_surrogates("value").alias("value"), *kept)
    if schema is None:
        parse = F.try_parse_json if malformed == "drop" else F.parse_json
        return lines.select(parse("value").alias("row"), *kept).where("row is not null")
    fields = _struct(spark, schema)
    if malformed == "fail":
        return lines.select(F.from_json("value", fields, {"mode": "FAILFAST"}).alias("row"), *kept).select("row.*", *kept)
    marked = StructType([*fields.fields, StructField("_bad", StringType())])
    parsed = lines.select(F.from_json("value", marked, {"columnNameOfCorruptRecord": "_bad"}).alias("row"), *kept)
    return parsed.where("row is not null and row._bad is null").select(*[F.col(f"row.`{f.name}`") for f in fields.fields], *kept)


def _struct(spark: SparkSession, schema: str | StructType) -> StructType:
    return spark.createDataFrame([], schema).schema


def _numbered(lines: DataFrame, name: str) -> DataFrame:
    """Lines with their place: numbers within a split follow the reader, splits follow file and offset.

    The counts that shift them have one row for each split of a file.
    """
    read = lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"))
    read = scratch.keep(read, "lines")
    splits = read.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("_file", "_at", (before - F.col("_first")).alias("_shift"))
    return read.join(starts, ["_file", "_at"]).select("value", (F.col("_id") + F.col("_shift")).alias(name))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def chat_rows(spark: SparkSession, path: str) -> DataFrame:
    """Chat rows of an earlier build; none if the path is missing; a malformed line is an error."""
    return json_lines(spark, path, MESSAGES, "fail") if exists(spark, path) else spark.createDataFrame([], MESSAGES)


def chat_splits(spark: SparkSession, train: str, val: str) -> DataFrame:
    """Both splits of an earlier build with the name of the split."""
    return chat_rows(spark, train).withColumn("split", F.lit("train")).unionByName(chat_rows(spark, val).withColumn("split", F.lit("val")))


def json_array(spark: SparkSession, path: str) -> DataFrame:
    """A file that holds one JSON array of flat objects."""
    return spark.read.option("multiLine", True).json(path)


def text_file(spark: SparkSession, path: str) -> str:
    """A small text file as a whole, stripped: a prompt."""
    return spark.read.text(path, wholetext=True).first()["value"].strip()


def config(spark: SparkSession, path: str) -> dict:
    return json.loads(text_file(spark, path))


def pages(df: DataFrame, order: list[str], max_rows: int, page: int = 100) -> DataFrame:
    """What a reader that asks for pages of rows until ``max_rows`` gets, with page numbers: whole pages, so up to one page more is asked for but not returned."""
    from grainmill.operators.card import numbered

    first = df.orderBy(*order).limit(max_rows)
    return numbered(first, order, "_n").withColumn("page", F.expr(f"cast((_n - 1) div {page} as int)")).drop("_n")


def first_match(df: DataFrame, condition: F.Column, order: list[str]):
    """The first row that meets the condition; an error if there is none."""
    row = df.where(condition).orderBy(*order).limit(1).collect()
    if not row:
        raise LookupError("no row meets the condition")
    return row[0]
