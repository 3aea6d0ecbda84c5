"""Writers: chat rows as JSON lines, the data card and the sample."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from grainmill.operators import card, selection


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def json_lines(df: DataFrame, path: str, atomic: bool = True, compression: str = "none") -> None:
    """JSON lines in UTF-8, fields without a value left out.

    With ``atomic`` the rows go to a new folder beside ``path``. The old folder is renamed
    aside, the new one takes its place, and only then the old one goes; where the second
    rename fails, the old folder comes back, so no failure loses it.
    """
    if not atomic:
        df.write.mode("overwrite").option("compression", compression).json(path)
        return
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.option("compression", compression).json(fresh)
    fs, target, jvm = _fs(df.sparkSession, path)
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    old = at(f"{fresh}.old") if fs.exists(target) else None
    if old and not fs.rename(target, old):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(at(fresh), target):
        if old:
            fs.rename(old, target)
        raise OSError(f"{fresh} could not be renamed to {path}")
    if old:
        fs.delete(old, True)


def build(placed: DataFrame, out: str, **notes) -> None:
    """Both splits in shuffled order, a stride sample and the data card under ``out``."""
    for part in ("train", "val"):
        rows = placed.where(placed["split"] == part)
        json_lines(rows.repartitionByRange("place").sortWithinPartitions("place").select("messages", "meta"), f"{out}.{part}.jsonl")
    json_lines(selection.stride_sample(placed).orderBy("place").select("messages", "meta"), f"{out}.sample.jsonl")
    json_lines(card.stamped(card.card(placed, **notes)), f"{out}.card.json")
