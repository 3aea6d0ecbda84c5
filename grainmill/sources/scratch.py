"""Intermediate tables in the shared folder of the cluster, and plans that evaluate a step once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only by sessions of one machine that name no shared folder, as tests may.
LOCAL = "file:///tmp/checkpoints"


def root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; an error on a cluster without one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = LOCAL
    return path.rstrip("/")


def keep(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back.

    This cuts the lineage with files that every executor can read, so a lost executor
    costs a retry of its own tasks only.
    """
    spark = df.sparkSession
    path = f"{root(spark)}/grainmill-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(df: DataFrame) -> DataFrame:
    """The same rows, with columns that later filters and projections read instead of repeating.

    The optimizer moves filters below projections and merges projections, which copies an
    expensive expression into each of its uses. Rows of a one-element array are not merged.
    """
    return df.select(F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("_row")).select("_row.*")
