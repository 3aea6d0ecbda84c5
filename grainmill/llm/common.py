"""Shared plumbing: scratch tables in the cluster's shared folder, input loading, widths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.sources import scratch

scratch_root, materialize = scratch.root, scratch.keep


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_safe_text(column: str) -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _give_back() -> None:
    """Return what this process has freed to the system, as allocators keep it for later."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another libc
        pass


def worker_cache(name: str = "") -> dict:
    """A dict that lives as long as this Python worker, for loaded models and word caches.

    Workers serve one operator after another, so asking for one cache drops all others and
    returns their memory to the system; code that keeps nothing calls it without a name.
    """
    import sys
    import types

    home = sys.modules.setdefault("_grainmill_worker_cache", types.ModuleType("_grainmill_worker_cache"))
    held = home.__dict__.setdefault("held", {})
    others = [k for k in held if k != name]
    for other in others:
        del held[other]
    if others:
        _give_back()
    return held.setdefault(name, {}) if name else {}
