"""Order-sensitive selection: positions, scan limits, caps, first-wins deduplication, shuffles and splits.

Small caps and first-wins keep rows by ``row_number``, which Spark limits within each task
before the shuffle, so a hot key or slice costs its limit from every task, not all its rows.
Larger caps count rows by runs of positions first and rank only within runs that reach below
the cap, so no task ranks a slice. Global places of a shuffled table come from hash prefixes:
rows are numbered within a prefix and shifted by the counts of the prefixes before it, at
most 4,096 numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.sources import scratch

PREFIX = 3
#: Caps up to this are limited within each task (Spark's own bound for that), and positions in a run of a larger cap.
IN_TASKS, RUN = 1000, 1 << 16


def with_position(df: DataFrame, name: str = "pos") -> DataFrame:
    """A gapless position in (file, row) order for rows read from Parquet files; nothing is shuffled but counts by file."""
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(sizes.select("_file", before.alias("_before")), "_file").withColumn(name, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def scan_limit(df: DataFrame, n: int | None, position: str = "pos") -> DataFrame:
    """The first n rows of the source, before any filter; all of them without a limit."""
    return df if n is None else df.where(F.col(position) < n)


def cap(df: DataFrame, limit: int | Column, by: list[str], order: list[str | Column], most: int | None = None) -> DataFrame:
    """The first ``limit`` rows of each group in source order.

    ``most`` bounds a limit that is a column. Above `IN_TASKS`, the order must hold a column
    of type long that tells positions; the columns before it are taken as they are.
    """
    most = limit if isinstance(limit, int) else most
    limit = F.lit(limit) if isinstance(limit, int) else limit
    if most is not None and most <= IN_TASKS:
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked.where((F.col("_rank") <= most) & (F.col("_rank") <= limit)).drop("_rank")
    run = []
    for c in order:
        column = F.col(c) if isinstance(c, str) else c
        if isinstance(df.select(column).schema[0].dataType, T.LongType):
            run.append(F.floor(column / RUN))
            break
        run.append(column)
    else:
        raise ValueError("a cap of this size needs a position among its order")
    names = [f"_run{k}" for k in range(len(run))]
    groups = [f"_by{k}" for k in range(len(by))]
    placed = df.withColumns(dict(zip(names, run, strict=True)))
    counts = placed.groupBy(*[F.col(b).alias(g) for b, g in zip(by, groups, strict=True)], *names).agg(F.count(F.lit(1)).alias("_n"))
    # One row for each run of positions that a group reaches.
    before = F.sum("_n").over(Window.partitionBy(*groups).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    starts = starts.withColumnsRenamed({n: f"{n}s" for n in names})
    on = [placed[b].eqNullSafe(starts[g]) for b, g in zip(by, groups, strict=True)] + [placed[n].eqNullSafe(starts[f"{n}s"]) for n in names]
    reached = placed.join(starts, on).where(F.col("_before") < limit)
    ranked = reached.withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy(*by, *names).orderBy(*order)))
    return ranked.where(F.col("_rank") <= limit).select(*df.columns)


def first_wins(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """One row of each key: the first in build order."""
    return cap(df, 1, [key], order)


def dedup_then_cap(candidates: DataFrame, others: DataFrame, limit: int, key: str, order: list[str]) -> DataFrame:
    """A slice that over-generates (its first ``limit`` distinct keys) before slices that come after it.

    Candidates beyond the limit reserve no key, so a later slice may still bring it.
    """
    first = first_wins(candidates, key, order)
    capped = first.withColumn("_one", F.lit(1))
    capped = cap(capped, limit, ["_one"], list(order)).drop("_one")
    return first_wins(capped.unionByName(others), key, order)


def fold(slices: list[tuple[DataFrame, int]], key: str, order: list[str], base: DataFrame | None = None) -> DataFrame:
    """The general form: each slice in turn loses accepted keys, is deduplicated, then capped.

    What a slice brings is written out, since every later slice asks for its keys.
    """
    accepted = base.select(key) if base is not None else None
    out = None
    for df, limit in slices:
        fresh = df if accepted is None else df.join(accepted, key, "left_anti")
        kept = scratch.keep(cap(first_wins(fresh, key, order).withColumn("_one", F.lit(1)), limit, ["_one"], list(order)).drop("_one"), "slice")
        out = kept if out is None else out.unionByName(kept)
        accepted = kept.select(key) if accepted is None else accepted.unionByName(kept.select(key))
    return out


def new_rows(df: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Rows whose key the base does not hold."""
    return df.join(base.select(key).distinct(), key, "left_anti")


def scaled(limit: int, scale: float, least: int = 1) -> int:
    return max(least, int(limit * scale))


def scaled_scan(limit: int | None, scale: float) -> int:
    return scaled(10_000 if limit is None else limit, scale, 50)


def shuffled(df: DataFrame, key: Column | str, seed: int, place: str = "place", total: str = "total") -> DataFrame:
    """Every row with its place in an order that follows from the seed and the key, and the number of rows.

    Rows are written out once, since both the counts by prefix and the rows ask for them.
    """
    key = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(key.cast("string"), F.lit(""))
    mixed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))).withColumn("_k", text).withColumn("_b", F.substring("_h", 1, PREFIX))
    mixed = scratch.keep(mixed, "shuffled")
    counts = mixed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    upto, everything = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select("_b", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"), F.sum("_n").over(everything).alias(total))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", "_k")) - 1
    # One row for each of at most 16 ** PREFIX prefixes.
    return mixed.withColumn("_i", inside).join(F.broadcast(starts), "_b").withColumn(place, (F.col("_start") + F.col("_i")).cast("long")).drop("_h", "_k", "_b", "_start", "_i")


def validation_rows(n: Column, share: float = 0.98, guard: bool = True) -> Column:
    """How many rows go to validation: none of up to twenty with ``guard``, else one at least."""
    held = F.greatest(F.lit(1), F.floor(n * (F.lit(1.0) - F.lit(share))).cast("long"))
    return F.when(n > 20, held).otherwise(F.lit(0).cast("long")) if guard else held


def split(df: DataFrame, key: Column | str, seed: int = 13, share: float = 0.98, guard: bool = True) -> DataFrame:
    """``split``: the head of the shuffled order is validation, the rest training; with ``place`` and ``total``."""
    placed = shuffled(df, key, seed)
    return placed.withColumn("split", F.when(F.col("place") < validation_rows(F.col("total"), share, guard), "val").otherwise("train"))


def stride_sample(placed: DataFrame, rows: int = 30, place: str = "place", total: str = "total") -> DataFrame:
    """Up to ``rows`` rows at even steps of the shuffled order."""
    step = F.greatest(F.lit(1).cast("long"), F.expr(f"{total} div {rows}"))
    return placed.where((F.col(place) % step == 0) & (F.col(place) / step < rows))
