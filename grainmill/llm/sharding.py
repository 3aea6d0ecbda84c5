"""Reproducible sharding by a Feistel permutation with cycle walking.

Rows are numbered 0..N-1 in ascending order of (id, size, crc): the ids are range
partitioned, each range is numbered on its own and shifted by the sizes of the ranges
before it, so no window sees the whole table. The number i is then permuted: i is written
as (i mod a, i div a) with a = ceil(sqrt(N)), b = ceil(N / a), and rounds of keyed
modular addition alternate between the halves. The domain a*b exceeds N by less than a, so
a result outside 0..N-1 is permuted again until it falls inside (cycle walking), which is
itself a permutation of 0..N-1. Row i goes to shard p mod S at slot p div S: counts differ
by at most one and slots have no gaps. Shard and slot follow from (i, N, S, seed) alone,
without another pass over the data; `permuted` is that function as a column.

Everything is built of DataFrame functions. The text is read once for its size and its
checksum and is not shuffled.

Defined cases: a null text has no bytes (size 1, checksum 0); null ids come first in the
numbering; rows equal in id, size and checksum are interchangeable, so ties do not change
the result as a multiset; an empty table gives an empty result; other input columns are not
read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.common import materialize, shuffle_width

ROUNDS = 4



def _feistel(value: F.Column, a: int, b: int, seed: int) -> F.Column:
    """One pass of the permutation of 0..a*b-1 (a struct keeps each half from being built twice)."""
    state = F.struct((value % a).cast("long").alias("l"), ((value - value % a) / a).cast("long").alias("r"))
    both = F.array(*[F.lit(k) for k in range(ROUNDS)])

    def step(s: F.Column, k: F.Column) -> F.Column:
        digest_l = F.md5(F.concat_ws(":", F.lit(str(seed)), k.cast("string"), s["r"].cast("string")))
        digest_r = F.md5(F.concat_ws(":", F.lit(str(seed)), k.cast("string"), s["l"].cast("string")))
        even = k % 2 == 0
        low = F.when(even, (s["l"] + F.conv(F.substring(digest_l, 1, 15), 16, 10).cast("long") % a) % a).otherwise(s["l"])
        high = F.when(even, s["r"]).otherwise((s["r"] + F.conv(F.substring(digest_r, 1, 15), 16, 10).cast("long") % b) % b)
        return F.struct(low.alias("l"), high.alias("r"))

    return F.aggregate(both, state, step, lambda s: s["r"] * a + s["l"])


def domain(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return a, max(1, -(-rows // a))


def permuted(number: F.Column, rows: int, seed: int = 0) -> F.Column:
    """The place of row ``number`` in the shuffled order of ``rows`` rows.

    A walk passes only through points outside 0..rows-1, so it takes at most a*b - rows
    more steps; beyond 4,096 rows, chains of over 64 such points do not occur (their odds
    are below rows ** -31), and one would raise an error, never a wrong place.
    """
    a, b = domain(rows)
    walks = min(a * b - rows, 64)
    first = _feistel(number, a, b, seed)
    if walks == 0:
        return first
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(walks)), first, lambda p, _: F.when(p < rows, p).otherwise(_feistel(p, a, b, seed))
    )
    return F.when(number.isNull(), None).otherwise(F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("a walk did not end"))))


def number_rows(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``df`` with a gapless global ``row_no`` in ascending ``order``, and its number of rows."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(shuffle_width(spark), *order).withColumn("part_no", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    # One row per range, so at most as many as there are shuffle partitions: a bound for the broadcast.
    counts = ranged.groupBy("part_no").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part_no", before.alias("start"))
    rank = F.row_number().over(Window.partitionBy("part_no").orderBy(*order)) - 1
    numbered = ranged.withColumn("rank", rank).join(F.broadcast(starts), "part_no")
    return numbered.withColumn("row_no", (F.col("start") + F.col("rank")).cast("long")).drop("part_no", "start", "rank"), ranged.count()


def shard_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, seed: int = 0) -> DataFrame:
    """(id, size, text_crc32, row_no, shard, slot) for every row of ``df``."""
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    facts = df.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(raw).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32"))
    numbered, rows = number_rows(facts, ["id", "size", "text_crc32"])
    placed = numbered.withColumn("place", permuted(F.col("row_no"), rows, seed))
    return placed.select(
        "id", "size", "text_crc32", "row_no", (F.col("place") % shards).cast("int").alias("shard"), ((F.col("place") - F.col("place") % shards) / shards).cast("long").alias("slot")
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, seed: int = 0, rows_per_file: int = 1_000_000) -> None:
    """Write whole rows as Parquet under shard=K folders, each in slot order, in files of bounded size."""
    plan = shard_rows(df, id_col, text_col, shards, seed)
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    keyed = df.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), (F.octet_length(raw).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32"))
    order = Window.partitionBy("id", "size", "text_crc32")
    # Rows that tie on all three keys take their places in any order.
    left = keyed.withColumn("tie", F.row_number().over(order.orderBy("text_crc32")))
    right = plan.withColumn("tie", F.row_number().over(order.orderBy("slot", "shard")))
    on = [left[c].eqNullSafe(right[c]) for c in ("id", "size", "text_crc32", "tie")]
    joined = left.join(right, on).select("row", right["shard"].alias("shard"), right["slot"].alias("slot"))
    files = max(shards, -(-plan.count() // rows_per_file))
    joined.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
